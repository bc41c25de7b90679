from __future__ import annotations

from tessera.plans import report as rp


def test_missing_artifacts_are_listed_not_invented(spark):
    build = spark.createDataFrame([(3, "ok")], "n int, state string")
    row = rp.assemble(spark, {"build": build, "lint": None, "pin": build.limit(0), "detect": None}).first()
    assert row["build"]["n"] == 3 and row["pin"] is None and row["missing"] == ["detect", "lint", "pin"] and "lint" not in row


def test_summaries(spark):
    m = spark.createDataFrame([(9, 10), (5, 6)], "killed long, valid long")
    assert tuple(rp.mutation_summary(m).first()) == (14, 16, 0.875) and rp.mutation_summary(m.limit(0)).first()["score"] is None
    tokens = rp.token_summary(spark.createDataFrame([("a", 5), ("b", 7), ("a", 1)], "step string, tokens long"), spark.createDataFrame([("a", "big")], "step string, tier string"))
    assert {r["tier"]: r["tokens"] for r in tokens.collect()} == {"big": 6, "other": 7}
    runs = rp.run_summary(spark.createDataFrame([("x", "ok"), ("x", "fail")], "stage string, outcome string"))
    assert {(r["dimension"], r["key"]): r["n"] for r in runs.collect()} == {("stage", "x"): 2, ("outcome", "ok"): 1, ("outcome", "fail"): 1, ("all", None): 2}
    table = rp.markdown_table(spark.createDataFrame([("b", None), ("a", 1)], "k string, n int"), ["k", "n"], ["k"]).first()["table"]
    assert table == "| k | n |\n| --- | --- |\n| a | 1 |\n| b | - |"
