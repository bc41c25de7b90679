"""Golden cases of the operators on small tables (FIXTURES.md, part A)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import graph as gr
from tessera.operators import joins as jn
from tessera.operators import ranges as rg
from tessera.operators import ranking as rk
from tessera.operators import rules as ru
from tessera.operators import selection as sl
from tessera.operators import sequences as sq
from tessera.operators import textgates as tg
from tessera.plans import registry


def seq(spark, values, kind="long"):
    return spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], f"g int, ord long, v {kind}")


def values(df, col="v", order="ord"):
    return [r[col] for r in df.orderBy(order).collect()]


def test_chunks(spark):
    s = seq(spark, range(10))
    got = lambda **k: [r["chunk"] for r in sq.chunks(s, ["g"], "ord", "v", 3, **k).orderBy("no").collect()]
    assert got() == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    assert got(pad=-1)[-1] == [9, -1, -1]
    assert got(drop_short=True) == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]


def test_sliding(spark):
    assert [r["window"] for r in sq.sliding_window(seq(spark, range(4)), ["g"], "ord", "v", 2).orderBy("ord").collect()] == [[0, 1], [1, 2], [2, 3]]


@pytest.mark.parametrize(("kwargs", "want"), [({}, [[1, 2], [3], [4]]), ({"keep_empty": True}, [[1, 2], [3], [4]]), ({"maxsplit": 2}, [[1, 2], [3], [4, None]])])
def test_split(spark, kwargs, want):
    s = seq(spark, [1, 2, None, None, 3, None, 4, None])
    got: dict = {}
    for r in sq.split(s, ["g"], "ord", F.col("v").isNull(), **kwargs).orderBy("ord").collect():
        got.setdefault(r["part"], []).append(r["v"])
    assert [got[k] for k in sorted(got)] == want


def test_split_keeps_empty_parts(spark):
    s = seq(spark, [1, 2, None, None, 3, None, 4, None])
    assert {r["part"] for r in sq.split(s, ["g"], "ord", F.col("v").isNull(), keep_empty=True).collect()} == {0, 2, 3}


def test_while(spark):
    s = seq(spark, [3, 2, 0, 1])
    assert values(sq.take_while(s, ["g"], "ord", F.col("v") != 0)) == [3, 2]
    assert values(sq.drop_while(seq(spark, [0, 0, 3, 2, 0]), ["g"], "ord", F.col("v") < 1)) == [3, 2, 0]


def test_unique(spark):
    assert "".join(values(sq.unique(seq(spark, "abBAcaCd", "string"), ["g"], "ord", F.lower("v")))) == "abcd"


def test_top_k_is_stable(spark):
    assert values(sq.top_k(seq(spark, [1, 100, 10, 1000]), ["g"], F.col("v"), "ord", 2), order="rank") == [1000, 100]
    assert values(sq.top_k(seq(spark, ["Alice", "Bob", "Charlie", "Dan"], "string"), ["g"], F.length("v"), "ord", 4), order="rank") == ["Charlie", "Alice", "Bob", "Dan"]


def test_ordinals_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(v,) for v in random.Random(3).sample(range(1000), 200)], "v long")
    a = {r["v"]: r["ord"] for r in sq.with_ordinals(df, ["v"], partitions=3).collect()}
    b = {r["v"]: r["ord"] for r in sq.with_ordinals(df.repartition(7), ["v"], partitions=5).collect()}
    assert a == b and sorted(a.values()) == list(range(200)) and sorted(a, key=a.get) == sorted(a)


def test_ordinals_of_more_rows_than_the_sample_of_ranges(spark):
    rows = spark.range(20_000).select(F.pmod(F.col("id") * 7919, F.lit(20_000)).alias("v"), F.col("id").alias("other")).repartition(6)
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    spark.conf.set(name, "4")
    try:
        got = sq.with_ordinals(rows, ["v"], partitions=12).collect()
    finally:
        spark.conf.unset(name)
    assert len(got) == 20_000 and all(r["ord"] == r["v"] for r in got)


def test_join_family(spark):
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, label string")
    fruit = spark.createDataFrame([("apple", 1), ("orange", 1), ("banana", 2), ("coconut", 2)], "fruit string, fid int")
    assert jn.join(names, fruit, [("id", "fid")]).count() == 4
    repeated = names.union(spark.createDataFrame([(1, "uno"), (2, "dos")], "id int, label string"))
    assert jn.join(repeated, fruit, [("id", "fid")]).count() == 8
    a, b = (spark.createDataFrame([(x,) for x in v], f"{c} int") for v, c in (([1, 2, 3], "a"), ([2, 3, 4], "b")))
    assert {tuple(r) for r in jn.join(a, b, [("a", "b")], "full", {"a": -1, "b": -2}).collect()} == {(2, 2), (3, 3), (-1, 4), (1, -2)}
    n = spark.createDataFrame([(None,), (1,)], "a int")
    m = spark.createDataFrame([(None,), (2,)], "b int")
    assert jn.join(n, m, [("a", "b")]).count() == 1 and jn.absent(n, m, [("a", "b")]).count() == 1 and jn.present(n, m, [("a", "b")]).count() == 1


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_groups_are_summed_before_they_meet(spark, tmp_path, how):
    """m and n rows of a key are one row each when they meet; null keys meet, and missing sides count as told."""
    c = [(i, (None if i % 5 == 0 else i % 4), 1.0 if i % 7 else -1.0) for i in range(90)]
    s = [(i, i % 6 + 2, 3000.0 if i % 3 else 0.0) for i in range(50)]
    spark.createDataFrame(c, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(s, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    left = [(k if b >= 0 else None, i) for i, k, b in c]
    right = [(k if b >= 2000 else None, i) for i, k, b in s]
    pairs = [(a, b, i, j) for a, i in left for b, j in right if a == b]
    pairs += [(a, None, i, -2) for a, i in left if how in ("left", "full") and a not in {b for b, _ in right}]
    pairs += [(None, b, -1, j) for b, j in right if how in ("right", "full") and b not in {a for a, _ in left}]
    want = {(a, b): (0, 0, 0) for a, b, _, _ in pairs}
    for a, b, i, j in pairs:
        n, x, y = want[a, b]
        want[a, b] = (n + 1, x + i, y + j)
    df = registry.queries()[f"join_28_{how}_null_safe"](spark, str(tmp_path))
    got = df.collect()
    assert len(got) == len(want) and {(r["k"], r["k2"]): (r["n"], r["custs"], r["supps"]) for r in got} == want
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_positional_diff(spark):
    a, b = seq(spark, [1, 2, 3]), seq(spark, [1, 5])
    assert [(r["ord"], r["v0"], r["v1"]) for r in jn.positional_diff([a, b], ["g"], "ord", "v").collect()] == [(1, 2, 5)]
    assert [(r["ord"], r["v1"]) for r in jn.positional_diff([a, b], ["g"], "ord", "v", pad=0, padded=True).orderBy("ord").collect()] == [(1, 5), (2, 0)]


def test_interval_join_buckets_give_the_same_pairs(spark):
    rng = random.Random(1)
    points = spark.createDataFrame([(k % 3, k, rng.randrange(500)) for k in range(200)], "f int, p int, at int")
    spans = spark.createDataFrame([(k % 3, k, (s := rng.randrange(450)), s + rng.randrange(120)) for k in range(60)], "f int, s int, lo int, hi int")
    plain, cut = (sorted((r["p"], r["s"]) for r in rg.interval_join(points, spans, ["f"], "at", "lo", "hi", bucket).collect()) for bucket in (None, 17))
    assert plain == cut and plain


def test_ratios(spark):
    lines = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True)], "file string, line int, hit boolean")
    spans = spark.createDataFrame([("a", "f", 1, 2), ("a", "g", 3, 3), ("a", "none", 8, 9), ("b", "far", 1, 4)], "file string, fn string, lo int, hi int")
    assert {r["fn"]: r["pct"] for r in rg.ratio_by_span(lines, spans, ["file"], "line", "lo", "hi", ["fn"], F.col("hit")).collect()} == {"f": 50.0, "g": 100.0}
    got = {r["fn"]: (r["ratio"], r["measured"]) for r in rg.uncovered_ratio(lines, spans, ["file"], "line", "lo", "hi", ["fn"], F.col("hit")).collect()}
    assert got == {"f": (0.5, 2), "g": (0.0, 1), "none": (None, 0), "far": (1.0, 4)}


def test_first_rule_wins(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None)], "id int, n int")
    rules = [ru.Rule("zero", F.col("n") == 0), ru.Rule("big", F.col("n") > 3, F.concat(F.col("n"), F.lit(">3"))), ru.Rule("later", F.col("id") == 1)]
    assert {r["id"]: (r["reason"], r["status"]) for r in ru.funnel(df, rules).collect()} == {1: ("big(5>3)", "rejected"), 2: ("zero", "rejected"), 3: (None, "candidate")}
    assert {r["key"]: r["n"] for r in ru.status_histogram(ru.funnel(df, rules)).collect()} == {"rejected:big": 1, "rejected:zero": 1, "candidate": 1}


def test_sample_budget(spark):
    df = spark.createDataFrame([(t, i) for t in "abc" for i in range(5)], "t string, k int")
    assert rk.stratified_sample(df, "t", ["k"], 0).count() == 3
    assert [(r["t"], r["k"]) for r in rk.stratified_sample(df, "t", ["k"], 4).orderBy("t", "k").collect()] == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_folds(spark):
    cost = spark.createDataFrame([("CA", 0, 200), ("CA", 1, 1000), ("IL", 2, 2100)], "s string, ord int, c int")
    add = ag.reduce_by(cost, ["s"], "ord", "c", lambda a, x: a + x)
    assert {r["s"]: r["value"] for r in add.collect()} == {"CA": 1200, "IL": 2100}
    minus = ag.reduce_by(cost, ["s"], "ord", "c", lambda a, x: a - x, F.lit(0))
    assert {r["s"]: r["value"] for r in minus.collect()} == {"CA": -1200, "IL": -2100}


def test_merge_maps(spark):
    m = spark.createDataFrame([(0, 0, {"a": 1, "b": 2}), (0, 1, {"a": 3})], "g int, ord int, m map<string,int>")
    assert {r["key"]: r["merged"] for r in ag.merge_maps(m, ["g"], "ord", "m").collect()} == {"a": 3, "b": 2}
    assert {r["key"]: r["merged"] for r in ag.merge_maps(m, ["g"], "ord", "m", lambda v: F.aggregate(v, F.lit(0), lambda a, x: a + x)).collect()} == {"a": 4, "b": 2}


def test_precision_is_null_without_decisions(spark):
    v = spark.createDataFrame([("x", "confirmed"), ("x", "mismatch"), ("x", "confirmed"), ("y", "unverifiable")], "t string, verdict string")
    assert {r["t"]: (r["precision"], r["other"]) for r in ag.precision(v, "t", "verdict", "confirmed", "mismatch").collect()} == {"x": (0.667, 0), "y": (None, 1)}


def test_graph(spark):
    nodes = spark.createDataFrame([("m",), ("f",)], "id string")
    edges = gr.union_edges({"contains": spark.createDataFrame([("m", "f"), ("m", "f")], "source string, target string"), "calls": spark.createDataFrame([("f", "lib.x"), ("ghost", "f")], "source string, target string")})
    kept = gr.without_dangling(edges, nodes)
    assert {(r["type"], r["source"], r["target"]) for r in kept.collect()} == {("contains", "m", "f"), ("calls", "f", "lib.x")}
    assert {r["id"]: r["neighbours"] for r in gr.adjacency(edges, ["calls"], reverse=True).collect()} == {"lib.x": ["f"], "f": ["ghost"]}
    assert {r["id"]: r["depth"] for r in gr.reachable(edges, spark.createDataFrame([("m",)], "id string"), 3).collect()} == {"m": 0, "f": 1, "lib.x": 2}


def pool(spark, order=None):
    rows = [(f"hist-{i:02d}", "history", "abcdefg"[i % 7], ("easy", "medium", "hard")[i % 3], 10 - i, True) for i in range(10)]
    rows += [(f"exc-{i}", "excision", "abcdefg"[i], ("medium", "hard")[i % 2], 8 - i, True) for i in range(5)]
    rows += [(f"net-{i}", "net-new", "a", "medium", 3, True) for i in range(2)]
    if order is not None:
        random.Random(order).shuffle(rows)
    return spark.createDataFrame(rows, "id string, type string, module string, difficulty string, weight int, eligible boolean")


QUOTAS = sl.Quotas(10, {"history": 5}, {"excision": 3, "net-new": 1}, modules=6, spread={"easy": 3, "medium": 4, "hard": 3})


def test_selection(spark):
    chosen = {r["id"]: r for r in sl.select(pool(spark), QUOTAS).where("selected").collect()}
    assert len(chosen) == 10 and len({r["module"] for r in chosen.values()}) >= 6
    assert sum(r["type"] == "history" for r in chosen.values()) >= 5 and sum(r["type"] == "excision" for r in chosen.values()) <= 3
    for order in (1, 2):
        assert {r["id"] for r in sl.select(pool(spark, order), QUOTAS).where("selected").collect()} == set(chosen)


def test_selection_pool_loses_nothing(spark):
    rng = random.Random(5)
    for trial in range(6):
        hot = [("a" if rng.random() < 0.7 else "b" if rng.random() < 0.7 else rng.choice(["c", "d", "e", "", None])) for _ in range(120)]
        rows = [(i, rng.choice("xy"), m, rng.choice(["easy", "hard"]), rng.randrange(40) / 4 + 50 * (m in ("a", "b"))) for i, m in enumerate(hot)]
        df = spark.createDataFrame(rows, "id long, type string, module string, difficulty string, weight double")
        q = sl.Quotas(total=4, floors={"x": 1}, caps={"x": 3, "y": 3}, modules=2 + trial % 3, spread={"easy": trial % 5, "hard": 4 - trial % 5})
        every = [r.asDict() for r in df.collect()]
        chosen = [r.asDict() for r in sl.greedy(df, q).collect()]
        pool = sl._pool(df, q)
        assert len(pool) < len(every)

        def repaired(rows, chosen=chosen, q=q):
            return [r["id"] for r in sl.repair_spread(sl.repair_modules(chosen, rows, q), rows, q)]

        assert repaired(pool) == repaired(every)


@pytest.mark.parametrize("quotas", [sl.Quotas(10, {"history": 11}), sl.Quotas(18), sl.Quotas(10, modules=9)])
def test_infeasible_quotas_raise(spark, quotas):
    with pytest.raises(sl.InfeasibleError):
        sl.select(pool(spark), quotas)


def test_shortlist_prefers_new_modules(spark):
    df = spark.createDataFrame([("a1", "a", 5.0, 0), ("a2", "a", 4.9, 1), ("b1", "b", 4.6, 2)], "id string, module string, score double, ord long")
    assert [r["id"] for r in sl.shortlist(df, 2, 0.5).orderBy("place").collect()] == ["a1", "b1"]


def test_text_gates(spark):
    lines = tg.lines_with_tokens(spark.createDataFrame([(1, "return  a + b\nshort\n  x = call(a, b)  ")], "id int, text string"), ["id"], "text", 4)
    texts = spark.createDataFrame([(7, "we say return a + b here"), (8, "nothing"), (9, "then x = call(a, b)")], "t int, body string")
    assert {(r["line"], r["t"]) for r in tg.contained_lines(lines, texts, "line", "body", 3).collect()} == {("return a + b", 7), ("x = call(a, b)", 9)}
    row = spark.createDataFrame([("use helper_fn and other",)], "text string")
    names = lambda *x: F.array(*[F.lit(n) for n in x])
    assert row.select(tg.leaked_names(F.col("text"), names("helper_fn", "other", "ab"), names("other"), 3).alias("x")).first()["x"] == ["helper_fn"]
    assert row.select(tg.mask(F.col("text"), ["helper", "helper_fn"]).alias("x")).first()["x"] == "use [...] and other"


def test_selection_pool_holds_a_rare_module(spark):
    """Only module c helps: rows of a and without a module come first, and cost a module or break a floor."""
    rows = [(0, "y", "a", "easy", 100.0), (1, "x", "b", "easy", 99.0), (2, "x", "a", "hard", 50.0), (3, "x", "a", "hard", 49.0), (4, "x", "", "hard", 48.0), (5, "x", "", "hard", 47.0)]
    rows += [(10 + i, "x", f"d{i}", "easy", 40.0 - i) for i in range(12)] + [(30, "x", "c", "hard", 1.0)]
    df = spark.createDataFrame(rows, "id long, type string, module string, difficulty string, weight double")
    q = sl.Quotas(total=2, floors={"y": 1}, caps={"x": 1}, modules=2, spread={"easy": 1, "hard": 1})
    chosen = sl.select(df.withColumn("eligible", F.lit(True)), q).where("selected")
    assert sorted(r["id"] for r in chosen.collect()) == [0, 30]
