"""The golden commit history, the function funnel, failure reasons and verdicts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.plans import funnels as fn

COMMIT = "repo string, ord long, sha string, parents array<string>, message string, is_merge boolean, pr_number int, files_changed array<string>, source_lines int, test_files_touched array<string>, touches_manifest boolean, touched_functions array<string>, parses boolean"


def commit(ord_, sha, message, parents=("p",), files=("src/a.py",), lines=5, tests=(), functions=("m.f",), manifest=False, merge=False, pr=None, parses=True):
    return ("r", ord_, sha, list(parents), message, merge, pr, list(files), lines, list(tests), manifest, list(functions), parses)


HISTORY = [
    commit(0, "a" * 40, "Merge pull request #3", parents=("b" * 40, "c" * 40), merge=True, pr=3),
    commit(1, "c" * 40, "Accept inverted bounds", parents=("d" * 40,)),
    commit(2, "b" * 40, "Fix ceil_div off-by-one", parents=("d" * 40,), files=("src/a.py", "tests/t.py"), tests=("tests/t.py",), lines=3),
    commit(3, "d" * 40, "docs: add README", files=("README.md", "docs/x.py"), parents=("e" * 40,)),
    commit(4, "e" * 40, "Use wcwidth", manifest=True, parents=("f" * 40,)),
    commit(5, "f" * 40, "Add geometry", functions=("g.area",), parents=("1" * 40,)),
    commit(6, "1" * 40, "Test clamp", files=("tests/t.py",), tests=("tests/t.py",), parents=("2" * 40,)),
    commit(7, "2" * 40, "Revert \"x\"\n\nThis reverts commit 3333333.", parents=("3" * 40,)),
    commit(8, "3" * 40, "Change x", parents=("4" * 40,)),
    commit(9, "4" * 40, "Big", lines=301, parents=("5" * 40,)),
    commit(10, "5" * 40, "Many", files=tuple(f"s{i}.py" for i in range(7)), parents=("6" * 40,)),
    commit(11, "6" * 40, "Small", lines=2, parents=("7" * 40,)),
    commit(12, "7" * 40, "Broken", parses=False, parents=("8" * 40,)),
    commit(13, "8" * 40, "Merge branch", merge=True, parents=("9" * 40, "x")),
    commit(14, "9" * 40, "Empty", files=(), parents=("0" * 40,)),
    commit(15, "0" * 40, "Initial", parents=()),
]


@pytest.fixture(scope="module")
def judged(spark):
    covered = spark.createDataFrame([("m.f",)], "qualname string")
    return fn.commit_funnel(spark.createDataFrame(HISTORY, COMMIT), covered)


def test_commit_reasons(judged):
    got = {r["ord"]: r["reason"] for r in judged.collect()}
    assert got == {
        0: None, 1: None, 2: None, 3: "docs-or-ci-only", 4: "dependency-changing", 5: "uncovered-and-no-tests", 6: "no-source-change", 7: None, 8: "reverted-by(2222222)",
        9: "too-large(301>300)", 10: "too-many-files(7>6)", 11: "too-small(2<3)", 12: "unparseable", 13: "non-pr-merge", 14: "docs-or-ci-only", 15: "root-commit",
    }


def test_threshold_knob(spark):
    covered = spark.createDataFrame([("m.f",)], "qualname string")
    got = fn.commit_funnel(spark.createDataFrame(HISTORY, COMMIT), covered, fn.CommitLimits(min_lines=4)).where("ord = 2").first()
    assert got["reason"] == "too-small(3<4)"


def test_scores(spark, judged):
    public = spark.createDataFrame([("m.f", True)], "qualname string, is_public boolean")
    got = {r["ord"]: (r["score"], r["score_breakdown"]) for r in fn.score_commits(judged.where("status = 'considered'"), public).collect()}
    assert got[2] == (5.0, {"fix_keyword": 1.0, "adds_tests": 2.0, "public_fn": 1.0, "single_function": 1.0}) and got[1][0] == 2.0 and got[0][0] == 3.0
    assert [r["ord"] for r in fn.order_candidates(fn.score_commits(judged.where("status = 'considered'"), public)).orderBy("place").collect()][0] == 2


def test_constituents_of_kept_merges_go(spark):
    rows = [(*r[:1], r[1], r[2], r[3], r[5], "kept" if r[1] in (0, 1, 2) else "rejected", None) for r in HISTORY]
    df = spark.createDataFrame(rows, "repo string, ord long, sha string, parents array<string>, is_merge boolean, status string, reason string")
    assert {r["ord"]: r["reason"] for r in fn.supersede(df).where("reason is not null").collect()} == {1: "superseded-by-merge(aaaaaaa)"}
    unkept = df.withColumn("status", F.when(F.col("ord") == 0, "rejected").otherwise(F.col("status")))
    assert fn.supersede(unkept).where("reason is not null").count() == 0


def test_classification(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "sha string")
    said = spark.createDataFrame([("a", "bugfix", True, True), ("b", "docs", True, True), ("c", "feature", False, True)], "sha string, kind string, self_contained boolean, verifiable boolean")
    assert {r["sha"]: (r["status"], r["reason"]) for r in fn.classify_commits(df, said).collect()} == {"a": ("kept", None), "b": ("rejected", "kind:docs"), "c": ("rejected", "not-self-contained"), "d": ("rejected", "classify-no-answer")}


def test_function_funnel(spark):
    f = lambda name, **k: {"qualname": f"p.m.{name}", "module": "p.m", "file": "p/m.py", "name": name, "parent": None, "is_method": False, "line": 1, "end_line": 20, "complexity": 4} | k
    functions = [f("good"), f("_hidden"), f("rare"), f("short", end_line=3), f("long", end_line=200), f("simple", complexity=1), f("none"), f("init", file="p/__init__.py"), f("method", qualname="p.m._C.method", parent="p.m._C", is_method=True), f("t", module="tests.x"), f("bad")]
    df = spark.createDataFrame([tuple(x.values()) for x in functions], "qualname string, module string, file string, name string, parent string, is_method boolean, line int, end_line int, complexity int")
    tests = [(x["qualname"], f"tests/{'q' if x['name'] == 'bad' else 't'}.py::t{k}") for x in functions for k in range({"rare": 1, "none": 0}.get(x["name"], 3))]
    got = fn.function_funnel(
        df, spark.createDataFrame(tests, "qualname string, test string"), spark.createDataFrame([("p.m", False, True), ("tests.x", True, False)], "module string, is_test boolean, is_source boolean"),
        spark.createDataFrame([("p.m._C", False)], "qualname string, is_public boolean"), spark.createDataFrame([("tests/q.py", ["_x", "_y"])], "test_file string, names array<string>"),
    )
    assert {r["name"]: r["reason"] for r in got.collect()} == {
        "good": None, "_hidden": "private", "rare": "few-covering-tests(1<2)", "short": "too-short(3<8)", "long": "too-long(200>80)", "simple": "low-complexity(1<3)", "none": "uncovered",
        "init": "init-module", "method": "private-parent", "t": "test-code", "bad": "verifier-imports-private(tests/q.py: _x, _y)",
    }
    assert got.where("name = 'good'").first()["score"] == 12


def test_target_and_gate_chains(spark):
    t = spark.createDataFrame([("__init__", True, "a.py", "m", 1, 9, True, 1, 3), ("main", False, "a.py", "m", 1, 9, True, 1, 3), ("f", False, "a.py", "m", 1, 2, True, 1, 3), ("_f", False, "a.py", "m", 1, 9, False, 1, 3), ("g", False, "a.py", "m", 1, 9, True, 1, 0), ("h", False, "a.py", "m", 1, 9, True, 1, 3)], "name string, is_method boolean, file string, module string, line int, end_line int, is_public boolean, complexity int, measurable int")
    assert [r[0] for r in t.select(fn.test_target_reason(3, 4)).collect()] == ["dunder", "cli_main", "too_small", "private_low_complexity", "no_executable_lines", None]
    g = spark.createDataFrame([(True, False, False, False, False, [], 2, True, False), (True, False, False, False, False, ["ImportError"], 2, True, False), (True, False, False, False, False, [], 0, True, False), (True, False, False, False, False, [], 2, False, True), (False, True, False, False, False, [], 2, True, False)], "has_tests boolean, private_imports boolean, drifted boolean, missing_symbol boolean, solution_failed boolean, input_reasons array<string>, n_failing int, neutral boolean, rewritten boolean")
    assert [r[0] for r in g.select(fn.build_gate_reason(1)).collect()] == [None, "verifier-on-input(ImportError)", "tests-pass-on-input", "neutrality-rewrite-failed", "no-tests-in-commit"]


def test_failure_reasons(spark):
    rows = [("E AssertionError", "assert 1 == 2", "call", 0, True), ("Failed: DID NOT RAISE", None, "call", 0, True), ("NotImplementedError: excised", None, "call", 1, False), ("KeyError: 1", "KeyError", "call", 2, False), ("ImportError: x", None, "call", 0, True), ("fixture 'db' not found", None, "setup", 0, True), ("KeyError", "KeyError", "call", 0, True)]
    df = spark.createDataFrame(rows, "text string, crash string, phase string, frames int, test boolean")
    got = [r[0] for r in df.select(fn.failure_reason(F.col("text"), F.col("crash"), F.col("phase"), F.col("frames"), F.col("test"))).collect()]
    assert got == ["AssertionError", "pytest.raises", "NotImplementedError", "exception_in_repo_code", "ImportError", "fixture_not_found", "error_before_repo_call"]


def test_verdicts(spark):
    reasons = spark.createDataFrame([(1, "a", "AssertionError"), (1, "b", "pytest.raises"), (2, "a", "ImportError")], "report int, nodeid string, reason string")
    reports = spark.createDataFrame([(1, 3, 1), (2, 1, 0), (3, 0, 0), (4, None, None), (5, 2, 2)], "report int, collected int, n_passing int")
    got = {r["report"]: (r["n_failing"], r["invalid"], r["ok"]) for r in fn.verdicts(reasons, reports).collect()}
    assert got == {1: (2, [], True), 2: (1, ["ImportError"], False), 3: (0, ["collected_0_items"], False), 4: (0, ["no_report"], False), 5: (0, ["no_failing_test"], False)}
    with pytest.raises(Exception, match="unknown reason"):
        fn.verdicts(reasons.withColumn("reason", F.lit("odd")), reports).collect()
    runs = spark.createDataFrame([("x", 1, "a", "f"), ("x", 2, "a", "f"), ("y", 1, "a", "f"), ("y", 2, "a", "p")], "phase string, run int, nodeid string, outcome string")
    assert {r["phase"]: r["identical"] for r in fn.outcomes_identical(runs, ["phase"]).collect()} == {"x": True, "y": False}
