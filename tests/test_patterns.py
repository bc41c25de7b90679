"""Nested patterns over VARIANT against cases with their outcome."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.plans import patterns as pt
from tessera.plans.patterns import And, M, Match, Not, Optional, Or, Regex, Required

NoneType = type(None)
#: pattern, values that match, values that do not
CASES = [
    (1, [1, 1.0, True], [2, "1", None, [1]]),
    (None, [None], [0, "", {}]),
    ("a", ["a"], ["b", 1, None]),
    (int, [1, True], [1.5, "1", None]),
    (float, [1.5], [1, "x"]),
    (NoneType, [None], [0]),
    (object, [None, 1, {}, []], []),
    ([int], [[1], []], [["1"], {}, [1, "x"], 1]),
    ([int, str], [[1, "a"]], [[1, 1.5]]),
    ([], [[]], [[1], {}]),
    ((int, str), [[1, "cat"]], [[1, 2], [1], [1, "a", "b"], "x"]),
    ((), [[]], [[1]]),
    ({}, [{}], [{"a": 1}, 1, []]),
    ({str: int}, [{"a": 1, "b": 2}, {}], [{"a": "1"}]),
    ({"a": int}, [{"a": 1}], [{}, {"a": "x"}, {"a": 1, "b": 2}]),
    ({Required(str): int}, [{"x": 1}], [{}]),
    # a plain key takes its key first, which leaves nothing to the required type
    ({"a": int, Required(str): int}, [{"a": 1, "b": 2}], [{"a": 1}]),
    ({Optional("name"): str}, [{}, {"name": "x"}], [{"name": 1}, {"other": "x"}]),
    ({Regex("k.*"): int, str: str}, [{"k1": 1, "z": "s"}], [{"k1": "s"}, {"z": 1}]),
    ({M > "m": int, object: str}, [{"z": 1, "a": "x"}], [{"z": "x"}]),
    ({"a": {"b": [{"c": Or(int, "x")}]}}, [{"a": {"b": [{"c": 1}, {"c": "x"}]}}], [{"a": {"b": [{"c": 1}, {"c": "y"}]}}]),
    (M > 0, [1, 1.5, True], [0, -1, "a", None, []]),
    (M != 1, [2, "1", None, [1]], [1, True, 1.0]),
    (M == M, [1, None, "x", [1], {"a": 1}], []),
    (M("a") == M("b.0"), [{"a": 1, "b": [1]}, {"a": "x", "b": ["x"]}], [{"a": 1, "b": [2]}, {"a": 1, "b": ["1"]}]),
    (M, [1, "a", [0], {"a": 0}, True], [0, "", [], {}, False, None]),
    (M("a"), [{"a": 1}], [{"a": False}, {}, 1]),
    ((M > 0) & float, [1.5], [1, -1.5]),
    ((M > 100) | float, [1.5, 101], [1]),
    (~(M > 3), [1, "x"], [4]),
    (Not("a"), ["b", 1], ["a"]),
    (And(str, Regex("[^@]+@[^@]+")), ["a@b"], ["a", 1, "a@b@c"]),
    (Regex("b", "search"), ["abc"], ["ac", None]),
    (Regex("b", "match"), ["bc"], ["ab"]),
    (M == 9007199254740993, [9007199254740993], [9007199254740992]),
    (Match(int, default=3), [1, "x", None], []),
]


@pytest.mark.parametrize("at", range(len(CASES)))
def test_matches(spark, at):
    pattern, good, bad = CASES[at]
    df = spark.createDataFrame([(json.dumps(v), i < len(good)) for i, v in enumerate([*good, *bad])], "v string, want boolean")
    got = df.select("v", "want", pt.failure(F.parse_json("v"), pattern).alias("why")).collect()
    assert [(r["v"], r["why"]) for r in got if (r["why"] is None) != r["want"]] == []


def test_first_failure_and_defaults(spark):
    pattern = {"id": And(M > 0, int), "tags": [str], Optional("lang", default="en"): str, Optional("box"): {Optional("n", default=[1]): list, str: object}}
    values = ['{"id": 1, "tags": []}', '{"id": 1, "tags": ["a", 3], "x": 1}', '{"tags": [], "lang": 5}', '{"id": 0, "tags": []}', '{"tags": []}', '{"id": 2, "tags": ["b"], "box": {"k": null}}', None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("v", F.parse_json("v"))
    got = df.select("i", pt.failure(F.col("v"), pattern).alias("why"), F.to_json(pt.matched(F.col("v"), pattern)).alias("value")).orderBy("i").collect()
    assert [r["why"] for r in got] == [None, "$.tags[1]: expected str, got int", "$.lang: expected str, got int", "$.id: M > 0 does not hold", "$: missing 'id'", None, "$: expected dict, got null"]
    assert json.loads(got[0]["value"]) == {"id": 1, "tags": [], "lang": "en"}
    assert json.loads(got[5]["value"]) == {"id": 2, "tags": ["b"], "lang": "en", "box": {"k": None, "n": [1]}}
    one = df.select(F.to_json(pt.matched(F.col("v"), Match({"id": 1, "tags": list}, default={"no": 1}))).alias("v"), "i").orderBy("i").collect()
    assert [json.loads(r["v"]) for r in one[:2]] == [{"id": 1, "tags": []}, {"no": 1}]


def test_wrong_patterns():
    for outer in (Required, Optional):
        with pytest.raises(TypeError):
            outer(Optional("key"))
    for wrong in (lambda: Required("key"), lambda: Optional(str), lambda: And(), lambda: Or()):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(TypeError):
        M(3)
    assert [pt.precedence(k) for k in ("a", Optional("a"), (), M > 1, Required(Regex("x")), str, (1, str))] == [0, 0, 0, 1, 1, 2, 2]
