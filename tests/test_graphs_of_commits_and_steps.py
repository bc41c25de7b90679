"""Ranges of commit graphs and hashes of dependent steps against plain walks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ancestry
from tessera.plans import funnels, ledger, steps


def history(repo: str, n: int, seed: int, merge: float, far: int):
    """(repo, sha, parents, level): a main line with branches; parents may lie far back, and some are no commits of the table."""
    rng = random.Random(seed)
    rows, tips = [], []
    for i in range(n):
        parents = [f"{repo}{rng.choice(tips[-3:])}"] if tips else []
        if tips and rng.random() < merge:
            parents.append(f"{repo}{rng.choice(tips[-far:])}")
        if rng.random() < 0.01:
            parents.append("elsewhere")
        rows.append((repo, f"{repo}{i}", list(dict.fromkeys(parents)), i))
        tips.append(i)
    return rows


def plain_range(parents: dict, a: str, b: str) -> set:
    def reach(start):
        seen, todo = set(), [start]
        while todo:
            x = todo.pop()
            if x in parents and x not in seen:
                seen.add(x)
                todo += parents[x]
        return seen

    return reach(b) - reach(a)


COMMIT = "repo string, sha string, parents array<string>, level long"


@pytest.mark.parametrize(("sizes", "merge", "far"), [((4000, 3000, 3000), 0.2, 12), ((60, 5), 0.6, 40)])
def test_ranges_equal_walks(spark, sizes, merge, far):
    rows = [r for k, n in enumerate(sizes) for r in history(f"r{k}-", n, k, merge, far)]
    wanted = [(repo, f"m{sha}", p[0], p[1]) for repo, sha, p, _ in rows if len(p) > 1 and p[1] != "elsewhere"]
    wanted += [("r0-", "same", "r0-30", "r0-30"), ("r0-", "lost", "r0-3", "nowhere"), ("r0-", "all", "nowhere", "r0-40"), ("r1-", "back", "r1-4", "r1-2"), ("r1-", "other repo", "r0-1", "r1-2")]
    got: dict = {}
    df = spark.createDataFrame(rows, COMMIT).repartition(6, "sha")
    for r in ancestry.ranges(df, spark.createDataFrame(wanted, "repo string, range string, a string, b string")).collect():
        assert r["sha"] not in got.setdefault((r["repo"], r["range"]), set())
        got[r["repo"], r["range"]].add(r["sha"])
    parents = {repo: {s: p for at, s, p, _ in rows if at == repo} for repo in {r[0] for r in rows}}
    for repo, name, a, b in wanted:
        assert got.get((repo, name), set()) == plain_range(parents[repo], a, b), name


def test_a_long_run_is_one_place(spark):
    """A linear history of thousands takes as many steps as one of ten, and a range that begins inside it is exact."""
    n = 5000
    rows = [("r", f"c{i}", [f"c{i - 1}"] if i else [], i) for i in range(n)] + [("r", "side", ["c10"], 11)]
    df = spark.createDataFrame(rows, COMMIT)
    wanted = spark.createDataFrame([("r", "x", "c100", "c4999"), ("r", "y", "side", "c4000"), ("r", "z", "c4999", "side")], "repo string, range string, a string, b string")
    got = {r["range"]: r["count"] for r in ancestry.ranges(df, wanted).groupBy("range").count().collect()}
    assert got == {"x": n - 101, "y": 3990, "z": 1}
    edges = ancestry.parent_edges(df, "repo")
    assert ancestry.runs(df, edges, wanted.select("repo", F.col("a").alias("sha")), "repo").select("run").distinct().count() < 10


def test_supersession_takes_the_last_merge(spark):
    rows = [("r", 0, "m2", ["m1", "b2"], True, "kept"), ("r", 1, "m1", ["a", "b2"], True, "kept"), ("r", 2, "b2", ["b1"], False, "kept"), ("r", 3, "b1", ["a"], False, "considered"), ("r", 4, "a", [], False, "kept"), ("s", 0, "m", ["a", "b1"], True, "rejected")]
    df = spark.createDataFrame(rows, "repo string, ord long, sha string, parents array<string>, is_merge boolean, status string")
    assert {(r["sha"], r["merge"]) for r in funnels.superseded(df).collect()} == {("b2", "m1"), ("b1", "m1")}
    assert funnels.superseded(df.limit(0)).count() == 0


STEP, INPUT = "step string, own string", "step string, input string, role string"


def graph(seed: int, n: int = 60):
    rng = random.Random(seed)
    own = {f"s{i}": f"o{rng.randint(0, 9)}" for i in range(n)}
    edges = {(f"s{i}", f"s{rng.randrange(i)}", rng.choice("xy")) for i in range(5, n) for _ in range(rng.randint(0, 3))}
    return own, edges


@pytest.mark.parametrize("seed", [1, 2])
def test_a_change_reaches_exactly_what_depends_on_it(spark, seed):
    own, edges = graph(seed)
    make = lambda o: spark.createDataFrame(list(o.items()), STEP)
    inputs = spark.createDataFrame([*edges, ("s9", "no step", "x")], INPUT)
    before = steps.hashes(make(own), inputs)
    done = ledger.mark(spark.createDataFrame([], ledger.SCHEMA), before, "done", 1)
    level: dict = {}
    for i in range(len(own)):
        level[f"s{i}"] = max((level[b] + 1 for a, b, _ in edges if a == f"s{i}"), default=0)
    assert {r["step"]: r["level"] for r in before.collect()} == level
    assert steps.plan_run(make(own), inputs, done).where("runs").count() == 0

    def behind(start):
        seen = set(start)
        while more := {a for a, b, _ in edges if b in seen} - seen:
            seen |= more
        return seen

    changed = own | {"s3": "another", "s20": "another"}
    runs = lambda **k: {r["step"] for r in steps.plan_run(make(changed if k.pop("new", True) else own), inputs, done, **k).where("runs").collect()}
    assert runs() == behind(["s3", "s20"]) and runs(new=False, forced=["s7"]) == behind(["s7"])
    told = before.select("step", F.lit(1).alias("item"), "input_hash")
    assert {r["step"] for r in steps.reusable(told, steps.hashes(make(changed), inputs)).collect()} == set(own) - behind(["s3", "s20"])


def test_roles_and_cycles(spark):
    base = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], STEP)
    one = steps.hashes(base, spark.createDataFrame([("c", "a", "x"), ("c", "b", "y")], INPUT)).where("step = 'c'").first()["input_hash"]
    other = steps.hashes(base, spark.createDataFrame([("c", "a", "y"), ("c", "b", "x")], INPUT)).where("step = 'c'").first()["input_hash"]
    assert one != other
    with pytest.raises(ValueError, match="depend on themselves: a, b"):
        steps.hashes(base, spark.createDataFrame([("a", "b", "x"), ("b", "a", "x")], INPUT))
    assert steps.hashes(base.limit(0), spark.createDataFrame([], INPUT)).count() == 0


def test_settled_ranges_are_not_dealt_again(spark, monkeypatch):
    """One range of many steps among many short ones: what is written grows with the ranges that still wait."""
    rows = [("long", i, [x for x in (i - 1, i - 2) if x >= 0], i) for i in range(12)]
    rows += [(f"r{k}", i, [i - 1] if i else [], i) for k in range(200) for i in range(3)]
    commits = spark.createDataFrame(rows, "repo string, sha long, parents array<long>, level long")
    wanted = spark.createDataFrame([("long", 1, 0, 11), *[(f"r{k}", 1, 0, 2) for k in range(200)]], "repo string, range long, a long, b long")
    written = []

    def counted(df, cut=ancestry.cut):
        done = cut(df)
        written.append(done.count())
        return done

    monkeypatch.setattr(ancestry, "cut", counted)
    got = ancestry.ranges(commits, wanted).collect()
    assert {(r["repo"], r["sha"]) for r in got} == {("long", i) for i in range(1, 12)} | {(f"r{k}", i) for k in range(200) for i in (1, 2)} and len(got) == 411
    assert sum(written) < 5_000, sum(written)
