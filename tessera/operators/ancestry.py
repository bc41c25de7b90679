"""Ancestry in commit graphs, for many repositories and many ranges at once.

`a..b` are the commits that b reaches and a does not, both counted among those they reach. All ranges are walked
together, step by step, as rows (range, commit, side); no repository and no range is gathered.

First, runs of commits with one parent and one child are drawn together by pointer doubling, so that a run of any length is one
place and takes one step. Then both ends of each range walk to parents. A place of b waits until no place from which a
still walks has a higher level: then a cannot reach it any more, and whether it belongs to the range is settled. a walks
no further than the lowest level at which b waits. So a range costs its own extent and not its repository's history.

`level` is any number that is lower in a parent than in its children, such as a generation number or the place in a
topological order. Parents outside the table end a walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import cut


def parent_edges(commits: DataFrame, by: str) -> DataFrame:
    """by, sha, parent: the parents of commits (by, sha, parents array) that are commits of the same repository."""
    there = commits.select(by, F.col("sha").alias("parent"))
    return commits.select(by, "sha", F.explode("parents").alias("parent")).distinct().join(there, [by, "parent"]).select(by, "sha", "parent")


def runs(commits: DataFrame, edges: DataFrame, ends: DataFrame, by: str) -> DataFrame:
    """by, sha, run: the topmost commit of the run that a commit is in. ends (by, sha) always begin a run.

    A commit is drawn to its child if that is its only one and has no other parent. Pointers are doubled: a run of n takes log n steps.
    """
    one_parent = edges.groupBy(by, F.col("sha").alias("child")).agg(F.count("*").alias("__p"))
    only_child = edges.groupBy(by, F.col("parent").alias("sha")).agg(F.count("*").alias("__c"), F.min("sha").alias("child")).where("__c = 1")
    drawn = only_child.join(one_parent.where("__p = 1"), [by, "child"]).join(ends.select(by, "sha").distinct(), [by, "sha"], "left_anti")
    up = commits.select(by, "sha").join(drawn.select(by, "sha", "child"), [by, "sha"], "left").select(by, "sha", F.coalesce("child", "sha").alias("run"), F.lit(True).alias("moved"))
    while True:
        up = cut(up)
        if up.where("moved").isEmpty():
            return up.drop("moved")
        above = up.where("sha <> run").select(by, F.col("sha").alias("run"), F.col("run").alias("__next"))
        up = up.join(above, [by, "run"], "left").select(by, "sha", F.coalesce("__next", "run").alias("run"), F.col("__next").isNotNull().alias("moved"))


def ranges(commits: DataFrame, wanted: DataFrame, by: str = "repo") -> DataFrame:
    """by, range, sha: the commits of each range.

    commits has by, sha, parents array and level; wanted has by, range, a and b (shas). A range whose b is no commit of the table is empty; an a outside the table reaches nothing.
    Ranges and places go by numbers while they are walked. A step deals the rows of the ranges that still wait once, by
    range, and what goes on once more, by place; ranges that are settled stay where they were written.
    """
    commits = commits.select(by, "sha", "parents", "level")
    edges = cut(parent_edges(commits, by))
    ends = wanted.select(by, F.explode(F.array("a", "b")).alias("sha")).distinct()
    of = runs(commits, edges, ends, by)
    top = of.where("sha = run").join(commits.select(by, "sha", "level"), [by, "sha"]).select(by, F.col("sha").alias("run"), "level")
    top = cut(top.withColumn("place", F.monotonically_increasing_id()))
    of = cut(of.join(top, [by, "run"]).select(by, "sha", "place", "level"))
    # what leads out of a run leads from its last commit to the top of another
    out = edges.join(of.select(by, "sha", F.col("place").alias("from")), [by, "sha"]).join(of.select(by, F.col("sha").alias("parent"), F.col("place").alias("to"), F.col("level").alias("to_level")), [by, "parent"])
    out = cut(out.where("from <> to").select(F.col("from").alias("place"), "to", "to_level").distinct())
    named = cut(wanted.select(by, "range").distinct().withColumn("no", F.monotonically_increasing_id()))
    begin = wanted.join(named, [by, "range"]).select(by, "no", F.explode(F.array(F.struct(F.lit(True).alias("in_a"), F.col("a").alias("sha")), F.struct(F.lit(False).alias("in_a"), F.col("b").alias("sha")))).alias("s"))
    a, b = F.col("in_a"), ~F.col("in_a")
    state = begin.select(by, "no", "s.*").join(of, [by, "sha"]).select("no", "place", "level", a.alias("in_a"), b.alias("in_b"), a.alias("open_a"), b.alias("open_b"))
    found = []
    while True:
        state = cut(_step(state))
        # of a place that both have reached, b's side is settled: it and all that it reaches lie outside
        found.append(state.where("low IS NULL AND in_b AND NOT in_a").select("no", "place"))
        state = state.where("low IS NOT NULL")
        if state.isEmpty():
            break
        moved = state.where("goes_a OR goes_b").select("no", "place", "goes_a", "goes_b").join(out, "place")
        moved = moved.select("no", F.col("to").alias("place"), F.col("to_level").alias("level"), F.col("goes_a").alias("in_a"), F.col("goes_b").alias("in_b"), F.col("goes_a").alias("open_a"), F.col("goes_b").alias("open_b"))
        stay = state.select("no", "place", "level", "in_a", "in_b", (F.col("open_a") & ~F.col("goes_a")).alias("open_a"), (F.col("open_b") & ~F.col("goes_b")).alias("open_b"))
        state = stay.unionByName(moved)
    return reduce(DataFrame.union, found).join(of, "place").join(named, [by, "no"]).select(by, "range", "sha")


def _step(state: DataFrame) -> DataFrame:
    """A row for each place of a range, with what is open and what goes on; low is null where b waits no more."""
    side = lambda x: F.coalesce(F.bool_and(F.when(F.col(f"in_{x}"), F.col(f"open_{x}"))), F.lit(False)).alias(f"open_{x}")
    seen = state.repartition("no").groupBy("no", "place").agg(F.min("level").alias("level"), F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"), side("a"), side("b"))
    seen = seen.withColumn("open_b", F.col("open_b") & ~F.col("in_a"))
    whole = Window.partitionBy("no")
    seen = seen.withColumn("low", F.min(F.when(F.col("open_b"), F.col("level"))).over(whole)).withColumn("high", F.max(F.when(F.col("open_a"), F.col("level"))).over(whole))
    goes_a = F.col("open_a") & F.col("low").isNotNull() & (F.col("level") > F.col("low"))
    goes_b = F.col("open_b") & (F.col("high").isNull() | (F.col("level") >= F.col("high")))
    # where b waits no more, a walks on for nothing
    return seen.withColumn("goes_a", F.coalesce(goes_a, F.lit(False))).withColumn("goes_b", F.coalesce(goes_b, F.lit(False))).drop("high")
