"""Steps that depend on each other: a step's hash takes in the hashes of its inputs, so that a change reaches exactly what depends on it.

steps: step, own (a hash of the step's own content, code or settings); inputs: step, input (a step), role. The hash of a step is a digest
of its own hash, the number of its inputs, and two sums over digests of (role, input's hash). Sums take any number of
inputs without gathering them, in any order; roles tell inputs apart where that matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.lineage import cut
from tessera.plans import ledger as lg


def _part(digest: Column, at: int) -> Column:
    """Sixty bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def levels(steps: DataFrame, inputs: DataFrame) -> DataFrame:
    """step, level: 0 without inputs, else one more than the highest input; null for steps on or behind a cycle.

    Inputs that are no step count as none. One round per level: a step is placed once all its inputs are.
    """
    known = inputs.join(steps.select(F.col("step").alias("input")), "input", "left_semi").select("step", "input").distinct()
    known = cut(known.join(steps.select("step"), "step", "left_semi"))
    needs = cut(known.groupBy("step").agg(F.count("*").alias("needed")))
    placed = cut(steps.select("step").join(needs, "step", "left_anti").withColumn("level", F.lit(0)))
    new, level = placed, 0
    met = None
    while True:
        level += 1
        # inputs met so far are counted on, so that a round reads only the edges out of the last level
        more = known.join(new.select(F.col("step").alias("input")), "input").groupBy("step").agg(F.count("*").alias("met"))
        met = cut(more if met is None else met.join(new.select("step"), "step", "left_anti").unionByName(more).groupBy("step").agg(F.sum("met").alias("met")))
        new = met.join(needs, "step").where("met = needed").select("step", F.lit(level).alias("level"))
        if new.isEmpty():
            break
        placed = cut(placed.union(new))
    return steps.select("step").join(placed, "step", "left")


def hashes(steps: DataFrame, inputs: DataFrame) -> DataFrame:
    """step, level, input_hash. A cycle is an error: its steps have no hash."""
    at = cut(levels(steps, inputs).join(steps.select("step", "own"), "step"))
    lost = at.where("level IS NULL").select("step").orderBy("step").limit(5).collect()
    if lost:
        raise ValueError(f"steps depend on themselves: {', '.join(str(r['step']) for r in lost)}")
    edges = inputs.select("step", "input", "role").distinct().join(at.select("step", "level"), "step")
    done = None
    for level in range((at.agg(F.max("level")).first()[0] or 0) + 1):
        mine = at.where(F.col("level") == level)
        if done is None:
            sums = mine.select("step", F.lit(0).cast("long").alias("n"), *[F.lit(0).cast("decimal(38,0)").alias(c) for c in "ab"])
        else:
            digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "input_hash").cast("binary"), 256)
            met = edges.where(F.col("level") == level).select("step", "input", "role").join(done.select(F.col("step").alias("input"), "input_hash"), "input").withColumn("h", digest)
            sums = met.groupBy("step").agg(F.count("*").alias("n"), F.sum(_part(F.col("h"), 1)).cast("decimal(38,0)").alias("a"), F.sum(_part(F.col("h"), 16)).cast("decimal(38,0)").alias("b"))
        made = mine.join(sums, "step").select("step", "level", F.sha2(F.concat_ws("|", "own", *[F.col(c).cast("string") for c in "nab"]).cast("binary"), 256).alias("input_hash"))
        done = cut(made if done is None else done.union(made))
    return done


def plan_run(steps: DataFrame, inputs: DataFrame, ledger: DataFrame, forced: list[str] = ()) -> DataFrame:
    """step, level, input_hash, runs: what must run, in the order of levels. A forced step runs, and so does what depends
    on it, as its result may be another one; everything else runs if the ledger does not hold it done from this very input."""
    made = hashes(steps, inputs)
    todo = lg.stale(made.select("step", "input_hash"), ledger).select("step")
    behind = descendants(inputs, steps.where(F.col("step").isin(list(forced))).select("step")) if forced else todo.limit(0)
    runs = todo.union(behind).distinct().withColumn("runs", F.lit(True))
    return made.join(runs, "step", "left").withColumn("runs", F.coalesce("runs", F.lit(False)))


def descendants(inputs: DataFrame, start: DataFrame) -> DataFrame:
    """step: the start steps and all that depend on them, each found once."""
    edges = cut(inputs.select("step", F.col("input")).distinct())
    seen = cut(start.select("step").distinct())
    new = seen
    while not new.isEmpty():
        new = cut(edges.join(new.select(F.col("step").alias("input")), "input").select("step").distinct().join(seen, "step", "left_anti"))
        seen = cut(seen.union(new))
    return seen


def reusable(decisions: DataFrame, made: DataFrame) -> DataFrame:
    """decisions (step, item, input_hash, ...) that still hold: taken on an item of a step from the input that it has now."""
    return decisions.join(made.select("step", "input_hash"), ["step", "input_hash"], "left_semi")
