"""Quota selection: a set-based greedy fill, then repairs for variety on the small pool that is eligible.

The pool that enters the repairs is bounded by the quotas and loses nothing, as `_pool` shows: a repair only ever swaps
in the most preferred row of a (type, difficulty, module) that is not chosen yet.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class InfeasibleError(ValueError):
    """The quotas cannot be met by the eligible rows."""


@dataclass(frozen=True)
class Quotas:
    """total rows; at least `floor` and at most `caps` per type; distinct modules; wanted rows per difficulty."""

    total: int = 10
    floors: dict[str, int] = field(default_factory=dict)
    caps: dict[str, int] = field(default_factory=dict)
    modules: int = 0
    spread: dict[str, int] = field(default_factory=dict)
    rounds: int = 100


def _pref() -> list:
    return [F.col("weight").desc(), F.col("id")]


def greedy(df: DataFrame, q: Quotas) -> DataFrame:
    """Rows chosen from (id, type, module, difficulty, weight): floors first, then by preference under the caps."""
    rn = F.row_number().over(Window.partitionBy("type").orderBy(*_pref()))
    ranked = df.withColumn("__rn", rn)
    allowed = F.lit(True)
    for kind, cap in q.caps.items():
        allowed &= (F.col("type") != kind) | (F.col("__rn") <= cap)
    reserved = F.lit(False)
    for kind, floor in q.floors.items():
        reserved |= (F.col("type") == kind) & (F.col("__rn") <= floor)
    return ranked.where(allowed).withColumn("__reserved", reserved).orderBy(F.col("__reserved").desc(), *_pref()).limit(q.total).drop("__rn", "__reserved")


def check_feasible(df: DataFrame, q: Quotas) -> None:
    """Raise if the floors, the caps or the number of modules leave too few rows."""
    by_type = {r["type"]: r["n"] for r in df.groupBy("type").agg(F.count("*").alias("n")).collect()}  # one row per type
    for kind, floor in q.floors.items():
        if by_type.get(kind, 0) < floor:
            raise InfeasibleError(f"{kind}: {by_type.get(kind, 0)} eligible, {floor} needed")
    room = sum(min(n, q.caps.get(t, n)) for t, n in by_type.items())
    if room < q.total:
        raise InfeasibleError(f"{room} rows fit the caps, {q.total} needed")
    modules = df.agg(F.count_distinct(F.when(F.col("module") != "", F.col("module"))).alias("n")).first()["n"]
    if modules < q.modules:
        raise InfeasibleError(f"{modules} modules, {q.modules} needed")


def _pool(df: DataFrame, q: Quotas) -> list[dict]:
    """All that a repair can use: `total` rows of each of the best cells of a (type, difficulty), `total + 3` of them.

    A cell is a (type, difficulty, module); its rows are alike to every rule, so only its best rows not chosen count. A
    swap that a row of a chosen module allows, the best row of a module not chosen allows as well. As at most `total`
    modules are chosen (and a row without one, null or empty, adds none), that row heads one of the `total + 3` best
    cells, and what is preferred to it lies in cells with better heads still.
    """
    cell = ["type", "difficulty", "module"]
    ranked = df.select("id", *cell, "weight").withColumn("__rn", F.row_number().over(Window.partitionBy(*cell).orderBy(*_pref())))
    best = ranked.where(F.col("__rn") <= q.total)
    place = F.row_number().over(Window.partitionBy("type", "difficulty").orderBy(*_pref()))
    heads = ranked.where("__rn = 1").withColumn("__h", place).where(F.col("__h") <= q.total + 3)
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"h.{c}")) for c in cell]
    pool = best.alias("b").join(heads.alias("h"), same, "left_semi").drop("__rn")
    return [r.asDict() for r in pool.orderBy(*_pref()).collect()]


def _fits(rows: list[dict], q: Quotas) -> bool:
    n = {}
    for r in rows:
        n[r["type"]] = n.get(r["type"], 0) + 1
    return all(n.get(t, 0) >= f for t, f in q.floors.items()) and all(n.get(t, 0) <= c for t, c in q.caps.items())


def _modules(rows: list[dict]) -> int:
    return len({r["module"] for r in rows if r["module"]})


def _distance(rows: list[dict], q: Quotas) -> int:
    n = {}
    for r in rows:
        n[r["difficulty"]] = n.get(r["difficulty"], 0) + 1
    return sum(abs(q.spread.get(k, 0) - n.get(k, 0)) for k in {*q.spread, *n})


def _order(r: dict) -> tuple:
    return (-r["weight"], r["id"])


def repair_modules(chosen: list[dict], pool: list[dict], q: Quotas) -> list[dict]:
    """Swap the least preferred row of a module chosen twice for the best row of a module not chosen, until enough."""
    chosen = list(chosen)
    while _modules(chosen) < q.modules:
        have = {r["module"] for r in chosen}
        counts = {m: sum(r["module"] == m for r in chosen) for m in have}
        fresh = [r for r in sorted(pool, key=_order) if r["module"] and r["module"] not in have]
        spare = [r for r in sorted(chosen, key=_order, reverse=True) if counts[r["module"]] > 1 or not r["module"]]
        swap = next(((o, i) for i in fresh for o in spare if _fits([*(r for r in chosen if r is not o), i], q)), None)
        if swap is None:
            raise InfeasibleError(f"{_modules(chosen)} modules can be chosen, {q.modules} needed")
        chosen = [*(r for r in chosen if r is not swap[0]), swap[1]]
    return chosen


def repair_spread(chosen: list[dict], pool: list[dict], q: Quotas) -> list[dict]:
    """Take the first swap, by preference, that brings the difficulties nearer to the wanted spread, round by round."""
    chosen = list(chosen)
    for _ in range(q.rounds):
        now, ids = _distance(chosen, q), {r["id"] for r in chosen}
        better = None
        for new in sorted(pool, key=_order):
            if new["id"] in ids:
                continue
            for old in sorted(chosen, key=_order, reverse=True):
                rows = [*(r for r in chosen if r is not old), new]
                if _distance(rows, q) < now and _fits(rows, q) and _modules(rows) >= min(q.modules, _modules(chosen)):
                    better = rows
                    break
            if better:
                break
        if better is None:
            break
        chosen = better
    return chosen


def select(df: DataFrame, q: Quotas) -> DataFrame:
    """Every row of df (id, type, module, difficulty, weight, eligible) with `selected`."""
    fit = df.where("eligible")
    check_feasible(fit, q)
    chosen = [r.asDict() for r in greedy(fit, q).collect()]  # `total` rows
    if q.modules or q.spread:
        pool = _pool(fit, q)
        chosen = repair_spread(repair_modules(chosen, pool, q), pool, q) if q.spread else repair_modules(chosen, pool, q)
    return df.withColumn("selected", F.col("id").isin([r["id"] for r in chosen]))


def shortlist(df: DataFrame, size: int, bonus: float) -> DataFrame:
    """place, id: rows of (id, module, score, ord) taken one by one, the best score plus a bonus while its module is new.

    Only the `size` best rows of a module can be taken, and only modules with one of the `size` best heads.
    """
    per = F.row_number().over(Window.partitionBy("module").orderBy(F.col("score").desc(), "ord"))
    heads = df.withColumn("__rn", per).where(F.col("__rn") <= size)
    first = heads.where("__rn = 1").orderBy(F.col("score").desc(), "ord").limit(size).select("module")
    rows = [r.asDict() for r in heads.join(first, "module").select("id", "module", "score", "ord").collect()]  # size * size rows at most
    taken, seen = [], set()
    while rows and len(taken) < size:
        best = min(rows, key=lambda r: (-(r["score"] + (0.0 if r["module"] in seen else bonus)), r["ord"]))
        rows.remove(best)
        seen.add(best["module"])
        taken.append((len(taken), best["id"]))
    id_type = df.schema["id"].dataType.simpleString()
    return df.sparkSession.createDataFrame(taken, f"place int, id {id_type}")
