"""Ordered reject rules compiled to one CASE expression: the first rule that holds names the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A reason and when it applies; detail is put in brackets behind the reason."""

    reason: str
    when: Column
    detail: Column | None = None

    def text(self) -> Column:
        if self.detail is None:
            return F.lit(self.reason)
        return F.concat(F.lit(self.reason + "("), self.detail.cast("string"), F.lit(")"))


def first_reason(rules: list[Rule]) -> Column:
    """Reason of the first rule that is true; null if none is (a null condition is not true)."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.when, rule.text()).otherwise(out)
    return out


def funnel(df: DataFrame, rules: list[Rule], reason: str = "reason", status: str = "status", kept: str = "candidate") -> DataFrame:
    """Every row of df with its reason and status; no row leaves."""
    return df.withColumn(reason, first_reason(rules)).withColumn(status, F.when(F.col(reason).isNull(), kept).otherwise("rejected"))


def status_histogram(df: DataFrame, reason: str = "reason", status: str = "status") -> DataFrame:
    """key, n: rows by status, rejected ones by their reason up to the first bracket."""
    key = F.when(F.col(status) == "rejected", F.concat(F.lit("rejected:"), F.substring_index(reason, "(", 1))).otherwise(F.col(status))
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))


def decide(df: DataFrame, decisions: DataFrame, on: list[str], rules: list[Rule], missing: str) -> DataFrame:
    """df with the reason that an external decision gives; rows without a decision get `missing`."""
    there = decisions.withColumn("__decided", F.lit(True))
    joined = df.join(there, on, "left")
    reason = F.when(F.col("__decided").isNull(), missing).otherwise(first_reason(rules))
    return joined.withColumn("reason", reason).drop("__decided")


def additive_score(terms: dict[str, tuple[Column, float]], digits: int = 3) -> tuple[Column, Column]:
    """Score and its breakdown: each term adds its weight where its condition holds."""
    parts = [F.when(cond, F.lit(float(weight))).otherwise(F.lit(0.0)) for cond, weight in terms.values()]
    total = sum(parts[1:], parts[0])
    shown = F.map_filter(F.create_map(*[x for name, part in zip(terms, parts, strict=True) for x in (F.lit(name), part)]), lambda _, v: v != 0)
    return F.round(total, digits), shown
