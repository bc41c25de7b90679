"""Requirement names and version ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def requirement_name(spec: Column) -> Column:
    return F.replace(F.lower(F.trim(F.split(spec, r"[<>=!~;\s\[]")[0])), F.lit("_"), F.lit("-"))


def is_requirement(spec: Column) -> Column:
    part = r"(?:===|==|~=|!=|<=|>=|<|>)\s*[A-Za-z0-9.*+!_-]+"
    return F.trim(spec).rlike(rf"^[A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?\s*(?:\[[A-Za-z0-9._,\s-]*\])?\s*(?:{part}(?:\s*,\s*{part})*)?\s*(?:;.*)?$")


def pinned(lock: Column) -> Column:
    """Lines of the form name==version."""
    return F.filter(F.transform(F.split(lock, "\n"), F.trim), lambda x: x.rlike(r"^[A-Za-z0-9._-]+==[^\s;]+$"))


def caret_range(spec: Column) -> Column:
    """^1.2.3 and ~1.2.3 as >=,< ranges; other specifiers stay."""
    base = F.regexp_replace(spec, r"^[\^~]", "")
    parts = F.transform(F.split(base, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))
    first, second = parts[0], F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(0))
    third = F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit(0))
    up = F.when(first > 0, (first + 1).cast("string")).when(second > 0, F.concat_ws(".", F.lit("0"), second + 1)).otherwise(F.concat_ws(".", F.lit("0"), F.lit("0"), third + 1))
    tilde = F.when(F.size(parts) > 1, F.concat_ws(".", first, second + 1)).otherwise((first + 1).cast("string"))
    return F.when(F.startswith(spec, F.lit("^")), F.concat(F.lit(">="), base, F.lit(",<"), up)).when(F.startswith(spec, F.lit("~")) & ~F.startswith(spec, F.lit("~=")), F.concat(F.lit(">="), base, F.lit(",<"), tilde)).otherwise(spec)


def best_minor(minors: Column, at_least: Column, below: Column, default: int) -> Column:
    """The greatest of the minor versions in [at_least, below), or the default."""
    return F.coalesce(F.array_max(F.filter(minors, lambda m: (m >= at_least) & (m < below))), F.lit(default))
