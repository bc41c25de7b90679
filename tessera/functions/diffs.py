"""Unified diffs and change statistics."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hunk_lines(diff: Column, side: str) -> Column:
    """Line numbers that a diff's hunks cover on the old or new side: length 1 if none is given, none for length 0."""
    at, size = (1, 2) if side == "old" else (3, 4)
    pattern = r"(?m)^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"
    heads = F.regexp_extract_all(diff, F.lit(r"(?m)^(@@ -[^@]* @@)"), F.lit(1))

    def lines(h: Column) -> Column:
        start = F.regexp_extract(h, pattern, at).cast("int")
        n = F.coalesce(F.nullif(F.regexp_extract(h, pattern, size), F.lit("")).cast("int"), F.lit(1))
        return F.when(n > 0, F.sequence(start, start + n - 1)).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(heads, lines))))


def numstat(text: Column) -> Column:
    """array<struct<path, added, deleted>> of numstat lines; binary files count 0."""
    rows = F.filter(F.transform(F.split(text, "\n"), lambda x: F.split(x, "\t")), lambda p: F.size(p) == 3)
    number = lambda x: F.coalesce(x.try_cast("int"), F.lit(0))
    return F.array_sort(F.transform(rows, lambda p: F.struct(p[2].alias("path"), number(p[0]).alias("added"), number(p[1]).alias("deleted"))))


def changed_lines(stats: Column, keep) -> Column:
    """Added and deleted lines of the files that keep() accepts."""
    return F.aggregate(F.filter(stats, lambda s: keep(s["path"])), F.lit(0), lambda a, s: a + s["added"] + s["deleted"])


def added_lines(diff: Column) -> Column:
    """Text of the lines that a diff adds."""
    lines = F.filter(F.split(diff, "\n"), lambda x: F.startswith(x, F.lit("+")) & ~F.startswith(x, F.lit("+++")))
    return F.transform(lines, lambda x: F.substring(x, 2, 1 << 20))


@F.pandas_udf(T.StringType())
def unified_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """Unified diff of two texts; null counts as empty."""
    made = [difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "a", "b", lineterm="") for a, b in zip(old, new, strict=True)]
    return pd.Series(["\n".join(m) for m in made])
