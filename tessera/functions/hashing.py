"""Content keys: hashes of inputs that decide whether something must be computed anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_key(*parts: Column, length: int = 64) -> Column:
    """SHA-256 of parts, each with its length in front, so that no two lists of parts run together; null counts as its own part."""
    framed = [F.when(p.isNull(), F.lit("-:")).otherwise(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string"))) for p in parts]
    return F.substring(F.sha2(F.concat(*framed).cast("binary"), 256), 1, length)


def joined_key(*parts: Column, sep: str = "\n", length: int = 64) -> Column:
    """SHA-256 of parts joined by a separator, cut to `length` hexadecimal digits."""
    return F.substring(F.sha2(F.concat_ws(sep, *parts).cast("binary"), 256), 1, length)


def tree_hash(files: DataFrame, by: list[str], path: str, content: str, out: str = "tree") -> DataFrame:
    """by, tree: hash over path and content hash of every file, in path order."""
    entry = F.concat(F.col(path), F.lit("\0"), F.sha2(F.col(content).cast("binary"), 256))
    return files.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), "\n").cast("binary"), 256).alias(out))


def normalised_patch(diff: Column) -> Column:
    """Hash of a diff without its line numbers and white space; null for an empty diff."""
    lines = F.filter(F.split(diff, "\n"), lambda x: x.rlike(r"^[+-]") & ~x.rlike(r"^(\+\+\+|---) "))
    flat = F.regexp_replace(F.array_join(lines, "\n"), r"[ \t]+", "")
    return F.when(F.size(lines) > 0, F.sha2(flat.cast("binary"), 256))


def reversed_patch(diff: Column) -> Column:
    """normalised_patch() of the diff that undoes this one."""
    return normalised_patch(F.translate(F.regexp_replace(F.regexp_replace(diff, r"(?m)^\+\+\+ ", "@@+ "), r"(?m)^--- ", "@@- "), "+-", "-+"))
