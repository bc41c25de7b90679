"""Gates on text: lines that stand verbatim in another text, identifiers that leak, and their masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A token of a line: a run of letters, digits and underscores, or one other sign.
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def lines_with_tokens(df: DataFrame, keep: list[str], text: str, at_least: int, out: str = "line") -> DataFrame:
    """keep, line: squeezed lines of at least so many tokens."""
    rows = df.select(*keep, F.explode(F.split(text, "\n")).alias("__line")).select(*keep, squeeze(F.col("__line")).alias(out))
    return rows.where(F.size(F.regexp_extract_all(out, F.lit(TOKEN), F.lit(0))) >= at_least)


def contained_lines(lines: DataFrame, texts: DataFrame, line: str, text: str, anchor: int) -> DataFrame:
    """Pairs of a line and a text that holds it, via the line's first `anchor` words: only texts that hold that run of
    words anywhere are compared, so nothing is joined crosswise. Runs of words travel as hashes beside a digest of their
    text, and only those that some line starts with; the texts themselves meet their lines last."""
    words = lambda c: F.split(c, " ")
    head = lines.where(F.size(words(F.col(line))) >= anchor).withColumn("__key", F.xxhash64(F.array_join(F.slice(words(F.col(line)), 1, anchor), " ")))
    flat = squeeze(F.col(text))
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    # a line may start inside a word of the text, so the first word is compared by its end: the key skips it
    w = texts.select(digest.alias("__digest"), words(flat).alias("__w"))
    grams = F.transform(F.sequence(F.lit(1), F.size("__w") - anchor + 1), lambda i: F.xxhash64(F.array_join(F.slice("__w", i, anchor), " ")))
    keyed = w.where(F.size("__w") >= anchor).select("__digest", F.explode(F.array_distinct(grams)).alias("__key"))
    met = keyed.join(head.select("__key").distinct(), "__key").distinct()
    told = texts.withColumn("__digest", digest).withColumn("__flat", flat)
    return met.join(told, "__digest").join(head, "__key").where(F.contains(F.col("__flat"), F.col(line))).drop("__key", "__digest", "__flat")


def leaked_names(text: Column, names: Column, allowed: Column, at_least: int) -> Column:
    """Sorted names (not allowed, long enough) that stand in the text as whole words."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("[A-Za-z0-9_]+"), F.lit(0)))
    wanted = F.filter(F.array_except(names, allowed), lambda n: F.length(n) >= at_least)
    return F.array_sort(F.array_intersect(wanted, found))


def mask(text: Column, names: list[str], by: str = "[...]") -> Column:
    """Text with whole-word names replaced, the longest first."""
    import re

    for name in sorted(set(names), key=lambda n: (-len(n), n)):
        text = F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}_]){re.escape(name)}(?![\p{{L}}\p{{N}}_])", by.replace("$", r"\$"))
    return text


def unknown_quoted(text: Column, allowed: Column) -> Column:
    """Sorted names in back quotes that are not allowed."""
    quoted = F.regexp_extract_all(text, F.lit(r"`([A-Za-z_][A-Za-z0-9_.]*)`"), F.lit(1))
    return F.array_sort(F.array_except(F.array_distinct(quoted), allowed))
