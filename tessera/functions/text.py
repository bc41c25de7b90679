"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(text: Column, limit: int, suffix: str = "...") -> Column:
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit), F.lit(suffix)))


def first_line(text: Column, limit: int = 160, fallback: str = "") -> Column:
    return F.substring(F.substring_index(F.coalesce(F.nullif(text, F.lit("")), F.lit(fallback)), "\n", 1), 1, limit)


def line_range(text: Column, first: Column, last: Column) -> Column:
    """Lines first..last, counted from 1."""
    return F.array_join(F.slice(F.split(text, "\n"), first, F.greatest(last - first + 1, F.lit(0))), "\n")


def splice_lines(text: Column, first: Column, last: Column, new: Column) -> Column:
    """Text with lines first..last replaced by one piece."""
    lines = F.split(text, "\n")
    return F.array_join(F.concat(F.slice(lines, 1, first - 1), F.array(new), F.slice(lines, last + 1, F.greatest(F.size(lines) - last, F.lit(0)))), "\n")


def indent_of(line: Column) -> Column:
    return F.length(line) - F.length(F.ltrim(line))


def dedent(text: Column) -> Column:
    """Lines without their common indent; blank lines do not count."""
    lines = F.split(text, "\n")
    common = F.coalesce(F.array_min(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), indent_of)), F.lit(0))
    return F.array_join(F.transform(lines, lambda x: F.substring(x, common + 1, F.length(x))), "\n")


def reindent(text: Column, prefix: str) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.when(F.trim(x) == "", x).otherwise(F.concat(F.lit(prefix), x))), "\n")


def append_to_lines(text: Column, numbers: Column, suffix: str) -> Column:
    """Text with a suffix on the lines of the given numbers (from 1), unless they have it."""
    mark = lambda x, i: F.when(F.array_contains(numbers, i + 1) & ~F.endswith(x, F.lit(suffix)), F.concat(x, F.lit(suffix))).otherwise(x)
    return F.array_join(F.transform(F.split(text, "\n"), mark), "\n")


def slug(name: Column) -> Column:
    """Lower-case letters and digits with single hyphens between."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def repo_name(url: Column) -> Column:
    last = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "[/:]"), -1)
    return slug(F.regexp_replace(last, r"\.git$", ""))


def name_tokens(name: Column, at_least: int) -> Column:
    """Parts of a camelCase or snake_case name."""
    flat = F.lower(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"))
    return F.filter(F.split(flat, "_"), lambda t: F.length(t) >= at_least)


def pairs_text(m: Column) -> Column:
    """k=v, k=v of a map, keys in order."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string"))), ", ")


def cell(value: Column) -> Column:
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("-"))


def markdown_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def frontmatter(text: Column) -> tuple[Column, Column]:
    """Map of the leading --- block's `key: value` lines, and the body behind it."""
    has = text.rlike(r"\A---\n[\s\S]*?\n---\n")
    block = F.regexp_extract(text, r"\A---\n([\s\S]*?)\n---\n", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: F.contains(x, F.lit(":")))
    pair = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value"))
    made = F.map_from_entries(F.transform(lines, pair))
    empty = F.create_map().cast("map<string,string>")
    return F.when(has, made).otherwise(empty), F.when(has, F.regexp_replace(text, r"\A---\n[\s\S]*?\n---\n", "")).otherwise(text)


def emit_frontmatter(fields: Column) -> Column:
    """The block that frontmatter() reads, keys in order."""
    lines = F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n"))


def between(text: Column, before: str, after: str) -> Column:
    """The first stretch between two patterns, empty if there is none."""
    return F.regexp_extract(text, f"{before}([\\s\\S]*?){after}", 1)


def cites(text: Column, name: Column, value: Column, gap: int = 20) -> Column:
    """Whether name and value stand within `gap` characters of each other in a sentence, in either order."""
    near = F.concat(F.lit(r"\b"), name, F.lit(rf"\b[^.;\n]{{0,{gap}}}\b"), value, F.lit(r"\b"))
    back = F.concat(F.lit(r"\b"), value, F.lit(rf"\b[^.;\n]{{0,{gap}}}\b"), name, F.lit(r"\b"))
    return F.rlike(text, near) | F.rlike(text, back)


def replace_section(text: Column, title: str, body: str) -> Column:
    """Text with the body of a `## title` section replaced, or the section put at the end; doing it twice changes nothing."""
    import re

    new = f"## {title}\n\n{body}\n"
    pattern = rf"(?m)^## {re.escape(title)}\n[\s\S]*?(?=^## |\z)"
    flat = new.replace("\\", r"\\").replace("$", r"\$")
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, flat)).otherwise(F.concat(F.regexp_replace(text, r"\n*\z", "\n\n"), F.lit(new)))


def linked_names(text: Column, title: str, known: Column) -> Column:
    """Sorted titles of the Markdown links in a section that are known."""
    import re

    section = F.regexp_extract(text, rf"(?m)^## {re.escape(title)}\n([\s\S]*?)(?=^## |\z)", 1)
    return F.array_sort(F.array_intersect(F.array_distinct(F.regexp_extract_all(section, F.lit(r"\[`?([^\]`]+)`?\]\("), F.lit(1))), known))
