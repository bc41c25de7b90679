"""Binary values: range reads, little-endian numbers, pattern search, hex dumps and text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_range(content: Column, offset: Column, size: Column) -> Column:
    """`size` bytes from `offset` on (from 0); raises where that leaves the content."""
    inside = (offset >= 0) & (size >= 0) & (offset + size <= F.octet_length(content))
    return F.when(inside, F.substring(content, (offset + 1).cast("int"), size.cast("int"))).otherwise(F.raise_error("read outside of the content").cast("binary"))


def unsigned(content: Column, offset: int | Column, size: int) -> Column:
    """Little-endian unsigned number of up to 7 bytes."""
    out = F.lit(0).cast("long")
    at = F.lit(offset) if isinstance(offset, int) else offset
    for i in range(size):
        byte = F.conv(F.hex(F.substring(content, (at + i + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        out = out + byte * (1 << (8 * i))
    return out


def prefixed_text(content: Column, offset: Column, charset: str = "UTF-16LE", fallback: str = "<unreadable>") -> Column:
    """Text behind a 4-byte length at `offset`, the fallback where it does not fit."""
    size = unsigned(content, offset, 4)
    fits = offset + 4 + size <= F.octet_length(content)
    return F.when(fits, F.decode(F.substring(content, (offset + 5).cast("int"), size.cast("int")), charset)).otherwise(F.lit(fallback))


def find_all(content: Column, pattern: bytes, skip_last: bool = False) -> Column:
    """All places (from 0) of a byte pattern, overlapping ones too; skip_last leaves out a hit that ends the content."""
    n, size = len(pattern), F.octet_length(content)
    last = size - n - (1 if skip_last else 0)
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.substring(content, i + 1, F.lit(n)) == F.lit(pattern))


def find_first(content: Column, pattern: bytes, skip_last: bool = False) -> Column:
    return F.slice(find_all(content, pattern, skip_last), 1, 1)


def hexdump(content: Column, width: int = 16, sep: str = ".", start: int = 0) -> Column:
    """Lines of offset, hexadecimal bytes and printable characters."""
    n = F.octet_length(content)
    rows = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(width))).otherwise(F.array().cast("array<int>"))

    def line(i: Column) -> Column:
        part = F.substring(content, i + 1, F.lit(width))
        codes = F.rpad(F.regexp_replace(F.hex(part), "(..)(?=.)", "$1 "), width * 3 - 1, " ")
        shown = F.regexp_replace(F.decode(part, "ISO-8859-1"), r"[^\x20-\x7e]", sep)
        return F.concat(F.lpad(F.lower(F.hex(i + start)), 8, "0"), F.lit("  "), F.lower(codes), F.lit("  "), shown)

    return F.array_join(F.transform(rows, line), "\n")


def text_table(df: DataFrame, columns: list[str], ord_col: str, by: list[str] = ()) -> DataFrame:
    """by, table: rows as lines of padded cells, in order; the first one is ruled off."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    w = [F.max(F.length(c)) for c in cells]
    widths = df.groupBy(*by).agg(*[x.alias(f"__w{i}") for i, x in enumerate(w)])
    joined = df.join(widths, list(by)) if by else df.crossJoin(widths)
    line = F.concat_ws(" | ", *[F.rpad(c, F.col(f"__w{i}"), F.lit(" ")) for i, c in enumerate(cells)])
    rows = joined.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), line.alias("v")))), lambda s: s["v"]).alias("__rows"))
    rule = F.repeat(F.lit("-"), F.length(F.col("__rows")[0]))
    ruled = F.concat(F.slice("__rows", 1, 1), F.array(rule), F.slice("__rows", F.lit(2), F.greatest(F.size("__rows") - 1, F.lit(0))))
    return rows.select(*by, F.array_join(ruled, "\n").alias("table"))


def in_range(address: Column, start: Column, end: Column) -> Column:
    return (address >= start) & (address < end)
