"""Map and nested-record functions as column expressions; of equal keys the later value wins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge(*maps: Column) -> Column:
    """All entries; a later map's value wins. Null maps count as empty."""

    def two(a: Column, b: Column) -> Column:
        kept = F.map_filter(a, lambda k, _: ~F.coalesce(F.map_contains_key(b, k), F.lit(False)))
        return F.coalesce(F.map_concat(kept, b), a, b)

    return reduce(two, maps)


def merge_with(combine: Callable[[Column], Column], *maps: Column) -> Column:
    """Each key with combine() of the list of its values, in the order of the maps."""
    keys = F.array_distinct(F.flatten(F.array(*[F.map_keys(m) for m in maps])))
    values = lambda k: F.filter(F.array(*[F.try_element_at(m, k) for m in maps]), lambda v: v.isNotNull())
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), combine(values(k)).alias("value"))))


def assoc(m: Column, key: Column | str, value: Column) -> Column:
    return merge(m, F.create_map(F.lit(key) if isinstance(key, str) else key, value))


def dissoc(m: Column, *keys: str) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(list(keys)))


def key_map(m: Column, fn: Callable[[Column], Column]) -> Column:
    """Keys through fn; of keys that fall together the last one's value stays."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(fn(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def item_map(m: Column, fn: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    pair = lambda e: F.struct(*[x.alias(n) for n, x in zip(("key", "value"), fn(e["key"], e["value"]), strict=True)])
    return F.map_from_entries(F.transform(F.map_entries(m), pair))


def sorted_json(m: Column) -> Column:
    """A map as text that is equal for equal maps."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def get_in(json: Column, path: list[str | int], kind: str = "string", default: object | None = None) -> Column:
    """Nested value of a VARIANT or JSON text; the default where a step is missing."""
    at = "$" + "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)
    got = F.try_variant_get(json, at, kind)
    return got if default is None else F.coalesce(got, F.lit(default).cast(kind))


def set_in(record: Column, path: list[str], value: Column) -> Column:
    """A struct with a nested field set; missing fields are added."""
    return record.withField(".".join(path), value)


def update_in(record: Column, path: list[str], fn: Callable[[Column], Column], default: object | None = None) -> Column:
    old = record
    for p in path:
        old = old.getField(p)
    return set_in(record, path, fn(old if default is None else F.coalesce(old, F.lit(default))))


def delete_in(record: Column, path: list[str]) -> Column:
    return record.dropFields(".".join(path))


def unzip(rows: Column, width: int) -> Column:
    """An array of `width` arrays from an array of arrays; rows that are too short end all of them."""
    whole = F.filter(rows, lambda r: F.size(r) >= width)
    column = lambda i: F.transform(whole, lambda r: r[i])
    return F.array(*map(column, range(width)))
