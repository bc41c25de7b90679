"""Search and reads over segments against plain scans."""

from __future__ import annotations

import random

import pytest

from tessera.operators import segments as sg

SEGMENT = "segment long, start long, content binary"


def plain(rows, patterns):
    return sorted((s, p, start + i) for s, start, data in rows for p in patterns for i in range(len(data or b"") - len(p) + 1) if data[i : i + len(p)] == p)


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("patterns", [[b"aba"], [b"ab", b"ba", b"aab"], [b"a", b"aa"], [b"ca", b"cb"], [b"\x00\n", b"."]])
def test_hits_across_ranges_are_found_once(spark, size, patterns):
    rng = random.Random(size)
    rows = [(k, k * 1000, bytes(rng.choice(b"abc\x00\n.") for _ in range(n))) for k, n in enumerate((0, 1, 2, 90, 200))] + [(9, 50_000, None), (10, 60_000, b"ab" * 40)]
    df = spark.createDataFrame([(s, a, None if d is None else bytearray(d)) for s, a, d in rows], SEGMENT)
    want = plain(rows, patterns)
    got = [(r["segment"], bytes(r["pattern"]), r["address"]) for r in sg.search(df, patterns, size=size).collect()]
    assert sorted(got) == want
    first = {(r["segment"], bytes(r["pattern"])): r["address"] for r in sg.search(df, patterns, find_first=True, size=size).collect()}
    assert first == {k: min(a for s, p, a in want if (s, p) == k) for k in {(s, p) for s, p, _ in want}}


def test_modules_and_reads(spark):
    rows = [(1, 100, b"xxabxx"), (2, 200, b"ab"), (3, 900, b"ab"), (4, 250, b"zzabab")]
    df = spark.createDataFrame([(s, a, bytearray(d)) for s, a, d in rows], SEGMENT)
    modules = spark.createDataFrame([("Kernel.dll", 0, 250, 1, False), ("user.dll", 250, 400, 0, True), ("kernelbase", 240, 300, 2, True)], "module string, base long, end long, ord long, unloaded boolean")
    found = lambda **k: sorted((r["module"], r["segment"], r["address"]) for r in sg.search_modules(df, modules, [b"ab"], 100, **k).collect())
    assert found() == [("Kernel.dll", 1, 102), ("Kernel.dll", 2, 200), ("kernelbase", 4, 252), ("kernelbase", 4, 254), ("user.dll", 4, 252), ("user.dll", 4, 254)]
    assert found(find_first=True) == [("Kernel.dll", 1, 102), ("kernelbase", 4, 252), ("user.dll", 4, 252)]
    names = {r["name"]: r["module"] for r in sg.find_modules(modules, spark.createDataFrame([("KERNEL",), ("base",), ("none",)], "name string")).collect()}
    assert names == {"KERNEL": "Kernel.dll", "base": "kernelbase", "none": None}
    asked = spark.createDataFrame([(1, 102, 2), (2, 104, 2), (3, 104, 3), (4, 150, 1), (5, 200, 0)], "request long, address long, size int")
    got = {r["request"]: (None if r["data"] is None else bytes(r["data"]), r["error"]) for r in sg.read_at(df, asked, 100).collect()}
    assert got.pop(5) == (b"", None)
    assert got == {1: (b"ab", None), 2: (b"xx", None), 3: (None, "read would cross boundaries"), 4: (None, "address not in memory range")}
    with pytest.raises(ValueError, match="bytes"):
        sg.search(df, [b""])
