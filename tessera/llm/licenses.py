"""Operator 7: license scan by conditional compression.

Around license wording, blocks of words are compressed once alone and once with each template as zstandard raw
dictionary. The bytes that a template saves rank the templates. A template that saves less than a share of what it
saves on its own wording is not supported and goes no further; the others are confirmed from the top down by exact
wording differences: their words must stand in the block, or differ in a few words of which none decides. What a
winner covers is cut out, and the rest of the block is ranked again, so a block may hold several licenses.

Templates go in groups of like size, long ones first, and the blocks of a group are bounded by its size: a short
notice is not lost in a long text, and no comparison grows with the text. Blocks overlap, so that every place where a
template of the group can stand lies inside of one.

Defined cases: null and empty texts have no finding; a license in other case, spacing, punctuation or line
breaks is found; a differing version, clause or qualifier (GNU Lesser, NC, ND, SA) is a difference in a
deciding word and never confirmed as that license; equal savings go to the template named first; repeated
rows repeat their findings; columns but for id and text take no part, whatever their names; an empty table gives an
empty table; texts of any length are read whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, slices

#: Wording of public licenses and notices; <...> stands for up to twelve words of any kind.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-licensed": "Licensed under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of <holder> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at <address> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at <address>",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
}

#: Words that a license is told by; one that differs rules the license out.
DECIDING = {
    *"apache mit isc gnu gpl lgpl agpl lesser affero mozilla mpl bsd cc cc0 by nc nd sa 0 1 2 3 4 neither unencumbered noncommercial".split(),
}
#: Wording around which blocks are compressed; every template holds some of it.
CANDIDATE = re.compile(r"licen[cs]e|copyright|warrant|redistribut|permission\W+(?:is\W+hereby|to\W+use)|public\W+domain|creative\W+commons|\bCC\W?(?:BY|0)\b", re.I)
#: Words that a placeholder may take in, and share of a template's words that may differ.
OPEN_WORDS, MAY_DIFFER = 12, 0.1
#: Share of what a template saves on its own wording from which a block supports it. In the densest surroundings, of
#: nothing but pieces of other templates, wording that is there saves twice that.
SUPPORT = 0.1
LEVEL = 19
WORD, SLOT = re.compile(r"[^\W_]+"), re.compile(r"<\w+>|[^\W_]+")


class Template(NamedTuple):
    name: str
    words: list[str]  # without placeholders
    pattern: re.Pattern  # over words joined by one space
    compressor: object
    own: int  # bytes saved on the template's own wording


@lru_cache(maxsize=1)
def groups() -> tuple[object, list[tuple[int, list[Template]]]]:
    """The plain compressor, and the templates by the power of two of words that holds each, long ones first."""
    import zstandard

    alone, made = zstandard.ZstdCompressor(level=LEVEL), {}
    for name, text in TEMPLATES.items():
        slots = [m[0].lower() for m in SLOT.finditer(text)]
        own = [w for w in slots if w[0] != "<"]
        raw = " ".join(own).encode()
        pattern = " ".join(rf"\S+(?: \S+){{0,{OPEN_WORDS}}}?" if w[0] == "<" else re.escape(w) for w in slots)
        given = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        size = len(own) + (OPEN_WORDS + 1) * (len(slots) - len(own))
        template = Template(name, own, re.compile(rf"(?<!\S){pattern}(?!\S)"), given, len(alone.compress(raw)) - len(given.compress(raw)))
        made.setdefault(1 << size.bit_length(), []).append(template)
    return alone, sorted(made.items(), reverse=True)


def rank(found: list[str], templates: list[Template]) -> list[tuple[int, Template]]:
    """(bytes saved, template) of a block of words, most saved first, as far as the block supports them."""
    raw = " ".join(found).encode()
    base = len(groups()[0].compress(raw))
    saved = [(base - len(t.compressor.compress(raw)), t) for t in templates]
    return sorted((x for x in saved if x[0] >= SUPPORT * x[1].own), key=lambda x: -x[0])


def differences(own: list[str], found: list[str]) -> tuple[list[str], int, int] | None:
    """Words that differ ("-" only in the template, "+" only in the text) in the best alignment, and its span of words."""
    same = [b for b in SequenceMatcher(None, own, found, autojunk=False).get_matching_blocks() if b.size]
    if not same:
        return None
    # the stretch around the longest match that has room for the whole template
    core = max(same, key=lambda b: b.size)
    first, last = core.b - core.a - len(own) // 8, core.b + len(own) - core.a + len(own) // 8
    kept = [b for b in same if b.b >= first and b.b + b.size <= last]
    a, b = kept[0].b, kept[-1].b + kept[-1].size
    out = []
    for tag, i, j, k, m in SequenceMatcher(None, own, found[a:b], autojunk=False).get_opcodes():
        if tag != "equal":
            out += [f"-{w}" for w in own[i:j]] + [f"+{w}" for w in found[a + k : a + m]]
    return out, a, b


def _exact(template: Template, found: list[str]) -> tuple[list[str], int, int] | None:
    text = " ".join(found)
    hit = template.pattern.search(text)
    return ([], text.count(" ", 0, hit.start()), text.count(" ", 0, hit.end()) + 1) if hit else None


def _close(template: Template, found: list[str]) -> tuple[list[str], int, int] | None:
    got = differences(template.words, found)
    if got is None or len(got[0]) > MAY_DIFFER * len(template.words) or any(d[1:] in DECIDING for d in got[0]):
        return None
    return got


def blocks(hits: list[int], n: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, end of the starts that are its own) of blocks of at most 3 * size of the n words, around hits."""
    k = 0
    while k < len(hits):
        first, end = max(0, hits[k] - size), hits[k] + size
        while k < len(hits) and hits[k] - size <= end:
            end = hits[k] + size
            k += 1
        end = min(n, end)
        while end - first > 3 * size:
            yield first, first + 3 * size, first + 2 * size
            first += 2 * size
        yield first, end, end


def _free(taken: bytearray, first: int, end: int) -> Iterator[tuple[int, int]]:
    """Spans of words that no finding covers."""
    while (a := taken.find(0, first, end)) >= 0:
        b = taken.find(1, a, end)
        first = b if b >= 0 else end
        yield a, first


def scan(text: str | None) -> list[dict]:
    """Findings of a text: license, start, end (characters), saved (bytes), differing words, in order of place."""
    out: list[dict] = []
    if not text or not CANDIDATE.search(text):
        return out
    places = [m.span() for m in WORD.finditer(text)]
    found = [text[a:b].lower() for a, b in places]
    starts = [a for a, _ in places]
    hits = sorted({max(0, bisect_right(starts, m.start()) - 1) for m in CANDIDATE.finditer(text)})
    taken = bytearray(len(found))
    for size, templates in groups()[1]:
        for confirm in (_exact, _close):
            for first, end, own in blocks(hits, len(found), size):
                todo = list(_free(taken, first, end))
                while todo:
                    a, b = todo.pop()
                    for saved, template in rank(found[a:b], templates):
                        got = confirm(template, found[a:b])
                        if got and a + got[1] < own:
                            x, y = a + got[1], a + got[2]
                            out.append({"license": template.name, "start": places[x][0], "end": places[y - 1][1], "saved": saved, "differences": got[0]})
                            taken[x:y] = b"\1" * (y - x)
                            todo += _free(taken, a, b)
                            break
    return sorted(out, key=lambda f: (f["start"], f["license"]))


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, license, start, end, saved, n_differences, differences: one row per finding."""
    bound_batches(df.sparkSession)
    fed = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [(doc, f) for doc, text in zip(*[c.to_pylist() for c in part.columns], strict=True) for f in scan(text)]
                cols = [
                    pa.array([d for d, _ in rows], pa.int64()),
                    pa.array([f["license"] for _, f in rows], pa.string()),
                    *[pa.array([f[k] for _, f in rows], pa.int64()) for k in ("start", "end", "saved")],
                    pa.array([len(f["differences"]) for _, f in rows], pa.int64()),
                    pa.array([" ".join(f["differences"]) for _, f in rows], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "license", "start", "end", "saved", "n_differences", "differences"])

    return fed.mapInArrow(run, "doc_id long, license string, start long, end long, saved long, n_differences long, differences string")


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every license finding of every document."""
    return find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
