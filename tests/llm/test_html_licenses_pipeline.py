"""Operators 7 and 9 on written cases and the given pages; the pipeline stage by stage."""

from __future__ import annotations

import html as entities
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import html, licenses

SF = "/root/testdata/sf0.01"
LONG = "This sentence is long enough to be the text of an article that somebody wants to read. "


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        (f"<body><nav><a href=x>Home</a></nav><div class='sidebar'>{LONG}</div><p>{LONG}</p><footer>{LONG}</footer>", LONG.strip()),
        (f"<article><h1>Ti &amp; tle</h1><p>{LONG}<br>two\n\n three</p><p>x</p></article><section id='comments'><article><p>{LONG}</p></article></section>", f"Ti & tle {LONG.strip()} two three x"),
        (f"<article><p>{LONG}</p><div class=ad>Buy!</div><aside>{LONG}</aside><p>end&nbsp;&#233;</p></article>", f"{LONG.strip()} end é"),
        (f"<div class='ad'>never closed<article><p>{LONG}</p></article>", LONG.strip()),
        (f"<script>var a='<p>{LONG}</p>';</script><style>p{{}}</style><p>{LONG}</p><!-- <p>{LONG}</p> -->", LONG.strip()),
        (f"<p>{LONG}</p><script>unclosed {LONG}", LONG.strip()),
        (f"<main><form><input><p>{LONG}</p></form><p>{LONG}</p></main>", LONG.strip()),
        ("<article><p>short</p></article>", "short"),
        (f"<article><p>a<b>b</b>c</p></div><p>{LONG}</p></article>", f"abc {LONG.strip()}"),
        # boilerplate told by marks on paragraphs and inside of lines
        (f"<article><p>{LONG}</p><p class='advert'>Buy now</p><p>x <span class='ad'>Buy <b>n</b>ow</span>y</p></article>", f"{LONG.strip()} x y"),
        # quotes inside of unquoted values, and quotes that never close
        ("<article><p title=it's>TEXT</p><p>it's TEXT</p></article>", "TEXT it's TEXT"),
        (f'<article><p title="never>TEXT</p><p>{LONG}</p></article>', "TEXT " + LONG.strip()),
        # an article is kept from its first line to its last
        (f"<article><p>{LONG}</p>{'<p><a href=x>link</a></p>' * 3}<p>Short end.</p></article>", f"{LONG.strip()} link link link Short end."),
        (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><p>x</p><p><a href=x>last</a></p></article>", f"Title {LONG.strip()} x last"),
        # words that an article may use of itself need links; others never silence headings or wrappers
        (f"<article><p>{LONG}</p><section id='related'><p>own words</p></section><h1 class='header'>H</h1><div class='related'><a href=x>teaser one</a></div></article>", f"{LONG.strip()} own words H"),
        (f"<main class='with-sidebar'><h2 class='section-header'>Head</h2><p>{LONG}</p></main>", f"Head {LONG.strip()}"),
        (f"<div class='container has-sidebar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div id='search-page'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div class='widget'><p>{LONG}</p></div>", LONG.strip()),
        (f"<article><header><h1>T</h1><p>by me</p></header><p>{LONG}</p></article>", f"T {LONG.strip()}"),
        # the distribution decides between articles, and on pages that mark none
        (f"<aside><article><p>{LONG}</p></article></aside><article><p>{LONG}</p>own</article>", f"{LONG.strip()} own"),
        (f"<article><p>{LONG}</p></article><article><p>Teaser.</p></article><article><a href=x>{LONG}</a></article>", LONG.strip()),
        (f"<div>menu words</div><div><div><div><h1><a href=x>Title</a></h1></div></div><div><p>{LONG}</p><p><a href=x>a link</a></p><p>tail</p></div></div><div><div><div>Copyright of somebody</div></div></div>", f"Title {LONG.strip()} a link tail"),
        (f"<div role=main><p>{LONG}</p><p>x</p></div><p>{LONG}</p>", f"{LONG.strip()} x"),
        # comments that are articles themselves, inside the article, beside it, and told by itemprop
        (f"<article><p>{LONG}</p><article class='comment'><p>{LONG}</p></article><p>end</p></article>", f"{LONG.strip()} end"),
        (f"<article class='post comments-open'><p>{LONG}</p></article><article class='comment depth-1' id='comment-3'><p>{LONG}</p></article>", LONG.strip()),
        (f"<article><p>{LONG}</p><div itemprop='comment'><p>{LONG}</p></div></article>", LONG.strip()),
        ("5 < 6 and <b>x</b>", "5 < 6 and x"),
        (f"<div><div>some menu</div></div><div class=content><p>{LONG}</p><div class=ad>Buy!</div><aside>a<p>b</p></aside><p>Short end.</p></div><div><div>Copyright</div></div>", f"{LONG.strip()} Short end."),
    ],
)
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_pages(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in html.op9_line_blocks(spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", rows[r["page_id"]], re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", article))
        assert r["text"] == " ".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_extract_cases(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", "old"), (1, "<p>a</p>", "old"), (2, None, "x")], "page_id long, html string, TEXT string")
    assert sorted((r["page_id"], r["text"]) for r in html.extract(df).collect()) == [(1, "a"), (1, "a"), (2, "")]
    assert html.extract(df.limit(0)).count() == 0
    assert len(html.main_text(f"<article>{'<p>' + LONG + '</p>'} " + f"<p>{LONG}</p>" * 20_000)) == 20_001 * len(LONG) - 1


def test_line_blocks_alone():
    """With the names of elements and classes taken away, surges and dives still find the articles of the given pages."""
    import collections

    import duckdb

    def words_shared(a, b):
        a, b = collections.Counter(a.split()), collections.Counter(b.split())
        return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))

    shares = []
    for (page,) in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall():
        plain = re.sub(r"</?(?:nav|article|footer)\b", lambda m: "</div" if m[0][1] == "/" else "<div", re.sub(r"(?s)<head>.*</head>", "", page)).replace(' class="ad"', "")
        shares.append(words_shared(html.main_text(page), html.main_text(plain)))
    assert sum(shares) / len(shares) > 0.93 and min(shares) > 0.5


@pytest.mark.parametrize("part", ['<a "b ', "<div>", "<article>", "<div class=ad><article>", '<a x="b ', "<", "<!", "</", '="', "<section class=related>", "<span class=ad>", "<title>", "<div>x</p>"])
def test_cost_grows_with_the_page(part):
    import time

    start = time.process_time()
    html.main_text(part * 40_000 + "</div>" * 40_000)
    assert time.process_time() - start < 5  # quadratic cost would take minutes


def test_surges():
    assert html.surges([0, 0, 100, 5, 0, 0, 0, 0, 90, 0]) == [(2, 4), (8, 9)]
    assert html.surges([3, 0, 0, 0, 200]) == [(4, 5)] and html.surges([]) == [] and html.surges([3]) == [(0, 1)]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_is_found(name):
    body = licenses.TEMPLATES[name].replace("<holder>", "the Example Group").replace("<address>", "http://example.org/x")
    for text in (body, f"noise before\n// {body.upper()}\nand after", f"a\n\n{body.replace(' ', chr(10), 3)}\nz"):
        assert [f["license"] for f in licenses.scan(text)] == [name]


def filled(name):
    return licenses.TEMPLATES[name].replace("<holder>", "the Example Group").replace("<address>", "http://example.org/x")


def test_ranking_selects():
    """Compression puts the template that is there first, and what it does not support is never compared."""
    for size, group in licenses.groups()[1]:
        for t in group:
            ranked = licenses.rank(["some", "words", *t.words, "and", "more"], group)
            assert ranked[0][1].name == t.name and ranked[0][0] > t.own / 2
            assert licenses.rank("nothing of the kind stands here but ordinary talk about rain".split(), group) == []


def test_only_supported_templates_are_confirmed(monkeypatch):
    seen = []
    exact = licenses._exact
    monkeypatch.setattr(licenses, "_exact", lambda t, found: seen.append(t.name) or exact(t, found))
    (found,) = licenses.scan("text before " + filled("MPL-2.0") + " text after")
    assert found["license"] == "MPL-2.0" and "MIT" not in seen and "GPL-3.0-or-later" not in seen
    monkeypatch.setattr(licenses, "rank", lambda found, templates: [])
    assert licenses.scan(filled("MPL-2.0")) == []


def test_no_license_is_lost_in_a_crowd():
    import random

    rng = random.Random(3)
    texts = [filled(n).split() for n in licenses.TEMPLATES]
    for name in licenses.TEMPLATES:
        for prose in ("This license and copyright notice is granted by the licensor under warranty terms of the license for redistribution. " * 8, None):
            sides = []
            for _ in range(2):
                side: list[str] = []
                while len(side) < 120:
                    own = rng.choice(texts)
                    at = rng.randrange(len(own))
                    side += own[at : at + rng.randint(1, 8)]
                sides.append(prose or " ".join(side))
            assert name in [f["license"] for f in licenses.scan(f"{sides[0]} {filled(name)} {sides[1]}")]
    everything = licenses.scan(" ".join(filled(n) for n in licenses.TEMPLATES))
    assert [(f["license"], f["differences"]) for f in everything] == [(n, []) for n in licenses.TEMPLATES]
    assert len(licenses.scan((filled("ISC") + "\n") * 50)) == 50
    assert [f["license"] for f in licenses.scan("released into the public\n  domain: " + filled("Unlicense").replace("public domain", "public\n\ndomain"))] == ["Unlicense"]


def test_blocks_hold_every_place():
    for hits, n, size in (([5, 60, 61, 300], 400, 8), (list(range(0, 500, 3)), 500, 16), ([0], 1, 8)):
        made = list(licenses.blocks(hits, n, size))
        assert all(0 <= a < b <= n and b - a <= 3 * size for a, b, _ in made)
        for start in range(n):
            end = min(n, start + size)
            if any(start <= h < end for h in hits):
                assert any(a <= start < own and end <= b for a, b, own in made)


def test_wording_decides():
    assert licenses.scan("This work is licensed under the GNU Lesser General Public License, version 2.") == []
    assert licenses.scan("Licensed under CC BY 3.0.") == [] and licenses.scan("Copyright 2020. No warranty.") == []
    (found,) = licenses.scan(licenses.TEMPLATES["MIT"].replace("free of charge", "without charge"))
    assert found["license"] == "MIT" and "-free" in found["differences"]
    both = licenses.scan("Released under the MIT License.\n" + "x\n" * 9 + "Licensed under the Apache License, Version 2.0.")
    assert [f["license"] for f in both] == ["MIT-notice", "Apache-2.0-notice"]
    assert both[0]["start"] == 0 and both[0]["saved"] > 0


def test_license_query(spark):
    want = {"MIT-notice": r"Released\W+under\W+the\W+MIT\W+License", "Apache-2.0-notice": r"Licensed\W+under\W+the\W+Apache\W+License\W+Version\W+2\W+0", "GPL-3.0-notice": r"This\W+work\W+is\W+licensed\W+under\W+the\W+GNU\W+General\W+Public\W+License\W+version\W+3", "CC-BY-NC-4.0": r"Licensed\W+under\W+CC\W+BY\W+NC\W+4\W+0"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((d["doc_id"], n) for d in docs for n, p in want.items() for _ in re.findall(p, d["text"], re.I))
    assert sorted((r["doc_id"], r["license"]) for r in licenses.op7_license_scan(spark, SF).collect()) == expected and expected
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 300_000), (None, "Released under the MIT License."), (4, "Released under the MIT License.")], "doc_id long, text string").withColumn("license", F.lit("clash"))
    assert sorted((r["doc_id"], r["license"]) for r in licenses.find_licenses(df.union(df.where("doc_id = 4"))).collect() if r["doc_id"]) == [(4, "MIT-notice")] * 2
    assert licenses.find_licenses(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns on its predecessor's Parquet."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_and_decisions(spark, stages):
    columns = stages["input"].dtypes
    for name in ("quality", "near_copies", "repeats", "private"):
        assert stages[name].dtypes == columns
        assert stages[name].where("n_chars <> length(text)").count() == 0
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = rows(stages["quality"])
    clean = [d for d, x in labels.items() if x == (1, 0)]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert sum(d in kept for d, x in labels.items() if x[0] == 0) <= 0.05 * sum(x[0] == 0 for x in labels.values())


def test_copies_leave_one(stages):
    from tests.llm.test_near_copies import brute_kept

    before, after = rows(stages["quality"]), rows(stages["near_copies"])
    assert set(after.items()) == brute_kept(before.items(), corpus_pipeline.RADIUS)


def test_repeats_and_private_data_go(spark, stages):
    from tests.llm.test_duplicates import brute_repeats

    before, after = rows(stages["near_copies"]), rows(stages["repeats"])
    for d, (size, gone, _, _) in brute_repeats(list(before.items()), 100).items():
        assert size - gone - 6 <= len(after[d].encode()) <= size - gone
    found = re.compile(r"\S+@\S+|\d+\.\d+\.\d+\.\d+|\+1 \(\d+\) \d+-\d+")
    private = rows(stages["private"])
    assert set(private) == set(after)
    for d, t in after.items():
        for value in found.findall(t):
            assert value not in private[d] or "@" not in value
        assert len(t) == len(private[d]) or not found.search(t) or abs(len(t) - len(private[d])) < 60


def test_packing_is_whole(spark, stages):
    from tokenizers import Tokenizer

    from tests.llm.test_tokenizer_packing import JSON, check_packing

    pieces = stages["packing"].collect()
    check_packing(pieces, list(rows(stages["private"]).items()), 2048)
    # the ids of the sequences, laid end to end, decode to the kept documents
    decoder, sequences, texts = Tokenizer.from_file(JSON), {}, {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = sequences.setdefault(r["sequence_id"], [])
        assert len(ids) == r["offset"] and len(r["ids"]) == r["length"]
        ids += r["ids"]
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["piece"])):
        texts.setdefault(r["doc_id"], []).extend(sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]])
    assert all(ids.pop() == 0 for ids in texts.values()) and max(map(len, sequences.values())) <= 2048
    assert {d: decoder.decode(ids, skip_special_tokens=False) for d, ids in texts.items()} == rows(stages["private"])
    assert corpus_pipeline.run(spark, SF).count() == stages["packing"].count()


def test_stages_on_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, "s", 0), (3, "word " * 60_000, "en", None, 1), (4, "fine little text", "en", "s", 16), (4, "fine little text", "en", "s", 16), (None, "no id here at all", "en", "s", 17)], "doc_id long, text string, lang string, source string, n_chars long").withColumn("KEPT", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("selected", F.lit("y"))
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        got = stage(spark, docs, str(tmp_path))
        ids = sorted((r["doc_id"] for r in got.collect()), key=str)
        want = {"quality": [3, 4, 4, None], "near_copies": [1, 3, 4, None], "repeats": [1, 2, 3, 4, 4, None], "private": [1, 2, 3, 4, 4, None]}
        if name in want:
            assert ids == want[name] and got.columns == docs.columns
        else:
            assert set(ids) == {1, 2, 3, 4, None}
