"""Queries of the training-data operators, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from tessera.llm.ann import op5_graph_ann
from tessera.llm.brown import op13_brown_lm
from tessera.llm.html import op9_line_blocks
from tessera.llm.licenses import op7_license_scan
from tessera.llm.packing import op6_best_fit_packing
from tessera.llm.pii import op8_feistel_pii
from tessera.llm.quality import op4_importance
from tessera.llm.resampling import op11_resampling
from tessera.llm.simhash import op10_simhash
from tessera.llm.search import op2_bm25_search
from tessera.llm.substrings import op3_suffix_dedup
from tessera.llm.tokenizer import op1_byte_bpe
from tessera.llm.whitening import op12_whitening
from tessera.plans.ship import ship

_OPERATORS = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_bm25_search": op2_bm25_search,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_importance": op4_importance,
    "op5_graph_ann": op5_graph_ann,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_license_scan": op7_license_scan,
    "op8_feistel_pii": op8_feistel_pii,
    "op9_line_blocks": op9_line_blocks,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_whitening": op12_whitening,
    "op13_brown_lm": op13_brown_lm,
}


def _shipped(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for name, query in _OPERATORS.items()}

ORACLE: dict[str, str] = {
    "op2_bm25_search": r"""
        WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS t FROM documents),
             tf AS (SELECT doc_id, t, count(*) AS n FROM w GROUP BY ALL),
             len AS (SELECT doc_id, sum(n) AS l FROM tf GROUP BY 1),
             g AS (SELECT count(*) AS nd, greatest(1, (SELECT sum(l) FROM len) / count(*)) AS mean FROM documents WHERE doc_id IS NOT NULL),
             df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1),
             s AS (SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.n * ln(1 + (nd - df + 0.5) / (df + 0.5)) * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
                   FROM tf q JOIN tf d USING (t) JOIN df USING (t) JOIN len ON len.doc_id = d.doc_id, g WHERE q.doc_id % 20 = 0 AND q.doc_id <> d.doc_id GROUP BY ALL),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10""",
    # what the tables' pages hold beside their article is named and taken away: head, menu, advert, footer, remarks
    "op9_line_blocks": r"""
        WITH a AS (SELECT page_id, url, regexp_replace(html, '<head>.*</head>|<nav>.*?</nav>|<div class="ad">.*?</div>|<footer>.*?</footer>|<!--.*?-->|<!DOCTYPE[^>]*>', ' ', 'gs') AS t FROM pages),
             b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
             c AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM b)
        SELECT page_id, url, text, length(text) AS n_chars FROM c""",
    # crc32 by its table of 256 entries, computed from the polynomial
    "op11_resampling": r"""
        WITH word AS (SELECT 'd' AS side, doc_id, w FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents)
                      UNION ALL SELECT 'b', NULL, w FROM (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark)),
             crc AS (SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS entry FROM range(256) r(i)),
             digits AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM word)),
             bytes AS (SELECT w, list_transform(range(length(h) // 2), lambda i: (16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::BIGINT) AS b FROM digits),
             place AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c // 256, entry[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
             model AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM word JOIN place USING (w) GROUP BY 1),
             total AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM model),
             gain AS (SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (all_s + 10000) / ((s + 1.0::DOUBLE) * (all_t + 10000)))) AS g FROM model, total),
             weighed AS (SELECT doc_id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight FROM word JOIN place USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY 1),
             scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT AS h FROM documents LEFT JOIN weighed USING (doc_id)),
             noisy AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
             placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM noisy)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed""",
}
