"""Queries of scalar functions: text, names, hashes, diffs, maps, binary values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import binary as bn
from tessera.functions import diffs as df_
from tessera.functions import hashing as hs
from tessera.functions import maps as mp
from tessera.functions import paths as pt
from tessera.functions import text as tx
from tessera.functions import versions as vs
from tessera.operators import textgates as tg
from tessera.plans.registry import query, table


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query("scl_01_path_to_module", "SCL-01 SCL-02 SCL-27 SCL-109 SCL-110 SRC-07", r"SELECT page_id, replace(regexp_replace(regexp_replace(regexp_replace(p, '^en/', ''), '\.py$', ''), '(^|/)__init__$', ''), '/', '.') AS module FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS p FROM pages)")
def path_to_module(spark, d):
    return table(spark, d, "pages").select("page_id", pt.path_to_module(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1), ["en"]).alias("module"))


@query("scl_12_prefixes", "SCL-12 SCL-49 SCL-10 SCL-106", "SELECT prefix, count(*) AS n FROM (SELECT unnest([split_part(p_type, ' ', 1), split_part(p_type, ' ', 1) || '.' || split_part(p_type, ' ', 2)]) AS prefix FROM part) GROUP BY 1")
def prefixes(spark, d):
    name = F.concat_ws(".", F.split_part("p_type", F.lit(" "), F.lit(1)), F.split_part("p_type", F.lit(" "), F.lit(2)))
    return table(spark, d, "part").select(F.explode(pt.prefixes(name)).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n"))


@query("scl_14_extract_ids", "SCL-14 SRC-05 SCL-77 SCL-120 SRC-02", r"SELECT doc_id, array_to_string(list_filter(regexp_extract_all(text, 'token = \"([0-9a-f]+)\"', 1), lambda x: x <> ''), ',') AS tokens FROM documents WHERE contains(text, 'token =')".replace('\\"', '"'))
def extract_ids(spark, d):
    found = F.filter(F.regexp_extract_all("text", F.lit('token = "([0-9a-f]+)"'), F.lit(1)), lambda x: x != "")
    return _docs(spark, d).where(F.contains("text", F.lit("token ="))).select("doc_id", F.array_join(found, ",").alias("tokens"))


@query("scl_15_truncate", "SCL-15 SCL-16 SCL-50", "SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE left(text, 80) || '...' END AS short, left(split_part(text, chr(10), 1), 160) AS head FROM documents")
def truncate(spark, d):
    return _docs(spark, d).select("doc_id", tx.truncate(F.col("text"), 80).alias("short"), tx.first_line(F.col("text")).alias("head"))


@query("scl_17_content_keys", "SCL-17 SCL-20 SCL-28 SCL-31 SCL-38 SCL-39 SCL-40 SCL-41 SCL-44 SCL-69 SCL-70", "SELECT doc_id, left(sha256(concat_ws(chr(10), doc_id::VARCHAR, lang, text)), 16) AS key FROM documents")
def content_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", hs.joined_key(F.col("doc_id").cast("string"), F.col("lang"), F.col("text"), length=16).alias("key"))


@query("scl_18_base_ids", "SCL-18 SCL-19 SCL-115", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS base, left(sha256(o_orderkey::VARCHAR), 7) AS short FROM orders")
def base_ids(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.substring_index("o_orderpriority", "-", 1).alias("base"), pt.short_sha(F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256)).alias("short"))


@query("scl_21_line_ranges", "SCL-21 SCL-22 SCL-23 SCL-24 SCL-91", "SELECT doc_id, array_to_string(string_split(text, chr(10))[2:3], chr(10)) AS part FROM documents")
def line_ranges(spark, d):
    return _docs(spark, d).select("doc_id", tx.line_range(F.col("text"), F.lit(2), F.lit(3)).alias("part"))


@query("scl_25_log_score", "SCL-25", "SELECT p_partkey, round((p_retailprice / 2000) * ln(1 + p_size) * (1 + p_size / 10.0) * CASE WHEN p_brand LIKE '%1' THEN 1.5 ELSE 1 END, 3)::DOUBLE AS score FROM part")
def log_score(spark, d):
    s = (F.col("p_retailprice") / 2000) * F.log1p(F.col("p_size")) * (1 + F.col("p_size") / 10.0) * F.when(F.col("p_brand").like("%1"), 1.5).otherwise(1.0)
    return table(spark, d, "part").select("p_partkey", F.round(s, 3).alias("score"))


@query("scl_29_name_tokens", "SCL-29", "SELECT event_type, array_to_string(list_filter(string_split(lower(regexp_replace(event_type || 'HappenedOn_site', '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '_'), lambda t: length(t) >= 3), ' ') AS tokens FROM (SELECT DISTINCT event_type FROM events)")
def name_tokens(spark, d):
    e = table(spark, d, "events").select("event_type").distinct()
    return e.select("event_type", F.array_join(tx.name_tokens(F.concat("event_type", F.lit("HappenedOn_site")), 3), " ").alias("tokens"))


@query("scl_30_cites", "SCL-30", "SELECT doc_id FROM documents WHERE regexp_matches(text, 'License[^.;\n]{0,20}(version|Version)')")
def cites(spark, d):
    return _docs(spark, d).where(tx.cites(F.col("text"), F.lit("License"), F.lit("[Vv]ersion"))).select("doc_id")


@query("scl_32_squeeze", "SCL-32", r"SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM documents")
def squeeze(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(tg.squeeze(F.col("text")).cast("binary"), 256).alias("h"))


def _mask_sql(names: list[str]) -> str:
    """Whole words replaced; twice, as neighbours share the sign between them."""
    out = "text"
    for name in names:
        for _ in range(2):
            out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}_]){name}([^\p{{L}}\p{{N}}_]|$)', '\1[...]\2', 'g')"
    return out


@query("scl_35_mask", "SCL-35 SET-14", f"SELECT doc_id, sha256({_mask_sql(['there', 'that', 'the'])}) AS h FROM documents")
def mask(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(tg.mask(F.col("text"), ["the", "there", "that"]).cast("binary"), 256).alias("h"))


@query("scl_43_frontmatter", "SCL-43 SRC-16 SRC-17 SRC-33 SCL-52 SCL-53", "SELECT item_id, '---' || chr(10) || 'id: ' || item_id || chr(10) || 'n: ' || length(text) || chr(10) || '---' || chr(10) || text AS page, length(text)::VARCHAR AS n FROM benchmark")
def frontmatter(spark, d):
    fields = F.create_map(F.lit("id"), F.col("item_id").cast("string"), F.lit("n"), F.length("text").cast("string"))
    pages = table(spark, d, "benchmark").select("item_id", F.concat(tx.emit_frontmatter(fields), F.col("text")).alias("page"))
    got, _ = tx.frontmatter(F.col("page"))
    return pages.select("item_id", "page", got["n"].alias("n"))


@query("scl_46_links", "SCL-46 SCL-47 SCL-48 SCL-123 SCL-122", "SELECT n_name, printf('/%s#L%d-L%d', n_name, n_regionkey, n_nationkey) AS resource, '[' || n_name || '](../' || n_regionkey || '/' || n_name || '.md)' AS link FROM nation")
def links(spark, d):
    page = F.concat(F.lit("functions/"), F.col("n_regionkey").cast("string"), F.lit("/"), F.col("n_name"), F.lit(".md"))
    link = pt.markdown_link(F.col("n_name"), pt.relative_link(F.lit("functions/x/a.md"), page))
    return table(spark, d, "nation").select("n_name", pt.resource(F.col("n_name"), F.col("n_regionkey"), F.col("n_nationkey")).alias("resource"), link.alias("link"))


@query("scl_75_requirements", "SCL-73 SCL-75 SCL-76 SCL-78 SCL-79 SCL-80 SCL-121 SCL-119", r"SELECT p_partkey, lower(replace(p_brand, '#', '-')) AS name, '>=' || v || ',<' || CASE WHEN p_size // 10 > 0 THEN (p_size // 10 + 1)::VARCHAR WHEN p_size % 10 > 0 THEN '0.' || (p_size % 10 + 1) ELSE '0.0.1' END AS range FROM (SELECT *, (p_size // 10) || '.' || (p_size % 10) || '.0' AS v FROM part)")
def requirements(spark, d):
    v = F.concat_ws(".", F.floor(F.col("p_size") / 10).cast("int"), F.col("p_size") % 10, F.lit("0"))
    spec = F.concat(F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit(">=1"))
    return table(spark, d, "part").select("p_partkey", vs.requirement_name(spec).alias("name"), vs.caret_range(F.concat(F.lit("^"), v)).alias("range"))


@query("scl_82_any_contains", "SCL-82 SCL-81", "SELECT doc_id FROM documents WHERE contains(text, 'License') OR contains(text, 'token') OR contains(text, '@')")
def any_contains(spark, d):
    tools = F.array(*[F.lit(x) for x in ("License", "token", "@")])
    return _docs(spark, d).where(F.exists(tools, lambda t: F.contains("text", t))).select("doc_id")


@query("scl_83_slugs", "SCL-83 SCL-122", "SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM customer")
def slugs(spark, d):
    return table(spark, d, "customer").select("c_custkey", tx.slug(F.col("c_name")).alias("slug"))


@query("scl_84_coerce", "SCL-84 SCL-85 SCL-86 SCL-129", "SELECT event_id, coalesce(try_cast(props->>'k' AS INTEGER), -1) AS k FROM events")
def coerce(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"))


@query("scl_92_grep", "SCL-92", "SELECT doc_id, no, line FROM (SELECT doc_id, generate_subscripts(l, 1) AS no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE regexp_matches(line, 'License|token =')")
def grep(spark, d):
    rows = _docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.where(F.col("line").rlike("License|token =")).select("doc_id", (F.col("pos") + 1).cast("long").alias("no"), "line")


def _user_map(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("event_type", F.length("event_type").cast("long"))))).alias("m"))


_SQL_MAP = "m AS (SELECT DISTINCT user_id, event_type AS k, length(event_type)::BIGINT AS v FROM events)"


@query("scl_93_valmap", "SCL-93 PRJ-72", f"WITH {_SQL_MAP} SELECT user_id, k, v * 2 AS v FROM m WHERE v > 4")
def valmap(spark, d):
    m = F.map_filter(F.transform_values("m", lambda _, v: v * 2), lambda _, v: v > 8)
    return _user_map(spark, d).select("user_id", F.explode(m).alias("k", "v"))


@query("scl_94_keymap", "SCL-94 PRJ-73", f"WITH {_SQL_MAP} SELECT user_id, left(k, 1) AS k, arg_max(v, k) AS v FROM m GROUP BY ALL")
def keymap(spark, d):
    return _user_map(spark, d).select("user_id", F.explode(mp.key_map(F.col("m"), lambda k: F.substring(k, 1, 1))).alias("k", "v"))


@query("scl_95_itemmap", "SCL-95 PRJ-74", f"WITH {_SQL_MAP} SELECT user_id, k || '!' AS k, v + 1 AS v FROM m")
def itemmap(spark, d):
    return _user_map(spark, d).select("user_id", F.explode(mp.item_map(F.col("m"), lambda k, v: (F.concat(k, F.lit("!")), v + 1))).alias("k", "v"))


@query("scl_96_assoc_dissoc", "SCL-96 SCL-97", f"WITH {_SQL_MAP} SELECT user_id, k, v FROM m WHERE k NOT IN ('error', 'new') UNION ALL SELECT DISTINCT user_id, 'new', 7 FROM m")
def assoc_dissoc(spark, d):
    m = mp.dissoc(mp.assoc(F.col("m"), "new", F.lit(7).cast("long")), "error")
    return _user_map(spark, d).select("user_id", F.explode(m).alias("k", "v"))


@query("scl_98_nested_records", "SCL-98 SCL-99 MUT-01 MUT-02 MUT-05 MUT-06", "SELECT o_orderkey, o_totalprice + 1 AS price, 'x' AS tag FROM orders")
def nested_records(spark, d):
    r = F.struct(F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")).alias("inner"))
    r = mp.set_in(mp.update_in(r, ["inner", "price"], lambda x: x + 1, 0.0), ["inner", "tag"], F.lit("x"))
    return table(spark, d, "orders").select("o_orderkey", r.alias("r")).select("o_orderkey", F.col("r.inner.price").alias("price"), F.col("r.inner.tag").alias("tag"))


@query("mut_03_delete", "MUT-03 MUT-04", "SELECT o_orderkey, to_json({'status': o_orderstatus})::VARCHAR AS json FROM orders")
def delete(spark, d):
    r = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_totalprice").alias("price"), F.lit(1).alias("one")).alias("inner"))
    gone = mp.delete_in(mp.delete_in(r, ["inner", "price"]), ["inner"])
    return table(spark, d, "orders").select("o_orderkey", F.to_json(gone).alias("json"))


@query("scl_100_get_in", "SCL-100", "SELECT event_id, coalesce((props->>'$.k')::BIGINT, -1) AS k, coalesce(props->>'$.a.b', 'none') AS b FROM events")
def get_in(spark, d):
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", mp.get_in(v, ["k"], "bigint", -1).alias("k"), mp.get_in(v, ["a", "b"], "string", "none").alias("b"))


@query("scl_101_unzip", "SCL-101", "SELECT l_orderkey, array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS parts, array_to_string(list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS supps FROM lineitem GROUP BY 1")
def unzip(spark, d):
    rows = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda s: F.array(s["l_partkey"], s["l_suppkey"]))
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(mp.unzip(rows, 2).alias("u"))
    return got.select("l_orderkey", F.array_join(F.col("u")[0], ",").alias("parts"), F.array_join(F.col("u")[1], ",").alias("supps"))


@query("scl_13_hunk_lines", "SCL-13 SRC-03", "SELECT n_nationkey, array_to_string(range(n_nationkey, n_nationkey + 3), ',') AS old, CASE WHEN n_regionkey = 0 THEN '' ELSE array_to_string(range(n_nationkey + 5, n_nationkey + 5 + n_regionkey), ',') END AS new FROM nation")
def hunk_lines(spark, d):
    diff = F.format_string("--- a\n+++ b\n@@ -%d,3 +%d,%d @@ f\n x", "n_nationkey", F.col("n_nationkey") + 5, "n_regionkey")
    n = table(spark, d, "nation").withColumn("diff", diff)
    return n.select("n_nationkey", F.array_join(df_.hunk_lines(F.col("diff"), "old"), ",").alias("old"), F.array_join(df_.hunk_lines(F.col("diff"), "new"), ",").alias("new"))


@query("scl_36_unified_diff", "SCL-36 SRC-40 SRC-41")
def unified_diff(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.lit("a\nb\nc").alias("old"), F.concat(F.lit("a\n"), "n_name", F.lit("\nc")).alias("new"))
    made = n.withColumn("diff", df_.unified_diff("old", "new"))
    return made.select("n_nationkey", "diff", F.array_join(df_.added_lines(F.col("diff")), ",").alias("added"), hs.normalised_patch(F.col("diff")).alias("patch_id"), hs.reversed_patch(F.col("diff")).alias("reverse_id"))


@query("scl_102_hexdump", "SCL-102 SCL-103 SCL-132 ITER-20 SRC-22 SRC-23", "SELECT page_id, lower(hex(encode(url)))[1:32] AS head, octet_length(encode(url)) AS n FROM pages")
def hexdump(spark, d):
    raw = F.col("url").cast("binary")
    p = table(spark, d, "pages").select("page_id", raw.alias("raw"), bn.hexdump(raw).alias("dump"))
    first = F.regexp_replace(F.trim(F.substring(F.split("dump", "\n")[0], 11, 47)), " ", "")
    return p.select("page_id", first.alias("head"), F.octet_length("raw").cast("long").alias("n"))


@query("scl_105_unsigned", "SCL-104 SCL-105 SCL-133", "SELECT page_id, ascii(url[1]) + 256 * ascii(url[2]) + 65536 * ascii(url[3]) AS u24 FROM pages")
def unsigned(spark, d):
    return table(spark, d, "pages").select("page_id", bn.unsigned(F.col("url").cast("binary"), 0, 3).cast("int").alias("u24"))


@query("iter_04_byte_search", "ITER-04 ITER-05", "SELECT page_id, (length(url) - length(replace(url, 'th', ''))) // 2 AS hits FROM pages")
def byte_search(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(bn.find_all(F.col("url").cast("binary"), b"th")).cast("long").alias("hits"))


@query("scl_116_append_lines", "SCL-116 SCL-68 REC-10", "SELECT item_id, array_to_string([text || ' # x', 'two'], chr(10)) AS marked, array_to_string(['one', text, 'three'], chr(10)) AS spliced FROM (SELECT item_id, replace(text, chr(10), ' ') AS text FROM benchmark)")
def append_lines(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    marked = tx.append_to_lines(F.concat("text", F.lit("\ntwo")), F.array(F.lit(1)), " # x")
    spliced = tx.splice_lines(F.lit("one\nx\ny\nthree"), F.lit(2), F.lit(3), F.col("text"))
    return b.select("item_id", marked.alias("marked"), spliced.alias("spliced"))


@query("scl_117_dedent", "SCL-117 SCL-118", "SELECT n_nationkey, n_name || chr(10) || '  b' AS dedented, '> ' || n_name || chr(10) || '>   b' AS indented FROM nation")
def dedent(spark, d):
    t = F.concat(F.lit("    "), "n_name", F.lit("\n      b"))
    return table(spark, d, "nation").select("n_nationkey", tx.dedent(t).alias("dedented"), tx.reindent(tx.dedent(t), "> ").alias("indented"))


@query("scl_124_pages", "SCL-124 SCL-125 SCL-126 SCL-127 SCL-128 SCL-37 SCL-111 SCL-112", "SELECT n_name, '# ' || n_name || chr(10) || chr(10) || 'Customers: ' || count(c_custkey) || chr(10) || 'Segments: ' || coalesce(string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment), '-') AS page FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name")
def pages(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_mktsegment")
    g = table(spark, d, "nation").join(c, "n_nationkey", "left").groupBy("n_name").agg(F.count("c_custkey").alias("n"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ", ").alias("segments"))
    return g.select("n_name", F.concat(F.lit("# "), "n_name", F.lit("\n\nCustomers: "), F.col("n").cast("string"), F.lit("\nSegments: "), tx.cell(F.col("segments"))).alias("page"))


@query("scl_131_value_keys", "SCL-131 SCL-130", "SELECT k, count(*) AS n FROM (SELECT event_type || '|' || (value > 50)::VARCHAR AS k FROM events) GROUP BY 1")
def value_keys(spark, d):
    return table(spark, d, "events").groupBy(F.concat_ws("|", "event_type", (F.col("value") > 50).cast("string")).alias("k")).agg(F.count("*").alias("n"))


@query("scl_42_sections", "SCL-42 SCL-54", "SELECT n_nationkey, '# x' || chr(10) || chr(10) || '## Links' || chr(10) || chr(10) || 'see [' || n_name || '](a.md)' || chr(10) AS page, CASE WHEN n_nationkey < 10 THEN n_name ELSE '' END AS known FROM nation")
def sections(spark, d):
    page = F.concat(F.lit("# x\n\n## Links\n\nsee ["), "n_name", F.lit("](a.md)\n"))
    known = F.when(F.col("n_nationkey") < 10, F.array("n_name")).otherwise(F.array(F.lit("other")))
    n = table(spark, d, "nation").withColumn("page", page)
    again = tx.replace_section(tx.replace_section(F.lit("# x\n\n## Links\n\nold\n"), "Links", "see $1"), "Links", "see $1")
    kept = n.withColumn("same", again == F.lit("# x\n\n## Links\n\nsee $1\n")).where("same")
    return kept.select("n_nationkey", "page", F.array_join(tx.linked_names(F.col("page"), "Links", known), ",").alias("known"))
