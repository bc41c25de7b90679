"""Queries of projections and filters: reject chains, predicates, node sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import paths as pt
from tessera.operators import rules as ru
from tessera.plans.registry import query, table


def _order_facts(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority").join(lines, "o_orderkey", "left").na.fill(0, ["n_lines", "n_returned"])


def _order_funnel(spark, d):
    rules = [
        ru.Rule("no-lines", F.col("n_lines") == 0),
        ru.Rule("not-finished", F.col("o_orderstatus") != "F"),
        ru.Rule("too-many-lines", F.col("n_lines") > 6, F.concat(F.col("n_lines"), F.lit(">6"))),
        ru.Rule("too-small", F.col("n_lines") < 2, F.concat(F.col("n_lines"), F.lit("<2"))),
        ru.Rule("all-returned", F.col("n_lines") == F.col("n_returned")),
        ru.Rule("too-cheap", F.col("o_totalprice") < 20000),
    ]
    return ru.funnel(_order_facts(spark, d), rules)


_SQL_FUNNEL = """l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1),
 o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, coalesce(n, 0) AS n, coalesce(r, 0) AS r FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
 f AS (SELECT *, CASE WHEN n = 0 THEN 'no-lines' WHEN o_orderstatus <> 'F' THEN 'not-finished' WHEN n > 6 THEN 'too-many-lines(' || n || '>6)' WHEN n < 2 THEN 'too-small(' || n || '<2)' WHEN n = r THEN 'all-returned' WHEN o_totalprice < 20000 THEN 'too-cheap' END AS reason FROM o)"""


@query("prj_01_order_funnel", "PRJ-01 PRJ-03 PRJ-05 PRJ-10 PRJ-14", f"WITH {_SQL_FUNNEL} SELECT o_orderkey, reason, CASE WHEN reason IS NULL THEN 'candidate' ELSE 'rejected' END AS status FROM f")
def order_funnel(spark, d):
    return _order_funnel(spark, d).select("o_orderkey", "reason", "status")


@query("agg_02_reason_histogram", "AGG-02 AGG-24 AGG-27 AGG-79 AGG-80", f"WITH {_SQL_FUNNEL} SELECT CASE WHEN reason IS NULL THEN 'candidate' ELSE 'rejected:' || split_part(reason, '(', 1) END AS key, count(*) AS n FROM f GROUP BY 1")
def reason_histogram(spark, d):
    return ru.status_histogram(_order_funnel(spark, d))


@query("agg_05_score", "AGG-05 WIN-03", f"WITH {_SQL_FUNNEL} SELECT o_orderkey, round(CASE WHEN starts_with(o_orderpriority, '1') THEN 1.0 ELSE 0 END + CASE WHEN n >= 3 THEN 2.0 ELSE 0 END + CASE WHEN r > 0 THEN -3.0 ELSE 0 END, 3)::DOUBLE AS score FROM f WHERE reason IS NULL")
def score(spark, d):
    kept = _order_funnel(spark, d).where("status = 'candidate'")
    total, _ = ru.additive_score({"urgent": (F.startswith(F.col("o_orderpriority"), F.lit("1")), 1.0), "many": (F.col("n_lines") >= 3, 2.0), "returned": (F.col("n_returned") > 0, -3.0)})
    return kept.select("o_orderkey", total.alias("score"))


@query("prj_02_path_globs", "PRJ-02 PRJ-20 PRJ-22 PRJ-29", r"SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path, regexp_matches(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '^((^|.*/)(en|de)/.*)$') AS ignored FROM pages")
def path_globs(spark, d):
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    return table(spark, d, "pages").select("page_id", path.alias("path"), pt.matches_any(path, ["en/", "de/"]).alias("ignored"))


@query("prj_06_decisions", "PRJ-06 PRJ-10 JOIN-13 JOIN-14 PRJ-81", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no-answer' WHEN quality = 0 THEN 'kind:poor' WHEN toxic = 1 THEN 'not-clean' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def decisions(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id", "quality", "toxic")
    rules = [ru.Rule("kind:poor", F.col("quality") == 0), ru.Rule("not-clean", F.col("toxic") == 1)]
    return ru.decide(docs, labels, ["doc_id"], rules, "no-answer").select("doc_id", "reason")


@query("prj_08_part_funnel", "PRJ-08 PRJ-09 PRJ-11 PRJ-12 PRJ-18 PRJ-19", """WITH l AS (SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)
 SELECT p_partkey, CASE WHEN n IS NULL THEN 'uncovered' WHEN n < 20 THEN 'few-covering(' || n || '<20)' WHEN n > 45 THEN 'too-central(' || n || '>45)' WHEN p_size < 5 THEN 'too-short' WHEN p_size > 40 THEN 'too-long' END AS reason, coalesce(n, 0) * p_size AS score FROM part LEFT JOIN l ON l_partkey = p_partkey""")
def part_funnel(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_orderkey").alias("n"))
    parts = table(spark, d, "part").select("p_partkey", "p_size").join(lines, "p_partkey", "left")
    rules = [
        ru.Rule("uncovered", F.col("n").isNull()),
        ru.Rule("few-covering", F.col("n") < 20, F.concat(F.col("n"), F.lit("<20"))),
        ru.Rule("too-central", F.col("n") > 45, F.concat(F.col("n"), F.lit(">45"))),
        ru.Rule("too-short", F.col("p_size") < 5),
        ru.Rule("too-long", F.col("p_size") > 40),
    ]
    return ru.funnel(parts, rules).select("p_partkey", "reason", (F.coalesce("n", F.lit(0)) * F.col("p_size")).alias("score"))


@query("prj_13_name_predicates", "PRJ-07 PRJ-13 PRJ-23 PRJ-30", "SELECT p_partkey, starts_with(p_name, '_') AS private, upper(p_brand) = p_brand AS shouted FROM part")
def name_predicates(spark, d):
    return table(spark, d, "part").select("p_partkey", pt.is_private(F.col("p_name")).alias("private"), (F.upper("p_brand") == F.col("p_brand")).alias("shouted"))


@query("prj_15_root_entries", "PRJ-15 PRJ-16 PRJ-17 SCL-113 SCL-114", "SELECT 'task-' || o_orderkey || '-' || left(sha256(o_orderkey::VARCHAR), 7) AS id, CASE o_orderstatus WHEN 'F' THEN 'VALID' WHEN 'O' THEN 'INVALID' ELSE 'UNVALIDATED' END AS state, concat_ws('/', 'tasks', o_orderpriority, o_orderkey::VARCHAR) AS path FROM orders")
def root_entries(spark, d):
    sha = F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256)
    state = F.when(F.col("o_orderstatus") == "F", "VALID").when(F.col("o_orderstatus") == "O", "INVALID").otherwise("UNVALIDATED")
    return table(spark, d, "orders").select(pt.task_id("task", F.col("o_orderkey").cast("string"), pt.short_sha(sha)).alias("id"), state.alias("state"), F.concat_ws("/", F.lit("tasks"), "o_orderpriority", F.col("o_orderkey").cast("string")).alias("path"))


@query("prj_24_node_union", "PRJ-24 AGG-04 REC-15", "SELECT type, count(*) AS n, count(balance) AS with_balance FROM (SELECT 'region' AS type, NULL::DOUBLE AS balance FROM region UNION ALL SELECT 'nation', NULL FROM nation UNION ALL SELECT 'customer', c_acctbal FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY 1")
def node_union(spark, d):
    parts = [
        table(spark, d, "region").select(F.lit("region").alias("type"), F.col("r_regionkey").cast("long").alias("id")),
        table(spark, d, "nation").select(F.lit("nation").alias("type"), F.col("n_nationkey").cast("long").alias("id")),
        table(spark, d, "customer").select(F.lit("customer").alias("type"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")),
        table(spark, d, "supplier").select(F.lit("supplier").alias("type"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
    ]
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p, allowMissingColumns=True)
    return nodes.groupBy("type").agg(F.count("*").alias("n"), F.count("balance").alias("with_balance"))


@query("prj_25_failure_reasons", "PRJ-25 PRJ-26 PRJ-28 AGG-16 AGG-17 AGG-67", "SELECT role, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN contains(text, '?') THEN 'question' WHEN contains(text, '!') THEN 'shout' WHEN regexp_matches(text, '[0-9]') THEN 'number' ELSE 'plain' END AS kind, count(*) AS n FROM conversations GROUP BY ALL")
def failure_reasons(spark, d):
    t = F.col("text")
    kind = ru.first_reason([ru.Rule("empty", t.isNull() | (t == "")), ru.Rule("question", F.contains(t, F.lit("?"))), ru.Rule("shout", F.contains(t, F.lit("!"))), ru.Rule("number", t.rlike("[0-9]")), ru.Rule("plain", F.lit(True))])
    return table(spark, d, "conversations").groupBy("role", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("prj_27_relative_paths", "PRJ-27 SCL-74", "SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN url[9:] WHEN starts_with(url, 'http') THEN NULL ELSE url END AS rel FROM pages")
def relative_paths(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", F.when(F.startswith(u, F.lit("https://")), F.substring(u, F.lit(9), F.length(u))).when(F.startswith(u, F.lit("http")), None).otherwise(u).alias("rel"))


@query("prj_76_markers", "PRJ-76 PRJ-77 PRJ-78", "SELECT source, CASE WHEN bool_or(contains(text, 'License')) THEN 'licensed' WHEN bool_or(contains(text, 'token =')) THEN 'secret' ELSE 'none' END AS style, bool_or(lang = 'de') AS has_de FROM documents GROUP BY 1")
def markers(spark, d):
    any_ = lambda c: F.bool_or(c)
    style = F.when(any_(F.contains("text", F.lit("License"))), "licensed").when(any_(F.contains("text", F.lit("token ="))), "secret").otherwise("none")
    return table(spark, d, "documents").groupBy("source").agg(style.alias("style"), any_(F.col("lang") == "de").alias("has_de"))


@query("prj_82_overlay", "PRJ-82 SET-12 PRJ-79", "SELECT DISTINCT p_brand AS name FROM part WHERE p_size > 45 UNION SELECT DISTINCT p_brand FROM part WHERE p_retailprice > 990 EXCEPT SELECT DISTINCT p_brand FROM part WHERE p_brand LIKE '%5'")
def overlay(spark, d):
    p = table(spark, d, "part")
    some = p.where("p_size > 45").select(F.col("p_brand").alias("name")).union(p.where("p_retailprice > 990").select("p_brand"))
    return some.where(~F.col("name").like("%5")).distinct()
