"""Queries of sources: exported records parsed into typed tables. Sources with files are built in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import diffs as df_
from tessera.functions import pyast as pa_
from tessera.plans.registry import query, table
from tessera.sources import readers as rd
from tessera.sources import sinks as sk


@query("src_03_numstat", "SRC-01 SRC-02 SRC-03 PRJ-05 PRJ-21", "SELECT o_orderkey, (o_orderkey % 7 + o_orderkey % 5)::INTEGER AS insertions, (o_orderkey % 3)::INTEGER AS deletions, 'src/a.py,tests/test_b.py,x.bin' AS files, o_orderkey % 2 = 0 AS is_merge, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey::INTEGER END AS pr_number FROM orders")
def numstat(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    stat = F.concat_ws("\n", F.format_string("%d\t%d\tsrc/a.py", F.col("o_orderkey") % 7, F.col("o_orderkey") % 3), F.format_string("%d\t0\ttests/test_b.py", F.col("o_orderkey") % 5), F.lit("-\t-\tx.bin"))
    parents = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    message = F.when(F.col("o_orderkey") % 4 == 0, F.format_string("Fix (#%d)\n\nbody", "o_orderkey")).otherwise("Add")
    raw = o.select("o_orderkey", F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("sha"), parents.alias("parents"), message.alias("message"), stat.alias("numstat"))
    return rd.commit_record(raw, r"^(pyproject\.toml|requirements.*)$").select(F.col("ord").alias("o_orderkey"), "insertions", "deletions", F.array_join("files_changed", ",").alias("files"), "is_merge", "pr_number")


@query("src_05_exit_code", "SRC-05", "SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN -1 ELSE n_nationkey END AS code FROM nation")
def exit_code(spark, d):
    text = F.when(F.col("n_regionkey") == 0, "no mark").otherwise(F.concat(F.lit("out\n__exit="), F.col("n_nationkey").cast("string"), F.lit("\n")))
    return table(spark, d, "nation").select("n_nationkey", rd.exit_code(text).alias("code"))


def _report(spark, d):
    phase = lambda text: F.struct(F.lit("x").alias("outcome"), text.alias("longrepr"))
    outcome = F.element_at(F.array(*[F.lit(x) for x in ("passed", "failed", "skipped", "xfailed", "odd")]), (F.col("event_id") % 5 + 1).cast("int"))
    none = F.lit(None).cast("string")
    test = F.struct(F.col("event_id").cast("string").alias("nodeid"), outcome.alias("outcome"), phase(none).alias("setup"), phase(F.col("event_type")).alias("call"), phase(none).alias("teardown"))
    broken = F.struct(F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string")).alias("nodeid"), F.lit("failed").alias("outcome"), F.lit("boom").alias("longrepr"))
    return table(spark, d, "events").groupBy("user_id").agg(F.collect_list(test).alias("tests"), F.collect_set(broken).alias("collectors"))


@query("src_10_test_results", "SRC-10 SRC-11 SRC-46", "WITH t AS (SELECT user_id, CASE event_id % 5 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'skip' WHEN 3 THEN 'skip' ELSE 'error' END AS status FROM events UNION ALL SELECT DISTINCT ON (user_id, event_id % 3) user_id, 'error' FROM events) SELECT user_id, status, count(*) AS n FROM t GROUP BY ALL")
def test_results(spark, d):
    return rd.test_results(_report(spark, d), ["user_id"]).groupBy("user_id", "status").agg(F.count("*").alias("n"))


@query("src_04_coverage", "SRC-04", "SELECT user_id, count(*) AS covered, count(DISTINCT event_type) AS tests FROM events WHERE value >= 50 GROUP BY 1")
def coverage(spark, d):
    e = table(spark, d, "events").where("value >= 50")
    per_line = e.groupBy("user_id", F.col("event_id").cast("string").alias("line")).agg(F.array_append(F.collect_set("event_type"), F.lit("")).alias("tests"))
    files = per_line.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("line", "tests"))).alias("contexts"))
    doc = files.select(F.create_map(F.col("user_id").cast("string"), F.struct(F.array().cast("array<int>").alias("executed_lines"), F.array().cast("array<int>").alias("missing_lines"), "contexts")).alias("files"))
    return rd.covered_lines(doc).groupBy(F.col("file").cast("long").alias("user_id")).agg(F.count_distinct("line").alias("covered"), F.count_distinct("test").alias("tests"))


@query("src_31_merge_report", "SRC-29 SRC-31 SRC-36 SRC-37 SRC-14 SRC-34", "SELECT c_custkey AS key, CASE WHEN c_acctbal > 5000 THEN 'new' ELSE 'old' END AS value FROM customer")
def merge_report(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_acctbal")
    return sk.merge_report(c.select("key", F.lit("old").alias("value")), c.where("c_acctbal > 5000").select("key", F.lit("new").alias("value")))


@query("src_39_blob_lookup", "SRC-39 SRC-44 SRC-15 SRC-12", "SELECT p.page_id, coalesce(d.text, '') AS blob FROM pages p LEFT JOIN documents d ON d.doc_id = p.page_id * 3")
def blob_lookup(spark, d):
    p = table(spark, d, "pages").select("page_id", (F.col("page_id") * 3).alias("doc_id"))
    return p.join(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "left").select("page_id", F.coalesce("text", F.lit("")).alias("blob"))


def _sources(spark, d):
    n = table(spark, d, "nation")
    name = F.regexp_replace(F.lower("n_name"), "[^a-z]", "_")
    body = F.format_string("import os\nfrom .m import %s as z\n\nclass C%d:\n    def get(self, x):\n        if x > %d and x < 9:\n            return x + 1\n        raise ValueError(x)\n\ndef %s(a, b=1):\n    return C%d().get(a)\n", name, "n_nationkey", "n_regionkey", name, "n_nationkey")
    return n.select("n_nationkey", F.concat(F.lit("pkg."), name).alias("module"), F.when(F.col("n_nationkey") == 7, "def broken(:").otherwise(body).alias("source"))


@query("src_06_functions", "SRC-06 SRC-07 SRC-09 SRC-45 SCL-03 SCL-04 SCL-05 SCL-57 SCL-67 SCL-107", """WITH s AS (SELECT n_nationkey, 'pkg.' || regexp_replace(lower(n_name), '[^a-z]', '_', 'g') AS m, regexp_replace(lower(n_name), '[^a-z]', '_', 'g') AS f FROM nation WHERE n_nationkey <> 7)
 SELECT n_nationkey, m || '.C' || n_nationkey || '.get' AS qualname, 5 AS line, 8 AS end_line, 3 AS complexity, 'get(self, x)' AS signature, 'ValueError' AS raises FROM s UNION ALL SELECT n_nationkey, m || '.' || f, 10, 11, 1, f || '(a, b=1)', '' FROM s""")
def functions(spark, d):
    return pa_.function_table(_sources(spark, d), ["n_nationkey"], "source", "module").select("n_nationkey", "qualname", "line", "end_line", "complexity", "signature", F.array_join("raises", ",").alias("raises"))


@query("src_06_imports", "SRC-06 SCL-26 SCL-64 SCL-65", "SELECT n_nationkey, 'import' AS kind, 'os' AS module, NULL::VARCHAR AS asname, 0 AS level FROM nation WHERE n_nationkey <> 7 UNION ALL SELECT n_nationkey, 'from', 'm', 'z', 1 FROM nation WHERE n_nationkey <> 7")
def imports(spark, d):
    return pa_.import_table(_sources(spark, d), ["n_nationkey"], "source").select("n_nationkey", "kind", "module", "asname", "level")


@query("scl_58_source_facts", "PRJ-04 SCL-55 SCL-56 SCL-58 SCL-59 SCL-60 SCL-61 SCL-62 SCL-63 SCL-66 SCL-108", "SELECT n_nationkey, n_nationkey <> 7 AS parses, CASE WHEN n_nationkey = 7 THEN '' ELSE array_to_string(list_sort(['C' || n_nationkey, f, 'os', 'z']), ',') END AS bound, CASE WHEN n_nationkey <> 7 THEN 0 END AS assertions, CASE WHEN n_nationkey <> 7 THEN false END AS effects FROM (SELECT n_nationkey, regexp_replace(lower(n_name), '[^a-z]', '_', 'g') AS f FROM nation)")
def source_facts(spark, d):
    s = _sources(spark, d)
    return s.select("n_nationkey", pa_.parses("source").alias("parses"), F.array_join(F.array_sort(pa_.bound_names("source")), ",").alias("bound"), pa_.assertions("source").alias("assertions"), pa_.side_effects("source").alias("effects"))


@query("src_40_changed_lines", "SRC-40 PRJ-05 JOIN-03", "SELECT n_nationkey, (n_nationkey + 2)::INTEGER AS changed FROM nation")
def changed_lines(spark, d):
    stats = df_.numstat(F.format_string("%d\t2\tsrc/a.py\n9\t9\tdocs/x.md", "n_nationkey"))
    return table(spark, d, "nation").select("n_nationkey", df_.changed_lines(stats, lambda p: p.like("%.py")).alias("changed"))
