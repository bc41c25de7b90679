"""The whole funnels on the given tables: orders stand for commits, their lines for changed files, parts for functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import funnels as fn
from tessera.plans.registry import query, table


def _commits(spark, d):
    k = F.col("o_orderkey")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == "A", "docs/a.md").when(F.col("l_returnflag") == "R", "tests/test_r.py").otherwise(F.concat(F.lit("src/m"), (F.col("l_partkey") % 40).cast("string"), F.lit(".py"))))).alias("files_changed"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))).cast("int").alias("source_lines"),
        F.array_sort(F.collect_set(F.when(F.col("l_returnflag") == "N", F.concat(F.lit("p.f"), (F.col("l_partkey") % 60).cast("string"))))).alias("touched_functions"),
    )
    o = table(spark, d, "orders").join(lines, k == F.col("l_orderkey"), "left")
    none = F.array().cast("array<string>")
    return o.select(
        k.alias("ord"), F.sha2(k.cast("string").cast("binary"), 256).alias("sha"), F.when(k % 50 == 0, none).otherwise(F.array(F.lit("x"))).alias("parents"),
        F.when(k % 9 == 0, "Fix an error").otherwise("Add").alias("message"), (k % 7 == 0).alias("is_merge"), F.when(k % 14 == 0, k.cast("int")).alias("pr_number"),
        F.coalesce("files_changed", none).alias("files_changed"), F.coalesce("source_lines", F.lit(0)).alias("source_lines"),
        F.filter(F.coalesce("files_changed", none), lambda f: F.startswith(f, F.lit("tests/"))).alias("test_files_touched"), (k % 11 == 0).alias("touches_manifest"),
        F.coalesce("touched_functions", none).alias("touched_functions"), (k % 13 != 0).alias("parses"),
    )


def _covered(spark, d):
    return spark.range(30).select(F.concat(F.lit("p.f"), F.col("id").cast("string")).alias("qualname"))


_SQL_COMMITS = """l AS (SELECT l_orderkey, count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_partkey % 40 END) AS n_src, count(*) FILTER (l_returnflag <> 'A') AS n_live, count(*) FILTER (l_returnflag = 'R') AS n_test,
 sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END)::INTEGER AS src_lines, count(*) FILTER (l_returnflag = 'N' AND l_partkey % 60 < 30) AS n_cov, count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_partkey % 60 END) AS n_fn FROM lineitem GROUP BY 1),
 c AS (SELECT o_orderkey AS k, coalesce(n_src, 0) AS n_src, coalesce(n_live, 0) AS n_live, coalesce(n_test, 0) AS n_test, coalesce(src_lines, 0) AS n, coalesce(n_cov, 0) AS n_cov, coalesce(n_fn, 0) AS n_fn FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
 f AS (SELECT *, CASE WHEN k % 50 = 0 THEN 'root-commit' WHEN k % 7 = 0 AND k % 14 <> 0 THEN 'non-pr-merge' WHEN n_live = 0 THEN 'docs-or-ci-only' WHEN k % 11 = 0 THEN 'dependency-changing' WHEN n_src = 0 THEN 'no-source-change'
 WHEN n_src > 6 THEN 'too-many-files(' || n_src || '>6)' WHEN n < 3 THEN 'too-small(' || n || '<3)' WHEN n > 300 THEN 'too-large(' || n || '>300)' WHEN n_cov = 0 AND n_test = 0 THEN 'uncovered-and-no-tests' WHEN k % 13 = 0 THEN 'unparseable' END AS reason FROM c)"""


@query("prj_01_commit_funnel", "PRJ-01 PRJ-02 PRJ-03 PRJ-04 PRJ-05 JOIN-10 SCL-14", f"WITH {_SQL_COMMITS} SELECT k AS ord, reason, CASE WHEN reason IS NULL THEN 'considered' ELSE 'rejected' END AS status FROM f")
def commit_funnel(spark, d):
    return fn.commit_funnel(_commits(spark, d), _covered(spark, d)).select("ord", "reason", "status")


@query("agg_05_commit_scores", "AGG-05 PRJ-07 WIN-03", f"WITH {_SQL_COMMITS} SELECT k AS ord, (CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END + CASE WHEN n_test > 0 THEN 2 ELSE 0 END + CASE WHEN n_fn > 0 THEN 1 ELSE 0 END + CASE WHEN n_fn = 1 THEN 1 ELSE 0 END)::DOUBLE AS score FROM f WHERE reason IS NULL")
def commit_scores(spark, d):
    kept = fn.commit_funnel(_commits(spark, d), _covered(spark, d)).where("status = 'considered'")
    public = _covered(spark, d).withColumn("is_public", F.lit(True))
    return fn.score_commits(kept, public).select("ord", "score")


@query("prj_09_function_funnel", "PRJ-08 PRJ-09 PRJ-11 JOIN-05 JOIN-06", """WITH t AS (SELECT DISTINCT l_partkey, l_orderkey % 97 AS t FROM lineitem), n AS (SELECT l_partkey, count(*) AS n, min(t::VARCHAR) FILTER (t % 10 = 3) AS bad FROM t GROUP BY 1),
 f AS (SELECT p_partkey, coalesce(n, 0) AS n, p_size AS span, p_partkey % 9 AS depth, bad FROM part LEFT JOIN n ON l_partkey = p_partkey),
 r AS (SELECT *, CASE WHEN p_partkey % 31 = 0 THEN 'test-code' WHEN p_partkey % 29 = 0 THEN 'init-module' WHEN p_partkey % 17 = 0 THEN 'private' WHEN n = 0 THEN 'uncovered' WHEN n < 2 THEN 'few-covering-tests(' || n || '<2)' WHEN n > 40 THEN 'too-central(' || n || '>40)'
 WHEN span < 8 THEN 'too-short(' || span || '<8)' WHEN span > 80 THEN 'too-long(' || span || '>80)' WHEN depth < 3 THEN 'low-complexity(' || depth || '<3)' WHEN bad IS NOT NULL THEN 'verifier-imports-private(t' || bad || '.py: _x)' END AS reason FROM f)
 SELECT p_partkey, reason, CASE WHEN reason IS NULL THEN n * depth END AS score FROM r""")
def function_funnel(spark, d):
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 17 == 0, "_g").otherwise("g"), k.cast("string"))
    module = F.when(k % 31 == 0, "tests.m").otherwise("p.m")
    f = table(spark, d, "part").select(
        "p_partkey", F.concat(module, F.lit("."), name).alias("qualname"), module.alias("module"), F.when(k % 29 == 0, "p/__init__.py").otherwise("p/m.py").alias("file"), name.alias("name"),
        F.lit(None).cast("string").alias("parent"), F.lit(False).alias("is_method"), F.lit(1).alias("line"), F.col("p_size").alias("end_line"), (k % 9).cast("int").alias("complexity"),
    )
    hit = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), (F.col("l_orderkey") % 97).alias("t")).distinct()
    tests = f.select("p_partkey", "qualname").join(hit, "p_partkey").select("qualname", F.concat(F.lit("t"), F.col("t").cast("string"), F.lit(".py::x")).alias("test"))
    modules = spark.createDataFrame([("p.m", False, True), ("tests.m", True, False)], "module string, is_test boolean, is_source boolean")
    private = spark.range(97).where("id % 10 = 3").select(F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".py")).alias("test_file"), F.array(F.lit("_x")).alias("names"))
    got = fn.function_funnel(f, tests, modules, spark.createDataFrame([], "qualname string, is_public boolean"), private)
    return got.select("p_partkey", "reason", F.col("score").cast("long").alias("score"))


@query("agg_16_verdicts", "AGG-16 AGG-17 AGG-18 AGG-19 AGG-20 AGG-21", "SELECT user_id AS report, count(*) FILTER (event_type <> 'view') AS n_failing, count(*) FILTER (event_type = 'view') AS n_passing, CASE WHEN count(*) FILTER (event_type <> 'view') = 0 THEN 'no_failing_test' ELSE array_to_string(list_sort(list_distinct(list(CASE event_type WHEN 'error' THEN 'ImportError' WHEN 'signup' THEN 'no_report' END) FILTER (event_type IN ('error', 'signup')))), ',') END AS invalid FROM events GROUP BY 1")
def verdicts(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("report"), "event_id", "event_type")
    reason = F.when(F.col("event_type") == "error", "ImportError").when(F.col("event_type") == "signup", "no_report").otherwise("AssertionError")
    reasons = e.where("event_type <> 'view'").select("report", F.col("event_id").alias("nodeid"), reason.alias("reason"))
    reports = e.groupBy("report").agg(F.count("*").alias("collected"), F.count_if(F.col("event_type") == "view").alias("n_passing"))
    # an empty list of reasons joins to null in SQL
    return fn.verdicts(reasons, reports).select("report", "n_failing", "n_passing", F.when(F.size("invalid") > 0, F.array_join("invalid", ",")).alias("invalid"))
