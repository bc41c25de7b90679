"""Queries of the aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import ranking as rk
from tessera.operators import sequences as sq
from tessera.plans.registry import query, table


@query("agg_01_hotspots", "AGG-01 AGG-60 AGG-61 AGG-62 AGG-53 AGG-30", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1")
def hotspots(spark, d):
    return ag.histogram(table(spark, d, "lineitem"), "l_partkey")


@query("agg_03_inverted", "AGG-03 REC-11 REC-12 REC-14", "SELECT l_suppkey AS value, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS keys FROM lineitem GROUP BY 1")
def inverted(spark, d):
    lists = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.collect_set("l_suppkey").alias("supps"))
    return ag.invert(lists, "l_returnflag", "supps").select("value", F.array_join("keys", ",").alias("keys"))


@query("agg_04_keep_last", "AGG-04 SRC-32 ITER-08 ITER-09", "SELECT md5(text) AS id, max(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY 1")
def keep_last(spark, d):
    docs = table(spark, d, "documents").select(F.md5(F.col("text").cast("binary")).alias("id"), "doc_id")
    last = ag.keep_last(docs, ["id"], [F.col("doc_id").desc()])
    return last.join(ag.histogram(docs, "id"), "id").select("id", "doc_id", "n")


@query("agg_06_two_level_top", "AGG-06", """WITH g AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY sum(p_size) DESC, p_brand LIMIT 3), r AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part)
 SELECT p_partkey, p_brand IN (SELECT p_brand FROM g) AND rn <= 5 AS selected FROM r""")
def two_level_top(spark, d):
    return rk.two_level_top(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), "p_brand", "p_size", "p_partkey", 3, 5).select("p_partkey", "selected")


@query("agg_07_uncovered", "AGG-07", """WITH p AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, event_type FROM events), s AS (SELECT DISTINCT user_id, day // 7 AS week FROM p),
 m AS (SELECT s.user_id, s.week, count(*) AS n, count(*) FILTER (event_type <> 'click') AS miss FROM s JOIN p ON p.user_id = s.user_id AND day BETWEEN week * 7 AND week * 7 + 6 GROUP BY ALL) SELECT user_id, week, miss / n::DOUBLE AS ratio, n AS measured FROM m""")
def uncovered(spark, d):
    from tessera.operators import ranges as rg

    p = table(spark, d, "events").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).alias("day"), "event_type")
    s = p.select("user_id", F.floor(F.col("day") / 7).alias("week")).distinct().withColumn("lo", F.col("week") * 7).withColumn("hi", F.col("week") * 7 + 6)
    return rg.uncovered_ratio(p, s, ["user_id"], "day", "lo", "hi", ["user_id", "week"], F.col("event_type") == "click")


@query("agg_08_rollup", "AGG-08 AGG-10 AGG-18 AGG-22 AGG-34 AGG-69 AGG-81", "SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_totalprice > 100000) AS big FROM orders GROUP BY 1")
def rollup(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_totalprice") > 100000).alias("big"))


@query("agg_09_thresholds", "AGG-09 AGG-68", "SELECT c_nationkey, CASE WHEN count(*) < 50 THEN 'few' WHEN count(*) FILTER (c_acctbal < 0) * 10 < count(*) THEN 'kept' ELSE 'weak' END AS state FROM customer GROUP BY 1")
def thresholds(spark, d):
    state = F.when(F.count("*") < 50, "few").when(F.count_if(F.col("c_acctbal") < 0) * 10 < F.count("*"), "kept").otherwise("weak")
    return table(spark, d, "customer").groupBy("c_nationkey").agg(state.alias("state"))


@query("agg_11_mode", "AGG-11 AGG-42 REC-16", "SELECT c_nationkey, arg_max(c_mktsegment, (n, c_mktsegment)) AS mode FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) GROUP BY 1")
def mode(spark, d):
    n = ag.histogram(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")
    return ag.argmax(n, ["c_nationkey"], "c_mktsegment", F.col("n"), F.col("c_mktsegment").desc(), "mode")


@query("agg_12_known_keys", "AGG-12 AGG-13", "SELECT k AS status, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(k) LEFT JOIN orders ON o_orderstatus = k GROUP BY 1")
def known_keys(spark, d):
    known = spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "status string")
    return ag.histogram(table(spark, d, "orders").withColumnRenamed("o_orderstatus", "status"), "status", known=known)


@query("agg_15_spread", "AGG-15", "WITH h AS (SELECT l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY 1), t AS (SELECT * FROM (VALUES ('A', 100), ('N', 200), ('Z', 7)) v(k, wanted)) SELECT sum(abs(coalesce(n, 0) - coalesce(wanted, 0)))::BIGINT AS distance FROM h FULL JOIN t USING (k)")
def spread(spark, d):
    target = spark.createDataFrame([("A", 100), ("N", 200), ("Z", 7)], "l_returnflag string, wanted long")
    return ag.histogram_distance(table(spark, d, "lineitem"), "l_returnflag", target)


@query("agg_20_runs_identical", "AGG-20 AGG-23 AGG-75", "SELECT count(*) FILTER (a.v IS DISTINCT FROM b.v OR a.k IS NULL OR b.k IS NULL) = 0 AS identical FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer) a FULL JOIN (SELECT c_custkey AS k, upper(c_mktsegment) AS v FROM customer) b ON a.k = b.k")
def runs_identical(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return ag.runs_identical(c, c.select("c_custkey", F.upper("c_mktsegment").alias("c_mktsegment")), "c_custkey", "c_mktsegment")


@query("agg_21_reasons", "AGG-21 REC-04", "SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice < 50000 THEN 'cheap' END, CASE WHEN o_orderstatus = 'P' THEN 'partial' END, CASE WHEN starts_with(o_orderpriority, '5') THEN 'low' END) AS reasons FROM orders")
def reasons(spark, d):
    checks = F.array(F.when(F.col("o_totalprice") < 50000, F.lit("cheap")), F.when(F.col("o_orderstatus") == "P", F.lit("partial")), F.when(F.startswith(F.col("o_orderpriority"), F.lit("5")), F.lit("low")))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.filter(checks, lambda x: x.isNotNull()), ",").alias("reasons"))


@query("agg_25_evidence", "AGG-25 AGG-26 AGG-28", "SELECT source, lang, count(*) AS n, array_to_string(list_sort(list(DISTINCT doc_id % 10)), ',') AS digits FROM documents GROUP BY ALL")
def evidence(spark, d):
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(F.col("doc_id") % 10)), ",").alias("digits"))


@query("agg_31_conformance", "AGG-31 AGG-63", "SELECT count(*) = count(DISTINCT doc_id) AS distinct_ids, count(*) FILTER (text IS NULL OR text = '') AS empty, count(*) FILTER (n_chars <> length(text)) AS wrong_length FROM documents")
def conformance(spark, d):
    return table(spark, d, "documents").agg((F.count("*") == F.count_distinct("doc_id")).alias("distinct_ids"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"))


@query("agg_32_totals", "AGG-32 AGG-33 AGG-39 AGG-73 AGG-76 SRC-32", "SELECT l_returnflag, sum(l_quantity)::BIGINT AS qty, count(*) AS n, grouping(l_returnflag) = 1 AS is_total FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())")
def totals(spark, d):
    return ag.totals(table(spark, d, "lineitem").withColumn("one", F.lit(1)), ["l_returnflag"], {"l_quantity": "qty", "one": "n"})


@query("agg_37_try_ratio", "AGG-37 AGG-35 AGG-70", "SELECT c_nationkey, round(count(*) FILTER (c_acctbal > 9000) / nullif(count(*) FILTER (c_acctbal > 5000), 0)::DOUBLE, 3) AS ratio FROM customer GROUP BY 1")
def try_ratio(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.try_divide(F.count_if(F.col("c_acctbal") > 9000).cast("double"), F.count_if(F.col("c_acctbal") > 5000)), 3).alias("ratio"))


@query("agg_40_budget", "AGG-40 ITER-11 AGG-78", "SELECT event_id, (sum(n) OVER w)::BIGINT AS spent, sum(n) OVER w <= 500 AS within FROM (SELECT *, length(event_type) AS n FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def budget(spark, d):
    e = sq.number(table(spark, d, "events").select("event_id", "user_id", "ts", F.length("event_type").alias("n")), ["user_id"], ["ts", "event_id"])
    return ag.running_total(e, ["user_id"], "ord", "n", 500).select("event_id", "spent", "within")


@query("agg_43_nested_group", "AGG-43 AGG-44 AGG-46 AGG-47 AGG-48", "SELECT n_regionkey, c_mktsegment, count(*) AS n, max(c_acctbal) AS most, min(c_acctbal) AS least, round(avg(c_acctbal), 2) AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def nested_group(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    flat = table(spark, d, "customer").join(n, "c_nationkey").groupBy("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"), F.max("c_acctbal").alias("most"), F.min("c_acctbal").alias("least"), F.round(F.avg("c_acctbal"), 2).alias("mean"))
    tree = flat.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", F.struct("n", "most", "least", "mean")))).alias("tree"))
    return tree.select("n_regionkey", F.explode("tree").alias("c_mktsegment", "v")).select("n_regionkey", "c_mktsegment", "v.*")


@query("agg_45_first_last", "AGG-45 WIN-16 SORT-07", "SELECT user_id, arg_min(event_type, (epoch_us(ts), event_id)) AS first, arg_max(event_type, (epoch_us(ts), event_id)) AS last FROM events GROUP BY 1")
def first_last(spark, d):
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", at).alias("first"), F.max_by("event_type", at).alias("last"))


@query("agg_49_reservoir", "AGG-49")
def reservoir(spark, d):
    return ag.reservoir(table(spark, d, "events").select("event_id", "event_type"), ["event_type"], 20, 11, F.col("event_id"))


@query("agg_50_limited", "AGG-50", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 10 GROUP BY 1")
def limited(spark, d):
    e = sq.number(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    return ag.limit_per_group(e, ["user_id"], "ord", 10).groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("agg_51_fold", "AGG-51 AGG-59 AGG-64", "SELECT user_id, list_reduce(list_prepend(7::BIGINT, list(length(event_type)::BIGINT ORDER BY ts, event_id)), lambda a, x: (a * 31 + x) % 1000003) AS value FROM events GROUP BY 1")
def fold(spark, d):
    e = sq.number(table(spark, d, "events").select("user_id", "ts", "event_id", F.length("event_type").cast("long").alias("n")), ["user_id"], ["ts", "event_id"])
    return ag.reduce_by(e, ["user_id"], "ord", "n", lambda a, x: (a * 31 + x) % 1000003, F.lit(7).cast("long"))


@query("agg_52_sum_init", "AGG-52 AGG-54 AGG-55", "SELECT conv_id, 100 + sum(length(text))::BIGINT AS total, count(*) AS turns FROM conversations GROUP BY 1")
def sum_init(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg((F.lit(100) + F.sum(F.length("text"))).alias("total"), F.count("*").alias("turns"))


@query("agg_56_merge", "AGG-56 AGG-57 AGG-65", "SELECT user_id, event_type AS key, arg_max(value, (epoch_us(ts), event_id)) AS merged FROM events GROUP BY ALL")
def merge(spark, d):
    e = sq.number(table(spark, d, "events").select("user_id", "ts", "event_id", F.create_map("event_type", "value").alias("m")), ["user_id"], ["ts", "event_id"])
    return ag.merge_maps(e, ["user_id"], "ord", "m")


@query("agg_58_group_lists", "AGG-58 SORT-16", "SELECT conv_id, array_to_string(list(role ORDER BY turn), '>') AS roles FROM conversations GROUP BY 1")
def group_lists(spark, d):
    return ag.group_list(table(spark, d, "conversations"), ["conv_id"], "turn", "role").select("conv_id", F.array_join("items", ">").alias("roles"))


@query("agg_66_merge_with", "AGG-66", "SELECT user_id, event_type AS key, count(*) AS merged FROM events GROUP BY ALL")
def merge_with(spark, d):
    e = sq.number(table(spark, d, "events").select("user_id", "ts", "event_id", F.create_map("event_type", "value").alias("m")), ["user_id"], ["ts", "event_id"])
    return ag.merge_maps(e, ["user_id"], "ord", "m", lambda vs: F.size(vs).cast("long"))


@query("agg_71_text_table", "AGG-71 AGG-72 SCL-87 SCL-88 SCL-89 SCL-90", "SELECT c_mktsegment, '| ' || concat_ws(' | ', c_mktsegment, count(*)::VARCHAR, coalesce(nullif(max(CASE WHEN c_acctbal > 9990 THEN 'rich' ELSE '' END), ''), '-')) || ' |' AS line FROM customer GROUP BY 1")
def text_table(spark, d):
    from tessera.functions import text as tx

    rich = F.max(F.when(F.col("c_acctbal") > 9990, "rich").otherwise(""))
    g = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), rich.alias("rich"))
    return g.select("c_mktsegment", tx.markdown_row(F.col("c_mktsegment"), F.col("n").cast("string"), tx.cell(F.col("rich"))).alias("line"))


@query("agg_74_environment", "AGG-74 SCL-71 SCL-72", "SELECT source, sha256(array_to_string(list(doc_id || chr(0) || sha256(text) ORDER BY doc_id || chr(0) || sha256(text)), chr(10))) AS tree FROM documents GROUP BY 1")
def environment(spark, d):
    from tessera.functions.hashing import tree_hash

    return tree_hash(table(spark, d, "documents").select("source", F.col("doc_id").cast("string").alias("path"), "text"), ["source"], "path", "text")


@query("agg_77_counters", "AGG-77 AGG-41", "SELECT role, count(*) FILTER (contains(text, '.')) AS sentences, sum(length(text) - length(replace(text, '.', '')))::BIGINT AS dots, max(turn) AS most FROM conversations GROUP BY 1")
def counters(spark, d):
    dots = F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))
    return table(spark, d, "conversations").groupBy("role").agg(F.count_if(F.contains("text", F.lit("."))).alias("sentences"), F.sum(dots).alias("dots"), F.max("turn").alias("most"))
