"""Queries of the joins: intervals, defaults, null keys, self joins, prefixes, verification of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import ancestry as an
from tessera.operators import graph as gr
from tessera.operators import joins as jn
from tessera.operators import ranges as rg
from tessera.operators import segments as sg
from tessera.operators import sequences as sq
from tessera.plans import funnels as fn
from tessera.plans.registry import query, table

#: Hours that a purchase's interval lasts, and seconds of a bucket of the interval join.
SPAN_S, BUCKET_S = 6 * 3600, 6 * 3600


def _points(spark, d) -> DataFrame:
    return table(spark, d, "events").select("user_id", "event_id", "event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("at"))


def _spans(spark, d) -> DataFrame:
    bought = _points(spark, d).where("event_type = 'purchase'")
    return bought.select("user_id", F.col("event_id").alias("span"), F.col("at").alias("start"), (F.col("at") + SPAN_S).alias("end"))


_SQL_SPANS = f"""p AS (SELECT user_id, event_id, event_type, epoch_us(ts) // 1000000 AS sec FROM events),
 s AS (SELECT user_id, event_id AS span, sec AS a, sec + {SPAN_S} AS b FROM p WHERE event_type = 'purchase'),
 m AS (SELECT p.*, s.span FROM p JOIN s ON p.user_id = s.user_id AND p.sec BETWEEN s.a AND s.b)"""


@query("join_01_interval_hits", "JOIN-01 JOIN-03 JOIN-04 AGG-01 SORT-17", f"WITH {_SQL_SPANS} SELECT event_type, count(*) AS hits, count(DISTINCT span) AS spans FROM m GROUP BY 1")
def interval_hits(spark, d):
    met = rg.interval_join(_points(spark, d), _spans(spark, d), ["user_id"], "at", "start", "end", BUCKET_S)
    return met.groupBy("event_type").agg(F.count("*").alias("hits"), F.count_distinct("span").alias("spans"))


@query("join_02_span_coverage", "JOIN-02 JOIN-15", f"WITH {_SQL_SPANS} SELECT span, round(count(*) FILTER (event_type = 'click') * 100.0 / count(*), 1) AS pct FROM m GROUP BY 1")
def span_coverage(spark, d):
    return rg.ratio_by_span(_points(spark, d), _spans(spark, d), ["user_id"], "at", "start", "end", ["span"], F.col("event_type") == "click", bucket=BUCKET_S)


@query("join_05_invert_passing", "JOIN-05 JOIN-13 AGG-03", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def invert_passing(spark, d):
    passing = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(passing, "l_orderkey", "left_semi")
    return lines.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("n_orders"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"))


def _edges(spark, d) -> DataFrame:
    n, c, s, o = (table(spark, d, t) for t in ("nation", "customer", "supplier", "orders"))
    name = lambda kind, col: F.concat(F.lit(f"{kind}:"), F.col(col).cast("string"))
    return gr.union_edges({
        "contains": n.select(name("region", "n_regionkey").alias("source"), name("nation", "n_nationkey").alias("target")),
        "hosts": c.select(name("nation", "c_nationkey").alias("source"), name("customer", "c_custkey").alias("target")).union(s.select(name("nation", "s_nationkey"), name("supplier", "s_suppkey"))),
        "orders": o.select(name("customer", "o_custkey").alias("source"), name("order", "o_orderkey").alias("target")),
    })


_SQL_EDGES = """e AS (SELECT DISTINCT * FROM (
 SELECT 'contains' AS type, 'region:' || n_regionkey AS source, 'nation:' || n_nationkey AS target FROM nation
 UNION ALL SELECT 'hosts', 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
 UNION ALL SELECT 'hosts', 'nation:' || s_nationkey, 'supplier:' || s_suppkey FROM supplier
 UNION ALL SELECT 'orders', 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders))"""


@query("join_07_edge_counts", "JOIN-07 JOIN-08 JOIN-36 SORT-21 SORT-22 PRJ-24", f"WITH {_SQL_EDGES}, n AS (SELECT 'region:' || r_regionkey AS id FROM region UNION ALL SELECT 'nation:' || n_nationkey FROM nation UNION ALL SELECT 'customer:' || c_custkey FROM customer) SELECT type, count(*) AS n, min(source) AS first_source, max(target) AS last_target FROM e WHERE source IN (SELECT id FROM n) GROUP BY 1")
def edge_counts(spark, d):
    ids = [table(spark, d, t).select(F.concat(F.lit(f"{k}:"), F.col(c).cast("string")).alias("id")) for t, k, c in (("region", "region", "r_regionkey"), ("nation", "nation", "n_nationkey"), ("customer", "customer", "c_custkey"))]
    nodes = ids[0].union(ids[1]).union(ids[2])
    kept = gr.without_dangling(_edges(spark, d), nodes)
    return kept.groupBy("type").agg(F.count("*").alias("n"), F.min("source").alias("first_source"), F.max("target").alias("last_target"))


@query("join_09_location_default", "JOIN-09 JOIN-19 JOIN-25 AGG-19", "SELECT coalesce(o_orderstatus, 'missing') AS status, count(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def location_default(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    both = c.join(o, "c_custkey", "left").withColumn("status", F.coalesce("o_orderstatus", F.lit("missing")))
    return ag.histogram(both, "status")


@query("join_10_first_later", "JOIN-10 JOIN-11", "SELECT a.o_orderkey, arg_min(b.o_orderkey, (epoch_us(b.o_orderdate), b.o_orderkey)) AS later FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND floor(a.o_totalprice / 50000) = floor(b.o_totalprice / 50000) AND b.o_orderdate > a.o_orderdate GROUP BY 1")
def first_later(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.floor(F.col("o_totalprice") / 50000).alias("band"))
    return jn.first_later(o, ["o_custkey", "band"], "o_orderkey", "o_orderdate")


#: A history for each nation and market segment, from its orders by date: blocks of seven commits, of which three go on, four stand on a
#: branch that takes the main line in and is merged by the next block; some commits name an old branch as a parent too.
_SQL_HISTORY = """WITH RECURSIVE o AS (SELECT c_nationkey || c_mktsegment AS repo, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders JOIN customer ON o_custkey = c_custkey),
 m AS (SELECT repo, i, CASE i % 7 WHEN 0 THEN i - 5 WHEN 3 THEN i - 3 ELSE i - 1 END AS a, CASE WHEN i % 7 = 0 THEN i - 1 WHEN i % 7 = 5 THEN i - 3 WHEN i % 7 = 4 AND i // 7 % 4 = 3 THEN i // 7 * 7 - 15 END AS b FROM o),
 p AS (SELECT repo, i, a AS parent FROM m WHERE a >= 0 UNION SELECT repo, i, b FROM m WHERE b >= 0),
 ra AS (SELECT repo, i AS range, a AS x FROM m WHERE b >= 0 AND a >= 0 UNION SELECT ra.repo, range, parent FROM ra JOIN p ON p.repo = ra.repo AND p.i = ra.x),
 rb AS (SELECT repo, i AS range, b AS x FROM m WHERE b >= 0 AND a >= 0 UNION SELECT rb.repo, range, parent FROM rb JOIN p ON p.repo = rb.repo AND p.i = rb.x)"""


def _history(spark, d) -> DataFrame:
    """repo, sha, ord, parents: places in the history of a repository."""
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment").alias("repo"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate").join(c, "c_custkey")
    i = F.row_number().over(Window.partitionBy("repo").orderBy("o_orderdate", "o_orderkey")) - 1
    at, block = F.col("sha"), F.floor(F.col("sha") / 7)
    a = F.when(at % 7 == 0, at - 5).when(at % 7 == 3, at - 3).otherwise(at - 1)
    b = F.when(at % 7 == 0, at - 1).when(at % 7 == 5, at - 3).when((at % 7 == 4) & (block % 4 == 3), block * 7 - 15)
    return o.select("repo", i.cast("long").alias("sha")).withColumn("parents", F.filter(F.array(a, b), lambda x: x >= 0))


@query("join_12_merged_commits", "JOIN-12", f"{_SQL_HISTORY} SELECT repo, range, x AS sha FROM (SELECT repo, range, x FROM rb EXCEPT SELECT repo, range, x FROM ra)")
def merged_commits(spark, d):
    """What every merge brings in: the commits that its second parent reaches and its first does not."""
    commits = _history(spark, d).withColumn("level", F.col("sha"))
    merges = commits.where(F.size("parents") > 1).select("repo", F.col("sha").alias("range"), F.col("parents")[0].alias("a"), F.col("parents")[1].alias("b"))
    return an.ranges(commits, merges)


@query("join_12_superseded", "JOIN-12", f"{_SQL_HISTORY} SELECT repo, sha, min(range) AS merge FROM (SELECT repo, range, x AS sha FROM rb EXCEPT SELECT repo, range, x FROM ra) WHERE range % 2 = 1 GROUP BY ALL")
def superseded(spark, d):
    """Commits that a kept merge stands for, every second one being kept; the earlier of two merges is later in order."""
    status = F.when(F.col("sha") % 2 == 1, "kept").otherwise("rejected")
    commits = _history(spark, d).select("repo", "sha", (-F.col("sha")).alias("ord"), "parents", (F.size("parents") > 1).alias("is_merge"), status.alias("status"))
    return fn.superseded(commits).select("repo", "sha", "merge")


@query("join_16_verify_edges", "JOIN-16 JOIN-30 JOIN-31 JOIN-32 JOIN-33 JOIN-34 JOIN-37 PRJ-80 AGG-29 AGG-36", f"""WITH {_SQL_EDGES},
 f AS (SELECT DISTINCT 'contains' AS type, 'region:' || r_regionkey AS source, 'nation:' || n_nationkey AS target FROM region JOIN nation ON n_regionkey = r_regionkey
 UNION SELECT 'hosts', 'nation:' || n_nationkey, 'customer:' || c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
 UNION SELECT 'orders', 'customer:' || c_custkey, 'order:' || o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey),
 v AS (SELECT e.type, CASE WHEN f.type IS NOT NULL THEN 'confirmed' WHEN e.target LIKE 'supplier:%' THEN 'unverifiable' ELSE 'mismatch' END AS verdict FROM e LEFT JOIN f USING (type, source, target))
 SELECT type, count(*) FILTER (verdict = 'confirmed') AS good, count(*) FILTER (verdict = 'mismatch') AS bad, count(*) FILTER (verdict = 'unverifiable') AS other,
 round(count(*) FILTER (verdict = 'confirmed') / nullif(count(*) FILTER (verdict <> 'unverifiable'), 0)::DOUBLE, 3) AS "precision" FROM v GROUP BY 1""")
def verify_edges(spark, d):
    r, n, c, o = (table(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    name = lambda kind, col: F.concat(F.lit(f"{kind}:"), F.col(col).cast("string"))
    facts = r.join(n, F.col("r_regionkey") == F.col("n_regionkey")).select(F.lit("contains").alias("type"), name("region", "r_regionkey").alias("source"), name("nation", "n_nationkey").alias("target"))
    facts = facts.union(n.join(c.where("c_acctbal >= 0"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.lit("hosts"), name("nation", "n_nationkey"), name("customer", "c_custkey")))
    facts = facts.union(c.join(o, F.col("c_custkey") == F.col("o_custkey")).select(F.lit("orders"), name("customer", "c_custkey"), name("order", "o_orderkey")))
    checked = gr.verify(_edges(spark, d), facts, ~F.startswith(F.col("target"), F.lit("supplier:")))
    return ag.precision(checked, "type", "verdict", "confirmed", "mismatch")


@query("join_17_features", "JOIN-17 JOIN-18 JOIN-45 JOIN-46", "SELECT n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, count(*) FILTER (o_orderstatus = 'O') AS open_orders FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def features(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey"))
    both = n.join(c.join(o, "c_custkey", "left"), "n_nationkey", "left")
    return both.groupBy("n_name").agg(F.count_distinct("c_custkey").alias("customers"), F.count("o_orderkey").alias("orders"), F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"))


@query("join_20_missing_imports", "JOIN-20 JOIN-06 JOIN-39 JOIN-40 SET-09 AGG-38", "SELECT p_brand, count(*) AS never_ordered FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) GROUP BY 1")
def missing_imports(spark, d):
    used = table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return ag.histogram(table(spark, d, "part").select("p_partkey", "p_brand").join(used, "p_partkey", "left_anti"), "p_brand", out="never_ordered")


@query("join_21_still_failing", "JOIN-21 JOIN-38 JOIN-41 JOIN-44 SET-10", "SELECT count(*) AS n, min(k) AS first, max(k) AS last FROM (SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_linestatus = 'O')")
def still_failing(spark, d):
    lines = table(spark, d, "lineitem")
    both = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")).intersect(lines.where("l_linestatus = 'O'").select(F.col("l_partkey").alias("k")))
    return both.agg(F.count("*").alias("n"), F.min("k").alias("first"), F.max("k").alias("last"))


@query("join_23_one_hop", "JOIN-23 JOIN-22 JOIN-24", f"WITH {_SQL_EDGES}, f AS (SELECT 'customer:' || c_custkey AS id, c_mktsegment AS fact FROM customer) SELECT source AS id, count(DISTINCT fact) AS facts FROM e JOIN f ON f.id = e.target WHERE type = 'hosts' GROUP BY 1")
def one_hop(spark, d):
    facts = table(spark, d, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("fact"))
    got = gr.one_hop(facts, _edges(spark, d), ["hosts"]).where(F.startswith(F.col("id"), F.lit("nation:")))
    return got.groupBy("id").agg(F.count("*").alias("facts"))


@query("join_26_prefix", "JOIN-26 JOIN-27", "SELECT o.c_custkey AS by_key, t.c_custkey AS found FROM (SELECT c_custkey, left(md5(c_custkey::VARCHAR), 7) AS p FROM customer) o JOIN (SELECT c_custkey, md5(c_custkey::VARCHAR) AS h FROM customer) t ON starts_with(h, p)")
def prefix(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.md5(F.col("c_custkey").cast("string").cast("binary")).alias("h"))
    short = c.select(F.col("c_custkey").alias("by_key"), F.substring("h", 1, 7).alias("p"))
    return jn.prefix_join(short, c.select(F.col("c_custkey").alias("found"), "h"), "p", "h", 7).select("by_key", "found")


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("k"), "c_custkey")
    s = table(spark, d, "supplier").select(F.when(F.col("s_acctbal") >= 2000, F.col("s_nationkey")).alias("k2"), "s_suppkey")
    return c, s


_SQL_SIDES = "c AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS k, c_custkey FROM customer), s AS (SELECT CASE WHEN s_acctbal >= 2000 THEN s_nationkey END AS k2, s_suppkey FROM supplier)"
_JOIN_SQL = "WITH {0} SELECT k, k2, count(*) AS n, sum(coalesce(c_custkey, -1))::BIGINT AS custs, sum(coalesce(s_suppkey, -2))::BIGINT AS supps FROM c {1} JOIN s ON k IS NOT DISTINCT FROM k2 GROUP BY ALL"


def _outer(how: str):
    """Each side is counted and summed by its key before they meet: a group of m and n rows meets as one row, not as m * n."""

    def run(spark, d):
        c, s = _sides(spark, d)
        c = c.groupBy("k").agg(F.count("*").alias("cs"), F.sum(F.coalesce("c_custkey", F.lit(-1))).alias("custs"))
        s = s.groupBy("k2").agg(F.count("*").alias("ss"), F.sum(F.coalesce("s_suppkey", F.lit(-2))).alias("supps"))
        met = jn.join(c, s, [("k", "k2")], how, {"cs": 1, "custs": -1, "ss": 1, "supps": -2})
        return met.select("k", "k2", (F.col("cs") * F.col("ss")).alias("n"), (F.col("custs") * F.col("ss")).alias("custs"), (F.col("supps") * F.col("cs")).alias("supps"))

    return run


for _how in ("inner", "left", "right", "full"):
    query(f"join_28_{_how}_null_safe", "JOIN-28", _JOIN_SQL.format(_SQL_SIDES, _how.upper()))(_outer(_how))


@query("join_29_positional_diff", "JOIN-29 JOIN-42 SET-08", """WITH a AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS o FROM events),
 b AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) - 1 AS o FROM events)
 SELECT a.user_id, a.o AS ord, a.event_type AS v0, b.event_type AS v1 FROM a JOIN b ON a.user_id = b.user_id AND a.o = b.o WHERE a.event_type IS DISTINCT FROM b.event_type""")
def positional_diff(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return jn.positional_diff([sq.number(e, ["user_id"], ["ts", "event_id"]), sq.number(e, ["user_id"], ["value", "event_id"])], ["user_id"], "ord", "event_type")


@query("join_35_symbol_targets", "JOIN-35 SCL-45 AGG-14 SORT-19", "SELECT DISTINCT split_part(p_type, ' ', 1) AS module, split_part(p_type, ' ', 2) AS attr FROM part")
def symbol_targets(spark, d):
    p = table(spark, d, "part").select(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("module"), F.split_part("p_type", F.lit(" "), F.lit(2)).alias("attr"))
    return p.dropDuplicates(["module", "attr"])


@query("join_43_reason_rows", "JOIN-43", "SELECT DISTINCT o_orderpriority AS reason, o_orderstatus AS source FROM orders UNION SELECT DISTINCT c_mktsegment, 'synthetic' FROM customer")
def reason_rows(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("reason"), F.col("o_orderstatus").alias("source"))
    return o.union(table(spark, d, "customer").select("c_mktsegment", F.lit("synthetic"))).distinct()


@query("join_47_first_segment", "JOIN-47 JOIN-48 PRJ-75", "SELECT event_id, min(n_nationkey) AS segment FROM events LEFT JOIN nation ON value >= n_nationkey * 4 AND value < n_nationkey * 4 + 10 GROUP BY 1")
def first_segment(spark, d):
    seg = table(spark, d, "nation").select(F.col("n_nationkey").alias("segment"), (F.col("n_nationkey") * 4).alias("lo"), (F.col("n_nationkey") * 4 + 10).alias("hi"))
    points = table(spark, d, "events").select("event_id", "value")
    return rg.first_containing(points, seg, "value", "lo", "hi", "segment", ["event_id"], 10).select("event_id", "segment")


@query("join_49_module_scan", "JOIN-49 ITER-21 PRJ-91", "SELECT lang, count(*) AS docs, sum((length(text) - length(replace(text, 'the', ''))) // 3)::BIGINT AS hits FROM documents WHERE contains(lower(source), 'src1') GROUP BY 1")
def module_scan(spark, d):
    docs = table(spark, d, "documents").where(F.contains(F.lower("source"), F.lit("src1")))
    hits = ((F.length("text") - F.length(F.replace("text", F.lit("the"), F.lit("")))) / 3).cast("long")
    return docs.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(hits).alias("hits"))


#: Every document is a segment of its own mebibyte; every nation is a module over a twenty-fifth of the ids below 5,000.
SEGMENT, MODULE_SEGMENTS, PATTERNS = 1 << 20, 200, [b"tion", b"the "]
_SQL_SEGMENTS = f"""WITH p AS (SELECT unnest(['tion', 'the ']) AS pattern), d AS (SELECT doc_id AS segment, doc_id * {SEGMENT} AS start, text FROM documents),
 w AS (SELECT segment, start, pattern, unnest(string_split(text, pattern)) AS piece, generate_subscripts(string_split(text, pattern), 1) AS k, len(string_split(text, pattern)) AS pieces FROM d, p),
 h AS (SELECT segment, pattern, start + sum(strlen(piece) + 4) OVER (PARTITION BY segment, pattern ORDER BY k) - 4 AS address, k, pieces FROM w)"""


def _segments(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("segment"), (F.col("doc_id") * SEGMENT).alias("start"), F.col("text").cast("binary").alias("content"))


def _modules(spark, d) -> DataFrame:
    n = F.col("n_nationkey").cast("long")
    return table(spark, d, "nation").select(F.col("n_name").alias("module"), (n * MODULE_SEGMENTS * SEGMENT).alias("base"), ((n + 1) * MODULE_SEGMENTS * SEGMENT).alias("end"), n.alias("ord"), (n % 2 == 1).alias("unloaded"))


@query("join_49_segment_hits", "JOIN-49 ITER-21", f"{_SQL_SEGMENTS} SELECT n_name AS module, segment, pattern, address::BIGINT AS address FROM h JOIN nation ON segment // {MODULE_SEGMENTS} = n_nationkey WHERE k < pieces")
def segment_hits(spark, d):
    """Every place of the patterns in the segments of every module, over ranges of 4 KiB that overlap."""
    found = sg.search_modules(_segments(spark, d), _modules(spark, d), PATTERNS, MODULE_SEGMENTS * SEGMENT, size=4096)
    return found.select("module", "segment", F.decode("pattern", "UTF-8").alias("pattern"), "address")


@query("iter_21_first_hits", "ITER-21", f"{_SQL_SEGMENTS} SELECT segment, pattern, min(address)::BIGINT AS address FROM h WHERE k < pieces GROUP BY ALL")
def first_hits(spark, d):
    """The first place of each pattern in every segment."""
    return sg.search(_segments(spark, d), PATTERNS, find_first=True, size=4096).withColumn("pattern", F.decode("pattern", "UTF-8"))


@query("src_22_memory_reads", "SRC-22 SRC-23", f"""WITH r AS (SELECT doc_id AS request, doc_id * {SEGMENT} + doc_id * 37 % 1500 AS address FROM documents), d AS (SELECT doc_id, doc_id * 37 % 1500 AS o, strlen(text) AS n, hex(encode(text)) AS h FROM documents)
 SELECT request, address, CASE WHEN o < n AND o + 16 <= n THEN substr(h, 2 * o + 1, 32) END AS data, CASE WHEN o >= n THEN 'address not in memory range' WHEN o + 16 > n THEN 'read would cross boundaries' END AS error FROM r JOIN d ON doc_id = request""")
def memory_reads(spark, d):
    """Sixteen bytes at an address for every document, which may lie outside of all segments or too near to the end of one."""
    requests = table(spark, d, "documents").select(F.col("doc_id").alias("request"), (F.col("doc_id") * SEGMENT + F.col("doc_id") * 37 % 1500).alias("address"), F.lit(16).alias("size"))
    return sg.read_at(_segments(spark, d), requests, SEGMENT).select("request", "address", F.hex("data").alias("data"), "error")


@query("prj_91_module_names", "PRJ-91", "WITH w AS (SELECT DISTINCT left(n_name, 2) AS name FROM nation UNION SELECT 'nowhere') SELECT name, arg_min(n_name, (n_nationkey % 2, n_nationkey)) AS module FROM w LEFT JOIN nation ON contains(lower(n_name), lower(name)) GROUP BY 1")
def module_names(spark, d):
    """The module that a part of a name, in any case, stands for: loaded ones first."""
    wanted = table(spark, d, "nation").select(F.substring("n_name", 1, 2).alias("name")).union(spark.createDataFrame([("nowhere",)], "name string")).distinct()
    return sg.find_modules(_modules(spark, d), wanted).select("name", "module")


@query("udf_11_graph_tools", "UDF-11 UDF-12 UDF-10", f"WITH {_SQL_EDGES} SELECT DISTINCT target FROM e WHERE source = 'nation:3' UNION SELECT DISTINCT source FROM e WHERE target = 'nation:3'")
def graph_tools(spark, d):
    from tessera.plans.tools import graph_tools as tools

    edges = _edges(spark, d).withColumn("type", F.lit("calls"))
    nodes = edges.select(F.col("source").alias("id")).distinct()
    t = tools(nodes, edges, spark.createDataFrame([], "ord long, sha string"))
    return t["callees"](qualname="nation:3").union(t["callers"](qualname="nation:3")).distinct()


_SQL_TOOLS = f"""WITH {_SQL_EDGES}, g AS (SELECT DISTINCT CASE type WHEN 'hosts' THEN 'calls' WHEN 'orders' THEN 'tested_by' ELSE type END AS type, replace(source, ':', '.') AS source, replace(target, ':', '.') AS target FROM e),
 n AS (SELECT DISTINCT source AS id FROM g), c AS (SELECT o_orderkey AS ord, md5(o_orderkey::VARCHAR) AS sha FROM orders)"""


@query("udf_10_table_functions", "UDF-10 UDF-11 UDF-12 JOIN-24 JOIN-25", f"""{_SQL_TOOLS} SELECT 'show_symbol' AS tool, id AS asked, id AS answer FROM n WHERE id = 'nation.3'
 UNION ALL SELECT DISTINCT 'callers', target, source FROM g WHERE type = 'calls' UNION ALL SELECT DISTINCT 'callees', source, target FROM g WHERE type = 'calls'
 UNION ALL SELECT DISTINCT 'tests_for', source, target FROM g WHERE type = 'tested_by'
 UNION ALL (SELECT 'show_commit', 'a', sha FROM c WHERE starts_with(sha, 'a') ORDER BY ord LIMIT 1)
 UNION ALL SELECT 'module_members', 'nation', id FROM n WHERE starts_with(id, 'nation.')""")
def table_functions(spark, d):
    """The six tools called from SQL: for a constant, and for every node of the graph at once."""
    from tessera.plans import table_functions as tf

    kind = F.when(F.col("type") == "hosts", "calls").when(F.col("type") == "orders", "tested_by").otherwise(F.col("type"))
    dotted = [F.replace(c, F.lit(":"), F.lit(".")).alias(c) for c in ("source", "target")]
    edges = _edges(spark, d).select(kind.alias("type"), *dotted).distinct()
    nodes = edges.select(F.col("source").alias("id")).distinct().withColumn("type", F.substring_index("id", ".", 1))
    commits = table(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("sha"), F.col("o_orderpriority").alias("message"))
    tf.register_graph(spark, nodes, edges, commits)
    return spark.sql("""SELECT 'show_symbol' AS tool, 'nation.3' AS asked, id AS answer FROM show_symbol('nation.3')
        UNION ALL SELECT 'callers', t.id, f.source FROM (SELECT DISTINCT target AS id FROM tessera_edges) t, LATERAL callers(t.id) f
        UNION ALL SELECT 'callees', t.id, f.target FROM tessera_nodes t, LATERAL callees(t.id) f
        UNION ALL SELECT 'tests_for', t.id, f.test FROM tessera_nodes t, LATERAL tests_for(t.id) f
        UNION ALL SELECT 'show_commit', 'a', sha FROM show_commit('a')
        UNION ALL SELECT 'module_members', 'nation', id FROM module_members('nation')""")


@query("udf_10_grep_file", "UDF-10 UDF-11", "SELECT doc_id::VARCHAR AS path, no, line FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS rn FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents) WHERE regexp_matches(line, 'tion|ing ')) WHERE rn <= 3")
def grep_file(spark, d):
    """The first three lines of every document that match, by a table function over the table of documents."""
    from tessera.plans import table_functions as tf

    tf.register_files(spark)
    table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content")).createOrReplaceTempView("tessera_files")
    return spark.sql("SELECT * FROM grep_file(TABLE(SELECT path, content FROM tessera_files) PARTITION BY (path), 'tion|ing ', 3)")
