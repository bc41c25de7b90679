"""Queries of selection, sequential decisions, incremental recomputation and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import hashing as hs
from tessera.operators import aggregates as ag
from tessera.operators import selection as sl
from tessera.operators import sequences as sq
from tessera.plans import ledger as lg
from tessera.plans import steps as st
from tessera.plans.registry import query, table
from tessera.streaming import retries as rt


def _pool(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    kind = F.element_at(F.split("p_type", " "), 1)
    return p.select(F.col("p_partkey").alias("id"), kind.alias("type"), F.col("p_brand").alias("module"), F.when(F.col("p_size") < 17, "easy").when(F.col("p_size") < 34, "medium").otherwise("hard").alias("difficulty"), F.col("p_size").alias("weight"), (F.col("p_size") > 5).alias("eligible"))


_SQL_POOL = "pool AS (SELECT p_partkey AS id, split_part(p_type, ' ', 1) AS type, p_brand AS module, p_size AS weight FROM part WHERE p_size > 5)"


@query("rec_03_greedy", "REC-03 PRJ-79 REC-02", f"WITH {_SQL_POOL}, k AS (SELECT type FROM pool GROUP BY 1 ORDER BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY weight DESC, id) AS rn FROM pool) SELECT id FROM r WHERE NOT (type = (SELECT max(type) FROM k) AND rn > 2) ORDER BY (type = (SELECT min(type) FROM k) AND rn <= 4) DESC, weight DESC, id LIMIT 10")
def greedy(spark, d):
    pool = _pool(spark, d).where("eligible")
    ends = pool.agg(F.min("type").alias("lo"), F.max("type").alias("hi")).first()
    return sl.greedy(pool, sl.Quotas(10, {ends["lo"]: 4}, {ends["hi"]: 2})).select("id")


@query("rec_01_select", "REC-01 REC-05 REC-06 SRC-28")
def select(spark, d):
    pool = _pool(spark, d)
    ends = pool.where("eligible").agg(F.min("type").alias("lo"), F.max("type").alias("hi")).first()
    return sl.select(pool, sl.Quotas(10, {ends["lo"]: 4}, {ends["hi"]: 2}, modules=7, spread={"easy": 3, "medium": 4, "hard": 3})).select("id", "selected")


@query("rec_07_shortlist", "REC-07")
def shortlist(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("module"), F.col("p_size").cast("double").alias("score"), F.col("p_partkey").alias("ord"))
    return sl.shortlist(p, 15, 0.5)


@query("rec_08_chunks", "REC-08", """WITH RECURSIVE t AS (SELECT conv_id, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS o FROM conversations),
 c AS (SELECT conv_id, o, n AS size, 0::BIGINT AS chunk FROM t WHERE o = 1 UNION ALL SELECT t.conv_id, t.o, CASE WHEN c.size + t.n > 600 THEN t.n ELSE c.size + t.n END, CASE WHEN c.size + t.n > 600 THEN c.chunk + 1 ELSE c.chunk END FROM c JOIN t ON t.conv_id = c.conv_id AND t.o = c.o + 1)
 SELECT conv_id, max(chunk) + 1 AS chunks, count(*) AS turns FROM c GROUP BY 1""")
def chunks(spark, d):
    sizes = ag.group_list(table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("n")), ["conv_id"], "turn", "n", "sizes")
    zero = F.struct(F.lit(-1).cast("long").alias("chunk"), F.lit(601).alias("size"))
    step = lambda a, n: F.when(a["size"] + n > 600, F.struct((a["chunk"] + 1).alias("chunk"), n.alias("size"))).otherwise(F.struct(a["chunk"].alias("chunk"), (a["size"] + n).alias("size")))
    return sizes.select("conv_id", (F.aggregate("sizes", zero, step)["chunk"] + 1).alias("chunks"), F.size("sizes").cast("long").alias("turns"))


@query("rec_09_interleaved", "REC-09", "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY depth, event_type) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS depth FROM events)) WHERE rn <= 6")
def interleaved(spark, d):
    e = sq.number(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"], "depth")
    w = Window.partitionBy("user_id").orderBy("depth", "event_type")
    return e.withColumn("rn", F.row_number().over(w)).where("rn <= 6").select("event_type", "event_id")


@query("rec_13_members", "REC-13", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS members FROM nation GROUP BY 1")
def members(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("members"))


@query("iter_03_random_sample", "ITER-03")
def random_sample(spark, d):
    return table(spark, d, "events").select("event_id").where(F.pmod(F.xxhash64(F.lit(5), "event_id"), F.lit(1000)) < 100)


def _steps(spark, d) -> DataFrame:
    """step, input_hash: every document of a source weighs in by two sums of hashes, so that no step is gathered."""
    docs = table(spark, d, "documents").select(F.col("source").alias("step"), F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))).cast("binary"), 256).alias("h"))
    part = lambda a: F.sum(F.conv(F.substring("h", a, 15), 16, 10).cast("decimal(38,0)"))
    sums = docs.groupBy("step").agg(F.count("*").alias("n"), part(1).alias("a"), part(16).alias("b"))
    return sums.select("step", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ("n", "a", "b")]).cast("binary")).alias("input_hash"))


@query("iter_07_stale_steps", "ITER-07 ITER-08 ITER-09 ITER-10 ITER-12 ITER-13 ITER-14 ITER-15 ITER-16 ITER-22 ITER-23 ITER-24 ITER-26 SRC-36 SRC-37", "SELECT DISTINCT source AS step FROM documents WHERE (source NOT LIKE '%1%' AND source NOT LIKE '%7') OR source = 'src11' OR source LIKE '%7'")
def stale_steps(spark, d):
    steps = _steps(spark, d)
    empty = spark.createDataFrame([], lg.SCHEMA)
    done = lg.mark(empty, steps.where("step LIKE '%1%'"), "done", 1)
    failed = lg.mark(done, steps.where("step LIKE '%7'"), "failed", 2)
    return lg.stale(steps, failed, forced=["src11"]).select("step")


@query("iter_25_obsolete", "ITER-25", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def obsolete(spark, d):
    return lg.obsolete(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("iter_17_batches", "ITER-17 ITER-18 ITER-19 ITER-28 ITER-06", """WITH r AS (SELECT doc_id, quality = 0 AS good, row_number() OVER (ORDER BY doc_id) - 1 AS ord FROM labels), b AS (SELECT ord // 15 AS batch, count(*) FILTER (good) AS g FROM r GROUP BY 1),
 w AS (SELECT batch, coalesce(sum(g) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 20 AND batch * 15 < 240 AS ran FROM b) SELECT doc_id, ran FROM r JOIN w ON batch = ord // 15""")
def batches(spark, d):
    rows = sq.with_ordinals(table(spark, d, "labels").select("doc_id", (F.col("quality") == 0).alias("good")), ["doc_id"])
    return lg.batches_until(rows, "ord", "good", 15, 20, 240).select("doc_id", "ran")


@query("iter_27_retries", "ITER-11 ITER-17 ITER-27", """WITH a AS (SELECT user_id::VARCHAR AS task, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS attempt, CASE WHEN event_type <> 'click' THEN event_type END AS issue, value FROM events),
    s AS (SELECT *, sum(value) OVER (PARTITION BY task ORDER BY attempt ROWS UNBOUNDED PRECEDING) AS spent FROM a),
    t AS (SELECT *, CASE WHEN issue IS NULL THEN 'final' WHEN attempt >= 3 OR spent >= 40 THEN 'failed' ELSE 'retry' END AS status FROM s)
    SELECT task, attempt, status, CASE WHEN status = 'failed' AND attempt < 3 AND spent >= 40 THEN 'budget spent' ELSE issue END AS feedback, round(spent, 2) AS spent FROM t
    QUALIFY count(*) FILTER (status <> 'retry') OVER (PARTITION BY task ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0""")
def retries(spark, d):
    e = sq.number(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    answers = e.select(F.col("user_id").cast("string").alias("task"), (F.col("ord") + 1).cast("int").alias("attempt"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("issue"), F.col("value").alias("cost"), F.lit(None).cast("string").alias("payload"))
    return rt.decide_table(answers, 3, 40.0).select("task", "attempt", "status", "feedback", F.round("spent", 2).alias("spent"))


@query("iter_12_reuse", "ITER-12 ITER-16 UDF-22", "SELECT count(*) FILTER (l.doc_id IS NOT NULL) AS hits, count(*) FILTER (l.doc_id IS NULL) AS misses FROM documents d LEFT JOIN labels l USING (doc_id)")
def reuse(spark, d):
    hit, miss = lg.reuse(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"], ["quality"])
    both = hit.select(F.lit(1).alias("h"), F.lit(0).alias("m")).union(miss.select(F.lit(0), F.lit(1)))
    return both.agg(F.sum("h").alias("hits"), F.sum("m").alias("misses"))


@query("iter_15_projection_hash", "ITER-15 ITER-26 SRC-42 SRC-43", "SELECT doc_id, sha256(concat(length(lang), ':', lang, length(source), ':', source)) AS key FROM documents")
def projection_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", hs.content_key(F.col("lang"), F.col("source")).alias("key"))


#: Steps of documents, their sources, their languages, families of sources, and one report; every 97th document is changed.
_SQL_STEPS = """WITH RECURSIVE d AS (SELECT doc_id, md5(text) AS old, md5(CASE WHEN doc_id % 97 = 0 THEN text || '!' ELSE text END) AS new, source, lang FROM documents),
 e AS (SELECT 'source:' || source AS step, 'doc:' || doc_id AS input, 'text' AS role FROM d UNION SELECT 'lang:' || lang, 'doc:' || doc_id, 'text' FROM d WHERE doc_id % 2 = 0
 UNION SELECT 'family:' || right(source, 1), 'source:' || source, 'member' FROM d UNION SELECT 'report', 'family:' || right(source, 1), 'source' FROM d UNION SELECT 'report', 'lang:' || lang, 'lang' FROM d WHERE doc_id % 2 = 0),
 h0 AS (SELECT 'doc:' || doc_id AS step, sha256(old || '|0|0|0') AS old, sha256(new || '|0|0|0') AS new FROM d),
"""


def _sql_level(name: str, below: str, like: str) -> str:
    part = lambda c, a: f"sum(('0x' || substr(sha256(length(role) || ':' || role || ':' || {c}), {a}, 15))::BIGINT::HUGEINT)"
    make = lambda c: f"sha256('' || '|' || count(*) || '|' || {part(c, 1)} || '|' || {part(c, 16)}) AS {c}"
    return f"{name} AS (SELECT e.step, {make('old')}, {make('new')} FROM e JOIN {below} b ON b.step = e.input WHERE {like} GROUP BY 1)"


_SQL_STEPS += ",\n ".join([
    _sql_level("h1", "h0", "(e.step LIKE 'source:%' OR e.step LIKE 'lang:%')"),
    _sql_level("h2", "h1", "e.step LIKE 'family:%'"),
    _sql_level("h3", "(FROM h1 UNION ALL FROM h2)", "e.step = 'report'"),
    "h AS (FROM h0 UNION ALL FROM h1 UNION ALL FROM h2 UNION ALL FROM h3)",
    "behind AS (SELECT 'doc:' || doc_id AS step FROM d WHERE old <> new UNION SELECT e.step FROM e JOIN behind ON behind.step = e.input)",
])


def _step_graph(spark, d, changed: bool) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    text = F.when((F.col("doc_id") % 97 == 0) & F.lit(changed), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    doc, source, lang, family = (F.concat(F.lit(f"{k}:"), v.cast("string")) for k, v in (("doc", F.col("doc_id")), ("source", F.col("source")), ("lang", F.col("lang")), ("family", F.right("source", F.lit(1)))))
    edge = lambda rows, step, on, role: rows.select(step.alias("step"), on.alias("input"), F.lit(role).alias("role")).distinct()
    even = docs.where("doc_id % 2 = 0")
    inputs = edge(docs, source, doc, "text").union(edge(even, lang, doc, "text")).union(edge(docs, family, source, "member"))
    inputs = inputs.union(edge(docs, F.lit("report"), family, "source")).union(edge(even, F.lit("report"), lang, "lang"))
    steps = docs.select(doc.alias("step"), F.md5(text.cast("binary")).alias("own")).union(inputs.select("step", F.lit("").alias("own")).distinct())
    return steps, inputs


@query("iter_23_step_hashes", "ITER-23 ITER-24 ITER-22 SCL-28", f"{_SQL_STEPS} SELECT step, new AS input_hash, (CASE WHEN step LIKE 'doc:%' THEN 0 WHEN step = 'report' THEN 3 WHEN step LIKE 'family:%' THEN 2 ELSE 1 END)::INTEGER AS level FROM h")
def step_hashes(spark, d):
    """The hash of every step: a document's from its text, all others' from the hashes of what they are made from."""
    return st.hashes(*_step_graph(spark, d, True)).select("step", "input_hash", "level")


@query("iter_24_behind_a_change", "ITER-23 ITER-24 ITER-13 ITER-14 ITER-26 ITER-10", f"{_SQL_STEPS} SELECT h.step, behind.step IS NOT NULL AS runs FROM h LEFT JOIN behind USING (step)")
def behind_a_change(spark, d):
    """Of a graph done before some documents changed, what must run: the changed and exactly what is made from them."""
    before = st.hashes(*_step_graph(spark, d, False))
    done = lg.mark(spark.createDataFrame([], lg.SCHEMA), before, "done", 1)
    return st.plan_run(*_step_graph(spark, d, True), done).select("step", "runs")


@query("iter_13_prior_decisions", "ITER-13 ITER-14 ITER-26 ITER-10", f"{_SQL_STEPS} SELECT doc_id, source FROM d WHERE 'source:' || source NOT IN (SELECT step FROM behind)")
def prior_decisions(spark, d):
    """Decisions on documents, taken by source: those of sources whose input is as it was."""
    before = st.hashes(*_step_graph(spark, d, False))
    docs = table(spark, d, "documents").select("doc_id", "source", F.concat(F.lit("source:"), "source").alias("step"))
    return st.reusable(docs.join(before, "step"), st.hashes(*_step_graph(spark, d, True))).select("doc_id", "source")
