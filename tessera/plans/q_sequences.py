"""Queries of ordered sequences, sorts and set operations over events, conversations and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import ranking as rk
from tessera.operators import sequences as sq
from tessera.plans.registry import query, table

_ORD = "(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)"
_E = f"e AS (SELECT *, {_ORD} AS ord FROM events)"


def _events(spark, d) -> DataFrame:
    return sq.number(table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"])


def _turns(spark, d) -> DataFrame:
    return sq.number(table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n")), ["conv_id"], ["turn", "role"])


_T = "t AS (SELECT conv_id, turn, role, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS ord FROM conversations)"


@query("win_01_round_robin", "WIN-01", "WITH r AS (SELECT p_partkey, p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS turn, max(p_retailprice) OVER (PARTITION BY p_brand) AS best FROM part) SELECT p_partkey, turn, row_number() OVER (PARTITION BY turn ORDER BY best DESC, p_brand) AS place FROM r")
def round_robin(spark, d):
    from pyspark.sql import Window

    p = rk.round_robin(table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice"), "p_brand", "p_retailprice", "p_partkey")
    # the place within a turn: a turn has a row per brand at most
    place = F.row_number().over(Window.partitionBy("turn").orderBy(F.desc("best"), "p_brand"))
    return p.select("p_partkey", "turn", place.cast("long").alias("place"))


@query("win_02_stratified", "WIN-02", "WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) SELECT event_type, event_id FROM r WHERE rn <= ceil(102 / (SELECT count(DISTINCT event_type) FROM events)) ORDER BY event_type, rn LIMIT 102")
def stratified(spark, d):
    return rk.stratified_sample(table(spark, d, "events").select("event_type", "event_id", "ts"), "event_type", ["ts", "event_id"], 102).select("event_type", "event_id")


@query("win_04_accumulate", "WIN-04", f"WITH {_E} SELECT event_id, 5 + sum(length(event_type)) OVER (PARTITION BY user_id ORDER BY ord)::BIGINT AS total FROM e")
def accumulate(spark, d):
    return sq.accumulate(_events(spark, d), ["user_id"], "ord", F.length("event_type"), "total", 5).select("event_id", "total")


@query("win_05_sliding", "WIN-05 WIN-06", f"WITH {_E}, w AS (SELECT event_id, list(event_type) OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS l FROM e) SELECT event_id, array_to_string(l, ',') AS w FROM w WHERE len(l) = 3")
def sliding(spark, d):
    return sq.sliding_window(_events(spark, d), ["user_id"], "ord", "event_type", 3).select("event_id", F.array_join("window", ",").alias("w"))


@query("win_07_chunks", "WIN-07 WIN-09", f"WITH {_E} SELECT user_id, ord // 4 AS no, array_to_string(list(event_type ORDER BY ord), ',') AS chunk FROM e GROUP BY ALL")
def chunks(spark, d):
    return sq.chunks(_events(spark, d), ["user_id"], "ord", "event_type", 4).select("user_id", "no", F.array_join("chunk", ",").alias("chunk"))


@query("win_08_partition_padded", "WIN-08 WIN-07", f"WITH {_E}, c AS (SELECT user_id, ord // 4 AS no, list(event_type ORDER BY ord) AS l FROM e GROUP BY ALL) SELECT user_id, no, array_to_string(l || list_resize(['-']::VARCHAR[], 4 - len(l), '-')[1:4 - len(l)], ',') AS chunk FROM c")
def partition_padded(spark, d):
    return sq.chunks(_events(spark, d), ["user_id"], "ord", "event_type", 4, pad="-").select("user_id", "no", F.array_join("chunk", ",").alias("chunk"))


@query("win_08_partition_whole", "WIN-08", f"WITH {_E} SELECT user_id, ord // 4 AS no, array_to_string(list(event_type ORDER BY ord), ',') AS chunk FROM e GROUP BY ALL HAVING count(*) = 4")
def partition_whole(spark, d):
    return sq.chunks(_events(spark, d), ["user_id"], "ord", "event_type", 4, drop_short=True).select("user_id", "no", F.array_join("chunk", ",").alias("chunk"))


_ISLANDS = f"WITH {_E}, c AS (SELECT *, CASE WHEN ord > 0 AND event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ord) THEN 1 ELSE 0 END AS ch FROM e), i AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY ord)::BIGINT AS island FROM c)"


@query("win_10_islands", "WIN-10", _ISLANDS + " SELECT user_id, island, min(event_type) AS kind, count(*) AS n FROM i GROUP BY ALL")
def islands(spark, d):
    return sq.islands(_events(spark, d), ["user_id"], "ord", F.col("event_type")).groupBy("user_id", "island").agg(F.min("event_type").alias("kind"), F.count("*").alias("n"))


_SEP = f"WITH {_E}, s AS (SELECT *, event_type = 'error' AS sep FROM e), p AS (SELECT *, coalesce(lag(sep) OVER (PARTITION BY user_id ORDER BY ord), true) AS before FROM s)"


@query("win_11_split_runs", "WIN-11", _SEP + ", q AS (SELECT *, sum(CASE WHEN sep AND NOT before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ord)::BIGINT AS part FROM p) SELECT user_id, part, count(*) AS n, min(event_id) AS first FROM q WHERE NOT sep GROUP BY ALL")
def split_runs(spark, d):
    s = sq.split(_events(spark, d), ["user_id"], "ord", F.col("event_type") == "error")
    return s.groupBy("user_id", "part").agg(F.count("*").alias("n"), F.min_by("event_id", F.struct("event_id")).alias("first"))


@query("win_11_split_max", "WIN-11", _SEP + ", q AS (SELECT *, sum(sep::INT) OVER (PARTITION BY user_id ORDER BY ord)::BIGINT AS c FROM p) SELECT user_id, least(c, 2) AS part, count(*) AS n FROM q WHERE NOT sep OR c > 2 GROUP BY ALL")
def split_max(spark, d):
    s = sq.split(_events(spark, d), ["user_id"], "ord", F.col("event_type") == "error", maxsplit=2, keep_empty=True)
    return s.groupBy("user_id", F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n"))


_FAILS = f"WITH {_E}, f AS (SELECT *, sum(CASE WHEN value < 60 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ord) AS bad FROM e)"


@query("win_12_take_while", "WIN-12 ITER-01 ITER-02", _FAILS + " SELECT event_id FROM f WHERE bad = 0")
def take_while(spark, d):
    return sq.take_while(_events(spark, d), ["user_id"], "ord", F.col("value") < 60).select("event_id")


@query("win_13_drop_while", "WIN-13", _FAILS + " SELECT event_id FROM f WHERE bad > 0")
def drop_while(spark, d):
    return sq.drop_while(_events(spark, d), ["user_id"], "ord", F.col("value") < 60).select("event_id")


@query("win_14_every_third", "WIN-14 SORT-12", f"WITH {_E} SELECT event_id FROM e WHERE ord >= 2 AND ord < 40 AND (ord - 2) % 3 = 0")
def every_third(spark, d):
    return sq.take_slice(_events(spark, d), "ord", 2, 40, 3).select("event_id")


@query("win_15_tail", "WIN-15", f"WITH {_E} SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ord DESC) AS rn FROM e) WHERE rn <= 3")
def tail(spark, d):
    return sq.tail(_events(spark, d), ["user_id"], "ord", 3).select("event_id")


def _by_type(spark, d, *kinds: str) -> list[DataFrame]:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return [sq.number(e.where(F.col("event_type") == k), ["user_id"], ["ts", "event_id"]) for k in kinds]


@query("win_17_interleave", "WIN-17", "WITH k AS (SELECT user_id, event_id, CASE event_type WHEN 'click' THEN 0 ELSE 1 END AS s, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS pos FROM events WHERE event_type IN ('click', 'view')) SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY pos, s) - 1 AS ord, event_id AS value FROM k")
def interleave(spark, d):
    return sq.interleave(_by_type(spark, d, "click", "view"), ["user_id"], "ord", "event_id").select("user_id", "ord", "value")


@query("win_18_interpose", "WIN-18", f"WITH {_T} SELECT conv_id, ord * 2 AS ord, role AS value FROM t UNION ALL SELECT conv_id, ord * 2 - 1, '|' FROM t WHERE ord > 0")
def interpose(spark, d):
    return sq.interpose(_turns(spark, d), ["conv_id"], "ord", "role", "|")


@query("win_19_unique", "WIN-19 WIN-20 SORT-20", f"WITH {_E} SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY ord) AS rn FROM e) WHERE rn = 1")
def unique(spark, d):
    return sq.unique(_events(spark, d), ["user_id"], "ord", F.lower("event_type")).select("user_id", "event_type", "event_id")


@query("sort_01_topk", "SORT-01", f"WITH {_E} SELECT * FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY length(event_type) DESC, ord) AS rank FROM e) WHERE rank <= 5")
def topk(spark, d):
    return sq.top_k(_events(spark, d), ["user_id"], F.length("event_type"), "ord", 5).select("event_id", "rank")


@query("sort_01_topk_global", "SORT-01 SORT-13", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk_global(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("sort_02_merge_sorted", "SORT-02 SORT-03 SORT-04", "WITH k AS (SELECT user_id, event_id, value, CASE event_type WHEN 'error' THEN 0 ELSE 1 END AS s, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS o FROM events WHERE event_type IN ('error', 'signup')) SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, s, o) - 1 AS place FROM k")
def merge_sorted(spark, d):
    return sq.merge_sorted(_by_type(spark, d, "error", "signup"), ["user_id"], "value", "ord", ["event_id", "value"]).select("event_id", "place")


@query("sort_05_head_nth", "SORT-05 SORT-06 SORT-08 SORT-09 SORT-10 SORT-11", f"WITH {_E} SELECT user_id, count(*) FILTER (ord < 3) AS head, count(*) FILTER (ord >= 3) AS rest, max(event_id) FILTER (ord = 1) AS second FROM e GROUP BY 1")
def head_nth(spark, d):
    return _events(spark, d).groupBy("user_id").agg(F.count_if(F.col("ord") < 3).alias("head"), F.count_if(F.col("ord") >= 3).alias("rest"), F.max(F.when(F.col("ord") == 1, F.col("event_id"))).alias("second"))


@query("sort_14_first_match", "SORT-14 SORT-15", f"WITH {_E} SELECT user_id, coalesce(arg_min(event_id, ord) FILTER (value > 95), -1) AS first FROM e GROUP BY 1")
def first_match(spark, d):
    return sq.first_match(_events(spark, d), ["user_id"], "ord", F.col("value") > 95, "event_id", -1)


@query("sort_18_unit_switch", "SORT-18", "SELECT CASE WHEN count(DISTINCT lang) > 3 THEN 'language' ELSE 'source' END AS unit FROM documents")
def unit_switch(spark, d):
    return table(spark, d, "documents").agg(F.when(F.count_distinct("lang") > 3, "language").otherwise("source").alias("unit"))


@query("sort_21_ordinals", "SRC-08 SORT-16", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS ord FROM orders")
def ordinals(spark, d):
    return sq.with_ordinals(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "ord")


@query("set_01_concat", "SET-01 SET-02", "WITH k AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS s, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS o FROM events WHERE event_type IN ('view', 'click')) SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, o) - 1 AS ord, event_id AS value FROM k")
def concat(spark, d):
    return sq.concat(_by_type(spark, d, "view", "click"), ["user_id"], "ord", "event_id").select("user_id", "ord", "value")


@query("set_03_mapcat", "SET-03 SET-05", "SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(string_split(regexp_replace(text, '[^A-Za-z ]', ' ', 'g'), ' ')) AS word FROM documents) WHERE length(word) > 12 GROUP BY ALL")
def mapcat(spark, d):
    words = F.split(F.regexp_replace("text", "[^A-Za-z ]", " "), " ")
    rows = table(spark, d, "documents").select("lang", F.explode(F.filter(words, lambda w: F.length(w) > 12)).alias("word"))
    return rows.groupBy("lang", "word").agg(F.count("*").alias("n"))


@query("set_04_cons", "SET-04", f"WITH {_T} SELECT conv_id, -1 AS ord, 'start' AS role FROM (SELECT DISTINCT conv_id FROM t) UNION ALL SELECT conv_id, ord, role FROM t")
def cons(spark, d):
    t = _turns(spark, d)
    return t.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("ord"), F.lit("start").alias("role")).union(t.select("conv_id", "ord", "role"))


@query("set_06_new_names", "SET-06 SET-07 SET-11", "SELECT DISTINCT p_brand || '/' || p_size AS name FROM part WHERE p_retailprice > 950 EXCEPT SELECT p_brand || '/' || p_size FROM part WHERE p_retailprice < 930 AND p_size < 25")
def new_names(spark, d):
    p = table(spark, d, "part").withColumn("name", F.concat_ws("/", "p_brand", "p_size"))
    return p.where("p_retailprice > 950").select("name").subtract(p.where("p_retailprice < 930 AND p_size < 25").select("name"))


@query("set_13_unknown_words", "SET-13 SCL-51", "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '[A-Za-z0-9_]+'), lambda w: regexp_full_match(w, '[A-Z][a-z]{2,}') AND w NOT IN ('The', 'And', 'Les', 'Des', 'Der', 'Die')))), ' ') AS names FROM documents")
def unknown_words(spark, d):
    names = F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]+"), F.lit(0)), lambda w: w.rlike("^[A-Z][a-z]{2,}$"))
    known = F.array(*[F.lit(w) for w in ("The", "And", "Les", "Des", "Der", "Die")])
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(F.array_except(F.array_distinct(names), known)), " ").alias("names"))


@query("set_14_leaked_names", "SET-14 SCL-33 SCL-34", r"SELECT b.item_id, d.doc_id FROM (SELECT item_id, trim(regexp_replace(unnest(string_split(text, chr(10))), '\s+', ' ', 'g')) AS line FROM benchmark) b JOIN (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat FROM documents) d ON len(regexp_extract_all(line, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]')) >= 5 AND len(string_split(line, ' ')) >= 4 AND contains(' ' || flat, ' ' || line) GROUP BY ALL")
def leaked_names(spark, d):
    from tessera.operators import textgates as tg

    lines = tg.lines_with_tokens(table(spark, d, "benchmark"), ["item_id"], "text", 5)
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tg.contained_lines(lines, docs, "line", "text", 4).select("item_id", "doc_id").distinct()
