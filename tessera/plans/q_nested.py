"""Queries of nested specifications over JSON records, structs and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import patterns as pt
from tessera.plans import spec as sp
from tessera.plans.registry import query, table


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.from_json("props", "k int").alias("props"))


@query("prj_31_record", "PRJ-31 PRJ-33 PRJ-34 PRJ-39 PRJ-40 PRJ-41 PRJ-43 PRJ-44 PRJ-51", "SELECT event_id, (props->>'k')::INTEGER AS k, event_type AS kind, 'x' AS tag FROM events")
def record(spark, d):
    e = _events(spark, d).withColumn("row", F.struct("event_type", "value", "props"))
    got = sp.project(e, "row", {"k": ("props", "k"), "kind": "event_type", "tag": sp.Val("x")})
    return got.select("event_id", "result.k", "result.kind", "result.tag")


def _baskets(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("qty")))).alias("lines"))
    return lines


_SQL_B = "b AS (SELECT l_orderkey, list({'n': l_linenumber, 'p': l_partkey, 's': l_suppkey, 'q': l_quantity::BIGINT} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS l FROM lineitem GROUP BY 1)"


@query("prj_32_list_skip", "PRJ-32 PRJ-53 ITER-02", f"WITH {_SQL_B} SELECT l_orderkey, array_to_string(list_transform(list_filter(l, lambda x: x.q > 25), lambda x: x.p), ',') AS parts FROM b")
def list_skip(spark, d):
    got = sp.project(_baskets(spark, d), "lines", [sp.Where(lambda x: x["qty"] > 25, "l_partkey")])
    return got.select("l_orderkey", F.array_join("result", ",").alias("parts"))


@query("prj_32_list_stop", "PRJ-32", f"WITH {_SQL_B} SELECT l_orderkey, array_to_string(list_transform(CASE WHEN list_position(list_transform(l, lambda x: x.q > 10), false) IS NULL OR list_position(list_transform(l, lambda x: x.q > 10), false) = 0 THEN l ELSE l[1:list_position(list_transform(l, lambda x: x.q > 10), false) - 1] END, lambda x: x.p), ',') AS parts FROM b")
def list_stop(spark, d):
    got = sp.project(_baskets(spark, d), "lines", [sp.Where(lambda x: x["qty"] > 10, "l_partkey", sp.STOP)])
    return got.select("l_orderkey", F.array_join("result", ",").alias("parts"))


@query("prj_35_path_star", "PRJ-35 PRJ-36 PRJ-37 PRJ-83 PRJ-84 PRJ-85 PRJ-86 PRJ-69 PRJ-70 PRJ-71", f"WITH {_SQL_B} SELECT l_orderkey, array_to_string(list_transform(l, lambda x: x.p), ',') AS parts, l[1].s AS first_supp, l[-1].s AS last_supp FROM b")
def path_star(spark, d):
    b = _baskets(spark, d).withColumn("row", F.struct("lines"))
    got = sp.project(b, "row", {"parts": "lines.*.l_partkey", "first_supp": "lines.0.l_suppkey", "last_supp": "lines.-1.l_suppkey"})
    return got.select("l_orderkey", F.array_join("result.parts", ",").alias("parts"), "result.first_supp", "result.last_supp")


@query("prj_38_coalesce", "PRJ-38 PRJ-66 PRJ-87", f"WITH {_SQL_B} SELECT l_orderkey, coalesce(l[7].p, l[4].p, -1) AS part FROM b")
def coalesce(spark, d):
    b = _baskets(spark, d).withColumn("row", F.struct("lines"))
    return sp.project(b, "row", sp.Coalesce(("lines.6.l_partkey", "lines.3.l_partkey"), default=-1)).select("l_orderkey", F.col("result").alias("part"))


@query("prj_50_observed", "PRJ-50 UDF-26", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def observed(spark, d):
    from pyspark.sql import Observation

    seen = table(spark, d, "events").observe(Observation(), F.count("*").alias("rows"))
    return seen.groupBy("event_type").agg(F.count("*").alias("n"))


@query("prj_54_truthy", "PRJ-54 PRJ-68 UDF-23", "SELECT event_id, (props->>'k')::INTEGER % 2 <> 0 AND (props->>'k') IS NOT NULL AS odd FROM events")
def truthy(spark, d):
    return _events(spark, d).select("event_id", sp.truthy("int")(F.col("props.k") % 2).alias("odd"))


@query("prj_55_match", "PRJ-55 PRJ-56 PRJ-60 PRJ-61 PRJ-62", "SELECT event_id, (event_type IN ('click', 'view') OR value > 50) AND NOT (value > 90) AND json_keys(props) = ['k'] AS ok FROM events")
def match(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value", F.from_json("props", "map<string,string>").alias("m"))
    kind = sp.any_of(lambda r: sp.one_of("click", "view")(r["event_type"]), lambda r: r["value"] > 50)
    ok = sp.all_of(kind, sp.negate(lambda r: r["value"] > 90), lambda r: sp.has_keys(["k"])(r["m"]))
    return e.withColumn("row", F.struct("event_type", "value", "m")).select("event_id", ok(F.col("row")).alias("ok"))


_PATTERN = {
    "event_type": pt.Or("click", "view", pt.Regex("e.*")),
    "value": (pt.M <= 90) & float,
    "props": {pt.Required(pt.Regex("k+")): pt.And(int, pt.M >= 10, pt.M != 50), pt.Optional("note", default="none"): str},
    pt.Optional("source", default={"from": "web"}): dict,
}


@query("prj_57_patterns", "PRJ-55 PRJ-56 PRJ-57 PRJ-60 PRJ-61 PRJ-63 PRJ-64 PRJ-65 PRJ-66 PRJ-67 PRJ-89 PRJ-90", """WITH r AS (SELECT event_id, value, (props->>'k')::INTEGER AS k, event_type AS t FROM events),
    w AS (SELECT *, CASE WHEN t NOT IN ('click', 'view') AND t NOT LIKE 'e%' THEN '$.event_type: does not match e.*' WHEN k < 10 THEN '$.props.k: M >= 10 does not hold'
    WHEN k = 50 THEN '$.props.k: M <> 50 does not hold' WHEN value > 90 THEN '$.value: M <= 90 does not hold' END AS why FROM r)
    SELECT event_id, why, CASE WHEN why IS NULL THEN 'none' END AS note, CASE WHEN why IS NULL THEN 'web' END AS origin, CASE WHEN why IS NULL THEN k END AS k, k > value AS above FROM w""")
def patterns(spark, d):
    e = table(spark, d, "events").select("event_id", F.struct("event_type", "value", F.from_json("props", "k long").alias("props")).alias("row"))
    e = e.select("event_id", F.to_variant_object("row").alias("v"))
    why = pt.failure(F.col("v"), _PATTERN)
    got = e.select("event_id", "v", why.alias("why"), pt.failure(F.col("v"), pt.M("props.k") > pt.M("value")).isNull().alias("above"))
    got = got.withColumn("m", F.when(F.col("why").isNull(), pt.matched(F.col("v"), _PATTERN)))
    note, origin, k = sp.get_variant(F.col("m"), "props.note"), sp.get_variant(F.col("m"), "source.from"), sp.get_variant(F.col("m"), "props.k", "int")
    return got.select("event_id", "why", note.alias("note"), origin.alias("origin"), k.alias("k"), "above")


@query("prj_58_switch", "PRJ-58", "SELECT event_id, CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN event_type ELSE 'high' END AS band FROM events")
def switch(spark, d):
    e = _events(spark, d).withColumn("row", F.struct("event_type", "value"))
    cases = ((lambda r: r["value"] < 10, sp.Val("low")), (lambda r: r["value"] < 50, "event_type"))
    return sp.project(e, "row", sp.Switch(cases, default="high")).select("event_id", F.col("result").alias("band"))


@query("prj_59_check", "PRJ-59", "SELECT event_id, CASE WHEN value >= 0 AND value < 80 THEN value ELSE -1 END AS checked FROM events")
def check(spark, d):
    c = sp.Check({"positive": lambda v: v >= 0, "small": lambda v: v < 80}, default=-1.0, strict=False)
    return sp.project(_events(spark, d), "value", c).select("event_id", F.col("result").alias("checked"))


@query("prj_65_regex", "PRJ-65", r"SELECT page_id, regexp_full_match(url, 'https?://[a-z.]+/.*') AS web, regexp_extract(url, '//([a-z]+)\.', 1) AS host FROM pages")
def regex(spark, d):
    return table(spark, d, "pages").select("page_id", sp.matches("https?://[a-z.]+/.*")(F.col("url")).alias("web"), F.regexp_extract("url", r"//([a-z]+)\.", 1).alias("host"))


@query("prj_45_descendants", "PRJ-35 PRJ-45 REC-18", "SELECT event_id, '$' AS path FROM events UNION ALL SELECT event_id, '$.k' FROM events")
def descendants(spark, d):
    e = table(spark, d, "events").select("event_id", F.parse_json("props").alias("v"))
    return sp.descendants(e, "v", 1).select("event_id", "path")


@query("agg_51_fold_spec", "AGG-51 AGG-52 AGG-54 AGG-55", f"WITH {_SQL_B} SELECT l_orderkey, list_sum(list_transform(l, lambda x: x.q))::BIGINT AS qty, len(l) * 2 AS flat FROM b")
def fold_spec(spark, d):
    b = _baskets(spark, d)
    both = F.transform("lines", lambda x: F.array(x["l_partkey"], x["l_suppkey"]))
    got = b.withColumn("qty", sp.evaluate(F.col("lines"), sp.Sum("*.qty", F.lit(0).cast("long")))).withColumn("flat", F.size(sp.Flatten()(both)).cast("long"))
    return got.select("l_orderkey", "qty", "flat")


@query("udf_16_compose", "UDF-16 UDF-17 UDF-18 UDF-19 UDF-20 UDF-21 UDF-24 UDF-27 UDF-28 UDF-29 PRJ-48 PRJ-49", "SELECT c_custkey, upper(c_name) || '!' AS a, length(c_name)::INTEGER AS n, lower(c_name) AS l FROM customer")
def compose(spark, d):
    shout = sp.compose(lambda c: F.concat(c, F.lit("!")), F.upper)
    c = table(spark, d, "customer").withColumn("j", sp.juxt(F.length, F.lower)(F.col("c_name")))
    return c.select("c_custkey", shout(F.col("c_name")).alias("a"), F.col("j._0").alias("n"), sp.thread(F.col("j._1"), F.lower).alias("l"))


@query("udf_25_excepts", "UDF-25", "SELECT event_id, coalesce(try_cast(event_type AS INTEGER), 0) AS n, (value / nullif((props->>'k')::INTEGER % 3, 0))::DOUBLE AS r FROM events")
def excepts(spark, d):
    return _events(spark, d).select("event_id", F.coalesce(F.col("event_type").try_cast("int"), F.lit(0)).alias("n"), F.try_divide("value", F.col("props.k") % 3).alias("r"))


@query("udf_13_registry", "UDF-13 UDF-14 UDF-15 UDF-30 UDF-31 PRJ-52 PRJ-42 UDF-01 UDF-10", "SELECT c_custkey, length(c_name)::INTEGER AS size_of_name, c_nationkey AS size_of_key FROM customer")
def registry(spark, d):
    r = sp.Registry()
    r.register("size", "string", F.length)
    r.register("size", "any", lambda c: c)
    c = table(spark, d, "customer")
    return c.select("c_custkey", r.apply("size", c, "c_name").alias("size_of_name"), r.apply("size", c, "c_nationkey").alias("size_of_key"))


@query("rec_17_iterate", "REC-17", "WITH RECURSIVE s(ord, value) AS (SELECT 0::BIGINT, 1::BIGINT UNION ALL SELECT ord + 1, (value * 3 + 1) % 1009 FROM s WHERE ord + 1 < 50) SELECT * FROM s")
def iterate(spark, d):
    return sp.iterate(spark, 1, "(value * 3 + 1) % 1009", 50)


@query("prj_46_variables", "PRJ-46 PRJ-47 PRJ-88", "SELECT o_orderkey, o_totalprice * 2 + length(o_orderstatus) AS both FROM orders")
def variables(spark, d):
    o = table(spark, d, "orders").withColumn("row", F.struct("o_totalprice", "o_orderstatus"))
    bound = sp.Let({"p": "o_totalprice", "s": "o_orderstatus"}, lambda p, s: p * 2 + F.length(s))
    return sp.project(o, "row", bound).select("o_orderkey", F.col("result").alias("both"))
