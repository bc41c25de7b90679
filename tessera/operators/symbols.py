"""Names in source code resolved to the definitions they stand for, as joins over tables of facts.

Two steps, as no source may be resolved before all are known: functions.pyast reads facts out of each text on its own;
the joins here bring them together by (repository, module, name). Only hash joins; a repository is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def modules_and_packages(modules: DataFrame, by: list[str]) -> DataFrame:
    """by, name: the modules and all packages above them."""
    parts = F.split("module", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))
    return modules.select(*by, F.explode(above).alias("name")).distinct()


def _source(module: Column, is_package: Column, level: Column, name: Column) -> Column:
    """The absolute module that an import names; null where it climbs past the top package."""
    parts = F.split(module, r"\.")
    n = F.size(parts) - F.when(is_package, 0).otherwise(1) - (level - 1)
    base = F.array_join(F.slice(parts, F.lit(1), F.greatest(n, F.lit(0))), ".")
    relative = F.when(n >= 0, F.array_join(F.filter(F.array(base, name), lambda x: x != ""), "."))
    found = F.when(level == 0, name).otherwise(relative)
    return F.when(found != "", found)


def bindings(imports: DataFrame, by: list[str]) -> DataFrame:
    """by, module, local, dotted, is_alias: what the imports of a module bind; of a name bound twice the last one counts.

    imports has by, module (the importing one), is_package, ord, and the columns of pyast.import_table with `module`
    named `target`. `import a.b` binds a alone.
    """
    plain = F.col("kind") == "import"
    source = F.when(plain, F.col("target")).otherwise(_source(F.col("module"), F.col("is_package"), F.col("level"), F.col("target")))
    local = F.when(plain, F.coalesce("asname", F.split("target", r"\.")[0])).otherwise(F.coalesce("asname", "name"))
    dotted = F.when(plain, F.coalesce(F.when(F.col("asname").isNotNull(), F.col("target")), local)).otherwise(F.concat(source, F.lit("."), F.col("name")))
    rows = imports.withColumn("source", source).where("source IS NOT NULL").select(*by, "module", "ord", local.alias("local"), dotted.alias("dotted"), plain.alias("is_alias"))
    return rows.groupBy(*by, "module", "is_alias", "local").agg(F.max_by("dotted", "ord").alias("dotted"))


def import_targets(imports: DataFrame, modules: DataFrame, by: list[str]) -> DataFrame:
    """imports plus source and target_module: the module of the repository that an import reaches, a submodule first."""
    plain = F.col("kind") == "import"
    source = F.when(plain, F.col("target")).otherwise(_source(F.col("module"), F.col("is_package"), F.col("level"), F.col("target")))
    known = modules_and_packages(modules, by)
    rows = imports.withColumn("source", source).withColumn("__sub", F.when(~plain, F.concat("source", F.lit("."), "name")))
    for key, out in (("__sub", "__a"), ("source", "__b")):
        rows = rows.join(known.withColumnRenamed("name", key).withColumn(out, F.col(key)), [*by, key], "left")
    return rows.withColumn("target_module", F.coalesce("__a", "__b")).drop("__sub", "__a", "__b")


def _bound(rows: DataFrame, by: list[str], names: DataFrame, is_alias: bool, out: str) -> DataFrame:
    one = names.where(F.col("is_alias") == is_alias).select(*by, "module", F.col("local").alias("__head"), F.col("dotted").alias(out))
    return rows.join(one, [*by, "module", "__head"], "left")


def resolve_calls(calls: DataFrame, names: DataFrame, definitions: DataFrame, modules: DataFrame, by: list[str]) -> DataFrame:
    """by, module, caller, text, line, target: every distinct call, with the function or class that it reaches or null.

    calls as from pyast.call_table with by and module; names from bindings(); definitions has by and qualname (functions
    and classes), methods marked by is_function; modules has by and module. A plain name is the module's own definition,
    else what a from-import binds it to; `self.x` is a method of the enclosing class; a dotted name starts at a module.
    """
    head = F.split("dotted", r"\.")[0]
    rest = F.substring("dotted", F.length("__head") + 1, F.length("dotted"))
    rows = calls.withColumn("__head", head).withColumn("__rest", F.when(F.col("dotted").isNotNull(), rest))
    rows = _bound(_bound(rows, by, names, True, "__alias"), by, names, False, "__from")
    known = modules.select(*by, F.col("module").alias("__from"), F.lit(True).alias("__is_module")).distinct()
    rows = rows.join(known, [*by, "__from"], "left")
    own = (F.col("__head") == "self") & F.col("enclosing").isNotNull() & F.col("__rest").rlike(r"^\.[^.]+$")
    chain = F.coalesce("__alias", F.when(F.col("__is_module"), F.col("__from")))
    candidates = (
        F.when(F.col("__rest") == "", F.array(F.concat_ws(".", "module", "__head"), F.col("__from")))
        .when(own, F.array(F.concat("enclosing", "__rest")))
        .otherwise(F.array(F.concat(chain, "__rest")))
    )
    key = [*by, "module", "caller", "text", "line"]
    tried = rows.select(*key, own.alias("__own"), F.posexplode_outer(candidates).alias("__rank", "target"))
    there = definitions.select(*by, F.col("qualname").alias("target"), F.col("is_function")).distinct()
    met = tried.join(there, [*by, "target"], "left").withColumn("target", F.when(F.col("is_function") | ~F.coalesce("__own", F.lit(False)) & F.col("is_function").isNotNull(), F.col("target")))
    return met.groupBy(*key).agg(F.min_by("target", F.when(F.col("target").isNotNull(), F.col("__rank"))).alias("target"))


def resolve_bases(bases: DataFrame, names: DataFrame, classes: DataFrame, by: list[str]) -> DataFrame:
    """bases (by, module, expr) plus target: the class that a base expression names. A plain name is the module's own
    definition if it has one of the name, else what a from-import binds; a dotted one starts at an import's alias."""
    rows = bases.withColumn("__head", F.split("expr", r"\.")[0]).withColumn("__rest", F.substring("expr", F.length("__head") + 1, F.length("expr")))
    rows = _bound(_bound(rows, by, names, True, "__alias"), by, names, False, "__from")
    rows = rows.withColumn("__own", F.concat_ws(".", "module", "__head"))
    own = classes.select(*by, F.col("qualname").alias("__own"), F.lit(True).alias("__has")).distinct()
    rows = rows.join(own, [*by, "__own"], "left")
    candidate = F.when(F.col("__rest") == "", F.when(F.col("__has"), F.col("__own")).otherwise(F.col("__from"))).otherwise(F.concat("__alias", "__rest"))
    known = classes.select(*by, F.col("qualname").alias("__c"), F.col("qualname").alias("target")).distinct()
    return rows.withColumn("__c", candidate).join(known, [*by, "__c"], "left").drop("__head", "__rest", "__alias", "__from", "__own", "__has", "__c")


def contained_edges(edges: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """edges plus verified boolean: whether the same edge stands among facts read from the sources anew."""
    return edges.join(facts.select(*keys, F.lit(True).alias("verified")).distinct(), keys, "left").withColumn("verified", F.coalesce("verified", F.lit(False)))


def numbered(imports: DataFrame, by: list[str]) -> DataFrame:
    """imports plus ord: their order within a module."""
    return imports.withColumn("ord", F.row_number().over(Window.partitionBy(*by, "module").orderBy("line", "target", "name")))
