"""Queries of the symbol index: one small repository of several modules for every nation, under a package of its own name.

The sources hold the forms that the rules tell apart; what each rule must find in them is written out in the SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import pyast as pa_
from tessera.operators import symbols as sy
from tessera.plans.registry import query, table

SOURCES = {
    "pkg": """from .base import Animal as Root
import os
""",
    "pkg.base": """class Animal:
    def speak(self):
        return self.name() + self.nothing()

    def name(self):
        return helper()


def helper(n=1, *, k: int = 2) -> list:
    return [x for x in range(n) if x if x > k]
""",
    "pkg.dog": """import pkg.base
import pkg.base as b
from . import base
from .base import Animal, helper as h
from ...far import nothing


class Dog(Animal):
    async def speak(self) -> str:
        return h() or pkg.base.helper() and b.Animal()


class Cat(b.Animal, list):
    class Inner:
        def deep(self):
            assert self
            with open(self) as f:
                return f


@h
def run(xs):
    base.helper()
    Dog().speak()
    missing()
    Animal()

    def inner():
        if xs:
            h()

    return inner
""",
    "pkg.broken": "def broken(:",
    "pkg.sub": """from .base import helper
from . import Root


def helper():
    try:
        return helper() if 1 else Root()
    except (KeyError, ValueError):
        raise
    finally:
        while 0:
            pass


def pick(x):
    match x:
        case 1 | 2:
            return lambda: helper()
        case _:
            return {k: v for k in x for v in k if v and k or x}


def late():
    from .base import Animal as Local

    Local()


def later():
    Local()
""",
    "pkg.steps": '''LIMIT = 3


class Steps:
    def take(self, xs, n=2):
        """Doc."""
        total = 0
        for x in xs:
            if 0 < x <= n and x not in self:
                total = total + x * 2
            else:
                break
        return total


def none():
    return None
''',
}
#: The module of a qualified name of the sources.
MODULE = r"^(p\d+\.\w+)"


def _own_name(c):
    return F.regexp_replace(c, r"\bpkg\b", F.concat(F.lit("p"), F.col("n_nationkey").cast("string")))


def sources(spark, d):
    """n_nationkey, module, is_package, source."""
    rows = spark.createDataFrame([(k, k == "pkg", v) for k, v in SOURCES.items()], "module string, is_package boolean, source string")
    every = table(spark, d, "nation").select("n_nationkey").crossJoin(F.broadcast(rows))  # six written rows
    return every.select("n_nationkey", _own_name(F.col("module")).alias("module"), "is_package", _own_name(F.col("source")).alias("source"))


def _facts(spark, d):
    """The sources, those that parse, their numbered imports, what these bind, and the definitions."""
    s, by = sources(spark, d), ["n_nationkey"]
    found = pa_.import_table(s.select("n_nationkey", F.col("module").alias("of"), "is_package", "source"), ["n_nationkey", "of", "is_package"], "source").where("top")
    imports = sy.numbered(found.withColumnRenamed("module", "target").withColumnRenamed("of", "module"), by)
    functions = pa_.function_table(s, by, "source", "module").select(*by, "qualname", F.lit(True).alias("is_function"))
    classes = pa_.class_table(s, by, "source", "module").select(*by, "qualname", "bases", F.lit(False).alias("is_function"))
    return s, s.where(pa_.parses("source")), imports, sy.bindings(imports, by), functions, classes


def _values(columns: str, rows: list[tuple], select: str) -> str:
    """SQL of written rows for every nation, pkg standing for its package."""

    def text(v) -> str:
        if v is None:
            return "NULL"
        return str(v).lower() if isinstance(v, bool | int) else "'" + v.replace("'", "''") + "'"

    values = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    return f"WITH w({columns}) AS (VALUES {values}) SELECT n_nationkey, {select} FROM nation, w"


def _own(column: str) -> str:
    return f"replace({column}, 'pkg', 'p' || n_nationkey) AS {column}"


CALLS = [
    ("pkg.base.Animal.name", "helper", 6, "pkg.base.helper"),
    ("pkg.base.Animal.speak", "self.name", 3, "pkg.base.Animal.name"),
    ("pkg.base.Animal.speak", "self.nothing", 3, None),
    ("pkg.base.helper", "range", 10, None),
    ("pkg.dog.Dog.speak", "h", 10, "pkg.base.helper"),
    ("pkg.dog.Dog.speak", "pkg.base.helper", 10, "pkg.base.helper"),
    ("pkg.dog.Dog.speak", "b.Animal", 10, "pkg.base.Animal"),
    ("pkg.dog.Cat.Inner.deep", "open", 17, None),
    ("pkg.dog.run", "base.helper", 23, "pkg.base.helper"),
    ("pkg.dog.run", "Dog().speak", 24, None),
    ("pkg.dog.run", "Dog", 24, "pkg.dog.Dog"),
    ("pkg.dog.run", "missing", 25, None),
    ("pkg.dog.run", "Animal", 26, "pkg.base.Animal"),
    ("pkg.sub.helper", "helper", 7, "pkg.sub.helper"),
    ("pkg.sub.helper", "Root", 7, None),
    ("pkg.sub.pick", "helper", 18, "pkg.sub.helper"),
    ("pkg.sub.late", "Local", 26, None),
    ("pkg.sub.later", "Local", 30, None),
]


@query("sym_06_calls", "SCL-06 SCL-07 SCL-08 SRC-06 SRC-07 JOIN-36 JOIN-37", _values("caller, text, line, target", CALLS, f"{_own('caller')}, {_own('text')}, line, {_own('target')}"))
def calls(spark, d):
    s, parsed, _, names, functions, classes = _facts(spark, d)
    made = pa_.call_table(s, ["n_nationkey", "module"], "source", "module")
    known = functions.union(classes.select("n_nationkey", "qualname", "is_function"))
    return sy.resolve_calls(made, names, known, parsed, ["n_nationkey"]).select("n_nationkey", "caller", "text", "line", "target")


BASES = [("pkg.dog.Dog", "Animal", "pkg.base.Animal"), ("pkg.dog.Cat", "b.Animal", "pkg.base.Animal"), ("pkg.dog.Cat", "list", None)]


def _bases(classes):
    return classes.select("n_nationkey", F.regexp_extract("qualname", MODULE, 1).alias("module"), "qualname", F.explode("bases").alias("expr"))


@query("sym_09_bases", "SCL-09 SRC-07", _values("qualname, expr, target", BASES, f"{_own('qualname')}, expr, {_own('target')}"))
def bases(spark, d):
    _, _, _, names, _, classes = _facts(spark, d)
    return sy.resolve_bases(_bases(classes), names, classes, ["n_nationkey"]).select("n_nationkey", "qualname", "expr", "target")


IMPORTS = [
    ("pkg", 1, "Animal", "pkg.base"),
    ("pkg", 2, None, None),
    ("pkg.dog", 1, None, "pkg.base"),
    ("pkg.dog", 2, None, "pkg.base"),
    ("pkg.dog", 3, "base", "pkg.base"),
    ("pkg.dog", 4, "Animal", "pkg.base"),
    ("pkg.dog", 4, "helper", "pkg.base"),
    ("pkg.dog", 5, "nothing", None),
    ("pkg.sub", 1, "helper", "pkg.base"),
    ("pkg.sub", 2, "Root", "pkg"),
]


@query("sym_11_imports", "SCL-11 SCL-26 SRC-06 SRC-07", _values("module, line, name, target_module", IMPORTS, f"{_own('module')}, line, name, {_own('target_module')}"))
def imports(spark, d):
    _, parsed, found, _, _, _ = _facts(spark, d)
    return sy.import_targets(found, parsed, ["n_nationkey"]).select("n_nationkey", "module", "line", "name", "target_module")


FUNCTIONS = [
    ("pkg.base.Animal.speak", 2, 3, 1, "speak(self)", "", "", "pkg.base.Animal"),
    ("pkg.base.Animal.name", 5, 6, 1, "name(self)", "", "", "pkg.base.Animal"),
    ("pkg.base.helper", 9, 10, 4, "helper(n=1, *, k: int=2) -> list", "", "", None),
    ("pkg.dog.Dog.speak", 9, 10, 3, "async speak(self) -> str", "", "", "pkg.dog.Dog"),
    ("pkg.dog.Cat.Inner.deep", 15, 18, 1, "deep(self)", "", "", "pkg.dog.Cat.Inner"),
    ("pkg.dog.run", 22, 32, 1, "run(xs)", "h", "", None),
    ("pkg.sub.helper", 5, 12, 4, "helper()", "", "", None),
    ("pkg.sub.pick", 15, 20, 8, "pick(x)", "", "", None),
    ("pkg.sub.late", 23, 26, 1, "late()", "", "", None),
    ("pkg.sub.later", 29, 30, 1, "later()", "", "", None),
    ("pkg.steps.Steps.take", 5, 13, 4, "take(self, xs, n=2)", "", "Doc.", "pkg.steps.Steps"),
    ("pkg.steps.none", 16, 17, 1, "none()", "", "", None),
]


@query("sym_03_functions", "SCL-03 SCL-04 SCL-05 SCL-57 SCL-107 SRC-06 SRC-09 SRC-45", _values("qualname, line, end_line, complexity, signature, decorators, docstring, parent", FUNCTIONS, f"{_own('qualname')}, line, end_line, complexity, signature, decorators, docstring, {_own('parent')}"))
def functions(spark, d):
    found = pa_.function_table(sources(spark, d), ["n_nationkey"], "source", "module")
    return found.select("n_nationkey", "qualname", "line", "end_line", "complexity", "signature", F.array_join("decorators", ",").alias("decorators"), F.coalesce("docstring", F.lit("")).alias("docstring"), "parent")


EDGES = [
    ("import", "pkg.dog", "pkg.base", True),
    ("import", "pkg.base", "pkg.dog", False),
    ("contains", "pkg.base", "pkg.base.helper", True),
    ("contains", "pkg.base.Animal", "pkg.base.Animal.name", True),
    ("contains", "pkg.base", "pkg.base.gone", False),
    ("inherits", "pkg.dog.Dog", "pkg.base.Animal", True),
    ("inherits", "pkg.dog.Cat", "list", False),
    ("calls", "pkg.dog.run", "pkg.dog.Dog", True),
    ("calls", "pkg.dog.run", "pkg.base.Animal.name", False),
    ("uses", "pkg.dog", "pkg.base", False),
]


@query("sym_30_edges", "PRJ-80 JOIN-30 JOIN-31 JOIN-32 JOIN-33 JOIN-34", _values("kind, source, target, verified", EDGES, f"kind, {_own('source')}, {_own('target')}, verified"))
def edges(spark, d):
    """Edges of a graph, each checked against facts of its kind that are read from the sources anew."""
    s, parsed, found, names, functions, classes = _facts(spark, d)
    by = ["n_nationkey"]
    defined = functions.union(classes.select("n_nationkey", "qualname", "is_function"))
    called = sy.resolve_calls(pa_.call_table(s, ["n_nationkey", "module"], "source", "module"), names, defined, parsed, by)

    def kind(name: str, source: str, target: str) -> list:
        return [*by, F.lit(name).alias("kind"), F.col(source).alias("source"), F.col(target).alias("target")]

    facts = sy.import_targets(found, parsed, by).select(*kind("import", "module", "target_module"))
    facts = facts.union(defined.withColumn("owner", F.regexp_extract("qualname", r"^(.*)\.", 1)).select(*kind("contains", "owner", "qualname")))
    facts = facts.union(sy.resolve_bases(_bases(classes), names, classes, by).select(*kind("inherits", "qualname", "target")))
    facts = facts.union(called.select(*kind("calls", "caller", "target")))
    told = spark.createDataFrame([e[:3] for e in EDGES], "kind string, source string, target string")
    graph = table(spark, d, "nation").select("n_nationkey").crossJoin(F.broadcast(told))  # ten written rows
    graph = graph.select("n_nationkey", "kind", _own_name(F.col("source")).alias("source"), _own_name(F.col("target")).alias("target"))
    return sy.contained_edges(graph, facts, ["n_nationkey", "kind", "source", "target"])


#: Of Steps.take: kind, number, first line that differs from what stood there, and what stands there now.
CHANGES = [
    ("comparison_flip", 0, 9, "            if 0 > x <= n and x not in self:"),
    ("comparison_boundary", 0, 9, "            if 0 <= x <= n and x not in self:"),
    ("arithmetic_swap", 0, 10, "                total = total - x * 2"),
    ("and_or_swap", 0, 9, "            if 0 < x <= n or x not in self:"),
    ("return_none", 0, 13, "        return None"),
    ("constant_tweak", 0, 5, "    def take(self, xs, n=3):"),
    ("statement_delete", 0, 7, "        for x in xs:"),
    ("comparison_flip", 1, 9, "            if 0 < x >= n and x not in self:"),
    ("comparison_boundary", 1, 9, "            if 0 < x < n and x not in self:"),
    ("arithmetic_swap", 1, 10, "                total = total + x / 2"),
    ("constant_tweak", 1, 7, "        total = 1"),
    ("statement_delete", 1, 8, "        return total"),
    ("comparison_flip", 2, 9, "            if 0 < x <= n and x in self:"),
    ("constant_tweak", 2, 9, "            if 1 < x <= n and x not in self:"),
    ("statement_delete", 2, 9, "            pass"),
    ("constant_tweak", 3, 10, "                total = total + x * 3"),
    ("statement_delete", 3, 10, "                pass"),
]


@query("udf_02_mutants", "UDF-02 UDF-03 UDF-04 UDF-05 UDF-06 UDF-07 UDF-08 UDF-09 REC-09 SCL-117 SCL-118", _values("operator, depth, line, text", CHANGES, "operator, depth, line, text"))
def mutants(spark, d):
    s = sources(spark, d).where("module LIKE '%.steps'")
    made = pa_.mutant_table(s, ["n_nationkey"], "source", "module", 20).join(s.select("n_nationkey", "source"), "n_nationkey")
    old = F.split("source", "\n")
    lines = F.transform(F.split("mutant", "\n"), lambda x, i: F.struct((i + 1).cast("int").alias("line"), x.alias("text"), F.get(old, i).alias("old")))
    first = F.filter(lines, lambda x: ~x["text"].eqNullSafe(x["old"]))[0]
    return made.where("qualname LIKE '%.take'").select("n_nationkey", "operator", "depth", first["line"].alias("line"), first["text"].alias("text"))
