"""Nested projections: a specification compiled to one column expression.

A specification is
  a dotted path     fields of structs and maps, numbers index arrays, `*` goes through an array's elements
  a dict            a struct with one field per entry
  a one-item list   its specification for each element of an array
  a tuple           its specifications one after the other
  a Column          itself
  a function        called with the column so far
  one of the classes below

SKIP from a list's specification drops the element, STOP ends the list before it. Errors follow ANSI mode: a
missing index raises, and Coalesce goes on with the next specification where `try_` access gives null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Any
Step = Callable[[Column], Column]


def parse_path(text: str) -> list[str | int]:
    """Segments of a dotted path; digits are places in an array, a backslash keeps a dot."""
    parts, now, it = [], "", iter(text)
    for c in it:
        if c == "\\":
            now += next(it, "")
        elif c == ".":
            parts, now = [*parts, now], ""
        else:
            now += c
    return [int(p) if p.lstrip("-").isdigit() else p for p in [*parts, now] if p != ""]


def starts_with(path: str, prefix: str) -> bool:
    a, b = parse_path(path), parse_path(prefix)
    return a[: len(b)] == b


def get_path(col: Column, path: str | list[str | int], lenient: bool = False) -> Column:
    """Value at a path; lenient gives null where an array is too short."""
    parts = parse_path(path) if isinstance(path, str) else list(path)
    if not parts:
        return col
    head, rest = parts[0], parts[1:]
    if head == "*":
        return F.transform(col, lambda x: get_path(x, rest, lenient))
    if isinstance(head, int):
        at = F.lit(head + 1 if head >= 0 else head)
        return get_path(F.try_element_at(col, at) if lenient else F.element_at(col, at), rest, lenient)
    return get_path(col.getItem(head), rest, lenient)


def variant_path(path: str) -> str:
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in parse_path(path))


def get_variant(col: Column, path: str, kind: str = "string") -> Column:
    """Value at a path of a VARIANT, null where a step is missing or the value does not fit the kind."""
    return F.try_variant_get(col, variant_path(path), kind)


def descendants(df: DataFrame, column: str, depth: int) -> DataFrame:
    """path, value: every value inside a VARIANT down to `depth` levels, the root included (path $)."""
    level = df.select(*[c for c in df.columns if c != column], F.lit("$").alias("path"), F.col(column).alias("value"))
    keep = [c for c in level.columns if c not in ("path", "value")]
    out, view = level, level
    for _ in range(depth):
        view.createOrReplaceTempView("__tessera_level")
        cols = "".join(f"`{c}`, " for c in keep)
        step = "path || CASE WHEN e.key IS NULL THEN '[' || e.pos || ']' ELSE '.' || e.key END"
        view = df.sparkSession.sql(f"SELECT {cols}{step} AS path, e.value AS value FROM __tessera_level, LATERAL variant_explode(value) AS e")
        out = out.unionByName(view)
    return out


class _Signal:
    def __init__(self, name: str):
        self.name = name

    def __repr__(self) -> str:
        return self.name


SKIP, STOP = _Signal("SKIP"), _Signal("STOP")


@dataclass(frozen=True)
class Val:
    """A literal."""

    value: Any


@dataclass(frozen=True)
class Coalesce:
    """The first specification whose value is not null nor among `skip`; else the default."""

    specs: tuple
    default: Any = None
    skip: tuple = ()


@dataclass(frozen=True)
class Check:
    """The value if all conditions hold; else the default, or an error that names those that fail."""

    conditions: dict[str, Step]
    default: Any = None
    strict: bool = True


@dataclass(frozen=True)
class Switch:
    """The specification of the first condition that holds; else the default, or an error."""

    cases: tuple[tuple[Step, Spec], ...]
    default: Any = None
    strict: bool = False


@dataclass(frozen=True)
class Let:
    """Names bound to values of the column so far; `then` gets them as keyword arguments and gives a specification."""

    bindings: dict[str, Spec]
    then: Callable[..., Spec]


@dataclass(frozen=True)
class Where:
    """In a list: elements without the condition are dropped (SKIP), or end the list (STOP)."""

    condition: Step
    spec: Spec = ""
    otherwise: _Signal = SKIP


@dataclass(frozen=True)
class Fold:
    """op over the elements of an array from `init` on."""

    spec: Spec
    init: Any
    op: Callable[[Column, Column], Column]
    finish: Step = field(default=lambda c: c)


def Sum(spec: Spec = "", init: Any = 0) -> Fold:  # noqa: N802
    return Fold(spec, init, lambda a, x: a + x)


def Flatten(spec: Spec = "", levels: int = 1) -> Step:  # noqa: N802
    if levels < 0:
        raise ValueError("levels must not be negative")
    return lambda c: reduce(lambda x, _: F.flatten(x), range(levels), evaluate(c, spec))


def _literal(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def evaluate(col: Column, spec: Spec) -> Column:
    """The column expression of a specification."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return get_path(col, spec)
    if isinstance(spec, Val):
        return _literal(spec.value)
    if isinstance(spec, dict):
        return F.struct(*[evaluate(col, s).alias(name) for name, s in spec.items()])
    if isinstance(spec, tuple):
        return reduce(evaluate, spec, col)
    if isinstance(spec, list):
        return _each(col, spec[0])
    if isinstance(spec, Coalesce):
        values = [get_path(col, s, lenient=True) if isinstance(s, str) else evaluate(col, s) for s in spec.specs]
        kept = [F.when(~v.isin(list(spec.skip)), v) if spec.skip else v for v in values]
        return F.coalesce(*kept, *([] if spec.default is None else [_literal(spec.default)]))
    if isinstance(spec, Check):
        failed = F.filter(F.array(*[F.when(~F.coalesce(c(col), F.lit(False)), F.lit(name)) for name, c in spec.conditions.items()]), lambda x: x.isNotNull())
        bad = F.raise_error(F.concat(F.lit("check failed: "), F.array_join(failed, ", "))) if spec.strict else _literal(spec.default)
        return F.when(F.size(failed) == 0, col).otherwise(bad)
    if isinstance(spec, Switch):
        out = F.raise_error("no case matches") if spec.strict else _literal(spec.default)
        for cond, then in reversed(spec.cases):
            out = F.when(cond(col), evaluate(col, then)).otherwise(out)
        return out
    if isinstance(spec, Let):
        return evaluate(col, spec.then(**{k: evaluate(col, v) for k, v in spec.bindings.items()}))
    if isinstance(spec, Fold):
        return F.aggregate(evaluate(col, spec.spec), _literal(spec.init), spec.op, spec.finish)
    if callable(spec):
        return spec(col)
    raise TypeError(f"no specification: {spec!r}")


def _each(col: Column, spec: Spec) -> Column:
    if not isinstance(spec, Where):
        return F.transform(col, lambda x: evaluate(x, spec))
    holds = lambda x: F.coalesce(spec.condition(x), F.lit(False))
    if spec.otherwise is SKIP:
        return F.transform(F.filter(col, holds), lambda x: evaluate(x, spec.spec))
    ends = F.array_position(F.transform(col, holds), False)
    kept = F.when(ends == 0, col).otherwise(F.slice(col, F.lit(1), F.greatest(ends.cast("int") - 1, F.lit(0))))
    return F.transform(kept, lambda x: evaluate(x, spec.spec))


def project(df: DataFrame, column: str, spec: Spec, out: str = "result", default: Any = None) -> DataFrame:
    """df with the value of a specification; the default replaces null."""
    value = evaluate(F.col(column), spec)
    return df.withColumn(out, value if default is None else F.coalesce(value, _literal(default)))


# Predicates, as steps from a column to a boolean column.


def all_of(*preds: Step) -> Step:
    return lambda c: reduce(lambda a, b: a & b, [p(c) for p in preds])


def any_of(*preds: Step) -> Step:
    return lambda c: reduce(lambda a, b: a | b, [p(c) for p in preds])


def negate(pred: Step) -> Step:
    return lambda c: ~pred(c)


def matches(pattern: str, how: str = "full") -> Step:
    """Regular expression over the whole value (full), its start (match) or any part of it (search)."""
    p = {"full": f"^(?:{pattern})$", "match": f"^(?:{pattern})", "search": pattern}[how]
    return lambda c: c.rlike(p)


def one_of(*values: Any) -> Step:
    return lambda c: c.isin(list(values))


def has_keys(required: list[str], optional: list[str] = (), others: bool = False) -> Step:
    """A map's keys: all required ones, and none but the optional ones besides."""

    def pred(c: Column) -> Column:
        keys = F.map_keys(c)
        there = F.size(F.array_except(F.array(*[F.lit(r) for r in required]), keys)) == 0 if required else F.lit(True)
        known = F.array(*[F.lit(k) for k in [*required, *optional]])
        return there if others else there & (F.size(F.array_except(keys, known)) == 0)

    return pred


def every(pred: Step) -> Step:
    return lambda c: F.forall(c, pred)


def truthy(kind: str) -> Step:
    """Python's truth of a value of the kind: null, 0, false and empty are false."""
    if kind.startswith(("array", "map")):
        return lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    if kind == "string":
        return lambda c: F.coalesce(c != "", F.lit(False))
    if kind == "boolean":
        return lambda c: F.coalesce(c, F.lit(False))
    return lambda c: F.coalesce(c != 0, F.lit(False))


class Registry:
    """Handlers by data type and operation: the type itself, else the nearest kind it belongs to."""

    def __init__(self):
        self._handlers: dict[tuple[str, str], Step] = {}

    def register(self, operation: str, kind: str, handler: Step) -> None:
        self._handlers[(operation, kind)] = handler

    def handler(self, operation: str, kind: str) -> Step:
        for k in (kind, kind.split("<")[0], "any"):
            if (operation, k) in self._handlers:
                return self._handlers[(operation, k)]
        raise KeyError(f"{operation} is not known for {kind}")

    def apply(self, operation: str, df: DataFrame, column: str) -> Column:
        return self.handler(operation, dict(df.dtypes)[column])(F.col(column))


# Combinators of steps.


def compose_left(*steps: Step) -> Step:
    return lambda c: reduce(lambda x, f: f(x), steps, c)


def compose(*steps: Step) -> Step:
    return compose_left(*reversed(steps))


def juxt(*steps: Step) -> Step:
    return lambda c: F.struct(*[f(c).alias(f"_{i}") for i, f in enumerate(steps)])


def thread(value: Column, *forms: Any, last: bool = False) -> Column:
    """Value through forms: a function, or (function, argument, ...) with the value as first or last argument."""
    for form in forms:
        fn, *args = form if isinstance(form, tuple) else (form,)
        value = fn(*args, value) if last else fn(value, *args)
    return value


def iterate(spark, start: Any, step: str, n: int, kind: str = "bigint") -> DataFrame:
    """ord, value: start, step(start), ... n values; step is SQL over `value`."""
    return spark.sql(f"WITH RECURSIVE s(ord, value) AS (SELECT 0L, CAST({start!r} AS {kind}) UNION ALL SELECT ord + 1, CAST({step} AS {kind}) FROM s WHERE ord + 1 < {int(n)}) SELECT * FROM s")
