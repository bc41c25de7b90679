"""Nested patterns over VARIANT values, compiled to one column expression.

A pattern is
  a type            str, int, float, bool, dict, list, NoneType, object (anything); a boolean is an int too
  a dict            an object: every key must be taken by a key pattern, tried in the order written, whose value
                    pattern then decides. Plain keys must be there; Optional ones may lack and have a default; types,
                    M and Regex take any number of keys, at least one inside Required
  a list            an array, each element of which matches one of the patterns; [] matches the empty array only
  a tuple           an array of that length, place by place
  M, M(path)        the value, or a value inside it: compared (M > 3, M == M("a.b")), or by itself if it is truthy
  And, Or, Not, Regex, Match(pattern, default)
  anything else     a constant that the value must equal

`failure` gives the path and reason of the first mismatch, or null; `matched` the value with defaults filled in.
Object keys are read in alphabetical order, as VARIANT keeps no other. Everything stays in the JVM.

Defined cases: a null column is JSON null; values of different kinds are unequal, and none is less than another
(numbers and booleans are one kind); sets of keys are compared by whole keys, whatever signs they hold.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.plans.spec import variant_path

_NONE = type(None)
_MISSING = object()
_KINDS = {str: ["str"], int: ["int", "bool"], float: ["float"], bool: ["bool"], dict: ["dict"], list: ["list"], _NONE: ["null"]}


class _Operand:
    """Comparisons and combinations that build patterns."""

    def __eq__(self, other):
        return Compare(self, "=", other)

    def __ne__(self, other):
        return Compare(self, "<>", other)

    def __lt__(self, other):
        return Compare(self, "<", other)

    def __le__(self, other):
        return Compare(self, "<=", other)

    def __gt__(self, other):
        return Compare(self, ">", other)

    def __ge__(self, other):
        return Compare(self, ">=", other)

    __hash__ = object.__hash__


class _Joins:
    def __and__(self, other):
        return And(self, other)

    def __or__(self, other):
        return Or(self, other)

    def __invert__(self):
        return Not(self)


class Value(_Operand, _Joins):
    """The value at a dotted path inside the target; M is the target itself."""

    def __init__(self, path: str = ""):
        self.path = path

    def __call__(self, path: str) -> Value:
        if not isinstance(path, str) or not path:
            raise TypeError("M(...) takes a dotted path")
        return Value(path)

    def __repr__(self) -> str:
        return f"M({self.path!r})" if self.path else "M"


M = Value()


class Compare(_Joins):
    def __init__(self, left: Any, op: str, right: Any):
        self.left, self.op, self.right = left, op, right

    def __repr__(self) -> str:
        return f"{self.left!r} {self.op} {self.right!r}"


class _Several(_Joins):
    def __init__(self, *patterns: Any, default: Any = _MISSING):
        if not patterns:
            raise ValueError(f"{type(self).__name__} needs a pattern")
        self.patterns, self.default = patterns, default

    def __repr__(self) -> str:
        return f"{type(self).__name__}({', '.join(map(_name, self.patterns))})"


class And(_Several):
    """All patterns, one after the other; a default takes the place of a mismatch."""


class Or(_Several):
    """The first pattern that matches; a default takes the place of a mismatch."""


class Not(_Joins):
    def __init__(self, pattern: Any):
        self.pattern = pattern

    def __repr__(self) -> str:
        return f"Not({_name(self.pattern)})"


@dataclass(frozen=True)
class Regex(_Joins):
    """A string that matches as a whole (full), from its start (match), or anywhere (search)."""

    pattern: str
    how: str = "full"


@dataclass(frozen=True)
class Match:
    """A pattern whose mismatch gives the default."""

    pattern: Any
    default: Any = _MISSING


@dataclass(frozen=True)
class Optional:
    """A key that may lack."""

    key: str
    default: Any = field(default=_MISSING, compare=False)

    def __post_init__(self):
        if isinstance(self.key, (Required, Optional)):
            raise TypeError("Optional wraps a plain key")
        if precedence(self.key):
            raise ValueError(f"Optional wraps a plain key, not {self.key!r}")


@dataclass(frozen=True)
class Required:
    """A key pattern that must take at least one key."""

    key: Any

    def __post_init__(self):
        if isinstance(self.key, (Required, Optional)):
            raise TypeError("Required wraps a key pattern")
        if not precedence(self.key):
            raise ValueError(f"a plain key is required already: {self.key!r}")


def precedence(key: Any) -> int:
    """How general a key pattern is: 0 equals one key, 1 tests it, 2 takes a type."""
    if isinstance(key, (Required, Optional)):
        return precedence(key.key)
    if isinstance(key, (tuple, frozenset)):
        return max(map(precedence, key), default=0)
    if isinstance(key, type):
        return 2
    return int(isinstance(key, (Value, Compare, _Several, Not, Regex, Match)))


def _name(pattern: Any) -> str:
    return pattern.__name__ if isinstance(pattern, type) else repr(pattern)


def kind(v: Column) -> Column:
    """str, int, float, bool, dict, list or null: the kind of a VARIANT."""
    names = {"STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "OBJECT": "dict", "ARRAY": "list", "DECIMAL": "float", "DOUBLE": "float", "FLOAT": "float"}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)), F.lit("null"))


@dataclass(frozen=True)
class _Node:
    """A VARIANT and its kind, which is found once."""

    value: Column
    kind: Column


def _bound(v: Column, then: Callable[[_Node], Column]) -> Column:
    """An expression of a value that is evaluated once, however often the expression names it."""
    return F.get(F.transform(F.array(F.struct(v.alias("value"), kind(v).alias("kind"))), lambda x: then(_Node(x["value"], x["kind"]))), 0)


def _constant(value: Any) -> Column:
    return F.parse_json(F.lit(json.dumps(value)))


def _side(n: _Node, side: Any, then: Callable[[_Node], Column]) -> Column:
    if isinstance(side, Value):
        return _bound(F.try_variant_get(n.value, variant_path(side.path), "variant"), then) if side.path else then(n)
    kinds = {str: "str", bool: "bool", int: "int", float: "float", dict: "dict", list: "list", tuple: "list"}
    return then(_Node(_constant(side), F.lit(kinds.get(type(side), "null"))))


def _number(n: _Node) -> Column:
    """Numbers and booleans as double; null for other kinds."""
    return F.when(n.kind.isin("int", "float", "bool"), n.value.try_cast("double"))


_OPS = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def _compared(a: _Node, op: str, b: _Node) -> Column:
    ordered = _OPS[op]
    both = lambda name: (a.kind == name) & (b.kind == name)
    whole = F.when(both("int"), ordered(a.value.try_cast("long"), b.value.try_cast("long")))
    texts = F.when(both("str"), ordered(a.value.try_cast("string"), b.value.try_cast("string")))
    nested = F.lit(False)
    if op in ("=", "<>"):
        same = ordered(F.coalesce(F.to_json(a.value), F.lit("null")), F.coalesce(F.to_json(b.value), F.lit("null")))
        nested = (a.kind == b.kind) & same if op == "=" else (a.kind != b.kind) | same
    return F.coalesce(whole, ordered(_number(a), _number(b)), texts, nested)


def _compare(n: _Node, left: Any, op: str, right: Any) -> Column:
    return _side(n, left, lambda a: _side(n, right, lambda b: _compared(a, op, b)))


def _truthy(n: _Node) -> Column:
    v = n.value
    sizes = F.coalesce(F.size(v.try_cast("map<string,variant>")), F.size(v.try_cast("array<variant>")))
    return F.coalesce(F.when(n.kind.isin("dict", "list"), sizes > 0), F.when(n.kind == "str", v.try_cast("string") != ""), _number(n) != 0, F.lit(False))


def _first(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))


def _fail(holds: Column, path: Column, reason: str | Column) -> Column:
    return F.when(~F.coalesce(holds, F.lit(False)), F.concat(path, F.lit(": "), F.lit(reason) if isinstance(reason, str) else reason))


def _of_kind(n: _Node, wanted: type, path: Column) -> Column:
    if wanted is object:
        return F.lit(None).cast("string")
    if wanted not in _KINDS:
        raise TypeError(f"no JSON value is a {wanted.__name__}")
    return _fail(n.kind.isin(_KINDS[wanted]), path, F.concat(F.lit(f"expected {wanted.__name__}, got "), n.kind))


def _key_matches(key: Column, pattern: Any) -> Column:
    inner = pattern.key if isinstance(pattern, (Required, Optional)) else pattern
    if isinstance(inner, str):
        return key == inner
    if inner is str or inner is object:
        return F.lit(True)
    return _failure(_Node(key.cast("variant"), F.lit("str")), inner, F.lit("")).isNull()


def _choice(key: Column, patterns: list) -> Column:
    """The number of the first key pattern that takes the key; -1: none."""
    return reduce(lambda rest, i: F.when(_key_matches(key, patterns[i]), F.lit(i)).otherwise(rest), reversed(range(len(patterns))), F.lit(-1))


def _by_key(key: Column, patterns: list, then: Callable[[Any], Column], none: Column) -> Column:
    return reduce(lambda rest, p: F.when(_key_matches(key, p), then(p)).otherwise(rest), reversed(patterns), none)


def _object(n: _Node, pattern: dict, path: Column) -> Column:
    fields, patterns = n.value.try_cast("map<string,variant>"), list(pattern)

    def field(e: Column) -> Column:
        at = F.concat(path, F.lit("."), e["key"])
        return _by_key(e["key"], patterns, lambda p: failure(e["value"], pattern[p], at), F.concat(at, F.lit(": no pattern takes the key")))

    def missing(i: int, p: Any) -> Column:
        if precedence(p):
            return _fail(F.exists(F.map_keys(fields), lambda k: _choice(k, patterns) == i), path, f"missing Required({_name(p.key)})")
        return _fail(F.array_contains(F.map_keys(fields), p) if isinstance(p, str) else F.lit(False), path, f"missing {p!r}")

    needed = [missing(i, p) for i, p in enumerate(patterns) if isinstance(p, Required) or not precedence(p) and not isinstance(p, Optional)]
    found = _first(F.transform(F.array_sort(F.map_entries(fields), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(F.when(a["key"] > b["key"], 1).otherwise(0))), field))
    return F.coalesce(_of_kind(n, dict, path), found, *needed)


def _array(n: _Node, pattern: list | tuple, path: Column) -> Column:
    items, wrong = n.value.try_cast("array<variant>"), _of_kind(n, list, path)
    place = lambda i: F.concat(path, F.lit("["), F.lit(i).cast("string") if isinstance(i, int) else i.cast("string"), F.lit("]"))
    if isinstance(pattern, tuple):
        size = _fail(F.size(items) == len(pattern), path, F.concat(F.lit(f"expected {len(pattern)} elements, got "), F.size(items).cast("string")))
        return F.coalesce(wrong, size, *[failure(F.get(items, i), p, place(i)) for i, p in enumerate(pattern)])
    if not pattern:
        return F.coalesce(wrong, _fail(F.size(items) == 0, path, "the pattern is empty, the array is not"))
    return F.coalesce(wrong, _first(F.transform(items, lambda x, i: failure(x, Or(*pattern), place(i)))))


def failure(v: Column, pattern: Any, path: Column | None = None) -> Column:
    """The path and reason of the first mismatch of a VARIANT; null where it matches."""
    return _bound(v, lambda n: _failure(n, pattern, F.lit("$") if path is None else path))


def _failure(n: _Node, pattern: Any, path: Column) -> Column:
    if isinstance(pattern, type):
        return _of_kind(n, pattern, path)
    if isinstance(pattern, dict):
        return _object(n, pattern, path)
    if isinstance(pattern, (list, tuple)):
        return _array(n, pattern, path)
    if isinstance(pattern, Match):
        return _failure(n, pattern.pattern, path) if pattern.default is _MISSING else F.lit(None).cast("string")
    if isinstance(pattern, _Several):
        if pattern.default is not _MISSING:
            return F.lit(None).cast("string")
        each = [_failure(n, p, path) for p in pattern.patterns]
        if isinstance(pattern, And):
            return F.coalesce(*each)
        # the last pattern's mismatch tells why
        return reduce(lambda rest, f: F.when(f.isNull(), None).otherwise(rest), reversed(each[:-1]), each[-1])
    if isinstance(pattern, Not):
        return _fail(_failure(n, pattern.pattern, path).isNotNull(), path, f"{pattern!r} does not hold")
    if isinstance(pattern, Regex):
        test = {"full": f"^(?:{pattern.pattern})$", "match": f"^(?:{pattern.pattern})", "search": pattern.pattern}[pattern.how]
        return F.coalesce(_of_kind(n, str, path), _fail(n.value.try_cast("string").rlike(test), path, f"does not match {pattern.pattern}"))
    if isinstance(pattern, Value):
        return _fail(_side(n, pattern, _truthy), path, f"{pattern!r} is not truthy")
    if isinstance(pattern, Compare):
        return _fail(_compare(n, pattern.left, pattern.op, pattern.right), path, f"{pattern!r} does not hold")
    return _fail(_compare(n, M, "=", pattern), path, f"is not {pattern!r}")


def matched(v: Column, pattern: Any) -> Column:
    """The VARIANT with the defaults of its pattern filled in; meaningful where `failure` is null."""
    if isinstance(pattern, Match):
        inner = matched(v, pattern.pattern)
        return inner if pattern.default is _MISSING else F.when(failure(v, pattern.pattern).isNull(), inner).otherwise(_constant(pattern.default))
    if isinstance(pattern, _Several):
        if isinstance(pattern, Or):
            none = v if pattern.default is _MISSING else _constant(pattern.default)
            return reduce(lambda rest, p: F.when(failure(v, p).isNull(), matched(v, p)).otherwise(rest), reversed(pattern.patterns), none)
        inner = reduce(matched, pattern.patterns, v)
        return inner if pattern.default is _MISSING else F.when(failure(v, And(*pattern.patterns)).isNull(), inner).otherwise(_constant(pattern.default))
    if isinstance(pattern, dict) and pattern:
        fields, patterns = v.try_cast("map<string,variant>"), list(pattern)
        got = F.transform_values(fields, lambda k, x: _by_key(k, patterns, lambda p: matched(x, pattern[p]), x))
        defaults = {p.key: p.default for p in patterns if isinstance(p, Optional) and p.default is not _MISSING}
        if defaults:
            given = F.create_map(*[c for k, d in defaults.items() for c in (F.lit(k), _constant(d))])
            got = F.map_concat(got, F.map_filter(given, lambda k, _: ~F.array_contains(F.map_keys(fields), k)))
        return F.to_variant_object(got)
    if isinstance(pattern, list) and pattern:
        return F.to_variant_object(F.transform(v.try_cast("array<variant>"), lambda x: matched(x, Or(*pattern))))
    if isinstance(pattern, tuple):
        items = v.try_cast("array<variant>")
        return F.to_variant_object(F.array(*[matched(F.get(items, i), p) for i, p in enumerate(pattern)])) if pattern else v
    return v
