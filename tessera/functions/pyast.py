"""Facts about Python source text, as Arrow-batched functions over the standard library's syntax tree.

A text that does not parse has no facts: lists are empty, numbers null, and `parses` is false.
"""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Nodes that add one path each.
BRANCHES = (ast.If, ast.For, ast.AsyncFor, ast.While, ast.ExceptHandler, ast.IfExp, ast.match_case)
FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)


def parse(source: str | None) -> ast.Module | None:
    try:
        return ast.parse(source or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None


def own(node: ast.AST) -> Iterator[ast.AST]:
    """Nodes below a node that are its own: a function or class inside counts, what is in it does not."""
    todo = list(ast.iter_child_nodes(node))
    while todo:
        x = todo.pop()
        yield x
        if not isinstance(x, (*FUNCTIONS, ast.ClassDef)):
            todo += ast.iter_child_nodes(x)


def complexity(node: ast.AST) -> int:
    """1, plus one per branch, per further operand of and/or, per `for` and per `if` of a comprehension."""

    def paths(x: ast.AST) -> int:
        if isinstance(x, ast.BoolOp):
            return len(x.values) - 1
        return 1 + len(x.ifs) if isinstance(x, ast.comprehension) else int(isinstance(x, BRANCHES))

    return 1 + sum(map(paths, own(node)))


def signature(x: ast.FunctionDef | ast.AsyncFunctionDef) -> str:
    returns = f" -> {ast.unparse(x.returns)}" if x.returns else ""
    return f"{'async ' if isinstance(x, ast.AsyncFunctionDef) else ''}{x.name}({ast.unparse(x.args)}){returns}"


def _spans(tree: ast.Module, module: str) -> Iterator[tuple[str, str | None, ast.FunctionDef | ast.AsyncFunctionDef]]:
    """(qualname, enclosing class, node) of functions and methods, nested classes included, functions in functions not."""

    def walk(body: list, prefix: str, parent: str | None) -> Iterator:
        for x in body:
            name = f"{prefix}.{getattr(x, 'name', '')}" if prefix else getattr(x, "name", "")
            if isinstance(x, ast.ClassDef):
                yield from walk(x.body, name, name)
            elif isinstance(x, FUNCTIONS):
                yield name, parent, x

    return walk(tree.body, module, None)


def functions(tree: ast.Module, module: str) -> Iterator[dict]:
    for qualname, parent, x in _spans(tree, module):
        calls = sorted({ast.unparse(c.func) for c in own(x) if isinstance(c, ast.Call)})
        raised = sorted({ast.unparse(r.exc.func if isinstance(r.exc, ast.Call) else r.exc) for r in own(x) if isinstance(r, ast.Raise) and r.exc})
        yield {
            "qualname": qualname, "name": x.name, "parent": parent, "line": x.lineno, "end_line": x.end_lineno,
            "signature": signature(x), "docstring": ast.get_docstring(x), "decorators": [ast.unparse(d) for d in x.decorator_list],
            "complexity": complexity(x), "calls": calls, "raises": raised,
        }


def _dotted(node: ast.AST) -> str | None:
    """a.b.c of a chain of names; null for anything else."""
    names = []
    while isinstance(node, ast.Attribute):
        names.append(node.attr)
        node = node.value
    return ".".join([node.id, *reversed(names)]) if isinstance(node, ast.Name) else None


def calls(tree: ast.Module, module: str) -> Iterator[dict]:
    """Calls that functions make themselves, methods of nested classes included: the callee's text, and its dotted name where it is one."""
    for qualname, parent, x in _spans(tree, module):
        for c in own(x):
            if isinstance(c, ast.Call):
                yield {"caller": qualname, "enclosing": parent, "text": ast.unparse(c.func), "dotted": _dotted(c.func), "line": c.lineno}


def imports(tree: ast.Module) -> Iterator[dict]:
    """All imports; those of the module's body itself, the only ones that bind names of the module, are marked `top`."""
    body = set(map(id, tree.body))
    for x in ast.walk(tree):
        at = {"line": getattr(x, "lineno", 0), "top": id(x) in body}
        if isinstance(x, ast.Import):
            for a in x.names:
                yield {"kind": "import", "module": a.name, "name": None, "asname": a.asname, "level": 0, **at}
        elif isinstance(x, ast.ImportFrom):
            for a in x.names:
                yield {"kind": "from", "module": x.module or "", "name": a.name, "asname": a.asname, "level": x.level, **at}


def classes(tree: ast.Module, module: str) -> Iterator[dict]:
    """Classes of the module's body; those inside classes or functions are no part of an index of names."""
    for x in tree.body:
        if isinstance(x, ast.ClassDef):
            yield {"qualname": f"{module}.{x.name}" if module else x.name, "name": x.name, "line": x.lineno, "end_line": x.end_lineno, "docstring": ast.get_docstring(x), "bases": [ast.unparse(b) for b in x.bases]}


_FUNCTION = "qualname string, name string, parent string, line int, end_line int, signature string, docstring string, decorators array<string>, complexity int, calls array<string>, raises array<string>"
_IMPORT = "kind string, module string, name string, asname string, level int, line int, top boolean"
_CALL = "caller string, enclosing string, text string, dotted string, line int"
_CLASS = "qualname string, name string, line int, end_line int, docstring string, bases array<string>"


def _rows(sources: DataFrame, keep: list[str], source: str, module: str | None, schema: str, find: Callable, whole: bool = False) -> DataFrame:
    fields = [f.split()[0] for f in schema.split(", ")]
    kept = ", ".join(f"`{c}` {t}" for c, t in sources.select(*keep).dtypes)
    fed = sources.select(*keep, F.col(source).alias("__source"), (F.col(module) if module else F.lit("")).alias("__module"))
    names = [*keep, *fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                tree = parse(row[-2])
                if tree is not None:
                    given = (tree, row[-1], row[-2]) if whole else (tree, row[-1]) if module else (tree,)
                    out += [(*row[: len(keep)], *(f[k] for k in fields)) for f in find(*given)]
            yield pd.DataFrame(out, columns=names)

    return fed.mapInPandas(run, f"{kept}, {schema}")


def function_table(sources: DataFrame, keep: list[str], source: str, module: str) -> DataFrame:
    """One row per function of each source text, with the `keep` columns."""
    return _rows(sources, keep, source, module, _FUNCTION, functions)


def import_table(sources: DataFrame, keep: list[str], source: str) -> DataFrame:
    return _rows(sources, keep, source, None, _IMPORT, imports)


def call_table(sources: DataFrame, keep: list[str], source: str, module: str) -> DataFrame:
    return _rows(sources, keep, source, module, _CALL, calls)


def class_table(sources: DataFrame, keep: list[str], source: str, module: str) -> DataFrame:
    return _rows(sources, keep, source, module, _CLASS, classes)


def _per_text(kind: T.DataType, empty: object, find: Callable):
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([empty if (tree := parse(t)) is None else find(tree) for t in texts])

    return F.pandas_udf(run, kind)


def _bound(tree: ast.Module) -> list[str]:
    out: set[str] = set()
    for x in tree.body:
        if isinstance(x, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            out.add(x.name)
        elif isinstance(x, ast.Import | ast.ImportFrom):
            out |= {a.asname or a.name.split(".")[0] for a in x.names}
        else:
            out |= {n.id for n in ast.walk(x) if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store)}
    return sorted(out)


def _tests(tree: ast.Module) -> list[str]:
    out = [x.name for x in tree.body if isinstance(x, ast.FunctionDef | ast.AsyncFunctionDef) and x.name.startswith("test")]
    for c in tree.body:
        if isinstance(c, ast.ClassDef) and c.name.startswith("Test"):
            out += [f"{c.name}::{x.name}" for x in c.body if isinstance(x, ast.FunctionDef | ast.AsyncFunctionDef) and x.name.startswith("test")]
    return sorted(out)


def _assertions(tree: ast.Module) -> int:
    raising = lambda x: isinstance(x, ast.Call) and isinstance(x.func, ast.Attribute) and x.func.attr in ("raises", "warns")
    return sum(isinstance(x, ast.Assert) or raising(x) for x in ast.walk(tree))


def _side_effects(tree: ast.Module) -> bool:
    loud = {"open", "print", "write", "exec", "input", "remove", "unlink", "mkdir", "send"}
    for x in ast.walk(tree):
        if isinstance(x, ast.Global | ast.Nonlocal) or isinstance(x, ast.Attribute | ast.Subscript) and isinstance(x.ctx, ast.Store | ast.Del):
            return True
        if isinstance(x, ast.Call) and (getattr(x.func, "attr", None) or getattr(x.func, "id", None)) in loud:
            return True
    return False


parses = _per_text(T.BooleanType(), False, lambda tree: True)
bound_names = _per_text(T.ArrayType(T.StringType()), [], _bound)
test_names = _per_text(T.ArrayType(T.StringType()), [], _tests)
assertions = _per_text(T.IntegerType(), None, _assertions)
side_effects = _per_text(T.BooleanType(), None, _side_effects)
identifiers = _per_text(T.ArrayType(T.StringType()), [], lambda tree: sorted({x.id for x in ast.walk(tree) if isinstance(x, ast.Name)} | {x.attr for x in ast.walk(tree) if isinstance(x, ast.Attribute)}))


#: Operators of a comparison and their opposites, their neighbours at the boundary, of arithmetic, of logic.
FLIPS = {ast.Lt: ast.Gt, ast.Gt: ast.Lt, ast.LtE: ast.GtE, ast.GtE: ast.LtE, ast.Eq: ast.NotEq, ast.NotEq: ast.Eq, ast.Is: ast.IsNot, ast.IsNot: ast.Is, ast.In: ast.NotIn, ast.NotIn: ast.In}
EDGES = {ast.Lt: ast.LtE, ast.LtE: ast.Lt, ast.Gt: ast.GtE, ast.GtE: ast.Gt}
SWAPS = {ast.Add: ast.Sub, ast.Sub: ast.Add, ast.Mult: ast.Div, ast.Div: ast.Mult}
LOGIC = {ast.And: ast.Or, ast.Or: ast.And}
#: The kinds of change, in the order in which they take turns; statements that are never deleted.
OPERATORS = ["comparison_flip", "comparison_boundary", "arithmetic_swap", "and_or_swap", "return_none", "constant_tweak", "statement_delete"]
STAYS = (ast.Pass, ast.Return, ast.Raise, ast.Break, ast.Continue, *FUNCTIONS, ast.ClassDef)


def _changes(node: ast.AST) -> Iterator[tuple[str, str, object]]:
    """(kind, field, what goes there) of every change that one node allows."""
    if isinstance(node, ast.Compare):
        for kind, table in (("comparison_flip", FLIPS), ("comparison_boundary", EDGES)):
            for i, op in enumerate(node.ops):
                if type(op) in table:
                    yield kind, "ops", [*node.ops[:i], table[type(op)](), *node.ops[i + 1 :]]
    for kind, of, table in (("arithmetic_swap", ast.BinOp, SWAPS), ("and_or_swap", ast.BoolOp, LOGIC)):
        if isinstance(node, of) and type(node.op) in table:
            yield kind, "op", table[type(node.op)]()
    if isinstance(node, ast.Return) and node.value is not None and not (isinstance(node.value, ast.Constant) and node.value.value is None):
        yield "return_none", "value", ast.Constant(None)
    if isinstance(node, ast.Constant) and isinstance(node.value, int | float):
        yield "constant_tweak", "value", not node.value if isinstance(node.value, bool) else node.value + 1
    if not isinstance(node, ast.Module):
        for field in ("body", "orelse", "finalbody"):
            block = getattr(node, field, None)
            for i, x in enumerate(block if isinstance(block, list) else []):
                remark = i == 0 and isinstance(x, ast.Expr) and isinstance(x.value, ast.Constant)
                if isinstance(x, ast.stmt) and not isinstance(x, STAYS) and not remark:
                    yield "statement_delete", field, [*block[:i], *block[i + 1 :]] or [ast.Pass()]


def mutants(span: str) -> Iterator[tuple[str, int, str]]:
    """(kind, number within the kind, text): a span of lines with one place changed, each of which parses and differs.

    The span is parsed once; a change is put into the tree, written out, and taken back.
    """
    pad = min((len(x) - len(x.lstrip()) for x in span.splitlines() if x.strip()), default=0)
    tree = parse("\n".join(x[pad:] if x.strip() else "" for x in span.splitlines()))
    plain, found = ast.unparse(tree) if tree else "", {k: 0 for k in OPERATORS}
    for node in ast.walk(tree) if tree else ():
        for kind, field, value in list(_changes(node)):
            before = getattr(node, field)
            setattr(node, field, value)
            made = ast.unparse(tree)
            setattr(node, field, before)
            if made != plain and parse(made) is not None:
                yield kind, found[kind], "".join(f"{' ' * pad}{x}\n" if x.strip() else "\n" for x in made.splitlines())
                found[kind] += 1


def function_mutants(tree: ast.Module, module: str, source: str) -> Iterator[dict]:
    """Changes of every function; lines outside of it stay as they are, byte by byte."""
    lines = source.splitlines(keepends=True)
    for qualname, _, x in _spans(tree, module):
        for kind, depth, text in mutants("".join(lines[x.lineno - 1 : x.end_lineno])):
            yield {"qualname": qualname, "operator": kind, "depth": depth, "mutant": "".join([*lines[: x.lineno - 1], text, *lines[x.end_lineno :]])}


def mutant_table(sources: DataFrame, keep: list[str], source: str, module: str, count: int | None = None) -> DataFrame:
    """keep, qualname, operator, depth, mutant: one change of a function per row; with count, the first of each function,
    the kinds taking turns."""
    kept = [c for c in keep if c != source]
    made = _rows(sources, [*kept, source], source, module, "qualname string, operator string, depth int, mutant string", lambda tree, name, text: function_mutants(tree, name, text), whole=True).drop(source)
    if count is None:
        return made
    from pyspark.sql import Window

    turn = F.array_position(F.array(*map(F.lit, OPERATORS)), F.col("operator"))
    w = Window.partitionBy(*kept, "qualname").orderBy("depth", turn)
    return made.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= count).drop("__rn")


def excise(source: str, qualpath: list[str], replacement: str) -> str | None:
    """Source with a function's body replaced, every other byte as it was; null if there is no such function."""
    tree = parse(source)
    body, found = (tree.body if tree else []), None
    for name in qualpath:
        found = next((x for x in body if getattr(x, "name", None) == name), None)
        body = getattr(found, "body", [])
    if found is None or not body:
        return None
    lines = source.splitlines(keepends=True)
    pad = " " * body[0].col_offset
    return "".join([*lines[: body[0].lineno - 1], pad + replacement + "\n", *lines[found.end_lineno :]])


