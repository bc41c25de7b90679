"""Paths, dotted names and identifiers of a repository."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_to_module(path: Column, roots: list[str] = ()) -> Column:
    """Dotted module of a .py path, without a leading source root and without __init__."""
    out = path
    for r in roots:
        out = F.regexp_replace(out, f"^{r}/", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\.py$", ""), r"(^|/)__init__$", "")
    return F.replace(out, F.lit("/"), F.lit("."))


def parent(name: Column) -> Column:
    """Dotted name without its last part, empty for a single part."""
    return F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise("")


def prefixes(name: Column) -> Column:
    """All dotted prefixes of a name, itself included."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))


def relative_base(module: Column, level: Column, is_package: Column) -> Column:
    """Package that an import of `level` dots starts from, null if there are too many dots."""
    parts = F.split(module, r"\.")
    keep = F.size(parts) - level + F.when(is_package, 1).otherwise(0)
    return F.when(level == 0, module).when(keep > 0, F.array_join(F.slice(parts, F.lit(1), F.greatest(keep, F.lit(1))), "."))


def base_test(nodeid: Column) -> Column:
    """Test id without its parameters."""
    return F.substring_index(nodeid, "[", 1)


def is_private(name: Column) -> Column:
    """Whether a dotted part starts with an underscore."""
    return F.exists(F.split(name, r"\."), lambda p: F.startswith(p, F.lit("_")))


def is_dunder(name: Column) -> Column:
    return F.startswith(name, F.lit("__")) & F.endswith(name, F.lit("__"))


def is_public_member(qualname: Column, module: Column) -> Column:
    """No part behind the module starts with an underscore."""
    rest = F.substring(qualname, F.length(module) + 2, F.length(qualname))
    return ~is_private(rest)


def glob_pattern(globs: list[str]) -> str:
    """One regular expression for path globs; a trailing slash names a directory anywhere in the path."""
    import fnmatch

    parts = [f"(?:^|.*/){g.rstrip('/')}/.*" if g.endswith("/") else fnmatch.translate(g).removeprefix("(?s:").rsplit(")", 1)[0] for g in globs]
    return "^(?:" + "|".join(parts) + ")$"


def matches_any(path: Column, globs: list[str]) -> Column:
    return path.rlike(glob_pattern(globs)) if globs else F.lit(False)


def is_test_path(path: Column, dirs: list[str] = ("test", "tests", "testing"), files: str = r"^(?:test_.*|.*_test|conftest)\.py$") -> Column:
    parts = F.split(path, "/")
    folders = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.arrays_overlap(folders, F.array(*[F.lit(d) for d in dirs])) | F.element_at(parts, -1).rlike(files)


def relative_to(path: Column, root: str) -> Column:
    """Path below root; null outside of it; relative paths stay."""
    return F.when(F.startswith(path, F.lit(root + "/")), F.substring(path, len(root) + 2, 1 << 20)).when(F.startswith(path, F.lit("/")), None).otherwise(path)


def resource(file: Column, first: Column, last: Column) -> Column:
    return F.format_string("/%s#L%d-L%d", file, first, last)


def markdown_link(title: Column, target: Column) -> Column:
    return F.format_string("[%s](%s)", title, target)


def relative_link(source: Column, target: Column) -> Column:
    """Relative path from the folder of one page to another page."""
    a, b = F.split(source, "/"), F.split(target, "/")
    a = F.slice(a, F.lit(1), F.size(a) - 1)
    shared = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1))), F.lit(0), lambda n, i: F.when((n == i - 1) & (i <= F.size(a)) & (i < F.size(b)) & F.try_element_at(a, i).eqNullSafe(F.try_element_at(b, i)), i).otherwise(n))
    ups = F.array_repeat(F.lit(".."), F.size(a) - shared)
    return F.array_join(F.concat(ups, F.slice(b, shared + 1, F.size(b) - shared)), "/")


def task_id(prefix: str, *parts: Column) -> Column:
    return F.concat_ws("-", F.lit(prefix), *parts)


def short_sha(sha: Column, n: int = 7) -> Column:
    return F.substring(sha, 1, n)
