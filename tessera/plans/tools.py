"""Named point queries over a repository's tables, each with a JSON schema of its arguments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx


@dataclass(frozen=True)
class Tool:
    name: str
    about: str
    arguments: dict[str, str]
    run: Callable[..., DataFrame]

    def schema(self) -> dict:
        return {"type": "object", "properties": {k: {"type": t.rstrip("?")} for k, t in self.arguments.items()}, "required": [k for k, t in self.arguments.items() if not t.endswith("?")]}

    def __call__(self, **given) -> DataFrame:
        unknown, missing = set(given) - set(self.arguments), set(self.schema()["required"]) - set(given)
        if unknown or missing:
            raise TypeError(f"{self.name}: unknown {sorted(unknown)}, missing {sorted(missing)}")
        return self.run(**given)


def graph_tools(nodes: DataFrame, edges: DataFrame, commits: DataFrame) -> dict[str, Tool]:
    """Queries by exact id, by neighbour, and by a sha's first characters."""
    calls = edges.where("type = 'calls'")
    near = lambda a, b: lambda qualname: calls.where(F.col(a) == qualname).select(b).distinct().orderBy(b)
    tested = edges.where("type = 'tested_by'")
    return {
        t.name: t
        for t in (
            Tool("show_symbol", "a node", {"qualname": "string"}, lambda qualname: nodes.where(F.col("id") == qualname).limit(1)),
            Tool("callers", "who calls it", {"qualname": "string"}, near("target", "source")),
            Tool("callees", "what it calls", {"qualname": "string"}, near("source", "target")),
            Tool("tests_for", "tests that reach it", {"qualname": "string"}, lambda qualname: tested.where(F.col("source") == qualname).select(F.col("target").alias("test")).distinct().orderBy("test")),
            Tool("show_commit", "a commit", {"sha": "string"}, lambda sha: commits.where(F.startswith(F.col("sha"), F.lit(sha))).orderBy("ord").limit(1)),
            Tool("module_members", "nodes of a module", {"module": "string"}, lambda module: nodes.where(F.startswith(F.col("id"), F.lit(module + "."))).orderBy("id")),
        )
    }


def file_tools(files: DataFrame, cap: int = 100) -> dict[str, Tool]:
    """Queries over (path, content)."""

    def read(path: str, first: int = 1, last: int = 1 << 30) -> DataFrame:
        return files.where(F.col("path") == path).select(tx.line_range(F.col("content"), F.lit(first), F.lit(last)).alias("text"))

    def grep(pattern: str) -> DataFrame:
        rows = files.select("path", F.posexplode(F.split("content", "\n")).alias("no", "line")).where(F.col("line").rlike(pattern))
        return rows.select("path", (F.col("no") + 1).alias("no"), "line").orderBy("path", "no").limit(cap)

    return {t.name: t for t in (Tool("read_file", "lines of a file", {"path": "string", "first": "integer?", "last": "integer?"}, read), Tool("grep", "lines that match", {"pattern": "string"}, grep), Tool("list_files", "all paths", {}, lambda: files.select("path").orderBy("path")))}
