"""The tools of plans.tools as table functions of SQL, with declared arguments and results.

The point queries over a graph are SQL functions that Catalyst inlines: a call with a constant becomes a pushed filter, and a LATERAL
call for every row of a table becomes one join, whatever the number of calls. What walks through a file line by line is a
Python table function over a table argument: rows come partition by partition (PARTITION BY), one at a time, and a
partition is never gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.functions import udtf

#: Name, arguments, results, and body; {n}, {e} and {c} are the views of nodes (id, type), edges (type, source, target) and commits (ord, sha, message).
GRAPH = {
    "show_symbol": ("qualname STRING", "id STRING, type STRING", "SELECT n.id, n.type FROM {n} n WHERE n.id = show_symbol.qualname"),
    "callers": ("qualname STRING", "source STRING", "SELECT DISTINCT e.source FROM {e} e WHERE e.type = 'calls' AND e.target = callers.qualname"),
    "callees": ("qualname STRING", "target STRING", "SELECT DISTINCT e.target FROM {e} e WHERE e.type = 'calls' AND e.source = callees.qualname"),
    "tests_for": ("qualname STRING", "test STRING", "SELECT DISTINCT e.target FROM {e} e WHERE e.type = 'tested_by' AND e.source = tests_for.qualname"),
    "show_commit": ("prefix STRING", "ord BIGINT, sha STRING, message STRING", "SELECT c.ord, c.sha, c.message FROM {c} c WHERE startswith(c.sha, show_commit.prefix) ORDER BY c.ord LIMIT 1"),
    "module_members": ("module STRING", "id STRING", "SELECT n.id FROM {n} n WHERE startswith(n.id, concat(module_members.module, '.'))"),
}


def register_graph(spark: SparkSession, nodes: DataFrame, edges: DataFrame, commits: DataFrame, prefix: str = "tessera") -> list[str]:
    """Names of the functions over these tables, which replace older ones of the session and prefix."""
    views = {k: f"{prefix}_{name}" for k, name in (("n", "nodes"), ("e", "edges"), ("c", "commits"))}
    for k, df in (("n", nodes), ("e", edges), ("c", commits)):
        df.createOrReplaceTempView(views[k])
    for name, (arguments, results, body) in GRAPH.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({results}) RETURN {body.format(**views)}")
    return list(GRAPH)


@udtf(returnType="path string, no long, line string")
class GrepFile:
    """Lines of a file that match a pattern, at most `cap` of each partition, with their numbers from 1."""

    def __init__(self):
        self.left = None

    def eval(self, row: Row, pattern: str, cap: int) -> Iterator[tuple[str, int, str]]:
        if self.left is None:
            self.left, self.match = cap, re.compile(pattern).search
        for k, line in enumerate((row["content"] or "").split("\n"), 1):
            if self.left <= 0:
                return
            if self.match(line):
                self.left -= 1
                yield row["path"], k, line


@udtf(returnType="path string, no long, line string")
class ReadFile:
    """Lines `first` to `last` of each file."""

    def eval(self, row: Row, first: int, last: int) -> Iterator[tuple[str, int, str]]:
        for k, line in enumerate((row["content"] or "").split("\n"), 1):
            if k > last:
                return
            if k >= first:
                yield row["path"], k, line


def register_files(spark: SparkSession) -> list[str]:
    """grep_file(TABLE(files) PARTITION BY (path), pattern, cap) and read_file(TABLE(files), first, last); files has path and content."""
    for name, kind in (("grep_file", GrepFile), ("read_file", ReadFile)):
        spark.udtf.register(name, kind)
    return ["grep_file", "read_file"]
