"""Host-side sources: a repository's history, trees and blobs through the `git` program, and configuration files.

The commit log is a Spark data source whose partitions are ranges of the log; the machines that read it need
the repository. Elsewhere, `export_commits` writes the JSON lines that `readers.read_commits` takes.
"""

from __future__ import annotations

import configparser
import json
import subprocess
import tomllib
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "ord bigint, sha string, parents array<string>, message string, numstat string"
_MARK = "\x1e"


def git(repo: str, *args: str, check: bool = True) -> str:
    done = subprocess.run(["git", "-C", repo, *args], capture_output=True, text=True, errors="replace")
    if check and done.returncode:
        raise RuntimeError(f"git {args[0]}: {done.stderr.strip()}")
    return done.stdout


def commits(repo: str, ref: str, skip: int = 0, count: int = -1) -> Iterator[tuple]:
    """(ord, sha, parents, message, numstat), newest first."""
    log = git(repo, "log", "--no-renames", "--numstat", f"--skip={skip}", f"--max-count={count}", f"--format={_MARK}%H%x1f%P%x1f%B%x1f", ref)
    for k, entry in enumerate(log.split(_MARK)[1:]):
        sha, parents, message, stat = entry.split("\x1f", 3)
        yield skip + k, sha, parents.split(), message.strip("\n"), stat.strip("\n")


def show(repo: str, ref: str, path: str) -> str | None:
    """Content of a file at a ref, None if it is not there."""
    done = subprocess.run(["git", "-C", repo, "show", f"{ref}:{path}"], capture_output=True)
    return None if done.returncode else done.stdout.decode("utf-8", "replace")


def diff(repo: str, a: str, b: str, paths: list[str] = ()) -> str:
    return git(repo, "diff", "--no-renames", a, b, "--", *paths)


def tree(repo: str, ref: str) -> Iterator[tuple[str, str]]:
    """(path, content) of all files at a ref."""
    for path in git(repo, "ls-tree", "-r", "--name-only", "-z", ref).split("\0"):
        if path and (text := show(repo, ref, path)) is not None:
            yield path, text


def export_commits(repo: str, ref: str, path: str) -> int:
    """Write the log as JSON lines; the number of commits."""
    n = 0
    with Path(path).open("w", encoding="utf-8") as out:
        for row in commits(repo, ref):
            out.write(json.dumps(dict(zip(("ord", "sha", "parents", "message", "numstat"), row, strict=True))) + "\n")
            n += 1
    return n


class _Range(InputPartition):
    def __init__(self, skip: int, count: int):
        super().__init__((skip, count))
        self.skip, self.count = skip, count


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.repo, self.ref, self.size = options["path"], options.get("ref", "HEAD"), int(options.get("partitionSize", 500))

    def partitions(self) -> list[_Range]:
        n = int(git(self.repo, "rev-list", "--count", self.ref))
        return [_Range(at, self.size) for at in range(0, n, self.size)] or [_Range(0, 1)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        yield from commits(self.repo, self.ref, partition.skip, partition.count)


class GitLog(DataSource):
    """spark.dataSource.register(GitLog); spark.read.format("gitlog").option("ref", "HEAD").load(repo)"""

    @classmethod
    def name(cls) -> str:
        return "gitlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options)


def _toml(text: str | None) -> str | None:
    try:
        return json.dumps(tomllib.loads(text or ""), default=str, sort_keys=True)
    except tomllib.TOMLDecodeError:
        return None


def _ini(text: str | None) -> str | None:
    parser = configparser.ConfigParser(interpolation=None)
    try:
        parser.read_string(text or "")
    except configparser.Error:
        return None
    return json.dumps({s: dict(parser[s]) for s in parser.sections()}, sort_keys=True)


@F.pandas_udf(T.StringType())
def toml_json(texts: pd.Series) -> pd.Series:
    """TOML text as JSON, null where it does not parse."""
    return texts.map(_toml)


@F.pandas_udf(T.StringType())
def ini_json(texts: pd.Series) -> pd.Series:
    """INI text as JSON (section, key, value), null where it does not parse."""
    return texts.map(_ini)
