"""All queries of the library by name, with their DuckDB equivalents.

"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.ship import ship

FLAGSHIP = "join_01_interval_hits"

_MODULES = ("q_sources", "q_filters", "q_joins", "q_aggregates", "q_sequences", "q_scalars", "q_nested", "q_iteration", "q_streams", "q_funnels", "q_symbols")


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


_ENTRIES: dict[str, Entry] = {}


def query(key: str, ops: str, sql: str | None = None):
    """Register a query; sql is None where SQL cannot express it (its tests hold it against a plain model)."""

    def add(run):
        if key in _ENTRIES:
            raise ValueError(f"two queries named {key}")

        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        _ENTRIES[key] = Entry(shipped, sql, tuple(ops.split()))
        return run

    return add


@cache
def _load() -> None:
    for name in _MODULES:
        import_module(f"tessera.plans.{name}")


def entries() -> dict[str, Entry]:
    _load()
    return dict(_ENTRIES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.run for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in entries().items() if e.sql}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
