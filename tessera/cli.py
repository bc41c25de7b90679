"""python -m tessera.cli SPEC [TARGET | --target-file FILE]: evaluate a specification on a document, print JSON.

SPEC is a dotted path or a JSON object of paths; TARGET is JSON, TOML or a Python literal.
"""

from __future__ import annotations

import argparse
import ast
import json
import sys
import tomllib
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.plans import spec as sp


def load(text: str, kind: str) -> object:
    readers = {"json": json.loads, "toml": tomllib.loads, "python": ast.literal_eval}
    if kind not in readers:
        raise SystemExit(f"unknown format {kind}; known: {', '.join(readers)}")
    return readers[kind](text)


def evaluate(spark: SparkSession, target: object, spec: object) -> object:
    """The value of a path, or of each path of an object, in a document."""
    doc = spark.createDataFrame([(json.dumps(target),)], "j string").select(F.parse_json("j").alias("v"))
    one = lambda path: F.to_json(sp.get_variant(F.col("v"), path, "variant"))
    if isinstance(spec, dict):
        row = doc.select(*[one(p).alias(str(i)) for i, p in enumerate(spec.values())]).first()
        return {k: None if row[i] is None else json.loads(row[i]) for i, k in enumerate(spec)}
    value = doc.select(one(spec)).first()[0]
    return None if value is None else json.loads(value)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    p.add_argument("spec")
    p.add_argument("target", nargs="?")
    p.add_argument("--target-file")
    p.add_argument("--target-format", default="json")
    p.add_argument("--indent", type=int, default=2)
    p.add_argument("--scalar", action="store_true")
    a = p.parse_args(argv)
    if a.target is not None and a.target_file:
        p.error("give a target or a file, not both")
    text = a.target if a.target is not None else Path(a.target_file).read_text() if a.target_file else sys.stdin.read()
    spec = json.loads(a.spec) if a.spec.lstrip().startswith("{") else a.spec
    value = evaluate(SparkSession.builder.getOrCreate(), load(text, a.target_format), spec)
    if a.scalar and not isinstance(value, dict | list):
        print(value if isinstance(value, str) else json.dumps(value))
    else:
        print(json.dumps(value, indent=a.indent or None, sort_keys=True))


if __name__ == "__main__":
    main()
