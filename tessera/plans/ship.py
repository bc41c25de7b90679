"""Send this package to the executors, whose Python workers import what they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SENT.add(sc.applicationId)
