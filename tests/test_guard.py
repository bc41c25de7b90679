"""The library stands without the training-data operators and the pipeline."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_library_does_not_import_llm():
    for p in (ROOT / "tessera").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(?:from|import)\s+(?:tessera\.llm|corpus_pipeline)", p.read_text(), re.M), p


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
