"""The entry points, with and without the training-data subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_sql_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_training_data_subpackage(tmp_path):
    """The rest imports and keeps its queries where both folders are deleted."""
    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for folder in ("corpusloom/llm", "tests/llm"):
        shutil.rmtree(copy / folder, ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'ingest_status' in q and not [k for k in q if k[0] == 'p' and k[1].isdigit()]; print(len(q), len(e.oracle_sql()))"
    made = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert made.returncode == 0, made.stderr
