"""The entry module in a copy of the repository without the optional operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCRIPT = """
import __spark_entry__ as entry
from pyspark.sql import SparkSession
names = set(entry.queries())
assert names and set(entry.oracle_sql()) <= names, names
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["report_funnel"](spark, SF_DIR).count())
spark.stop()
"""


@pytest.mark.parametrize("left_out", [("dealtide/llm",), ("dealtide/llm", "corpus_pipeline.py")])
def test_core_queries_work_without_the_optional_folders(tmp_path, left_out):
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not there")
    kept = shutil.ignore_patterns(".git", "__pycache__", "llm", *left_out[1:])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=kept)
    run = subprocess.run(
        [sys.executable, "-c", f"SF_DIR = {SF_DIR!r}\n{SCRIPT}"], cwd=tmp_path / "copy", capture_output=True,
        text=True, timeout=300, env={**os.environ, "PYTHONPATH": str(tmp_path / "copy"), "PYTHONDONTWRITEBYTECODE": "1"},
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert "rows" in run.stdout
