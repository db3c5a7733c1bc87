import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from dealtide.session import start  # noqa: E402

DATA = Path(__file__).resolve().parent / "data"
AS_OF = "2025-04-01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = start(
        SparkSession.builder.master(f"local[{min(8, os.cpu_count() or 4)}]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from dealtide.sources.exports import read_exports

    return read_exports(spark, str(DATA), multiline=True)


@pytest.fixture(scope="session")
def run_folder(spark, raw, tmp_path_factory):
    """One full refresh of the fixture, shared by the tests."""
    from dealtide.plans.refresh import refresh

    return refresh(spark, raw, str(tmp_path_factory.mktemp("runs")), run_id="run-1")


@pytest.fixture(scope="session")
def tables(spark, run_folder):
    from dealtide.sources.snapshot import read_snapshot

    return read_snapshot(spark, run_folder)


def rows(df, *columns):
    """Rows as tuples, in the order of their text."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
