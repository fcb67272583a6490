from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw articles from dicts; fetch order is list order unless given."""
    from pressgrid.schemas import RAW_ARTICLE

    def build(*rows: dict):
        full = [
            {"window_index": 0, "position": at, **row} for at, row in enumerate(rows)
        ]
        return spark.createDataFrame(
            [tuple(row.get(name) for name in RAW_ARTICLE.fieldNames()) for row in full], RAW_ARTICLE
        )

    return build


@pytest.fixture
def values(spark):
    """Evaluate a column expression over a list of strings."""

    def run(expression, *texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
        return [r.v for r in rows.select("i", expression(F.col("s")).alias("v")).orderBy("i").collect()]

    return run
