from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: Column names that operators use inside; inputs that carry them too must not confuse an operator.
CLASHES = ["k0", "k1", "g0", "e", "r", "t", "s", "l", "c", "h", "n", "x", "v", "f", "blk", "bin", "slot", "seq", "rank", "size", "source", "part", "id", "key", "prefix", "carry", "label"]


@pytest.fixture
def crowded():
    """Adds columns with names that operators use inside, except those that the input has."""
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in [x.lower() for x in df.columns]})

    return add
