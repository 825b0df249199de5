from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import labelflow  # noqa: E402

cloudpickle.register_pickle_by_value(labelflow)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of texts."""

    def run(function, values):
        df = spark.createDataFrame(list(enumerate(values)), "i long, text string")
        out = df.select("i", function(F.col("text")).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return run
