from __future__ import annotations

import uuid

import pytest
from pyspark.sql import SparkSession

from siltstone.plans.control import ensure_metadata
from siltstone.session import tune
from siltstone.specs import Layers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.checkpoint.dir", str(home / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    """Empty schemas of this test alone, with the control tables in place."""
    tag = uuid.uuid4().hex[:8]
    layers = Layers(str(tmp_path), f"silver_{tag}", f"gold_{tag}", f"metadata_{tag}")
    ensure_metadata(spark, layers)
    return layers


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
