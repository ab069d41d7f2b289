from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]").appName("sluice-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    # Only where nobody configured a shared checkpoint folder.
    if not (session.conf.get("spark.checkpoint.dir", None) or session.sparkContext.getCheckpointDir()):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-test-ckpt-"))
    yield session


@pytest.fixture()
def workdir(spark):
    from sluice.context import new_workdir

    return new_workdir(spark, "test")


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")
