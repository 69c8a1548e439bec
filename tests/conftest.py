from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("deckforge-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="deckforge-test-ckpt-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from deckforge.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    yield spark


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="deckforge-test-")
