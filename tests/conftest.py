from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("eventlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("TEST_SESSION_TZ", "UTC"))
        .config("spark.sql.streaming.schemaInference", "false")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their session: give it a shared folder only if none is set.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="eventlake-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_uri():
    """A fresh local folder per test (tests only), as a file URI."""
    return "file://" + tempfile.mkdtemp(prefix="eventlake-t-") + "/t"


@pytest.fixture()
def session_conf(spark):
    """Set session confs for one test and restore them afterwards."""
    saved = {}

    def set_(key, value):
        if key not in saved:
            saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
