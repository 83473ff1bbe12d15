from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import CORE_CONF, ensure_checkpoint_dir, ship_code

    event_log = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    b = (SparkSession.builder.master("local[*]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
         .config("spark.eventLog.compress", "false")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    ship_code(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    d = df.orderBy(*order) if order else df
    return [r.asDict() for r in d.collect()]


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-tests-", dir=os.environ.get("TMPDIR", "/tmp"))
