from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from terrace.session import build_session

    spark = build_session(
        app_name="terrace-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.default.parallelism": "4",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get(
        "spark.checkpoint.dir", None
    ):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
