from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from utxoflow.session import LOCAL_CONF, checkpoint_dir

    builder = SparkSession.builder.master("local[4]").appName("utxoflow-tests")
    for k, v in {**LOCAL_CONF, "spark.sql.shuffle.partitions": "8"}.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    checkpoint_dir(s)
    yield s
    s.stop()
