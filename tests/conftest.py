import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lakegov.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[4]").appName("lakegov-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder (a cluster names one in spark.checkpoint.dir)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakegov-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
