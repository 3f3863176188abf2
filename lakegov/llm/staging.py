"""Intermediate tables in the shared folder.

Steps that are read more than once, or that end a long lineage, are written
as Parquet under the folder named by ``spark.checkpoint.dir`` and read back:
a lost executor then re-reads files instead of re-running the steps before.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shuffle files go as soon as the write that needed them has ended; a smaller
#: Arrow batch bounds what a Python task holds when documents are long.
STEP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Local sessions without one (tests) get a folder of their own; any other
    master must name a folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(root)
        root = "file://" + root
    return root.rstrip("/")


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` for functions of this package: the package is shipped
    to the Python workers once per application, so they need not have it
    installed."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "lakegov_llm.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(function, schema)


@contextmanager
def step_conf(spark: SparkSession):
    before = {k: spark.conf.get(k) for k in STEP_CONF}
    for k, v in STEP_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    with step_conf(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a table made by ``staged`` that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getParent().getName() == "llm":
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each behind as many underscores as it needs to be no column of
    ``df``: operators that carry a caller's columns name their own ones so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def unit_hash(seed: str, *cols: Column) -> Column:
    """A uniform number in [0, 1) from MD5 of the seed and the columns as text
    (null: empty), 52 bits, the same on every engine."""
    parts = [F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
