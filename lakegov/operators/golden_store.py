"""Incremental golden store (C5, C6): current rows in hashed buckets, history by batch.

Layout under one path:

* ``current/bucket=n``: the current row of every key, dealt by a hash of the key;
* ``expired/batch_id=b/bucket=n``: the versions that batch ``b`` replaced;
* ``<path>__commits``: one marker per published batch, written last.

``publish`` reads the current rows of the buckets that the batch's keys fall
into, compares them with the batch, and rewrites the buckets where something
changed; expired versions are only ever added, so history is neither read nor
shuffled, however long it grows. What is rewritten is staged first, in the
shared checkpoint folder, and replaced by a dynamic partition overwrite.

A publish that was cut short is repeated: the same rows expire into the same
batch folder, the same buckets are replaced. Until its marker stands, ``golden``
leaves the batch's expired rows out, so no version shows up twice; the
replaced versions are back once the repeated publish has written it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegov.functions.expr import record_hash
from lakegov.operators.scd import APPROVED, _ts, golden_schema
from lakegov.session import work_dir
from lakegov.sources import lake

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(buckets)).cast("int")


def _current(spark: SparkSession, path: str, key: str, attrs: Sequence[str], only: Sequence[int] | None = None) -> DataFrame:
    """Current rows (of the buckets ``only``, a literal list that prunes the scan)."""
    schema = f"{golden_schema(key, attrs)}, bucket int"
    if not lake.file_state(spark, f"{path}/current"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/current")
    return rows if only is None else rows.filter(F.col("bucket").isin(*only) if only else F.lit(False))


def golden(spark: SparkSession, path: str, key: str, attrs: Sequence[str]) -> DataFrame:
    """All versions: the current rows and what committed batches expired."""
    current = _current(spark, path, key, attrs).drop("bucket")
    if not lake.file_state(spark, f"{path}/expired"):
        return current
    schema = f"{golden_schema(key, attrs)}, batch_id string, bucket int"
    done = F.broadcast(lake.commits(spark, path).select(F.col("version").alias("batch_id")).distinct())   # a row per batch
    expired = spark.read.schema(schema).parquet(f"{path}/expired").join(done, "batch_id", "left_semi")
    return current.unionByName(expired.select(*current.columns))


def changes(spark: SparkSession, path: str, records: DataFrame, batch_id: str, key: str, attrs: Sequence[str],
            buckets: int = BUCKETS) -> DataFrame:
    """New and changed keys of the batch with the current row they replace
    (``old``, null for a new key). Reads touched buckets of the current rows only."""
    inc = (records.filter((F.col("batch_id") == batch_id) & (F.col("status") == APPROVED))
           .select(F.col(key).cast("int").alias(key), *[F.col(c).cast("string").alias(c) for c in attrs])
           .withColumn("new_hash", record_hash(*attrs)).withColumn("bucket", bucket_of(key, buckets)))
    touched = sorted(r[0] for r in inc.select("bucket").distinct().collect())     # at most ``buckets`` rows
    old = _current(spark, path, key, attrs, touched)
    old = old.select(F.col("bucket"), F.col(key), F.struct(*[c for c in old.columns if c != "bucket"]).alias("old"))
    both = inc.join(old, ["bucket", key], "left")
    return both.filter(F.col("old").isNull() | (F.col("old.record_hash") != F.col("new_hash")))


def publish(spark: SparkSession, path: str, records: DataFrame, batch_id: str, key: str, attrs: Sequence[str], as_of,
            buckets: int = BUCKETS) -> list[int]:
    """Publish the APPROVED records of one batch; the rewritten buckets. The rules
    are those of ``scd2_publish``; publishing a batch again changes nothing."""
    at, base = _ts(as_of), work_dir(spark, "golden-publish")
    changes(spark, path, records, batch_id, key, attrs, buckets).write.parquet(f"{base}/changes")
    changed = spark.read.parquet(f"{base}/changes")
    touched = sorted(r[0] for r in changed.select("bucket").distinct().collect())
    top = max([r["m"] or 0 for r in lake.commits(spark, path).agg(F.max(F.get_json_object("note", "$.max_sk").cast("long")).alias("m")).collect()]
              + [_current(spark, path, key, attrs).agg(F.max("golden_sk")).first()[0] or 0])
    if touched:
        gone = changed.filter("old IS NOT NULL").select("bucket", "old.*").withColumns(
            {"effective_to": at, "is_current": F.lit(False), "batch_id": F.lit(batch_id)})
        fresh = changed.select("bucket", (F.monotonically_increasing_id() + top + 1).alias("golden_sk"), key, *attrs,
                               F.col("new_hash").alias("record_hash"), at.alias("effective_from"),
                               F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"),
                               F.lit(batch_id).alias("source_batch_id"), at.alias("created_at"))
        stay = _current(spark, path, key, attrs, touched).join(changed.select("bucket", key), ["bucket", key], "left_anti")
        stay.unionByName(fresh).write.parquet(f"{base}/current")
        _replace(gone, f"{path}/expired", ["batch_id", "bucket"])
        _replace(spark.read.parquet(f"{base}/current"), f"{path}/current", ["bucket"])
        top = spark.read.parquet(f"{base}/current").agg(F.max("golden_sk")).first()[0] or top
    lake.commit(spark, path, batch_id, f'{{"max_sk": {top}}}')
    lake.remove(spark, base)
    return touched


def _replace(rows: DataFrame, path: str, by: list[str]) -> None:
    (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
