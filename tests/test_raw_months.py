"""Raw months whose columns differ in type, text times, and folder states without a walk over files."""

import os
import time

from pyspark.sql import functions as F

from lakegov.operators import quality
from lakegov.plans import binding, catalog
from lakegov.session import work_dir
from lakegov.sources import lake


def test_months_of_different_types_are_one_table(spark):
    base = f"{work_dir(spark, 'months')}/raw"
    for i, kind in enumerate(["bigint", "bigint", "double", "string", "double", "bigint"]):
        df = spark.range(i * 10, i * 10 + 10).select(F.col("id").cast(kind).alias("PULocationID"), F.lit(i).alias("n"))
        if i == 5:
            df = df.withColumn("extra_column", F.lit("x"))
        df.coalesce(1).write.mode("append").parquet(base)
    raw = lake.read_raw(spark, base)
    assert dict(raw.dtypes) == {"PULocationID": "string", "n": "int", "extra_column": "string"}
    typed = quality.cast_existing(raw)
    assert sorted(r.PULocationID for r in typed.collect()) == list(range(60))
    assert raw.filter("extra_column IS NOT NULL").count() == 10


def test_common_types(spark):
    from pyspark.sql import types as T

    schema = lambda **c: T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in c.items()])
    got = lake.common_types([schema(a="int", b="bigint", c="float", d="timestamp_ntz", E="int"),
                             schema(a="bigint", b="double", c="string", d="string", e="int")])
    assert got == {"a": "bigint", "b": "double", "c": "string", "d": "string", "E": "int"}


def test_all_eight_reasons_appear(spark):
    got = {r.code for r in catalog.QUERIES["mixed_months_reasons"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == 8 and {"PICKUP_TS_NULL", "DROPOFF_TS_NULL"} <= got


def test_mixed_months_join_the_trips_once(spark, tmp_path, monkeypatch):
    """All three deliveries come from one read of lineitem, hold every trip once and leave nothing else behind."""
    n = 120
    spark.range(n).select(
        (F.col("id") % 40).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), F.col("id").cast("double").alias("l_quantity"),
        (F.col("id") + 0.25).alias("l_extendedprice"), F.lit(0.5).alias("l_discount"), F.lit(0.1).alias("l_tax"),
        F.lit("2024-12-31 00:00:00").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(F.col("id").alias("o_orderkey"), F.expr(
        "cast(add_months(date'2024-01-01', cast(id % 12 as int)) as timestamp_ntz)").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    whole = sorted(r.total_amount or 0 for r in binding.raw_trips(spark, str(tmp_path)).collect())
    read = spark.sparkContext.accumulator(0)

    def seen(key):
        read.add(1)
        return True
    plain, seen = binding.table, F.udf(seen, "boolean").asNondeterministic()
    monkeypatch.setattr(binding, "table", lambda s, d, t: plain(s, d, t).filter(seen("l_orderkey")) if t == "lineitem" else plain(s, d, t))
    binding.write_mixed_months(spark, str(tmp_path), f"{tmp_path}/out/raw")
    assert read.value == n and os.listdir(f"{tmp_path}/out") == ["raw"]
    raw = lake.read_raw(spark, f"{tmp_path}/out/raw")
    assert sorted(r.total_amount or 0 for r in raw.collect()) == whole and len(whole) == n


def test_state_of_many_files_takes_two_calls(spark, tmp_path):
    for i in range(5000):
        open(tmp_path / f"part-{i}.parquet", "w").close()
    spark.range(1).count()
    t = time.perf_counter()
    before = lake.file_state(spark, str(tmp_path))
    assert time.perf_counter() - t < 1.5 and before[1] == 5000
    (tmp_path / "part-new.parquet").write_text("x")
    assert lake.file_state(spark, str(tmp_path)) != before
    assert lake.file_state(spark, f"{tmp_path}/absent") == ()


def test_unrelated_tables_do_not_rebuild_layers(spark, tmp_path, monkeypatch):
    sf = str(tmp_path)
    for n in catalog.GOVERNED_TABLES:
        os.symlink(f"/root/testdata/sf0.001/{n}.parquet", f"{sf}/{n}.parquet")
    first, _ = catalog.validated(spark, sf)
    spark.range(3).write.parquet(f"{sf}/documents.parquet")
    assert catalog.validated(spark, sf)[0] is first


def test_jdbc_reads_are_split_by_key_ranges():
    whole = lake.jdbc_read_options("jdbc:x:y", "zone")
    assert whole["dbtable"] == "v_mdm_zone_golden_all" and "partitionColumn" not in whole
    split = lake.jdbc_read_options("jdbc:x:y", "vendor", "current", {"user": "u", "fetchsize": "5"}, (1, 1_200_000))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("golden_sk", "1", "1200001", "3")
    assert split["fetchsize"] == "5" and split["user"] == "u"
