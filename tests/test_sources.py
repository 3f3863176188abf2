"""Catalog layers, external views, golden reads and the latest-version listing."""

import os
import time

from lakegov.operators import scd
from lakegov.session import work_dir
from lakegov.sources import lake


def test_layers_external_and_golden(spark):
    names = lake.ensure_layers(spark, prefix="lgtest_")
    assert names == ["lgtest_staging", "lgtest_mdm", "lgtest_dim", "lgtest_fact", "lgtest_dq"]
    assert lake.ensure_layers(spark, prefix="lgtest_") == names          # idempotent
    base = work_dir(spark, "golden")
    g = scd.empty_golden(spark, "location_id", ("borough", "zone", "service_zone"))
    rec = spark.createDataFrame([("b1", 1, "Q", "A", None, "APPROVED")],
                                "batch_id string, location_id int, borough string, zone string, "
                                "service_zone string, status string")
    g1 = scd.scd2_publish(g, rec, "b1", "location_id", ("borough", "zone", "service_zone"), "2024-01-01 00:00:00")
    g1.write.parquet(f"{base}/zone")
    assert lake.read_golden(spark, base, "zone", "current").count() == 1
    lake.register_external(spark, "lg_golden_ext", f"{base}/zone")
    assert spark.sql("SELECT COUNT(*) FROM lg_golden_ext WHERE is_current").first()[0] == 1


def test_latest_version_picks_newest_folder(spark):
    base = work_dir(spark, "versions")
    spark.range(3).write.parquet(f"{base}/run_id=a")
    time.sleep(1.1)
    spark.range(3).write.parquet(f"{base}/run_id=b")
    got = lake.resolve_latest(spark, base)
    assert got.rstrip("/").endswith("run_id=b")
    # touching an older run's file makes it the latest
    older = [f for f in os.listdir(f"{base}/run_id=a".replace("file:", "")) if f.endswith(".parquet")][0]
    os.utime(os.path.join(f"{base}/run_id=a".replace("file:", ""), older))
    assert lake.resolve_latest(spark, base).rstrip("/").endswith("run_id=a")


def test_replace_batch_keeps_other_batches(spark):
    base = work_dir(spark, "batches")
    df = spark.createDataFrame([("b1", 1), ("b1", 2), ("b2", 3)], "batch_id string, k int")
    lake.replace_batch(df, base)
    lake.replace_batch(spark.createDataFrame([("b1", 9)], "batch_id string, k int"), base)
    got = sorted((r.batch_id, r.k) for r in spark.read.parquet(base).collect())
    assert got == [("b1", 9), ("b2", 3)]


def test_stage_curated_reads_one_run_slice(spark):
    base = work_dir(spark, "runs")
    a = spark.range(50).selectExpr("id", "CAST(id % 3 AS INT) AS VendorID")
    lake.write_run(a, base, "run-a")
    lake.write_run(a.union(a), base, "run-b")
    table = spark.read.parquet(base)
    sliced = lake.stage_curated(table, "run-a")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "run_id" in plan.split("PartitionFilters", 1)[1][:200]
    assert sliced.count() == 50 and lake.stage_curated(table).count() == 150
    empty = lake.empty_like(table)
    assert empty.count() == 0 and empty.schema == table.schema
