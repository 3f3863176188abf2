"""Vendor and rate-code masters end to end, mergeable quality state, platform KPIs, size checks without jobs."""


from pyspark.sql import functions as F

from lakegov.operators import dq, enrich, governance
from lakegov.plans import masters as M
from lakegov.plans import pipeline as P
from lakegov.session import work_dir
from lakegov.sources import seeds


def records(spark, batch, rows):
    return spark.createDataFrame([(k, n, st, batch) for k, n, st in rows], "vendor_id int, vendor_name string, status string, batch_id string")


def test_vendor_master_follows_its_batches(spark):
    root = work_dir(spark, "masters")
    assert M.master(spark, root, M.VENDOR) is None
    assert M.dimension(spark, root, M.VENDOR, seeds.seed(spark, "vendor")).count() == 4
    M.publish(spark, root, M.VENDOR, records(spark, "b1", [(1, "one", "APPROVED"), (2, "two", "APPROVED"), (3, "three", "PENDING")]), "b1", "2024-01-01")
    M.publish_snapshot(spark, root, M.VENDOR, "s1", "2024-01-01")
    assert M.load_master(spark, root, M.VENDOR, "2024-01-02") == "s1"
    first = {r.vendor_id: r for r in M.master(spark, root, M.VENDOR).collect()}
    assert set(first) == {1, 2}
    assert M.load_master(spark, root, M.VENDOR, "2030-01-01") == "s1"          # loaded already: nothing changes
    assert {r.updated_at for r in M.master(spark, root, M.VENDOR).collect()} == {first[1].updated_at}
    M.publish(spark, root, M.VENDOR, records(spark, "b2", [(1, "one changed", "APPROVED"), (4, "four", "APPROVED")]), "b2", "2024-02-01")
    M.publish_snapshot(spark, root, M.VENDOR, "s2", "2024-02-01")
    M.load_master(spark, root, M.VENDOR, "2024-02-02")
    rows = M.master(spark, root, M.VENDOR).collect()
    assert sorted((r.vendor_id, r.vendor_name, r.is_current) for r in rows) == [
        (1, "one", False), (1, "one changed", True), (2, "two", True), (4, "four", True)]
    kept = next(r for r in rows if r.vendor_name == "two")
    assert kept.loaded_at == first[2].loaded_at and kept.updated_at > kept.loaded_at
    dim = M.dimension(spark, root, M.VENDOR, seeds.seed(spark, "vendor")).collect()
    assert sorted((r.vendor_id, r.vendor_sk) for r in dim) == [(1, 1), (2, 2), (4, 3)]
    assert P.Layout(root).root == root


FACT = ("run_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, total_amount double, trip_distance double, "
        "vendor_sk long, ratecode_sk long, payment_type_sk long, pickup_zone_sk long, dropoff_zone_sk long")


def fact(spark, n, run):
    i = F.col("id")
    ts = lambda e: F.timestamp_seconds(e).cast("timestamp_ntz")
    return spark.range(n).select(
        F.lit(run).alias("run_id"), F.when(i % 9 > 0, ts(i * 60)).alias("pickup_datetime"), F.when(i % 11 > 0, ts(i * 60 + 300 - i % 7 * 60)).alias("dropoff_datetime"),
        F.when(i % 5 > 0, i / 3).alias("total_amount"), F.when(i % 4 > 0, i - 20.0).alias("trip_distance"),
        *(F.when(i % k > 0, i).alias(c) for k, c in ((3, "vendor_sk"), (6, "ratecode_sk"), (7, "payment_type_sk"), (8, "pickup_zone_sk"), (13, "dropoff_zone_sk"))))


def test_states_of_runs_merge_to_one_scan(spark):
    base = f"{work_dir(spark, 'states')}/t"
    parts = {"a": fact(spark, 100, "a"), "b": fact(spark, 37, "b")}
    for run, f in parts.items():
        dq.store_state(f, base, run)
    dq.store_state(fact(spark, 500, "a"), base, "a")          # a run that is repeated replaces its own row alone
    whole = fact(spark, 500, "a").unionByName(parts["b"])
    got, want = dq.merge_states(spark.read.parquet(base)).first(), dq.dq_metrics(whole).first()
    assert got.asDict() == {k: want[k] for k in got.asDict()} and len(got) == len(want)
    none = fact(spark, 0, "a")
    assert dq.merge_states(dq.run_state(none)).first().asDict() == dq.dq_metrics(none).first().asDict()


def test_a_second_run_reads_its_own_rows(spark):
    base, data = f"{work_dir(spark, 'states')}/t", f"{work_dir(spark, 'fact')}/t"
    for run in ("a", "b"):
        fact(spark, 40, run).drop("run_id").write.parquet(f"{data}/run_id={run}")
    second = spark.read.parquet(data).filter("run_id = 'b'")
    plan = dq.run_state(second)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    dq.store_state(second, base, "b")
    assert dq.merge_states(spark.read.parquet(base)).first().total_rows == 40


def test_platform_kpis(spark):
    cov = spark.createDataFrame([("a", 100, 99, 50), ("b", 100, 99, 50)], "run_id string, total_rows long, pu_nonnull long, do_nonnull long")
    dec = spark.createDataFrame([("a", "approved"), ("b", "rejected"), ("c", "approved")], "run_id string, decision string")
    snaps = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 06:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("committed_at"))
    got = {r.name: (r.value, r.ok) for r in governance.platform_kpis(cov, dec, snaps, "2024-01-02 12:00:00").collect()}
    assert got == {"total_rows_processed": (200.0, True), "pickup_zone_completeness": (0.99, True), "dropoff_zone_completeness": (0.5, False),
                   "approved_runs": (2.0, True), "rejected_runs": (1.0, True), "snapshot_age_hours": (6.0, True)}
    none = {r.name: (r.value, r.ok) for r in governance.platform_kpis(cov.limit(0), dec.limit(0), snaps.limit(0), "2024-01-02").collect()}
    assert none["pickup_zone_completeness"] == (None, False) and none["snapshot_age_hours"] == (None, False)


def test_size_check_starts_no_job(spark):
    base = f"{work_dir(spark, 'dims')}/t"
    spark.range(100).write.parquet(base)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size-check", "size check")
    small = spark.read.schema("id long").parquet(base)
    assert enrich.is_bounded(small.filter("id > 3")) and not enrich.is_bounded(small, max_bytes=10)
    assert not tracker.getJobIdsForGroup("size-check")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
