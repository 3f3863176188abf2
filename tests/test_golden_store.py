"""Incremental golden store, committed versions, batch ids as text."""

import os

import pytest
from pyspark.sql import functions as F

from lakegov.operators import golden_store as G
from lakegov.operators import scd
from lakegov.session import work_dir
from lakegov.sources import lake

KEY, ATTRS = "k", ("name", "kind")


def batch(spark, n, change=lambda k: False, new=0):
    rows = [(k, f"name {k}" + (" changed" if change(k) else ""), None if k % 7 == 0 else f"kind {k % 3}", "APPROVED" if k % 11 else "PENDING", n)
            for k in range(1, 200 + new)]
    return spark.createDataFrame(rows, "k int, name string, kind string, status string, batch_id string")


def plain(df):
    return sorted((tuple(r) for r in df.drop("golden_sk").collect()), key=repr)


def files(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


@pytest.fixture()
def store(spark):
    return f"{work_dir(spark, 'store')}/golden"


def test_store_equals_the_whole_publish(spark, store):
    b1, b2, b3 = batch(spark, "b1"), batch(spark, "b2", lambda k: k % 5 == 0, new=30), batch(spark, "b3", lambda k: k % 10 == 0)
    want = scd.empty_golden(spark, KEY, ATTRS)
    for i, (name, df) in enumerate((("b1", b1), ("b2", b2), ("b3", b3))):
        at = f"2024-0{i + 1}-01 00:00:00"
        want = scd.scd2_publish(want, df, name, KEY, ATTRS, at, next_sk_from=1 + (i << 40))
        G.publish(spark, store, df, name, KEY, ATTRS, at, buckets=8)
    got = G.golden(spark, store, KEY, ATTRS)
    assert plain(got) == plain(want)
    assert got.select("golden_sk").distinct().count() == got.count()


def test_republish_of_one_record_writes_one_bucket(spark, store):
    G.publish(spark, store, batch(spark, "b1"), "b1", KEY, ATTRS, "2024-01-01", buckets=16)
    before = files(f"{store}/current".replace("file:", ""))
    one = batch(spark, "b2", lambda k: k == 42).filter("k = 42")
    assert len(G.publish(spark, store, one, "b2", KEY, ATTRS, "2024-02-01", buckets=16)) == 1
    after = files(f"{store}/current".replace("file:", ""))
    gone, came = set(before) - set(after), set(after) - set(before)
    assert {f.split("bucket=")[1].split("/")[0] for f in gone | came} == {f.split("bucket=")[1].split("/")[0] for f in came}
    assert len({f.split("bucket=")[1].split("/")[0] for f in came}) == 1
    # the same record again is no change at all
    assert G.publish(spark, store, one.withColumn("batch_id", F.lit("b3")), "b3", KEY, ATTRS, "2024-03-01", buckets=16) == []
    assert files(f"{store}/current".replace("file:", "")) == after


def test_history_is_not_read_by_a_publish(spark, store):
    for i, n in enumerate(("b1", "b2")):
        G.publish(spark, store, batch(spark, n, lambda k, i=i: i and k % 2 == 0), n, KEY, ATTRS, f"2024-0{i + 1}-01", buckets=8)
    plan = G.changes(spark, store, batch(spark, "b3", lambda k: k == 8).filter("k = 8"), "b3", KEY, ATTRS, 8)._jdf.queryExecution().toString()
    assert "expired" not in plan and "PartitionFilters" in plan and f"bucket#" in plan


def test_publish_cut_short_is_repeated(spark, store):
    G.publish(spark, store, batch(spark, "b1"), "b1", KEY, ATTRS, "2024-01-01", buckets=8)
    b2 = batch(spark, "b2", lambda k: k % 5 == 0)
    # the marker never got written: replaced versions are not shown twice
    G.publish(spark, store, b2, "b2", KEY, ATTRS, "2024-02-01", buckets=8)
    whole = plain(G.golden(spark, store, KEY, ATTRS))
    lake.remove(spark, f"{store}__commits/commit=v-b2")
    hidden = G.golden(spark, store, KEY, ATTRS)
    assert hidden.groupBy(KEY).count().filter("count > 1").count() == 0
    G.publish(spark, store, b2, "b2", KEY, ATTRS, "2024-02-02", buckets=8)
    assert plain(G.golden(spark, store, KEY, ATTRS)) == whole
    keys = G.golden(spark, store, KEY, ATTRS).select("golden_sk")
    assert keys.distinct().count() == keys.count()


def test_newest_complete_version(spark):
    base = f"{work_dir(spark, 'complete')}/t"
    assert lake.latest_committed(spark, base) is None
    for v in ("001", "007", "1"):
        lake.write_version(spark.range(3).withColumn("v", F.lit(v)), base, v)
    lake.write_run(spark.range(9).withColumn("v", F.lit("half")), base, "zzz", "version")
    assert lake.latest_committed(spark, base) == "1"
    assert {r.v for r in lake.read_latest(spark, base).collect()} == {"1"}
    lake.write_version(spark.range(2).withColumn("v", F.lit("again")), base, "001")
    assert lake.read_latest(spark, base).count() == 2


def test_batch_ids_stay_text(spark):
    base = f"{work_dir(spark, 'batch-ids')}/t"
    rows = spark.createDataFrame([("001", 1), ("001", 2), ("002", 3)], "batch_id string, v int")
    lake.replace_batch(rows, base)
    lake.replace_batch(rows.filter("batch_id = '001'").withColumn("v", F.col("v") + 10), base)
    got = lake.read_batches(spark, base, rows.schema)
    assert sorted((r.batch_id, r.v) for r in got.collect()) == [("001", 11), ("001", 12), ("002", 3)]
    again = spark.createDataFrame(got.filter("batch_id = '001'").collect(), got.schema)
    lake.replace_batch(again, base)
    assert lake.read_batches(spark, base, rows.schema).count() == 3
