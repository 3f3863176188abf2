"""SCD2 publish, golden views, snapshot and record upserts."""

import datetime as dt

from pyspark.sql import functions as F

from lakegov.operators import scd
from lakegov.operators.survivorship import survivorship_vendor, survivorship_zone

KEY, ATTRS = "location_id", ("borough", "zone", "service_zone")
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
REC = "batch_id string, location_id int, borough string, zone string, service_zone string, status string"


def publish_two(spark):
    b1 = spark.createDataFrame([
        ("b1", 1, "Q", "Corona", "Boro"), ("b1", 2, "Q", "Jamaica", None), ("b1", 3, "M", "SoHo", "Yellow"),
        ("b1", 4, "M", "Pending Place", "Yellow")], "batch_id string, location_id int, borough string, "
        "zone string, service_zone string").withColumn(
        "status", F.when(F.col("location_id") == 4, F.lit("PENDING")).otherwise(F.lit("APPROVED")))
    b2 = spark.createDataFrame([
        ("b2", 1, "Q", "Corona", "Boro", "APPROVED"),          # unchanged
        ("b2", 2, "Q", "Jamaica", "", "APPROVED"),             # NULL -> '' hashes equal: unchanged
        ("b2", 5, "B", "New Zone", None, "APPROVED"),          # new key
        ("b2", 3, "M", "SoHo East", "Yellow", "APPROVED")],    # changed
        REC)
    g0 = scd.empty_golden(spark, KEY, ATTRS)
    g1 = scd.scd2_publish(g0, b1, "b1", KEY, ATTRS, T1)
    g2 = scd.scd2_publish(g1, b2, "b2", KEY, ATTRS, T2)
    return g1, g2, b2


def test_scd2_cases(spark):
    g1, g2, _ = publish_two(spark)
    r1 = {r.location_id: r for r in g1.collect()}
    assert set(r1) == {1, 2, 3}                                   # PENDING row not published
    rows = g2.collect()
    cur = {r.location_id: r for r in rows if r.is_current}
    hist = [r for r in rows if not r.is_current]
    assert set(cur) == {1, 2, 3, 5}
    assert cur[3].zone == "SoHo East" and cur[3].source_batch_id == "b2"
    assert [h.location_id for h in hist] == [3] and str(hist[0].effective_to) == T2
    assert cur[1].source_batch_id == "b1" and cur[2].source_batch_id == "b1"
    assert cur[5].service_zone is None
    assert len({r.golden_sk for r in rows}) == len(rows)          # unique surrogate keys
    assert min(r.golden_sk for r in rows if r.source_batch_id == "b2") > max(
        r.golden_sk for r in rows if r.source_batch_id == "b1")


def test_republish_is_noop_and_one_current(spark):
    _, g2, b2 = publish_two(spark)
    g3 = scd.scd2_publish(g2, b2, "b2", KEY, ATTRS, T3)
    strip = lambda df: sorted(tuple(r) for r in df.drop("golden_sk").collect())
    assert strip(g3) == strip(g2)
    assert g3.filter("is_current").groupBy(KEY).count().filter("count > 1").count() == 0


def test_golden_views(spark):
    _, g2, _ = publish_two(spark)
    cur = scd.golden_current(g2, KEY, ATTRS)
    assert cur.columns == [KEY, *ATTRS, "effective_from", "effective_to", "is_current", "source_batch_id"]
    assert cur.count() == 4
    assert "record_hash" in scd.golden_all(g2, KEY, ATTRS).columns
    assert scd.golden_all(g2, KEY, ATTRS).count() == 5


def test_record_hash_matches_md5_text(spark):
    from lakegov.functions.expr import record_hash
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(record_hash("x", "y", "z")).first()[0] == df.select(F.md5(F.lit("a||c"))).first()[0]


SNAP = ("golden_sk bigint, location_id int, borough string, zone string, service_zone string, "
        "effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, source_batch_id string, "
        "created_at timestamp_ntz, snapshot_id string, snapshot_ts timestamp_ntz")
COMPARE = ["location_id", "borough", "zone", "service_zone", "effective_from", "effective_to", "is_current",
           "source_batch_id", "snapshot_id", "snapshot_ts"]


def test_snapshot_upsert_cases(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    tgt = spark.createDataFrame([
        (1, 1, "Q", "A", None, t1, None, True, "b1", t1, "s1", t1, t1, t1),
        (2, 2, "Q", "B", "x", t1, None, True, "b1", t1, "s1", t1, t1, t1),
        (3, 3, "Q", "C", "x", t1, None, True, "b1", t1, "s1", t1, t1, t1),
        (9, 9, "Q", "Z", "x", t1, None, True, "b1", t1, "s1", t1, t1, t1)],
        SNAP + ", loaded_at timestamp_ntz, updated_at timestamp_ntz")
    stg = spark.createDataFrame([
        (1, 1, "Q", "A", "", t1, None, True, "b1", t1, "s1", t1, "h"),      # NULL vs '' -> equal
        (2, 2, "Q", "B2", "x", t1, None, True, "b1", t1, "s1", t1, "h"),    # one column changed
        (3, 3, "Q", "C", "x", t1, None, True, "b1", t2, "s1", t1, "h"),     # only created_at changed
        (4, 4, "Q", "D", "x", t2, None, True, "b2", t2, "s2", t2, "h")],    # new
        SNAP + ", record_hash string")                                       # extra column ignored
    out = {r.golden_sk: r for r in scd.upsert_snapshot(tgt, stg, COMPARE, dt.datetime(2024, 3, 1)).collect()}
    assert out[1].updated_at == t1 and out[1].service_zone is None
    assert out[2].zone == "B2" and out[2].updated_at == dt.datetime(2024, 3, 1) and out[2].loaded_at == t1
    assert out[3].updated_at == t1 and out[3].created_at == t1
    assert out[4].loaded_at == dt.datetime(2024, 3, 1)
    assert out[9].zone == "Z"
    assert len(out) == 5


def test_record_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([("b1", 1, "A", "APPROVED")], "batch_id string, location_id int, zone string, "
                              "status string").withColumns(
        {"created_at": F.lit(T1).cast("timestamp_ntz"), "updated_at": F.lit(T1).cast("timestamp_ntz")})
    inc = spark.createDataFrame([("b1", 1, "A2", "PENDING"), ("b1", 2, "B", "APPROVED")],
                                "batch_id string, location_id int, zone string, status string")
    once = scd.upsert_records(t, inc, ["batch_id", KEY], T2, ["zone", "status"])
    twice = scd.upsert_records(once, inc, ["batch_id", KEY], T2, ["zone", "status"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    r = {x.location_id: x for x in once.collect()}
    assert r[1].zone == "A2" and str(r[1].created_at) == T1 and str(r[1].updated_at) == T2
    assert str(r[2].created_at) == T2


def test_survivorship(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    cand = spark.createDataFrame([
        (1, "Q", "A", "x", False, ts(T1), "b1"), (1, "Q", "A2", "x", False, ts(T2), "b2"),
        (1, "Q", None, "x", False, ts(T3), "b3"),                      # latest but incomplete
        (2, "Q", "B", "x", False, ts(T2), "b2"), (2, "Q", "B*", "x", True, ts(T1), "manual")],
        "location_id int, borough string, zone string, service_zone string, is_override boolean, "
        "approved_at timestamp_ntz, batch_id string")
    out = {r.location_id: r.zone for r in survivorship_zone(cand).collect()}
    assert out == {1: "A2", 2: "B*"}
    v = spark.createDataFrame([(1, "raw a", 2, None, 10), (1, "raw b", 2, None, 20), (1, "Steward", 1, ts(T1), 0),
                               (3, "raw only", 2, None, 5)],
                              "vendor_id int, vendor_name string, source_rank int, updated_at timestamp_ntz, "
                              "record_id bigint")
    got = {r.vendor_id: r.vendor_name for r in survivorship_vendor(v).collect()}
    assert got == {1: "Steward", 3: "raw only"}
