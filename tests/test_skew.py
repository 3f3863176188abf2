"""One key holding a third of all rows: results stay whole and exact, and the
plans collapse the hot key before any shuffle (no pair enumeration)."""

import datetime as dt

from pyspark.sql import functions as F

from lakegov.operators import analytics, matching, star, survivorship
from lakegov.plans import binding
from lakegov.sources import seeds

N = 30_000


def test_hot_zone_top_k_and_fact(spark):
    t0 = dt.datetime(2024, 1, 1)
    trips = spark.range(N).select(
        F.lit(1).alias("VendorID"), F.lit(t0).cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.lit(t0).cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 50).cast("int")).alias("pulocationid"),
        F.lit(1).alias("dolocationid"), F.lit(1.0).alias("total_amount"))
    zones = spark.range(60).select(F.col("id").cast("int").alias("location_id"), F.lit("B").alias("borough"),
                                   F.concat(F.lit("Z"), F.col("id").cast("string")).alias("zone"),
                                   F.lit("s").alias("service_zone"))
    d = {"v": star.build_vendor_dim(seeds.seed(spark, "vendor")),
         "r": star.build_ratecode_dim(seeds.seed(spark, "rate_code")),
         "p": star.build_payment_dim(seeds.seed(spark, "payment_type")), "z": star.build_zone_dim(zones)}
    fact = star.build_fact(trips, d["v"], d["r"], d["p"], d["z"])
    top = analytics.q_top_zones(fact, d["z"], k=3).collect()
    hot = N // 3 + sum(1 for i in range(N) if i % 3 and i % 50 == 7)
    assert top[0].zone == "Z7" and top[0].trips == hot
    assert fact.count() == N
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan                      # the hot key is never shuffled for lookups


def test_hot_name_counts_pairs_without_enumerating(spark):
    # a third of all records share one name in one block: ~50M record pairs
    recs = spark.range(N).select(
        F.col("id").cast("int").alias("location_id"), F.lit("Hot Borough").alias("borough"),
        F.when(F.col("id") % 3 == 0, F.lit("Corona")).otherwise(
            F.concat(F.lit("Zone "), (F.col("id") % 200).cast("string"))).alias("zone"))
    m = matching.match_records(recs, "location_id", "zone", "borough", 100, 80, batch_id="b")
    hot = m.filter((F.col("name_1") == "CORONA") & (F.col("name_2") == "CORONA")).first()
    m_hot = N // 3
    assert hot.pair_count == m_hot * (m_hot - 1) // 2 and hot.action == "AUTO_MERGE"
    assert hot.recommended_golden_id == 0                   # longest raw name, then smallest id
    # pending ids come from STEWARD pairs between 'ZONE 1' and 'ZONE 10'.. — exact set, no pair expansion
    pend = matching.pending_ids(m, recs, "location_id", "zone", "borough")
    steward_names = {r.name for r in matching.pending_names(m).collect()}
    assert "CORONA" not in steward_names
    expect = recs.filter((F.col("id") % 3 != 0)).filter(
        F.upper(F.col("zone")).isin(list(steward_names))).count()
    assert pend.count() == expect


def test_hot_vendor_survivorship(spark):
    cand = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 97).cast("int")).alias("vendor_id"),
        F.concat(F.lit("raw "), F.col("id").cast("string")).alias("vendor_name"),
        F.lit(2).alias("source_rank"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.col("id").alias("record_id"))
    out = {r.vendor_id: r.vendor_name for r in survivorship.survivorship_vendor(cand).collect()}
    assert out[1] == f"raw {max(i for i in range(N) if i % 3 == 0 or i % 97 == 1)}"
    plan = survivorship.survivorship_vendor(cand)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan                            # collapsed map-side before the shuffle


def test_raw_trips_are_not_sorted_for_the_join(spark, tmp_path):
    """Beyond the broadcast bound the line items are hashed, not sorted; a hot, a repeated and a null key keep their rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 != 0, F.col("id") % 50).cast("bigint")
    spark.range(3000).select(
        key.alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice"), F.lit(0.5).alias("l_discount"), F.lit(0.1).alias("l_tax"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(42).select(
        F.when(F.col("id") < 41, F.col("id") % 40).alias("o_orderkey"),     # key 0 twice, one null key, none above 39
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    keys = [1 if i % 3 == 0 else i % 50 if i % 7 else None for i in range(3000)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = binding.raw_trips(spark, str(tmp_path))
        plan = trips._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan
        assert trips.count() == sum(2 if k == 0 else 1 for k in keys if k is not None and k < 40)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
