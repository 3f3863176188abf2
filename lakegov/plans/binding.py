"""Binding of the supplied TPC-H-ish tables to the pipeline's shapes.

No trip, zone or master-record data ships with the test tables, so the
reference-shaped inputs are *derived* from them with deterministic formulas
that plain SQL can repeat (the SQL forms live next to the DataFrame forms so
oracles use the identical derivation). Every derived table grows with the
tables it reads.

* raw trips      <- lineitem JOIN orders  (grows with lineitem)
* zone master    <- nation JOIN region    (small, like the real zone file)
* master records <- part                  (grows with part; matching, SCD2)
* runs / audit   <- events                (grows with events)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegov.sources import lake


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# raw trips
# --------------------------------------------------------------------------
def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the date of their order. A task hashes its share of the
    orders (two narrow columns) and streams the line items past it, so the large
    side is never sorted and nothing spills when a partition outgrows a task."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey, "inner")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    zero = F.lit(0.0).cast("double")
    return j.select(
        (F.col("l_suppkey") % 8).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.when(k % 43 == 0, F.lit("bad")).otherwise(q.cast("bigint").cast("string")).alias("passenger_count"),
        F.when(k % 53 == 0, F.lit(None).cast("double"))
         .when((k % 11 == 0) & (ln == 2), -q).otherwise(q).alias("trip_distance"),
        F.when(k % 29 == 0, F.lit(None).cast("bigint")).otherwise(k % 8).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.when(k % 97 == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_partkey") % 27).alias("PULocationID"),
        F.when(k % 89 == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_suppkey") % 26).alias("DOLocationID"),
        F.when(k % 31 == 0, F.lit(None).cast("int")).otherwise(ln % 8).alias("payment_type"),
        (price * (1 - F.col("l_discount"))).alias("fare_amount"),
        zero.alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        (price * F.col("l_discount")).alias("tip_amount"),
        zero.alias("tolls_amount"),
        zero.alias("improvement_surcharge"),
        F.when(k % 61 == 0, F.lit(None).cast("double")).otherwise(price).alias("total_amount"),
        zero.alias("congestion_surcharge"),
        zero.alias("airport_fee"),
        zero.alias("cbd_congestion_fee"),
    )


RAW_TRIPS_SQL = """
SELECT
  l.l_suppkey % 8 AS VendorID,
  o.o_orderdate AS tpep_pickup_datetime,
  l.l_shipdate AS tpep_dropoff_datetime,
  CASE WHEN l.l_orderkey % 43 = 0 THEN 'bad' ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS passenger_count,
  CASE WHEN l.l_orderkey % 53 = 0 THEN NULL
       WHEN l.l_orderkey % 11 = 0 AND l.l_linenumber = 2 THEN -l.l_quantity
       ELSE l.l_quantity END AS trip_distance,
  CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE l.l_orderkey % 8 END AS RatecodeID,
  'N' AS store_and_fwd_flag,
  CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE l.l_partkey % 27 END AS PULocationID,
  CASE WHEN l.l_orderkey % 89 = 0 THEN NULL ELSE l.l_suppkey % 26 END AS DOLocationID,
  CASE WHEN l.l_orderkey % 31 = 0 THEN NULL ELSE l.l_linenumber % 8 END AS payment_type,
  l.l_extendedprice * (1 - l.l_discount) AS fare_amount,
  CAST(0 AS DOUBLE) AS extra,
  l.l_tax AS mta_tax,
  l.l_extendedprice * l.l_discount AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(0 AS DOUBLE) AS improvement_surcharge,
  CASE WHEN l.l_orderkey % 61 = 0 THEN NULL ELSE l.l_extendedprice END AS total_amount,
  CAST(0 AS DOUBLE) AS congestion_surcharge,
  CAST(0 AS DOUBLE) AS airport_fee,
  CAST(0 AS DOUBLE) AS cbd_congestion_fee
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

def write_mixed_months(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The raw trips as three deliveries whose column types differ, in one
    prefix: by pickup month mod 3, (0) ids bigint, counts text, times as they
    are, (1) ids double, counts bigint, times text of which some are no time and
    some are absent, (2) ids int, distances text. The trips are joined and stored
    once, next to (not under) the prefix; every delivery is a scan of them."""
    trips = raw_trips(spark, sf_dir)
    tmp = f"{base.rstrip('/')}__staging"
    trips.write.mode("overwrite").parquet(tmp)
    t = spark.read.schema(trips.schema).parquet(tmp)
    part = F.month("tpep_pickup_datetime") % 3
    cents = F.floor(F.col("total_amount") * 100)
    ids = ("VendorID", "RatecodeID", "PULocationID", "DOLocationID")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    t.filter(part == 0).write.mode("append").parquet(base)
    t.filter(part == 1).withColumns({
        **{c: F.col(c).cast("double") for c in ids}, "passenger_count": F.col("passenger_count").try_cast("bigint"),
        "tpep_pickup_datetime": F.when(cents % 71 == 0, F.lit("no time")).otherwise(stamp("tpep_pickup_datetime")),
        "tpep_dropoff_datetime": F.when(cents % 73 == 0, F.lit(None).cast("string")).otherwise(stamp("tpep_dropoff_datetime")),
    }).write.mode("append").parquet(base)
    t.filter(part == 2).withColumns({**{c: F.col(c).cast("int") for c in ids}, "trip_distance": F.col("trip_distance").cast("string")}
                                    ).write.mode("append").parquet(base)
    lake.remove(spark, tmp)


MIXED_TRIPS_SQL = """
SELECT * REPLACE (
  CASE WHEN month(tpep_pickup_datetime) % 3 = 1 AND CAST(floor(total_amount * 100) AS BIGINT) % 71 = 0 THEN NULL
       ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
  CASE WHEN month(tpep_pickup_datetime) % 3 = 1 AND CAST(floor(total_amount * 100) AS BIGINT) % 73 = 0 THEN NULL
       ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime)
FROM all_trips
"""

# typed + reasoned trips in SQL (the oracle form of B4/B5/B10)
REASONED_TRIPS_SQL = """
SELECT t.*,
  concat_ws('|',
    CASE WHEN PULocationID IS NULL THEN 'PULocationID_NULL' END,
    CASE WHEN DOLocationID IS NULL THEN 'DOLocationID_NULL' END,
    CASE WHEN tpep_pickup_datetime IS NULL THEN 'PICKUP_TS_NULL' END,
    CASE WHEN tpep_dropoff_datetime IS NULL THEN 'DROPOFF_TS_NULL' END,
    CASE WHEN trip_distance IS NULL THEN 'TRIP_DISTANCE_NULL' WHEN trip_distance < 0 THEN 'TRIP_DISTANCE_NEG' END,
    CASE WHEN total_amount IS NULL THEN 'TOTAL_AMOUNT_NULL' END,
    CASE WHEN tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
          AND tpep_dropoff_datetime < tpep_pickup_datetime THEN 'DROPOFF_BEFORE_PICKUP' END
  ) AS bad_reason
FROM (
  SELECT
    TRY_CAST(VendorID AS INTEGER) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
    TRY_CAST(passenger_count AS INTEGER) AS passenger_count, TRY_CAST(trip_distance AS DOUBLE) AS trip_distance,
    TRY_CAST(RatecodeID AS INTEGER) AS RatecodeID, store_and_fwd_flag,
    TRY_CAST(PULocationID AS INTEGER) AS PULocationID, TRY_CAST(DOLocationID AS INTEGER) AS DOLocationID,
    TRY_CAST(payment_type AS INTEGER) AS payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee
  FROM raw_trips
) t
"""


# --------------------------------------------------------------------------
# zone master (enrichment / dims)
# --------------------------------------------------------------------------
def zone_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("Boro Zone")).otherwise(F.lit("Yellow Zone")).alias("service_zone"),
    )


ZONE_MASTER_SQL = """
SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, r.r_name AS borough, n.n_name AS zone,
       CASE WHEN r.r_regionkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""


# --------------------------------------------------------------------------
# master records from part (matching, stewardship, SCD2)
# --------------------------------------------------------------------------
BATCH_1 = "batch_001"
BATCH_2 = "batch_002"
NEW_KEY_OFFSET = 1_000_000_000


def part_records(spark: SparkSession, sf_dir: str, batch: str = BATCH_1) -> DataFrame:
    """Record-table rows (key, block, name, attribute) for one batch.

    batch_001: every part as-is.
    batch_002: names of keys divisible by 5 change, attributes of keys
    divisible by 7 become NULL, and keys ending in 3 (mod 10) also arrive
    under a new id (key + 1e9)."""
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.col("p_partkey").cast("int").alias("location_id"),
        F.col("p_brand").alias("borough"),
        F.col("p_name").alias("zone"),
        F.col("p_type").alias("service_zone"),
    )
    if batch == BATCH_1:
        return base
    k = F.col("location_id")
    changed = base.select(
        k.alias("location_id"), "borough",
        F.when(k % 5 == 0, F.concat(F.col("zone"), F.lit(" II"))).otherwise(F.col("zone")).alias("zone"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("service_zone")).alias("service_zone"),
    )
    new = base.filter(k % 10 == 3).select(
        (k + F.lit(NEW_KEY_OFFSET)).alias("location_id"), "borough", "zone", "service_zone")
    return changed.unionByName(new)


PART_RECORDS_SQL = {
    BATCH_1: """
SELECT CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough, p_name AS zone, p_type AS service_zone
FROM part""",
    BATCH_2: """
SELECT CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough,
       CASE WHEN p_partkey % 5 = 0 THEN p_name || ' II' ELSE p_name END AS zone,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS service_zone
FROM part
UNION ALL
SELECT CAST(p_partkey AS INTEGER) + 1000000000, p_brand, p_name, p_type FROM part WHERE p_partkey % 10 = 3""",
}

# matching thresholds used with the bindings
PART_AUTO, PART_STEWARD = 100, 80
ZONE_AUTO, ZONE_STEWARD = 89, 80
