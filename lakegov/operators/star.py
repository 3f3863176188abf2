"""Dimensional build.

Dimensions are bounded by their business domain (zones, vendors, codes),
never by trips. Each dim is numbered densely in key order by one distributed
method at every size, which also measures its rows; the fact broadcasts the
dims whose measured size allows it, with no shuffle of trip rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegov.operators.enrich import mark_bounded, maybe_broadcast
from lakegov.session import checkpoint_root
from lakegov.sources.seeds import UNKNOWN_PAYMENT_TYPE, UNKNOWN_RATE_CODE


LITERAL_ROWS = 1_000


# B9 --------------------------------------------------------------------------
def surrogate_key(df: DataFrame, name: str, order_by: Sequence[str] | None = None, start: int = 1) -> DataFrame:
    """Unique surrogate key.

    * ``order_by`` given (dimensions): dense start..start+n-1 in business-key
      order (nulls last) at every size. Rows are range-partitioned and sorted,
      stored once by a reliable checkpoint (so that partitions stay as they
      are), numbered inside each partition, and shifted by the rows of the
      partitions before; only one count per partition reaches the driver.
      Up to ``LITERAL_ROWS`` rows that are known to be no more (seed rows) are numbered by a window.
    * otherwise (facts): ``monotonically_increasing_id`` offset by ``start`` —
      unique, no shuffle; the caller writes the result before reusing the keys.
    """
    if not order_by:
        return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_last() for c in order_by]
    known = getattr(df, "_lakegov_max_rows", None)
    if known is not None and known <= LITERAL_ROWS:      # seed rows: numbered where they stand, no job
        return mark_bounded(df.withColumn(name, F.row_number().over(Window.orderBy(*keys)).cast("long") + F.lit(start - 1)), known)
    checkpoint_root(spark)
    place = F.monotonically_increasing_id()  # partition number above bit 33, row number in it below
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    ranged = ranged.select("*", F.shiftright(place, 33).cast("int").alias("_part"),
                           place.bitwiseAND((1 << 33) - 1).alias("_row"))
    counts = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())
    offsets, total = [], start
    for part, n in counts:
        offsets.append((part, total))
        total += n
    before = spark.createDataFrame(offsets, "_part int, _before long")
    out = (ranged.join(F.broadcast(before), "_part")  # one row per partition
           .withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before"))
    return mark_bounded(out.select(*df.columns, name), total - start)


# J1–J4 -----------------------------------------------------------------------
def _carry(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Filters and projections never add rows: keep a proven bound."""
    known = getattr(src, "_lakegov_max_rows", None)
    return mark_bounded(dst, known) if known is not None else dst


def build_zone_dim(zone_master: DataFrame) -> DataFrame:
    """Current zone masters -> zone_dim (zone_sk, location_id, attributes,
    lineage)."""
    m = zone_master
    if "is_current" in m.columns:
        m = m.filter(F.col("is_current"))
    cols = [F.col("location_id").cast("int").alias("location_id"), "borough", "zone", "service_zone"]
    for c, alias in (("golden_sk", "mdm_golden_sk"), ("snapshot_id", "snapshot_id"), ("snapshot_ts", "snapshot_ts")):
        if c in m.columns:
            cols.append(F.col(c).alias(alias))
    return surrogate_key(_carry(zone_master, m.select(*cols)), "zone_sk", ["location_id"])


def build_vendor_dim(vendor_master: DataFrame) -> DataFrame:
    """Current vendor masters -> vendor_dim."""
    m = vendor_master.filter(F.col("is_current")) if "is_current" in vendor_master.columns else vendor_master
    m = m.select(F.col("vendor_id").cast("int").alias("vendor_id"), "vendor_name")
    return surrogate_key(_carry(vendor_master, m), "vendor_sk", ["vendor_id"])


def build_ratecode_dim(rate_master: DataFrame) -> DataFrame:
    """Current rate-code masters -> ratecode_dim."""
    m = rate_master.filter(F.col("is_current")) if "is_current" in rate_master.columns else rate_master
    m = m.select(F.col("rate_code_id").cast("int").alias("rate_code_id"), "rate_code_name")
    return surrogate_key(_carry(rate_master, m), "ratecode_sk", ["rate_code_id"])


def build_payment_dim(payment_seed: DataFrame) -> DataFrame:
    """Static payment types (full reload each build)."""
    m = (payment_seed.select("payment_type_id", "payment_type_name", "description")
         .withColumn("record_source", F.lit("TLC data dictionary")))
    return surrogate_key(_carry(payment_seed, m), "payment_type_sk", ["payment_type_id"])


# C10 / J5 --------------------------------------------------------------------
FACT_MEASURES = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
                 "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
                 "airport_fee", "cbd_congestion_fee"]


def build_fact(trips: DataFrame, vendor_dim: DataFrame, ratecode_dim: DataFrame, payment_dim: DataFrame,
               zone_dim: DataFrame, keep_business_keys: bool = False, with_fact_sk: bool = True) -> DataFrame:
    """Five LEFT joins (zone dim twice). A NULL rate code looks up 99 and
    a NULL payment type looks up 5; any other code without a dim row gets a
    NULL key. Dims are broadcast behind a size check, so the fact side is
    never shuffled; every trip yields exactly one fact row.

    ``keep_business_keys`` also returns the matched dim business keys (for
    checks that must not depend on surrogate numbering)."""
    cols = {c.lower(): c for c in trips.columns}

    def t(name):
        return F.col(f"t.`{cols[name.lower()]}`") if name.lower() in cols else F.lit(None)

    v = maybe_broadcast(vendor_dim).alias("v")
    r = maybe_broadcast(ratecode_dim).alias("r")
    p = maybe_broadcast(payment_dim).alias("p")
    zd = maybe_broadcast(zone_dim)
    zpu, zdo = zd.alias("zpu"), zd.alias("zdo")
    j = (trips.alias("t")
         .join(v, F.col("v.vendor_id") == t("vendorid"), "left")
         .join(r, F.col("r.rate_code_id") == F.coalesce(t("ratecodeid"), F.lit(UNKNOWN_RATE_CODE)), "left")
         .join(p, F.col("p.payment_type_id") == F.coalesce(t("payment_type"), F.lit(UNKNOWN_PAYMENT_TYPE)), "left")
         .join(zpu, F.col("zpu.location_id") == t("pulocationid"), "left")
         .join(zdo, F.col("zdo.location_id") == t("dolocationid"), "left"))
    out = [
        F.col("v.vendor_sk").alias("vendor_sk"),
        F.col("r.ratecode_sk").alias("ratecode_sk"),
        F.col("p.payment_type_sk").alias("payment_type_sk"),
        F.col("zpu.zone_sk").alias("pickup_zone_sk"),
        F.col("zdo.zone_sk").alias("dropoff_zone_sk"),
        t("tpep_pickup_datetime").alias("pickup_datetime"),
        t("tpep_dropoff_datetime").alias("dropoff_datetime"),
        t("passenger_count").cast("int").alias("passenger_count"),
        *[t(m).cast("double").alias(m) for m in FACT_MEASURES[1:]],
        t("run_id").cast("string").alias("run_id"),
        t("ingested_at_utc").cast("string").alias("ingested_at_utc"),
    ]
    if keep_business_keys:
        out += [F.col("v.vendor_id").alias("vendor_id"), F.col("r.rate_code_id").alias("rate_code_id"),
                F.col("p.payment_type_id").alias("payment_type_id"),
                F.col("zpu.location_id").alias("pickup_location_id"),
                F.col("zdo.location_id").alias("dropoff_location_id")]
    fact = j.select(*out)
    return surrogate_key(fact, "trip_fact_sk") if with_fact_sk else fact
