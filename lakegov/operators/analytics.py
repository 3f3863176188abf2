"""The standard revenue and volume queries over the star.

Plan shape for the dim-grouped queries: aggregate the fact by surrogate key
first (map-side partial aggregation, so the shuffle carries one row per key
per task), then inner-join the tiny result to the dimension and roll up by
the dimension's name. The big fact never crosses a join, and a hot key
(one zone holding a third of all trips) is collapsed before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.operators.enrich import maybe_broadcast

MONEY_DIGITS = 2
AVG_DIGITS = 4


def _money(c):
    return F.round(c, MONEY_DIGITS)


# D4 --------------------------------------------------------------------------
def q_daily(fact: DataFrame) -> DataFrame:
    """Daily trips and revenue by pickup date, ordered by date."""
    return (fact.groupBy(F.to_date("pickup_datetime").alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trips"), _money(F.sum("total_amount")).alias("total_revenue"))
            .orderBy("trip_date"))


def _by_key(fact: DataFrame, key: str, **aggs) -> DataFrame:
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[a.alias(n) for n, a in aggs.items()])


# F1 --------------------------------------------------------------------------
def q_top_zones(fact: DataFrame, zone_dim: DataFrame, k: int = 10) -> DataFrame:
    """Top-k pickup zones by trips (grouped by zone and borough names).
    Ties are broken by zone, then borough, so the answer is deterministic."""
    per_sk = _by_key(fact, "pickup_zone_sk", trips=F.count(F.lit(1)))
    z = maybe_broadcast(zone_dim).select(F.col("zone_sk").alias("pickup_zone_sk"), "zone", "borough")
    return (per_sk.join(z, "pickup_zone_sk", "inner")
            .groupBy("zone", "borough").agg(F.sum("trips").cast("bigint").alias("trips"))
            .orderBy(F.desc("trips"), F.asc_nulls_last("zone"), F.asc_nulls_last("borough"))
            .limit(k))


# D5 --------------------------------------------------------------------------
def q_vendor_revenue(fact: DataFrame, vendor_dim: DataFrame) -> DataFrame:
    per_sk = _by_key(fact, "vendor_sk", trips=F.count(F.lit(1)), revenue=F.sum("total_amount"))
    v = maybe_broadcast(vendor_dim).select("vendor_sk", "vendor_name")
    return (per_sk.join(v, "vendor_sk", "inner")
            .groupBy("vendor_name")
            .agg(F.sum("trips").cast("bigint").alias("trips"), _money(F.sum("revenue")).alias("revenue"))
            .orderBy(F.desc("revenue"), "vendor_name"))


# D6 --------------------------------------------------------------------------
def q_avg_by_rate(fact: DataFrame, ratecode_dim: DataFrame) -> DataFrame:
    """Average total by rate-code name (NULL totals ignored, as AVG does)."""
    per_sk = _by_key(fact, "ratecode_sk", s=F.sum("total_amount"), n=F.count("total_amount"))
    r = maybe_broadcast(ratecode_dim).select("ratecode_sk", "rate_code_name")
    return (per_sk.join(r, "ratecode_sk", "inner")
            .groupBy("rate_code_name")
            .agg(F.round(F.sum("s") / F.sum("n"), AVG_DIGITS).alias("avg_fare"))
            .orderBy(F.desc_nulls_last("avg_fare"), "rate_code_name"))


# D7 --------------------------------------------------------------------------
def q_payment_mix(fact: DataFrame, payment_dim: DataFrame) -> DataFrame:
    per_sk = _by_key(fact, "payment_type_sk", trips=F.count(F.lit(1)))
    p = maybe_broadcast(payment_dim).select("payment_type_sk", "payment_type_name")
    return (per_sk.join(p, "payment_type_sk", "inner")
            .groupBy("payment_type_name").agg(F.sum("trips").cast("bigint").alias("trips"))
            .orderBy(F.desc("trips"), "payment_type_name"))


# D8 --------------------------------------------------------------------------
def q_negative_duration(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if(F.col("dropoff_datetime") < F.col("pickup_datetime"))
                    .alias("negative_duration_trips"))
