"""Warehouse data-quality metrics and assertions.

The reference scans the fact once per assertion; here one global aggregate
(partial per task, one tiny final merge) yields every metric, and the eleven
assertion rows are projected from that single row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegov.functions.expr import as_rate, fill_rate, flag_sum

RESULT_PREFIX = "final_fact.trip_fact."
VALUE_TYPE = "decimal(20,6)"


# D9 --------------------------------------------------------------------------
def dq_metrics(fact: DataFrame) -> DataFrame:
    """One row: total rows, completeness, validity and FK fill rates.
    Rates are NUMERIC(10,6); the two bad counts are SUM(flag), NULL on empty."""
    return fact.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        as_rate(fill_rate("pickup_datetime")).alias("pickup_ts_fill_rate"),
        as_rate(fill_rate("dropoff_datetime")).alias("dropoff_ts_fill_rate"),
        as_rate(fill_rate("total_amount")).alias("total_amount_fill_rate"),
        flag_sum(F.col("dropoff_datetime") < F.col("pickup_datetime")).cast("bigint").alias("bad_time_order_count"),
        flag_sum(F.col("trip_distance") < 0).cast("bigint").alias("negative_distance_count"),
        as_rate(fill_rate("vendor_sk")).alias("vendor_fk_fill_rate"),
        as_rate(fill_rate("ratecode_sk")).alias("ratecode_fk_fill_rate"),
        as_rate(fill_rate("payment_type_sk")).alias("payment_fk_fill_rate"),
        as_rate(fill_rate("pickup_zone_sk")).alias("pickup_zone_fk_fill_rate"),
        as_rate(fill_rate("dropoff_zone_sk")).alias("dropoff_zone_fk_fill_rate"),
        # the assertion counts use COUNT(*) WHERE ..., which is 0 on empty input
        F.count_if(F.col("dropoff_datetime") < F.col("pickup_datetime")).alias("_bad_time_cnt"),
        F.count_if(F.col("trip_distance") < 0).alias("_neg_dist_cnt"),
    )


# --- mergeable state: one stored row per run -----------------------------------
_FILLED = {"pickup_ts_fill_rate": "pickup_datetime", "dropoff_ts_fill_rate": "dropoff_datetime", "total_amount_fill_rate": "total_amount",
           "vendor_fk_fill_rate": "vendor_sk", "ratecode_fk_fill_rate": "ratecode_sk", "payment_fk_fill_rate": "payment_type_sk",
           "pickup_zone_fk_fill_rate": "pickup_zone_sk", "dropoff_zone_fk_fill_rate": "dropoff_zone_sk"}
_BAD = {"bad_time_order_count": "dropoff_datetime < pickup_datetime", "negative_distance_count": "trip_distance < 0"}


def run_state(fact: DataFrame, key: str = "run_id") -> DataFrame:
    """Per run what its metrics are made of: rows, filled cells, bad rows and how
    many rows could be judged. A run's row depends on its own fact rows alone, so
    it is stored with the run and never computed again."""
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *(F.count(c).alias(f"filled_{m}") for m, c in _FILLED.items()),
        *(F.count_if(F.expr(e)).alias(f"bad_{m}") for m, e in _BAD.items()),
        *(F.count(F.expr(e)).alias(f"judged_{m}") for m, e in _BAD.items()))


def store_state(fact_of_run: DataFrame, base: str, run_id: str) -> None:
    """Write (or replace) the state row of one run; other runs' rows stay as they are."""
    state = run_state(fact_of_run.withColumn("run_id", F.lit(run_id)))
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(base)


def merge_states(states: DataFrame) -> DataFrame:
    """``dq_metrics`` of all runs together from their stored states: sums of a row
    per run, equal to one scan of the whole fact."""
    s = states.agg(*(F.sum(c).alias(c) for c in states.columns if c.startswith(("filled_", "bad_", "judged_"))), F.sum("n").alias("n"))
    rate = lambda m: as_rate(F.col(f"filled_{m}") / F.nullif(F.col("n"), F.lit(0))).alias(m)
    bad = lambda m: F.when(F.col(f"judged_{m}") > 0, F.col(f"bad_{m}")).cast("bigint").alias(m)
    zero = lambda m, name: F.coalesce(F.col(f"bad_{m}"), F.lit(0)).cast("bigint").alias(name)
    return s.select(F.coalesce("n", F.lit(0)).cast("bigint").alias("total_rows"),
                    *(rate(m) for m in list(_FILLED)[:3]), *(bad(m) for m in _BAD), *(rate(m) for m in list(_FILLED)[3:]),
                    zero("bad_time_order_count", "_bad_time_cnt"), zero("negative_distance_count", "_neg_dist_cnt"))


def public_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.drop("_bad_time_cnt", "_neg_dist_cnt")


# J7 --------------------------------------------------------------------------
@dataclass(frozen=True)
class Assertion:
    name: str
    metric: str
    op: str  # one of '>', '=', '>='
    threshold: float
    details: str


# --- fixed values: the eleven fact assertions ------------------------------
FACT_ASSERTIONS = [
    Assertion("row_count_gt_0", "total_rows", ">", 0, "Row count should be greater than 0"),
    Assertion("negative_distance_count_eq_0", "_neg_dist_cnt", "=", 0, "Trip distance must not be negative"),
    Assertion("bad_time_order_count_eq_0", "_bad_time_cnt", "=", 0, "Dropoff must not be earlier than pickup"),
    Assertion("pickup_ts_fill_rate_ge_0_999", "pickup_ts_fill_rate", ">=", 0.999,
              "pickup_datetime fill rate should be at least 0.999"),
    Assertion("dropoff_ts_fill_rate_ge_0_999", "dropoff_ts_fill_rate", ">=", 0.999,
              "dropoff_datetime fill rate should be at least 0.999"),
    Assertion("total_amount_fill_rate_ge_0_999", "total_amount_fill_rate", ">=", 0.999,
              "total_amount fill rate should be at least 0.999"),
    Assertion("vendor_fk_fill_rate_ge_0_995", "vendor_fk_fill_rate", ">=", 0.995,
              "vendor_sk should be present for at least 99.5% of rows"),
    Assertion("ratecode_fk_fill_rate_ge_0_995", "ratecode_fk_fill_rate", ">=", 0.995,
              "ratecode_sk should be present for at least 99.5% of rows"),
    Assertion("payment_fk_fill_rate_ge_0_995", "payment_fk_fill_rate", ">=", 0.995,
              "payment_type_sk should be present for at least 99.5% of rows"),
    Assertion("pickup_zone_fk_fill_rate_ge_0_995", "pickup_zone_fk_fill_rate", ">=", 0.995,
              "pickup_zone_sk should be present for at least 99.5% of rows"),
    Assertion("dropoff_zone_fk_fill_rate_ge_0_995", "dropoff_zone_fk_fill_rate", ">=", 0.995,
              "dropoff_zone_sk should be present for at least 99.5% of rows"),
]
# the row-count assertion records threshold 1 (its "> 0" is checked against 0)
RECORDED_THRESHOLD = {"row_count_gt_0": 1}


def assert_rows(metrics: DataFrame, specs=FACT_ASSERTIONS, prefix: str = RESULT_PREFIX,
                created_by: str | None = None) -> DataFrame:
    """One PASS/FAIL row per assertion, projected from the metrics row.
    A NULL metric (empty fact) fails its assertion."""
    rows = []
    for a in specs:
        m = F.col(a.metric).cast(VALUE_TYPE)
        thr = F.lit(a.threshold).cast(VALUE_TYPE)
        cond = {">": m > thr, "=": m == thr, ">=": m >= thr}[a.op]
        rows.append(F.struct(
            F.lit(prefix + a.name).alias("test_name"),
            F.coalesce(cond, F.lit(False)).alias("passed"),
            m.alias("metric_value"),
            F.lit(RECORDED_THRESHOLD.get(a.name, a.threshold)).cast(VALUE_TYPE).alias("threshold"),
            F.lit(a.details).alias("details"),
        ))
    user = F.lit(created_by) if created_by else F.expr("current_user()")
    return (metrics.select(F.inline(F.array(*rows)))
            .withColumns({"test_run_id": F.expr("uuid()"), "created_at": F.current_timestamp(),
                          "created_by": user}))


# F2 --------------------------------------------------------------------------
def latest_results(results: DataFrame, n: int = 100) -> DataFrame:
    """Newest n results by created_at desc, then test_name (top-k, no full sort)."""
    return results.orderBy(F.desc("created_at"), F.asc("test_name")).limit(n)
