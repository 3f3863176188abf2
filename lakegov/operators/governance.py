"""Governance operators re-aimed from functions / state machine to tables
(K1–K5). Each is a small aggregate or semi-join over run, decision, audit
and file-metadata tables, so they scale with the number of runs and files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_AGE_HOURS = 24.0
DEFAULT_QUALITY_THRESHOLD = 0.98

# --- fixed values: audit vocabulary ----------------------------------------
EV_START, EV_END = "START", "END"
ST_STARTED, ST_SUCCESS, ST_FAILED = "STARTED", "SUCCESS", "FAILED"
REASON_APPROVAL_REJECTED = "APPROVAL_REJECTED"
REASON_JOB_FAILED = "GLUE_JOB_FAILED"
REASON_QUALITY_CHECK_FAILED = "QUALITY_CHECK_FAILED"
DECISION_APPROVED, DECISION_REJECTED = "approved", "rejected"


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v).cast("timestamp_ntz") if v.tzinfo is None else F.lit(v)
    return F.lit(v).cast("timestamp_ntz")


# K1 --------------------------------------------------------------------------
def freshness(files: DataFrame, as_of, max_age_hours: float = DEFAULT_MAX_AGE_HOURS,
              prefix_col: str | None = None, time_col: str = "modificationTime") -> DataFrame:
    """Per prefix (or overall): newest modification time, age in hours at
    ``as_of`` and ok = age <= max. Age is rounded to 2 places for output only.
    An empty listing yields a not-ok row with a reason (overall mode)."""
    age = (F.unix_micros(F.to_timestamp(_ts(as_of))) - F.unix_micros(F.to_timestamp(F.col("last_modified")))) / 3.6e9
    keys = [prefix_col] if prefix_col else []
    # without a prefix this is a global aggregate: one row even on empty input
    agg = files.groupBy(*keys).agg(F.max(time_col).alias("last_modified"))
    return agg.select(
        *keys,
        F.coalesce(age <= F.lit(max_age_hours), F.lit(False)).alias("freshness_ok"),
        "last_modified",
        F.round(age, 2).alias("age_hours"),
        F.lit(float(max_age_hours)).alias("max_age_hours"),
        F.when(F.col("last_modified").isNull(), F.lit("No objects found under snapshot_prefix"))
         .alias("reason"),
    )


# K2 --------------------------------------------------------------------------
def quality_gate(metrics: DataFrame, threshold: float = DEFAULT_QUALITY_THRESHOLD) -> DataFrame:
    """Passed iff total_rows > 0 and both zone rates >= threshold. Missing
    metrics count as 0; a metrics read error fails the gate."""
    cols = set(metrics.columns)
    tot = F.coalesce(F.col("total_rows"), F.lit(0)) if "total_rows" in cols else F.lit(0)
    pu = F.coalesce(F.col("pu_zone_nonnull_rate"), F.lit(0.0)) if "pu_zone_nonnull_rate" in cols else F.lit(0.0)
    do = F.coalesce(F.col("do_zone_nonnull_rate"), F.lit(0.0)) if "do_zone_nonnull_rate" in cols else F.lit(0.0)
    err = F.col("read_error") if "read_error" in cols else F.lit(None).cast("string")
    passed = err.isNull() & (tot > 0) & (pu >= F.lit(threshold)) & (do >= F.lit(threshold))
    return metrics.select(
        passed.alias("quality_passed"),
        tot.cast("bigint").alias("total_rows"),
        pu.alias("pu_zone_nonnull_rate"),
        do.alias("do_zone_nonnull_rate"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(err.isNotNull(), err).when(~passed, F.lit(REASON_QUALITY_CHECK_FAILED)).alias("reason"),
    )


# K3 --------------------------------------------------------------------------
def approved_runs(runs: DataFrame, decisions: DataFrame, key: str = "run_id") -> DataFrame:
    """Runs released for processing: only those whose latest decision is
    'approved'. Rejected or undecided runs are held. (Approval is required
    whether or not the master snapshot is fresh.)"""
    latest = audit_latest(decisions.withColumn("event_type", F.lit("DECISION")), key=key,
                          time_col="decided_at", value_cols=["decision"])
    ok = latest.filter(F.col("decision") == DECISION_APPROVED).select(key)
    return runs.join(ok, key, "left_semi")


# K4 --------------------------------------------------------------------------
def audit_event(run_id, event_type: str, status: str, at, reason=None, details=None) -> dict:
    """One audit item as a plain row dict (for createDataFrame / append)."""
    return {"run_id": run_id, "event_type": event_type, "status": status, "put_at": at,
            "reason": reason, "details": details}


def audit_latest(audit: DataFrame, key: str = "run_id", time_col: str = "put_at",
                 value_cols=("status", "reason"), tie_col: str | None = None) -> DataFrame:
    """Key-value semantics of the audit table: a put on (run_id, event_type)
    overwrites, so the latest write per key wins. Implemented as max over a
    (time, tie, values) struct — a partial aggregate, so a run with millions
    of puts is collapsed map-side before the shuffle."""
    order = [F.col(time_col).alias("_t")]
    if tie_col:
        order.append(F.col(tie_col).alias("_k"))
    payload = F.struct(*order, *[F.col(c).alias(c) for c in value_cols])
    return (audit.groupBy(key, "event_type").agg(F.max(payload).alias("_m"))
            .select(key, "event_type", F.col("_m._t").alias(time_col),
                    *[F.col(f"_m.{c}").alias(c) for c in value_cols]))


# K5 --------------------------------------------------------------------------
def governance_kpis(audit_now: DataFrame, decisions_now: DataFrame) -> DataFrame:
    """One row of governance KPIs from the latest audit and decision states:
    approved / rejected decisions, successful / failed runs, failures by reason
    and the run success rate."""
    # one pass over the union of both inputs: no join between the aggregates
    ends = audit_now.filter(F.col("event_type") == EV_END).select(
        "status", "reason", F.lit(None).cast("string").alias("decision"))
    dec = decisions_now.select(F.lit(None).cast("string").alias("status"),
                               F.lit(None).cast("string").alias("reason"), "decision")
    out = ends.unionByName(dec).agg(
        F.count_if(F.col("status") == ST_SUCCESS).alias("runs_succeeded"),
        F.count_if(F.col("status") == ST_FAILED).alias("runs_failed"),
        F.count_if(F.col("reason") == REASON_APPROVAL_REJECTED).alias("failed_approval"),
        F.count_if(F.col("reason") == REASON_QUALITY_CHECK_FAILED).alias("failed_quality"),
        F.count_if(F.col("reason") == REASON_JOB_FAILED).alias("failed_job"),
        F.count_if(F.col("decision") == DECISION_APPROVED).alias("runs_approved"),
        F.count_if(F.col("decision") == DECISION_REJECTED).alias("runs_rejected"),
    )
    return out.withColumn(
        "success_rate",
        F.round(F.col("runs_succeeded") / F.nullif(F.col("runs_succeeded") + F.col("runs_failed"), F.lit(0)), 4))


def platform_kpis(run_coverage: DataFrame, decisions_now: DataFrame, snapshots: DataFrame, as_of, max_age_hours: float = 24.0) -> DataFrame:
    """(name, value, target, ok) of the platform's KPIs: rows processed, pickup and
    dropoff zone completeness over all runs, approved and rejected runs, age of the newest snapshot.

    ``run_coverage`` holds one stored row per run (total_rows, pu_nonnull,
    do_nonnull), so no trip is read again; ``snapshots`` one row per snapshot
    (committed_at). Rates of nothing are null and not ok."""
    cov = run_coverage.agg(F.sum("total_rows").alias("rows"), F.sum("pu_nonnull").alias("pu"), F.sum("do_nonnull").alias("do"))
    dec = decisions_now.agg(F.count_if(F.col("decision") == DECISION_APPROVED).alias("approved"),
                            F.count_if(F.col("decision") == DECISION_REJECTED).alias("rejected"))
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    age = snapshots.agg(F.max(F.col("committed_at").cast("timestamp_ntz")).alias("newest")).select(
        F.round(F.timestamp_diff("SECOND", F.col("newest"), at) / 3600, 4).alias("age"))
    # three one-row aggregates laid over each other: no join
    one = (cov.unionByName(dec, allowMissingColumns=True).unionByName(age, allowMissingColumns=True)
           .agg(*(F.max(c).alias(c) for c in ("rows", "pu", "do", "approved", "rejected", "age"))))
    rate = lambda c: F.round(F.col(c) / F.nullif(F.col("rows"), F.lit(0)), 4)
    kpi = lambda name, value, target, ok: F.struct(
        F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(target).cast("double").alias("target"),
        F.coalesce(ok, F.lit(False)).alias("ok"))
    return one.select(F.inline(F.array(
        kpi("total_rows_processed", F.coalesce("rows", F.lit(0)), 1, F.col("rows") > 0),
        kpi("pickup_zone_completeness", rate("pu"), 0.98, rate("pu") >= 0.98),
        kpi("dropoff_zone_completeness", rate("do"), 0.98, rate("do") >= 0.98),
        kpi("approved_runs", F.col("approved"), None, F.lit(True)),
        kpi("rejected_runs", F.col("rejected"), None, F.lit(True)),
        kpi("snapshot_age_hours", F.col("age"), max_age_hours, F.col("age") <= max_age_hours))))
