"""Registered governance, lake I/O and streaming queries (K1, K3–K5, F2,
A4, A6–A8, A15, L1). Runs, decisions and audit puts are derived from the
``events`` table; lake I/O queries stage their tables under the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegov.operators import dq, enrich, governance, matching
from lakegov.plans import binding as B
from lakegov.plans import catalog, catalog_mdm
from lakegov.plans.catalog import register, with_ctes
from lakegov.session import work_dir
from lakegov.sources import lake
from lakegov.streaming.ingest import ingest_stream, run_to_completion

AS_OF = "2024-01-31 00:00:00"


# ==========================================================================
# bindings over events
# ==========================================================================
def runs(spark, sf) -> DataFrame:
    return B.table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"))


def decisions(spark, sf) -> DataFrame:
    """One decision per non-signup event; every 10th run is decided again an
    hour later with the opposite answer (the later one must win)."""
    e = B.table(spark, sf, "events").filter(F.col("event_type") != "signup")
    first = e.select(F.col("event_id").alias("run_id"),
                     F.when(F.col("value") >= 5, F.lit("approved")).otherwise(F.lit("rejected")).alias("decision"),
                     F.col("ts").alias("decided_at"))
    again = e.filter(F.col("event_id") % 10 == 0).select(
        F.col("event_id").alias("run_id"),
        F.when(F.col("value") >= 5, F.lit("rejected")).otherwise(F.lit("approved")).alias("decision"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("decided_at"))
    return first.unionByName(again)


DECISIONS_SQL = """
SELECT event_id AS run_id, CASE WHEN value >= 5 THEN 'approved' ELSE 'rejected' END AS decision, ts AS decided_at
FROM events WHERE event_type <> 'signup'
UNION ALL
SELECT event_id, CASE WHEN value >= 5 THEN 'rejected' ELSE 'approved' END, ts + INTERVAL 1 HOUR
FROM events WHERE event_type <> 'signup' AND event_id % 10 = 0"""

LATEST_DECISION_SQL = """
SELECT run_id, decision FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY decided_at DESC, decision DESC) AS rn FROM dec)
WHERE rn = 1"""


def audit_puts(spark, sf) -> DataFrame:
    e = B.table(spark, sf, "events")
    et, v = F.col("event_type"), F.col("value")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(et == "signup", F.lit(governance.EV_START)).otherwise(F.lit(governance.EV_END)).alias("event_type"),
        F.when(et == "signup", F.lit(governance.ST_STARTED)).when(et == "error", F.lit(governance.ST_FAILED))
         .otherwise(F.lit(governance.ST_SUCCESS)).alias("status"),
        F.when(et == "error", F.when(v < 10, F.lit(governance.REASON_QUALITY_CHECK_FAILED))
               .when(v < 20, F.lit(governance.REASON_JOB_FAILED))
               .otherwise(F.lit(governance.REASON_APPROVAL_REJECTED))).alias("reason"),
        F.col("ts").alias("put_at"), F.col("event_id"))


AUDIT_PUTS_SQL = """
SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id,
  CASE WHEN event_type = 'signup' THEN 'START' ELSE 'END' END AS event_type,
  CASE WHEN event_type = 'signup' THEN 'STARTED' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN event_type = 'error' THEN CASE WHEN value < 10 THEN 'QUALITY_CHECK_FAILED'
       WHEN value < 20 THEN 'GLUE_JOB_FAILED' ELSE 'APPROVAL_REJECTED' END END AS reason,
  ts AS put_at, event_id
FROM events"""

AUDIT_LATEST_SQL = """
SELECT run_id, event_type, put_at, status, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, event_type ORDER BY put_at DESC, event_id DESC) AS rn FROM puts)
WHERE rn = 1"""


def audit_now(spark, sf) -> DataFrame:
    return governance.audit_latest(audit_puts(spark, sf), tie_col="event_id")


def decisions_now(spark, sf) -> DataFrame:
    d = decisions(spark, sf).withColumn("event_type", F.lit("DECISION"))
    return governance.audit_latest(d, time_col="decided_at", value_cols=["decision"]).drop("event_type")


# ==========================================================================
# K1 freshness, K3 approval, K4 audit, K5 KPIs
# ==========================================================================
@register("freshness", f"""
SELECT event_type, COALESCE((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 3.6e9 <= 24.0, FALSE) AS freshness_ok,
  max(ts) AS last_modified, ROUND((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 3.6e9, 2) AS age_hours,
  CAST(24.0 AS DOUBLE) AS max_age_hours, CAST(NULL AS VARCHAR) AS reason
FROM events GROUP BY event_type""")
def q_freshness(spark, sf):
    """K1 per prefix: newest object time (event time per event type here),
    age in hours at a fixed as-of and the 24 h verdict."""
    files = B.table(spark, sf, "events").select("event_type", F.col("ts").alias("modificationTime"))
    return governance.freshness(files, AS_OF, 24.0, prefix_col="event_type")


@register("approved_runs", with_ctes([("dec", DECISIONS_SQL), ("ld", LATEST_DECISION_SQL)], """
SELECT event_id AS run_id, ts AS started_at FROM events
WHERE event_id IN (SELECT run_id FROM ld WHERE decision = 'approved')"""))
def q_approved_runs(spark, sf):
    """K3: only runs whose latest decision is 'approved' are released."""
    return governance.approved_runs(runs(spark, sf), decisions(spark, sf))


@register("audit_latest", with_ctes([("puts", AUDIT_PUTS_SQL)], AUDIT_LATEST_SQL))
def q_audit_latest(spark, sf):
    """K4: last put wins per (run_id, event_type)."""
    return audit_now(spark, sf)


@register("governance_kpis", with_ctes(
    [("puts", AUDIT_PUTS_SQL), ("al", AUDIT_LATEST_SQL), ("dec", DECISIONS_SQL), ("ld", LATEST_DECISION_SQL)], """
SELECT e.*, d.*, ROUND(e.runs_succeeded / NULLIF(e.runs_succeeded + e.runs_failed, 0), 4) AS success_rate
FROM (SELECT COUNT(*) FILTER (WHERE status = 'SUCCESS') AS runs_succeeded,
             COUNT(*) FILTER (WHERE status = 'FAILED') AS runs_failed,
             COUNT(*) FILTER (WHERE reason = 'APPROVAL_REJECTED') AS failed_approval,
             COUNT(*) FILTER (WHERE reason = 'QUALITY_CHECK_FAILED') AS failed_quality,
             COUNT(*) FILTER (WHERE reason = 'GLUE_JOB_FAILED') AS failed_job
      FROM al WHERE event_type = 'END') e,
     (SELECT COUNT(*) FILTER (WHERE decision = 'approved') AS runs_approved,
             COUNT(*) FILTER (WHERE decision = 'rejected') AS runs_rejected FROM ld) d"""))
def q_governance_kpis(spark, sf):
    """K5: approved vs rejected runs, run outcomes by reason, success rate."""
    return governance.governance_kpis(audit_now(spark, sf), decisions_now(spark, sf))


COVERAGE_RUNS_SQL = """
SELECT quarter(tpep_pickup_datetime) AS run, COUNT(*) AS total_rows, COUNT(pu_zone) AS pu_nonnull, COUNT(do_zone) AS do_nonnull
FROM curated GROUP BY 1"""


@register("platform_kpis", with_ctes(
    catalog.TRIP_CTES + [("dec", DECISIONS_SQL), ("ld", LATEST_DECISION_SQL), ("cov", COVERAGE_RUNS_SQL), ("one", f"""
SELECT CAST(SUM(total_rows) AS DOUBLE) AS n, SUM(pu_nonnull) AS pu, SUM(do_nonnull) AS do_,
  (SELECT COUNT(*) FILTER (WHERE decision = 'approved') FROM ld) AS approved,
  (SELECT COUNT(*) FILTER (WHERE decision = 'rejected') FROM ld) AS rejected,
  (SELECT ROUND(date_diff('second', date_trunc('second', MAX(ts)), TIMESTAMP '{AS_OF}') / 3600.0, 4) FROM events WHERE event_type = 'signup') AS age
FROM cov""")], """
SELECT 'total_rows_processed' AS name, CAST(n AS DOUBLE) AS value, CAST(1 AS DOUBLE) AS target, n > 0 AS ok FROM one
UNION ALL SELECT 'pickup_zone_completeness', ROUND(pu / n, 4), 0.98, ROUND(pu / n, 4) >= 0.98 FROM one
UNION ALL SELECT 'dropoff_zone_completeness', ROUND(do_ / n, 4), 0.98, ROUND(do_ / n, 4) >= 0.98 FROM one
UNION ALL SELECT 'approved_runs', CAST(approved AS DOUBLE), NULL, TRUE FROM one
UNION ALL SELECT 'rejected_runs', CAST(rejected AS DOUBLE), NULL, TRUE FROM one
UNION ALL SELECT 'snapshot_age_hours', CAST(age AS DOUBLE), 24, age <= 24 FROM one"""))
def q_platform_kpis(spark, sf):
    """K5: rows, completeness, decisions and snapshot age, from one coverage row per run."""
    cur = catalog.curated_trips(spark, sf)
    cov = cur.groupBy(F.quarter("tpep_pickup_datetime").alias("run")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count("pu_zone").alias("pu_nonnull"), F.count("do_zone").alias("do_nonnull"))
    snaps = B.table(spark, sf, "events").filter(F.col("event_type") == "signup").select(
        F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("committed_at"))
    return governance.platform_kpis(cov, decisions_now(spark, sf), snaps, AS_OF)


# ==========================================================================
# latest DQ results
# ==========================================================================
RESULTS_SQL = """
SELECT 'final_fact.trip_fact.' || event_type || '_value_ge_10' AS test_name, value >= 10 AS passed,
  CAST(value AS DECIMAL(20,6)) AS metric_value, CAST(10 AS DECIMAL(20,6)) AS threshold,
  'event value check' AS details, ts AS created_at
FROM events"""


@register("latest_results", with_ctes([("r", RESULTS_SQL)],
                                      "SELECT * FROM r ORDER BY created_at DESC, test_name LIMIT 100"))
def q_latest_results(spark, sf):
    """the newest 100 results of an append-only results table."""
    e = B.table(spark, sf, "events")
    res = e.select(F.concat(F.lit(dq.RESULT_PREFIX), F.col("event_type"), F.lit("_value_ge_10")).alias("test_name"),
                   (F.col("value") >= 10).alias("passed"),
                   F.col("value").cast(dq.VALUE_TYPE).alias("metric_value"),
                   F.lit(10).cast(dq.VALUE_TYPE).alias("threshold"),
                   F.lit("event value check").alias("details"), F.col("ts").alias("created_at"))
    return dq.latest_results(res, 100)


# ==========================================================================
# A7 + A8 + K2: metrics document round trip; A6: batch replace; A4: latest
# ==========================================================================
@register("metrics_roundtrip", with_ctes(catalog.TRIP_CTES + [("cov", catalog.COVERAGE_SQL)], """
SELECT (total_rows > 0 AND pu_zone_nonnull_rate >= 0.98 AND do_zone_nonnull_rate >= 0.98) AS quality_passed,
  CAST(total_rows AS BIGINT) AS total_rows, pu_zone_nonnull_rate, do_zone_nonnull_rate,
  CAST(0.98 AS DOUBLE) AS threshold,
  CASE WHEN NOT (total_rows > 0 AND pu_zone_nonnull_rate >= 0.98 AND do_zone_nonnull_rate >= 0.98)
       THEN 'QUALITY_CHECK_FAILED' END AS reason
FROM cov
UNION ALL
SELECT FALSE, 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0.98 AS DOUBLE), 'METRICS_READ_ERROR'"""))
def q_metrics_roundtrip(spark, sf):
    """A7 writes the metrics JSON, A8 reads it back and K2 gates it; a
    missing document yields a failed gate with METRICS_READ_ERROR."""
    base = work_dir(spark, "metrics")
    cov = enrich.coverage_metrics(catalog.curated_trips(spark, sf))
    lake.write_metrics(cov, f"{base}/_METRICS.json", run_id=catalog.RUN_ID)
    ok = governance.quality_gate(lake.read_metrics(spark, f"{base}/_METRICS.json"), 0.98)
    missing = governance.quality_gate(lake.read_metrics(spark, f"{base}/absent/_METRICS.json"), 0.98)
    return ok.unionByName(missing)


@register("replace_batch", with_ctes(
    [("b1", catalog_mdm.B.PART_RECORDS_SQL[B.BATCH_1]), ("b2", catalog_mdm.B.PART_RECORDS_SQL[B.BATCH_2])], f"""
SELECT location_id, borough, upper(zone) AS zone, service_zone, '{B.BATCH_1}' AS batch_id FROM b1
WHERE location_id % 2 = 0
UNION ALL SELECT location_id, borough, zone, service_zone, '{B.BATCH_2}' FROM b2"""))
def q_replace_batch(spark, sf):
    """Write two batches, re-run batch 1 with new content; only batch 1's
    partition is replaced (delete-then-append per batch)."""
    target = work_dir(spark, "records")
    r1 = catalog_mdm.records(spark, sf, B.BATCH_1).withColumn("batch_id", F.lit(B.BATCH_1))
    r2 = catalog_mdm.records(spark, sf, B.BATCH_2).withColumn("batch_id", F.lit(B.BATCH_2))
    lake.replace_batch(r1.unionByName(r2), target)
    rerun = r1.filter(F.col("location_id") % 2 == 0).withColumn("zone", F.upper("zone"))
    lake.replace_batch(rerun, target)
    return lake.read_batches(spark, target, r1.schema).select("location_id", "borough", "zone", "service_zone", "batch_id")


@register("latest_version", """
SELECT p_partkey, p_name, p_retailprice, 'v3' AS written_as FROM part WHERE p_partkey % 3 <> 0""")
def q_latest_version(spark, sf):
    """A4 + A5: of three written versions and a newer one that was cut short,
    the rows of the newest complete one."""
    base = f"{work_dir(spark, 'versions')}/parts"
    part = B.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    for i, version in enumerate(("v2", "v1", "v3")):
        rows = part.filter((F.col("p_partkey") % 3 != 0) if version == "v3" else (F.col("p_partkey") % 3 == i))
        lake.write_version(rows.withColumn("written_as", F.lit(version)), base, version)
    lake.write_run(part.withColumn("written_as", F.lit("v9")), base, "v9", "version")     # no marker
    return lake.read_latest(spark, base)


@register("file_freshness")
def q_file_freshness(spark, sf):
    """K1 on real file metadata: newest table file vs now (rows-only)."""
    files = lake.list_files(spark, sf)
    return governance.freshness(files, F.current_timestamp().cast("timestamp_ntz"), 24.0)


# ==========================================================================
# L1: streaming ingest of master uploads
# ==========================================================================
@register("ingest_stream", with_ctes(catalog_mdm.M1, "SELECT *, CAST(0 AS BIGINT) AS micro_batch_id FROM b1_m"))
def q_ingest_stream(spark, sf):
    """L1: the upload folder is a file stream; each micro-batch of new files
    runs matching and lands in the match sink (availableNow, checkpointed)."""
    base = work_dir(spark, "ingest")
    schema = B.table(spark, sf, "part").schema

    def transform(batch_df, batch_id):
        recs = batch_df.select(F.col("p_partkey").cast("int").alias("location_id"),
                               F.col("p_brand").alias("borough"), F.col("p_name").alias("zone"),
                               F.col("p_type").alias("service_zone"))
        return matching.match_records(recs, "location_id", "zone", "borough", B.PART_AUTO, B.PART_STEWARD,
                                      batch_id=B.BATCH_1)

    # the table is one file or a folder of part files
    folder = lake.is_folder(spark, f"{sf}/part.parquet")
    source, glob = (f"{sf}/part.parquet", None) if folder else (sf, "part.parquet")
    q = ingest_stream(spark, source, schema, f"{base}/sink", f"{base}/_checkpoint", transform, glob=glob)
    run_to_completion(q)
    return spark.read.parquet(f"{base}/sink")


# ==========================================================================
# J2 over survivorship; A9 external view; A10 staging load; A11 run slice
# ==========================================================================
SNAP_UPSERT_SQL = catalog.ORACLES["snapshot_upsert"]


@register("zone_dim", with_ctes([("zm", SNAP_UPSERT_SQL)], """
SELECT CAST(location_id AS INTEGER) AS location_id, borough, zone, service_zone, golden_sk AS mdm_golden_sk,
  snapshot_id, snapshot_ts, row_number() OVER (ORDER BY location_id) AS zone_sk
FROM zm WHERE is_current"""))
def q_zone_dim(spark, sf):
    """The zone dim rebuilt from the zone master after a golden snapshot
    was upserted into it (C7/C8 output), current rows only."""
    from lakegov.operators import star
    return star.build_zone_dim(catalog_mdm.q_snapshot_upsert(spark, sf))


@register("vendor_dim", with_ctes(
    [("cand", f"""
SELECT CAST(s_suppkey % 8 AS INTEGER) AS vendor_id, s_name AS vendor_name, 2 AS source_rank,
  CAST(NULL AS TIMESTAMP) AS updated_at, s_suppkey AS record_id FROM supplier
UNION ALL SELECT vendor_id, vendor_name, 1, TIMESTAMP '{catalog_mdm.T1}', 0
FROM ({catalog_mdm.seeds.seed_sql('vendor')})"""),
     ("master", """
SELECT vendor_id, vendor_name FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY source_rank,
    COALESCE(updated_at, TIMESTAMP '0001-01-01') DESC, record_id DESC) AS rn FROM cand)
WHERE rn = 1""")],
    "SELECT vendor_id, vendor_name, row_number() OVER (ORDER BY vendor_id) AS vendor_sk FROM master"))
def q_vendor_dim(spark, sf):
    """Vendor dim rebuilt from the surviving vendor masters (E2 output)."""
    from lakegov.operators import star
    return star.build_vendor_dim(catalog_mdm.q_survivorship_vendor(spark, sf))


@register("external_view", """
SELECT p_brand, COUNT(*) AS parts, ROUND(SUM(p_retailprice), 2) AS retail FROM part GROUP BY p_brand""")
def q_external_view(spark, sf):
    """A catalog view over lake files, queried with Spark SQL."""
    lake.register_external(spark, "lakegov_part_ext", f"{sf.rstrip('/')}/part.parquet")
    return spark.sql("SELECT p_brand, COUNT(*) AS parts, ROUND(SUM(p_retailprice), 2) AS retail "
                     "FROM lakegov_part_ext GROUP BY p_brand")


STAGING_SCHEMA = ("golden_sk bigint, location_id int, borough string, zone string, service_zone string, "
                  "effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, "
                  "source_batch_id string, created_at timestamp_ntz, snapshot_id string, snapshot_ts timestamp_ntz")


@register("load_staging", with_ctes([("stg", catalog_mdm.SNAP_STAGING_SQL)], """
SELECT golden_sk, location_id, borough, zone, service_zone, effective_from, effective_to, is_current,
  source_batch_id, created_at, snapshot_id, snapshot_ts FROM stg"""))
def q_load_staging(spark, sf):
    """A10: truncate + bulk load a snapshot into the staging table by column
    name (its extra record_hash column is ignored, types are the table's)."""
    base = work_dir(spark, "staging")
    _, staging = catalog_mdm._snap_frames(spark, sf)
    staging.write.mode("overwrite").parquet(f"{base}/snapshot")
    lake.load_staging(spark, f"{base}/snapshot", STAGING_SCHEMA, f"{base}/zone_master_snapshot_raw")
    # a second load replaces (truncate semantics), it does not append
    return lake.load_staging(spark, f"{base}/snapshot", STAGING_SCHEMA, f"{base}/zone_master_snapshot_raw")


@register("stage_curated", with_ctes(catalog.TRIP_CTES, """
SELECT COUNT(*) AS rows_in_slice, COUNT(DISTINCT VendorID) AS vendors FROM curated"""))
def q_stage_curated(spark, sf):
    """Curated runs written per run_id, then one run's slice loaded
    (partition pruning on run_id) next to a zero-row clone of the schema."""
    base = work_dir(spark, "curated")
    cur = catalog.curated_trips(spark, sf)
    # the same curated rows land under two run ids (a re-run on another
    # day); reading one slice must prune the other partition, so a count
    # that doubled would expose a missing partition filter
    lake.write_run(cur.drop("run_id"), base, catalog.RUN_ID)
    lake.write_run(spark.read.parquet(f"{base}/run_id={catalog.RUN_ID}"), base, "run-other")
    table = spark.read.parquet(base)
    empty = lake.empty_like(table)
    sliced = empty.unionByName(lake.stage_curated(table, catalog.RUN_ID))
    return sliced.agg(F.count(F.lit(1)).alias("rows_in_slice"), F.count_distinct("VendorID").alias("vendors"))


@register("master_csv_ingest", """
SELECT CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough, p_name AS zone,
  CASE WHEN p_partkey % 11 = 0 THEN 'N/A' ELSE p_type END AS service_zone
FROM part WHERE p_partkey % 13 <> 0""")
def q_master_csv_ingest(spark, sf):
    """A2 + B1 + B2 + B6 + D1: a master file lands as CSV with padded,
    mixed-case headers; it is read with inference off (all strings, 'N/A'
    kept), headers normalised and checked, the key cast, rows with a missing
    key / borough / zone dropped, and the unique-key gate applied."""
    from lakegov.operators import quality
    base = work_dir(spark, "landing")
    p = B.table(spark, sf, "part")
    k = F.col("p_partkey")
    csv = p.select(F.when(k % 13 == 0, F.lit(None)).otherwise(k.cast("string")).alias(" LocationID "),
                   F.col("p_brand").alias("Borough"), F.col("p_name").alias("Zone"),
                   F.when(k % 11 == 0, F.lit("N/A")).otherwise(F.col("p_type")).alias("Service_Zone"))
    csv.write.mode("overwrite").option("header", True).csv(f"{base}/zones.csv")
    raw = quality.normalize_headers(lake.read_master_csv(spark, f"{base}/zones.csv"))
    quality.require_columns(raw, ["locationid", "borough", "zone", "service_zone"], "CSV")
    df = quality.drop_null_keys(raw.select(F.col("locationid").try_cast("int").alias("location_id"),
                                           "borough", "zone", "service_zone"), ["location_id", "borough", "zone"])
    quality.assert_unique(df, ["location_id"], "LocationID")
    return df
