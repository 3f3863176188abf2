"""End-to-end governed runs over persisted lake layers.

``run_trips_pipeline``: audit START -> snapshot freshness -> approval gate
-> raw->validated (+quarantine, one pass) -> validated->curated (zone
enrichment, coverage metrics observed during the same write) -> metrics
document -> quality gate -> audit END; a curated run is *published* (listed
in the released-runs table) only when every gate passed.

``run_mdm_ingest`` / ``publish_golden`` / ``publish_snapshot``: master file ->
header / duplicate gates -> matching -> record and match tables replaced per
batch -> SCD2 publish into a new golden version -> snapshot folder.

``build_warehouse``: dimensions, fact, DQ metrics and assertion rows.

Every step writes its output before the next one reads it, so lineage is cut
at each layer: a lost executor re-runs only the tasks of the current step,
and a re-run of a whole step overwrites its own output (idempotent by run /
batch / version key). Nothing is passed through the driver but one-row
metrics and the names of folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakegov.operators import dq, enrich, governance, matching, quality, scd, star
from lakegov.plans import masters
from lakegov.sources import lake, seeds

AUDIT_SCHEMA = ("run_id string, event_type string, status string, put_at timestamp_ntz, reason string, "
                "details string")


@dataclass(frozen=True)
class Layout:
    """Folder layout under one lake root (any Hadoop file system URI)."""
    root: str

    def p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self): return self.p("raw", "trips")
    @property
    def validated(self): return self.p("validated", "trips")
    @property
    def quarantine(self): return self.p("validated", "quarantine")
    @property
    def curated(self): return self.p("curated", "trips")
    @property
    def released(self): return self.p("curated", "_released_runs")
    @property
    def snapshots(self): return self.p("validated", "zone_snapshot")
    @property
    def metrics(self): return self.p("audit", "metrics", "_METRICS.json")
    @property
    def audit(self): return self.p("audit", "events")
    @property
    def decisions(self): return self.p("audit", "decisions")
    @property
    def records(self): return self.p("mdm", "zone_record")
    @property
    def matches(self): return self.p("mdm", "zone_match")
    @property
    def golden(self): return self.p("mdm", "zone_golden")
    @property
    def warehouse(self): return self.p("warehouse")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _append(spark: SparkSession, rows: list[dict], schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def audit(spark: SparkSession, layout: Layout, run_id: str, event_type: str, status: str,
          reason: str | None = None, details: str | None = None, at: dt.datetime | None = None) -> None:
    """K4 put: append; readers take the latest put per (run_id, event_type)."""
    _append(spark, [governance.audit_event(run_id, event_type, status, at or _now(), reason, details)],
            AUDIT_SCHEMA, layout.audit)


def record_decision(spark: SparkSession, layout: Layout, run_id: str, decision: str, comment: str = "",
                    at: dt.datetime | None = None) -> None:
    """K3 input: a steward's approve / reject, kept with its comment."""
    _append(spark, [{"run_id": run_id, "decision": decision, "comment": comment, "decided_at": at or _now()}],
            "run_id string, decision string, comment string, decided_at timestamp_ntz", layout.decisions)


# ----------------------------------------------------------------------------
# trips
# ----------------------------------------------------------------------------
def validate_raw(spark: SparkSession, layout: Layout, run_id: str, ingested_at: str) -> dict:
    """raw -> validated + quarantine in one pass; counts observed on the way."""
    reasoned = quality.stamp(quality.validate_trips(lake.read_raw(spark, layout.raw)),
                             run_id=run_id, ingested_at_utc=ingested_at)
    obs = Observation("validate")
    good, bad = lake.write_split(reasoned, layout.validated, layout.quarantine, run_id, obs)
    lake.commit(spark, layout.validated, run_id)
    m = obs.get
    return {"validated_path": good, "quarantine_path": bad, "good_rows": m["good_rows"], "bad_rows": m["bad_rows"]}


def enrich_run(spark: SparkSession, layout: Layout, run_id: str, current_only: bool = True,
               validated: str | None = None) -> dict:
    """validated + zone snapshot (latest) -> curated run folder. ``validated``
    is the folder that this run's validation wrote (the latest run's when the
    job is started alone). Coverage metrics are observed during the write."""
    validated = validated or lake.resolve_latest(spark, layout.validated)
    snapshot = lake.resolve_latest(spark, layout.snapshots)
    trips = spark.read.parquet(validated)
    if "bad_reason" in trips.columns:
        trips = trips.drop("bad_reason")
    zones = quality.canonical_zone(enrich.current_zones(spark.read.parquet(snapshot), current_only))
    enriched = enrich.enrich(trips, zones)
    obs = Observation("coverage")
    observed = enriched.observe(
        obs, F.count(F.lit(1)).alias("total_rows"),
        F.count("pu_zone").alias("pu_nonnull"), F.count("do_zone").alias("do_nonnull"))
    out = lake.write_run(observed, layout.curated, run_id)
    m = obs.get
    total = m["total_rows"]
    metrics = {
        "total_rows": total,
        "pu_zone_nonnull_rate": round(m["pu_nonnull"] / total, 4) if total else 0.0,
        "do_zone_nonnull_rate": round(m["do_nonnull"] / total, 4) if total else 0.0,
        "validated_read_path": validated, "snapshot_read_path": snapshot, "curated_write_path": out,
        "generated_utc": _now().isoformat() + "+00:00",
    }
    mdf = spark.createDataFrame([metrics])
    lake.write_metrics(mdf, layout.metrics, run_id=run_id)
    return metrics


def run_trips_pipeline(spark: SparkSession, layout: Layout, run_id: str, quality_threshold: float = 0.98,
                       max_age_hours: float = 24.0, current_only: bool = True) -> dict:
    """The governed trips run. Returns the final verdict as a dict."""
    audit(spark, layout, run_id, governance.EV_START, governance.ST_STARTED)
    result: dict = {"run_id": run_id}
    fresh = governance.freshness(lake.list_files(spark, layout.snapshots) if _exists(spark, layout.snapshots)
                                 else spark.createDataFrame([], "modificationTime timestamp"),
                                 F.current_timestamp(), max_age_hours).first()
    result["freshness"] = fresh.asDict()
    # approval is required whether or not the snapshot is fresh
    runs = spark.createDataFrame([(run_id,)], "run_id string")
    decisions = (spark.read.parquet(layout.decisions) if _exists(spark, layout.decisions)
                 else spark.createDataFrame([], "run_id string, decision string, decided_at timestamp_ntz"))
    if governance.approved_runs(runs, decisions).isEmpty():
        audit(spark, layout, run_id, governance.EV_END, governance.ST_FAILED, governance.REASON_APPROVAL_REJECTED)
        return result | {"status": governance.ST_FAILED, "reason": governance.REASON_APPROVAL_REJECTED}
    try:
        result["validate"] = validate_raw(spark, layout, run_id, _now().isoformat() + "+00:00")
        result["metrics"] = enrich_run(spark, layout, run_id, current_only, result["validate"]["validated_path"])
    except Exception as e:  # noqa: BLE001 - recorded, then reported
        audit(spark, layout, run_id, governance.EV_END, governance.ST_FAILED, governance.REASON_JOB_FAILED,
              str(e)[:1000])
        return result | {"status": governance.ST_FAILED, "reason": governance.REASON_JOB_FAILED}
    gate = governance.quality_gate(lake.read_metrics(spark, layout.metrics), quality_threshold).first()
    result["gate"] = gate.asDict()
    if not gate.quality_passed:
        audit(spark, layout, run_id, governance.EV_END, governance.ST_FAILED, governance.REASON_QUALITY_CHECK_FAILED)
        return result | {"status": governance.ST_FAILED, "reason": governance.REASON_QUALITY_CHECK_FAILED}
    # release: curated output of this run becomes visible to consumers
    _append(spark, [{"run_id": run_id, "released_at": _now()}], "run_id string, released_at timestamp_ntz",
            layout.released)
    audit(spark, layout, run_id, governance.EV_END, governance.ST_SUCCESS)
    return result | {"status": governance.ST_SUCCESS}


def released_curated(spark: SparkSession, layout: Layout) -> DataFrame:
    """Consumer view: curated rows of released runs only (partition pruning on
    run_id; runs that failed a gate stay invisible)."""
    # one row per release, as literals: only a literal list prunes run folders
    ok = [r["run_id"] for r in spark.read.parquet(layout.released).select("run_id").distinct().collect()]
    cur = lake.read_batches(spark, layout.curated, spark.read.parquet(layout.curated).schema, "run_id")
    return cur.filter(F.col("run_id").isin(*ok) if ok else F.lit(False))


# ----------------------------------------------------------------------------
# master data
# ----------------------------------------------------------------------------
def _records(spark: SparkSession, layout: Layout, batch_id: str) -> DataFrame:
    """One batch's records; batch ids are read as the text they were written as."""
    schema = spark.read.parquet(layout.records).schema
    return lake.read_batches(spark, layout.records, schema).filter(F.col("batch_id") == batch_id)


REQUIRED = ["locationid", "borough", "zone", "service_zone"]
ATTRS = ("borough", "zone", "service_zone")


def run_mdm_ingest(spark: SparkSession, layout: Layout, csv_path: str, batch_id: str,
                   auto_threshold: int, steward_threshold: int) -> dict:
    """Zone master file -> record and match tables (replaced per batch)."""
    raw = quality.normalize_headers(lake.read_master_csv(spark, csv_path))
    quality.require_columns(raw, REQUIRED, "CSV")
    df = quality.drop_null_keys(raw.select(
        F.col("locationid").try_cast("int").alias("location_id"), "borough", "zone", "service_zone"),
        ["location_id", "borough", "zone"])
    quality.assert_unique(df, ["location_id"], "LocationID")
    m = matching.match_records(df, "location_id", "zone", "borough", auto_threshold, steward_threshold,
                               batch_id=batch_id)
    m.write.mode("overwrite").parquet(layout.p("mdm", "_staging", f"match_batch={batch_id}"))
    m = spark.read.parquet(layout.p("mdm", "_staging", f"match_batch={batch_id}"))
    recs = matching.stage_records(df, m, "location_id", "zone", "borough", batch_id, csv_path)
    now = F.lit(_now()).cast("timestamp_ntz")
    recs = recs.withColumns({"created_at": now, "updated_at": now})
    lake.replace_batch(recs, layout.records)
    lake.replace_batch(m.withColumn("created_at", now), layout.matches)
    st = _records(spark, layout, batch_id).groupBy("status").count().collect()
    return {"batch_id": batch_id, "status_counts": {r["status"]: r["count"] for r in st}}


def apply_steward_decisions(spark: SparkSession, layout: Layout, batch_id: str, decisions: DataFrame) -> dict:
    """H6 on the record table: decisions (batch_id, location_id, decision,
    optional corrected attributes) update one batch, written back by batch
    replace (the batch is staged first: never overwrite a path being read)."""
    recs = _records(spark, layout, batch_id)
    out = matching.apply_decisions(recs, decisions, "location_id", ATTRS)
    out = out.withColumn("updated_at", F.lit(_now()).cast("timestamp_ntz"))
    stage = layout.p("mdm", "_staging", f"records_batch={batch_id}")
    out.write.mode("overwrite").parquet(stage)
    lake.replace_batch(spark.read.parquet(stage).select(*recs.columns), layout.records)
    st = _records(spark, layout, batch_id).groupBy("status").count().collect()
    return {r["status"]: r["count"] for r in st}


def _versions(spark: SparkSession, base: str) -> list[int]:
    if not _exists(spark, base):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version=") and fs.exists(
                jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def current_golden(spark: SparkSession, layout: Layout) -> DataFrame:
    v = _versions(spark, layout.golden)
    if not v:
        return scd.empty_golden(spark, "location_id", ATTRS)
    return spark.read.parquet(layout.p("mdm", "zone_golden", f"version={v[-1]:06d}"))


def publish_golden(spark: SparkSession, layout: Layout, batch_id: str, as_of: dt.datetime | None = None) -> int:
    """SCD2 publish of a batch's APPROVED records into a NEW golden version
    folder (the version being read is never overwritten). Returns the new
    version number; re-publishing the same batch yields identical content."""
    versions = _versions(spark, layout.golden)
    g = current_golden(spark, layout)
    recs = _records(spark, layout, batch_id)
    new = scd.scd2_publish(g, recs, batch_id, "location_id", ATTRS, as_of or _now())
    nv = (versions[-1] + 1) if versions else 1
    new.write.mode("overwrite").parquet(layout.p("mdm", "zone_golden", f"version={nv:06d}"))
    return nv


def publish_snapshot(spark: SparkSession, layout: Layout, snapshot_id: str) -> str:
    """The golden *all* view stamped with snapshot id / time, one folder per
    snapshot; an empty golden table is an error."""
    g = quality.require_nonempty(scd.golden_all(current_golden(spark, layout), "location_id", ATTRS),
                                 "Zone snapshot")
    out = layout.p("validated", "zone_snapshot", snapshot_id)
    scd.snapshot(g, snapshot_id, F.current_timestamp().cast("timestamp_ntz")).write.mode("overwrite").parquet(out)
    lake.commit(spark, layout.snapshots, snapshot_id)
    return out


# ----------------------------------------------------------------------------
# warehouse
# ----------------------------------------------------------------------------
def build_warehouse(spark: SparkSession, layout: Layout, run_id: str | None = None) -> dict:
    """Dims from the latest zone snapshot, from the vendor and rate-code masters
    (seed rows until one is loaded) and from seeds, the fact from released curated
    runs (optionally one run), DQ metrics and the eleven assertion rows
    (appended to the results table)."""
    wh = layout.warehouse
    snap = spark.read.parquet(lake.resolve_latest(spark, layout.snapshots))
    master = snap.withColumns({"loaded_at": F.current_timestamp().cast("timestamp_ntz")})
    dims = {
        "zone_dim": star.build_zone_dim(master),
        "vendor_dim": masters.dimension(spark, layout.root, masters.VENDOR, seeds.seed(spark, "vendor")),
        "ratecode_dim": masters.dimension(spark, layout.root, masters.RATE_CODE, seeds.seed(spark, "rate_code")),
        "payment_dim": star.build_payment_dim(seeds.seed(spark, "payment_type")),
    }
    for name, d in dims.items():
        d.write.mode("overwrite").parquet(f"{wh}/dim/{name}")
    # the rows counted while numbering go with the stored table
    dims = {name: enrich.mark_bounded(spark.read.parquet(f"{wh}/dim/{name}"), d._lakegov_max_rows)
            for name, d in dims.items()}
    trips = lake.stage_curated(released_curated(spark, layout), run_id)
    fact = star.build_fact(trips, dims["vendor_dim"], dims["ratecode_dim"], dims["payment_dim"], dims["zone_dim"])
    fact.sortWithinPartitions("pickup_datetime").write.mode("overwrite").parquet(f"{wh}/fact/trip_fact")
    fact = spark.read.parquet(f"{wh}/fact/trip_fact")
    metrics = dq.dq_metrics(fact)
    metrics.write.mode("overwrite").parquet(f"{wh}/dq/metrics")
    metrics = spark.read.parquet(f"{wh}/dq/metrics")
    dq.assert_rows(metrics).write.mode("append").parquet(f"{wh}/dq/test_results")
    return {"fact_rows": fact.count(), "metrics": dq.public_metrics(metrics).first().asDict()}


# ----------------------------------------------------------------------------
# catalog registration of the warehouse (A9 + A13)
# ----------------------------------------------------------------------------
WAREHOUSE_TABLES = {
    "fact": {"trip_fact": "fact/trip_fact"},
    "dim": {"zone_dim": "dim/zone_dim", "vendor_dim": "dim/vendor_dim", "ratecode_dim": "dim/ratecode_dim",
            "payment_type_dim": "dim/payment_dim"},
    "dq": {"test_results": "dq/test_results", "metrics": "dq/metrics"},
}


def register_warehouse(spark: SparkSession, layout: Layout, prefix: str = "final_") -> list[str]:
    """Create the layer databases (idempotent) and external tables over the
    warehouse folders, so warehouse SQL addresses them as <prefix><layer>.<table>
    (e.g. final_fact.trip_fact). No data is copied."""
    lake.ensure_layers(spark, ("staging", "mdm", "dim", "fact", "dq"), prefix=prefix)
    names = []
    for layer, tables in WAREHOUSE_TABLES.items():
        for name, rel in tables.items():
            path = f"{layout.warehouse}/{rel}"
            if not _exists(spark, path):
                continue
            full = f"{prefix}{layer}.{name}"
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
            names.append(full)
    return names
