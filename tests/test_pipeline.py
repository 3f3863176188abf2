"""End-to-end governed runs over persisted layers (sf0.001 inputs)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from lakegov.operators import governance
from lakegov.plans import binding as B
from lakegov.plans import pipeline as P
from lakegov.session import work_dir

pytestmark = pytest.mark.skipif(not os.path.isdir(SF0001), reason="test data not present")


def test_full_run(spark):
    lay = P.Layout(work_dir(spark, "lake"))
    B.raw_trips(spark, SF0001).repartition(3).write.parquet(lay.raw)
    csv = lay.p("landing", "zones")
    zm = B.zone_master(spark, SF0001).toDF(" LocationID ", "Borough", "Zone", "service_zone")
    zm.coalesce(1).write.option("header", True).csv(csv)

    ing = P.run_mdm_ingest(spark, lay, csv, "b1", 89, 80)
    assert ing["status_counts"].get("PENDING", 0) > 0 and ing["status_counts"]["APPROVED"] > 0
    assert P.run_mdm_ingest(spark, lay, csv, "b1", 89, 80) == ing              # batch replace is idempotent
    v1 = P.publish_golden(spark, lay, "b1")
    n1 = P.current_golden(spark, lay).count()
    v2 = P.publish_golden(spark, lay, "b1")                                     # same batch again: no change
    assert (v1, v2) == (1, 2) and P.current_golden(spark, lay).count() == n1 == ing["status_counts"]["APPROVED"]
    P.publish_snapshot(spark, lay, "snap_001")

    r = P.run_trips_pipeline(spark, lay, "run-a")
    assert r["status"] == "FAILED" and r["reason"] == governance.REASON_APPROVAL_REJECTED
    P.record_decision(spark, lay, "run-b", "approved")
    r = P.run_trips_pipeline(spark, lay, "run-b", quality_threshold=0.98)
    assert r["reason"] == governance.REASON_QUALITY_CHECK_FAILED               # pending zones lower coverage
    good, bad = r["validate"]["good_rows"], r["validate"]["bad_rows"]
    assert good + bad == spark.read.parquet(lay.raw).count()
    # dropoff zones 0-9 are all PENDING (score-88 pairs): coverage is 0 until a steward decides
    assert r["metrics"]["do_zone_nonnull_rate"] == 0.0
    pend = spark.read.parquet(lay.records).filter("status = 'PENDING'").select(
        "batch_id", "location_id", F.lit("APPROVED").alias("decision"))
    counts = P.apply_steward_decisions(spark, lay, "b1", pend)
    assert counts == {"APPROVED": 25}
    P.publish_golden(spark, lay, "b1")
    P.publish_snapshot(spark, lay, "snap_002")
    P.record_decision(spark, lay, "run-c", "approved")
    r = P.run_trips_pipeline(spark, lay, "run-c", quality_threshold=0.9)
    assert r["status"] == "SUCCESS", (r["metrics"], r["gate"])
    assert r["metrics"]["total_rows"] == good

    wh = P.build_warehouse(spark, lay)
    assert wh["fact_rows"] == good                                              # only the released run
    latest = {(x.run_id, x.event_type): x.status
              for x in governance.audit_latest(spark.read.parquet(lay.audit)).collect()}
    assert latest[("run-c", "END")] == "SUCCESS" and latest[("run-b", "END")] == "FAILED"
    tables = P.register_warehouse(spark, lay, prefix="lgt_")
    assert "lgt_fact.trip_fact" in tables and "lgt_dim.zone_dim" in tables
    daily = spark.sql("SELECT DATE(pickup_datetime) AS d, COUNT(*) AS n FROM lgt_fact.trip_fact GROUP BY 1")
    assert daily.agg(F.sum("n")).first()[0] == good
    top = spark.sql("SELECT z.zone, COUNT(*) AS trips FROM lgt_fact.trip_fact f JOIN lgt_dim.zone_dim z "
                    "ON f.pickup_zone_sk = z.zone_sk GROUP BY 1 ORDER BY trips DESC, zone LIMIT 10")
    assert top.count() == 10
    res = spark.sql("SELECT COUNT(*) FROM lgt_dq.test_results").first()[0]
    assert res == 11
    q = spark.read.parquet(lay.p("validated", "quarantine")).filter(F.col("run_id") == "run-c")
    assert q.filter(F.col("bad_reason") == "").count() == 0 and q.count() == bad
