"""Star build, analytics plan shape, DQ metrics/assertions and governance."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakegov.operators import analytics, dq, enrich, governance, star
from lakegov.sources import lake, seeds

T0 = dt.datetime(2024, 1, 1, 10)
TRIPS = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
         "RatecodeID int, payment_type int, pulocationid int, dolocationid int, trip_distance double, "
         "total_amount double, passenger_count int")


@pytest.fixture(scope="module")
def dims(spark):
    zones = spark.createDataFrame([(1, "Q", "Corona", "Boro"), (2, "M", "SoHo", "Yellow")],
                                  "location_id int, borough string, zone string, service_zone string")
    return {"vendor_dim": star.build_vendor_dim(seeds.seed(spark, "vendor")),
            "ratecode_dim": star.build_ratecode_dim(seeds.seed(spark, "rate_code")),
            "payment_dim": star.build_payment_dim(seeds.seed(spark, "payment_type")),
            "zone_dim": star.build_zone_dim(zones)}


@pytest.fixture(scope="module")
def trips(spark):
    h = dt.timedelta(hours=1)
    return spark.createDataFrame([
        (1, T0, T0 + h, None, None, 1, 2, 1.0, 10.0, 1),    # NULL rate -> 99, NULL payment -> 5
        (2, T0, T0 + h, 1, 0, 1, 99, 2.0, 20.0, 2),         # payment 0 -> NULL FK, unknown zone -> NULL FK
        (3, T0, T0 - h, 42, 1, 2, 1, -1.0, None, 1),        # unknown vendor / rate; bad order, neg distance
    ], TRIPS)


def fact_of(trips, d, **kw):
    return star.build_fact(trips, d["vendor_dim"], d["ratecode_dim"], d["payment_dim"], d["zone_dim"], **kw)


def test_fact_keys(trips, dims):
    f = fact_of(trips, dims, keep_business_keys=True)
    rows = sorted(f.collect(), key=lambda r: r.trip_distance, reverse=True)
    assert f.count() == trips.count()                       # fact rows = trip rows
    a, b, c = rows[1], rows[0], rows[2]
    assert a.rate_code_id == 99 and a.payment_type_id == 5 and a.ratecode_sk is not None
    assert b.payment_type_sk is None and b.dropoff_zone_sk is None and b.pickup_zone_sk is not None
    assert c.vendor_sk is None and c.ratecode_sk is None
    assert len({r.trip_fact_sk for r in rows}) == 3


def test_fact_plan_broadcasts_dims(trips, dims):
    plan = fact_of(trips, dims)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 5
    assert "SortMergeJoin" not in plan


def test_analytics_preaggregate_before_join(trips, dims):
    f = fact_of(trips, dims)
    top = analytics.q_top_zones(f, dims["zone_dim"])
    assert [(r.zone, r.trips) for r in top.collect()] == [("Corona", 2), ("SoHo", 1)]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    # the fact is aggregated by surrogate key below the join to the dimension
    assert plan.index("Join") < plan.rindex("Aggregate")
    pay = {r.payment_type_name: r.trips for r in analytics.q_payment_mix(f, dims["payment_dim"]).collect()}
    assert pay == {"Unknown": 1, "Credit Card": 1}
    assert analytics.q_negative_duration(f).first()[0] == 1


def test_dq_metrics_and_assertions(trips, dims):
    f = fact_of(trips, dims)
    m = dq.dq_metrics(f)
    r = m.first()
    assert r.total_rows == 3 and r.bad_time_order_count == 1 and r.negative_distance_count == 1
    assert str(r.total_amount_fill_rate) == "0.666667"
    res = {x.test_name.split(".")[-1]: x for x in dq.assert_rows(m).collect()}
    assert len(res) == 11
    assert res["row_count_gt_0"].passed and float(res["row_count_gt_0"].threshold) == 1
    assert not res["negative_distance_count_eq_0"].passed
    assert res["pickup_ts_fill_rate_ge_0_999"].passed
    assert not res["vendor_fk_fill_rate_ge_0_995"].passed


def test_dq_on_empty_fact(trips, dims):
    f = fact_of(trips.limit(0), dims)
    m = dq.dq_metrics(f)
    r = m.first()
    assert r.total_rows == 0 and r.pickup_ts_fill_rate is None and r.bad_time_order_count is None
    res = {x.test_name.split(".")[-1]: x.passed for x in dq.assert_rows(m).collect()}
    assert res["row_count_gt_0"] is False and res["vendor_fk_fill_rate_ge_0_995"] is False
    assert res["negative_distance_count_eq_0"] is True       # COUNT(*) WHERE is 0 on empty input


def test_rate_exactly_at_threshold(spark):
    m = spark.createDataFrame([(1000, 999)], "n long, k long").select(
        F.col("n").alias("total_rows"), (F.col("k") / F.col("n")).cast("decimal(10,6)").alias("pickup_ts_fill_rate"))
    spec = [a for a in dq.FACT_ASSERTIONS if a.name == "pickup_ts_fill_rate_ge_0_999"]
    assert dq.assert_rows(m, spec).first().passed is True


def test_coverage_gate_and_metrics_roundtrip(spark, tmp_path):
    enriched = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), ("a", "b")], "pu_zone string, do_zone string")
    cov = enrich.coverage_metrics(enriched)
    assert tuple(cov.first()) == (4, 0.75, 0.75)
    path = str(tmp_path / "_METRICS.json")
    lake.write_metrics(cov, path, run_id="r1")
    back = lake.read_metrics(spark, path)
    assert governance.quality_gate(back, 0.7).first().quality_passed is True
    g = governance.quality_gate(back, 0.98).first()
    assert g.quality_passed is False and g.reason == "QUALITY_CHECK_FAILED"
    miss = governance.quality_gate(lake.read_metrics(spark, str(tmp_path / "nope.json")), 0.98).first()
    assert miss.quality_passed is False and miss.reason == "METRICS_READ_ERROR"
    empty = enrich.coverage_metrics(enriched.limit(0)).first()
    assert tuple(empty) == (0, 0.0, 0.0)
    assert json.loads(lake.metrics_json(cov))["total_rows"] == 4
    long = {r.MetricName: r.Value for r in enrich.metrics_long(cov).collect()}
    assert long == {"total_rows": 4.0, "pu_zone_nonnull_rate": 0.75, "do_zone_nonnull_rate": 0.75}
    assert enrich.metrics_long(cov, None).count() == 0


def test_enrich_keeps_rows_and_current_only(spark):
    trips = spark.createDataFrame([(1, 2), (3, None)], "PULocationID bigint, DOLocationID bigint")
    snap = spark.createDataFrame([(1, "Q", "A", "s", True), (1, "Q", "A-old", "s", False), (2, "M", "B", "s", True)],
                                 "location_id int, borough string, zone string, service_zone string, "
                                 "is_current boolean")
    from lakegov.operators.quality import canonical_zone
    cur = canonical_zone(enrich.current_zones(snap, True))
    out = enrich.enrich(trips, cur)
    assert out.count() == 2 and out.columns[:2] == ["dolocationid", "pulocationid"]
    allv = canonical_zone(enrich.current_zones(snap, False))
    assert enrich.enrich(trips, allv).count() == 3                # reference parity: fan-out


def test_audit_and_approval(spark):
    t = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame([
        governance.audit_event("r1", "START", "STARTED", t),
        governance.audit_event("r1", "END", "FAILED", t + dt.timedelta(1), "QUALITY_CHECK_FAILED"),
        governance.audit_event("r1", "END", "SUCCESS", t + dt.timedelta(2)),     # same key put twice: last wins
        governance.audit_event("r2", "END", "FAILED", t, "APPROVAL_REJECTED")],
        "run_id string, event_type string, status string, put_at timestamp_ntz, reason string, details string")
    latest = {(r.run_id, r.event_type): r.status for r in governance.audit_latest(audit).collect()}
    assert latest == {("r1", "START"): "STARTED", ("r1", "END"): "SUCCESS", ("r2", "END"): "FAILED"}
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run_id string")
    dec = spark.createDataFrame([("r1", "approved", t), ("r2", "approved", t), ("r2", "rejected", t + dt.timedelta(1))],
                                "run_id string, decision string, decided_at timestamp_ntz")
    assert [r.run_id for r in governance.approved_runs(runs, dec).collect()] == ["r1"]
    k = governance.governance_kpis(governance.audit_latest(audit), dec).first()
    assert (k.runs_succeeded, k.runs_failed, k.failed_approval, k.runs_approved, k.runs_rejected) == (1, 1, 1, 2, 1)


def test_freshness(spark):
    t = dt.datetime(2024, 1, 10)
    files = spark.createDataFrame([("a", t - dt.timedelta(hours=30)), ("b", t - dt.timedelta(hours=2))],
                                  "prefix string, modificationTime timestamp_ntz")
    out = {r.prefix: (r.freshness_ok, r.age_hours) for r in governance.freshness(files, t, 24, "prefix").collect()}
    assert out == {"a": (False, 30.0), "b": (True, 2.0)}
    none = governance.freshness(files.limit(0), t, 24).first()
    assert none.freshness_ok is False and none.reason.startswith("No objects")


def test_surrogate_key_is_dense_at_every_size(spark):
    df = spark.range(50).selectExpr("CASE WHEN id = 7 THEN NULL ELSE 100 - id END AS k")
    want = [(k, i + 1) for i, k in enumerate(sorted(100 - i for i in range(50) if i != 7))] + [(None, 50)]
    for parts in (1, 4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        out = star.surrogate_key(df.repartition(parts), "sk", ["k"])
        assert sorted(((r.k, r.sk) for r in out.collect()), key=lambda x: x[1]) == want
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert star.surrogate_key(df.limit(0), "sk", ["k"]).count() == 0

