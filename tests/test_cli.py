"""CLI: sub-commands map onto the pipeline and report one JSON line."""

import json

from pyspark.sql import functions as F

from lakegov import cli
from lakegov.operators import governance
from lakegov.plans import pipeline as P
from lakegov.session import work_dir


def test_decide_then_run_without_raw_data_fails_cleanly(spark, capsys):
    root = work_dir(spark, "cli")
    assert cli.main(["decide", "--root", root, "--run-id", "r9", "--decision", "approved"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["decision"] == "approved"
    assert cli.main(["run", "--root", root, "--run-id", "r9"]) == 1
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == "FAILED" and out["reason"] == governance.REASON_JOB_FAILED
    audit = governance.audit_latest(spark.read.parquet(P.Layout(root).audit))
    assert audit.filter((F.col("event_type") == "END") & (F.col("status") == "FAILED")).count() == 1
