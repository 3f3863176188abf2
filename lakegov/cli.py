"""Command line for the governed runs (one sub-command per job).

    python -m lakegov.cli run        --root s3a://lake --run-id r1 [--quality-threshold 0.98]
    python -m lakegov.cli validate   --root ... --run-id r1
    python -m lakegov.cli enrich     --root ... --run-id r1 [--all-versions]
    python -m lakegov.cli mdm-ingest --root ... --csv s3a://landing/zones.csv --batch-id b1 \\
                                     --auto-merge-threshold 90 --steward-min-threshold 80
    python -m lakegov.cli publish    --root ... --batch-id b1
    python -m lakegov.cli snapshot   --root ... --snapshot-id s1
    python -m lakegov.cli decide     --root ... --run-id r1 --decision approved [--comment ...]
    python -m lakegov.cli warehouse  --root ... [--run-id r1] [--register]

Thresholds have no defaults where the job requires them. Each command prints
one JSON line with its result.
"""

from __future__ import annotations

import argparse
import json
import sys

from lakegov.plans import pipeline as P
from lakegov.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakegov")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def cmd(name, *extra):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True, help="lake root folder / URI")
        for flags, kw in extra:
            p.add_argument(*flags, **kw)
        return p

    run_id = (["--run-id"], {"required": True})
    cmd("run", run_id, (["--quality-threshold"], {"type": float, "default": 0.98}),
        (["--max-age-hours"], {"type": float, "default": 24.0}), (["--all-versions"], {"action": "store_true"}))
    cmd("validate", run_id)
    cmd("enrich", run_id, (["--all-versions"], {"action": "store_true"}))
    cmd("mdm-ingest", (["--csv"], {"required": True}), (["--batch-id"], {"required": True}),
        (["--auto-merge-threshold"], {"type": int, "required": True}),
        (["--steward-min-threshold"], {"type": int, "required": True}))
    cmd("publish", (["--batch-id"], {"required": True}))
    cmd("snapshot", (["--snapshot-id"], {"required": True}))
    cmd("decide", run_id, (["--decision"], {"choices": ["approved", "rejected"], "required": True}),
        (["--comment"], {"default": ""}))
    cmd("warehouse", (["--run-id"], {"default": None}), (["--register"], {"action": "store_true"}))
    a = ap.parse_args(argv)

    spark = get_session(app_name=f"lakegov-{a.cmd}")
    lay = P.Layout(a.root)
    if a.cmd == "run":
        out = P.run_trips_pipeline(spark, lay, a.run_id, a.quality_threshold, a.max_age_hours,
                                   current_only=not a.all_versions)
    elif a.cmd == "validate":
        out = P.validate_raw(spark, lay, a.run_id, P._now().isoformat() + "+00:00")
    elif a.cmd == "enrich":
        out = P.enrich_run(spark, lay, a.run_id, current_only=not a.all_versions)
    elif a.cmd == "mdm-ingest":
        out = P.run_mdm_ingest(spark, lay, a.csv, a.batch_id, a.auto_merge_threshold, a.steward_min_threshold)
    elif a.cmd == "publish":
        out = {"version": P.publish_golden(spark, lay, a.batch_id)}
    elif a.cmd == "snapshot":
        out = {"path": P.publish_snapshot(spark, lay, a.snapshot_id)}
    elif a.cmd == "decide":
        P.record_decision(spark, lay, a.run_id, a.decision, a.comment)
        out = {"run_id": a.run_id, "decision": a.decision}
    else:
        out = P.build_warehouse(spark, lay, a.run_id)
        if a.register:
            out["tables"] = P.register_warehouse(spark, lay)
    print(json.dumps(out, default=str))
    return 0 if out.get("status", "SUCCESS") == "SUCCESS" else 1


if __name__ == "__main__":
    sys.exit(main())
