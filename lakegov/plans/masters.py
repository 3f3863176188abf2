"""Master domains end to end (A5, A10, B7, C5–C8, J2, J3): one path for all.

A domain's approved records are published into its incremental golden store;
the all-versions view is stamped as a snapshot (one folder each, committed when
whole); the newest snapshot is bulk-loaded into a typed staging table and
merged into the domain's warehouse master, of which every load is a committed
version; the dimension is built from the master's current rows. All steps can
be repeated: a batch that is published again changes nothing, a snapshot that is loaded already is not loaded again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegov.operators import golden_store, quality, scd, star
from lakegov.sources import lake


@dataclass(frozen=True)
class Domain:
    name: str
    key: str
    attrs: tuple[str, ...]

    @property
    def compared(self) -> list[str]:
        """Columns whose change is an update of the master."""
        return [self.key, *self.attrs, "effective_from", "effective_to", "is_current", "source_batch_id", "snapshot_id", "snapshot_ts"]

    @property
    def staging(self) -> str:
        attrs = ", ".join(f"{a} string" for a in self.attrs)
        return (f"golden_sk bigint, {self.key} int, {attrs}, effective_from timestamp_ntz, effective_to timestamp_ntz, "
                "is_current boolean, source_batch_id string, created_at timestamp_ntz, snapshot_id string, snapshot_ts timestamp_ntz")


ZONE = Domain("zone", "location_id", ("borough", "zone", "service_zone"))
VENDOR = Domain("vendor", "vendor_id", ("vendor_name",))
RATE_CODE = Domain("rate_code", "rate_code_id", ("rate_code_name",))


def _path(root: str, d: Domain, part: str) -> str:
    return f"{root.rstrip('/')}/masters/{d.name}/{part}"


def publish(spark: SparkSession, root: str, d: Domain, records: DataFrame, batch_id: str, as_of,
            buckets: int = golden_store.BUCKETS) -> list[int]:
    """Approved records of one batch into the golden store; the buckets that were rewritten."""
    return golden_store.publish(spark, _path(root, d, "golden"), records, batch_id, d.key, d.attrs, as_of, buckets)


def publish_snapshot(spark: SparkSession, root: str, d: Domain, snapshot_id: str, snapshot_ts) -> str:
    """All golden versions stamped with the snapshot; without a version it is an error."""
    rows = quality.require_nonempty(scd.golden_all(golden_store.golden(spark, _path(root, d, "golden"), d.key, d.attrs), d.key, d.attrs),
                                    f"{d.name} snapshot")
    return lake.write_version(scd.snapshot(rows, snapshot_id, snapshot_ts), _path(root, d, "snapshots"), snapshot_id)


def load_master(spark: SparkSession, root: str, d: Domain, as_of) -> str:
    """The newest complete snapshot into staging and from there into the master; its id."""
    base = _path(root, d, "master")
    snapshot_id = lake.latest_committed(spark, _path(root, d, "snapshots"))
    if snapshot_id is None:
        raise FileNotFoundError(f"{d.name} has no snapshot")
    loaded = lake.latest_committed(spark, base)
    if loaded == snapshot_id:
        return snapshot_id
    staging = lake.load_staging(spark, f"{_path(root, d, 'snapshots')}/version={snapshot_id}", d.staging, _path(root, d, "staging"))
    if loaded is None:
        at = scd._ts(as_of)
        merged = staging.withColumns({"loaded_at": at, "updated_at": at})
    else:
        merged = scd.upsert_snapshot(lake.read_latest(spark, base), staging, d.compared, as_of)
    lake.write_version(merged, base, snapshot_id)
    return snapshot_id


def master(spark: SparkSession, root: str, d: Domain) -> DataFrame | None:
    """The domain's master table, or None where nothing was loaded yet."""
    base = _path(root, d, "master")
    return lake.read_latest(spark, base) if lake.latest_committed(spark, base) is not None else None


def dimension(spark: SparkSession, root: str, d: Domain, otherwise: DataFrame) -> DataFrame:
    """The dimension over the master's current rows, over ``otherwise`` (seed rows) without one."""
    build = {"vendor": star.build_vendor_dim, "rate_code": star.build_ratecode_dim, "zone": star.build_zone_dim}[d.name]
    rows = master(spark, root, d)
    return build(otherwise if rows is None else rows)
