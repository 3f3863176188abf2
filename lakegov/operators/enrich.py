"""Zone enrichment of validated trips (B8, C3, C4), coverage metrics (D3)
and the numeric metric export (A15).

The zone master is a dimension: at any data scale it is bounded by the
number of zones, not by trips. It is broadcast only where its rows were
counted when it was built, or where the plan's own statistics bound its bytes
(file sizes, carried through filters and joins); no job is run to find out.
Beyond the bound the join is a shuffle join that AQE can re-plan from measured
sizes and split for skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions up to this many counted rows (about 32 MB at 160 bytes a row), or up to this many bytes by the
# plan's statistics (Parquet bytes; text grows a few times in memory), are broadcast. The hint changes
# the join strategy only, never a value.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 8 << 20


def mark_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Record a proven upper bound on the rows of ``df`` (e.g. data built from
    a literal list, or a frame that already passed ``is_bounded``)."""
    df._lakegov_max_rows = rows  # plain attribute on this DataFrame object
    return df


def plan_bytes(df: DataFrame) -> int:
    """Upper estimate of the bytes of ``df`` by the optimizer: sizes of the files
    that are read, products for joins; very large where nothing is known."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))       # a JVM BigInt, which may arrive as a number already


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` is known to be small: by a recorded row bound, else by the
    plan's statistics. Starts no job."""
    known = getattr(df, "_lakegov_max_rows", None)
    return known <= max_rows if known is not None else plan_bytes(df) <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint behind a size check; unchanged otherwise."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def role_columns(zones: DataFrame, role: str, key_name: str) -> DataFrame:
    """The zone columns renamed for one role (pu / do)."""
    return zones.select(
        F.col("locationid").alias(key_name),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_servicezone"),
    )


def current_zones(snapshot: DataFrame, current_only: bool = True) -> DataFrame:
    """The snapshot rows to join. The reference joins every version
    (``current_only=False``, which fans trips out when a zone has two
    versions); the default keeps only current rows."""
    if current_only and "is_current" in [c.lower() for c in snapshot.columns]:
        snapshot = snapshot.filter(F.col("is_current"))
    return snapshot


def enrich(trips: DataFrame, zones: DataFrame, broadcast: bool = True) -> DataFrame:
    """Role-playing left lookups for pickup and dropoff zones.

    ``zones`` must be canonical (locationid, borough, zone, service_zone).
    Unmatched trips keep NULL zone columns; the trip row count never changes
    when zone keys are unique. Output keys are lower-case and lead, as in the
    curated layer."""
    trips = trips.withColumnsRenamed({c: c.lower() for c in trips.columns
                                      if c.lower() in ("pulocationid", "dolocationid")})
    trips = trips.withColumns({
        "pulocationid": F.col("pulocationid").try_cast("int"),
        "dolocationid": F.col("dolocationid").try_cast("int"),
    })
    z = maybe_broadcast(zones) if broadcast else zones
    pu = role_columns(z, "pu", "pulocationid")
    do = role_columns(z, "do", "dolocationid")
    return trips.join(pu, on="pulocationid", how="left").join(do, on="dolocationid", how="left")


def coverage_metrics(enriched: DataFrame) -> DataFrame:
    """D3: total rows and the pickup / dropoff zone non-null rates rounded to
    4 places (0.0 on empty input), from one aggregate over the enriched rows."""
    total = F.count(F.lit(1))
    return enriched.agg(
        total.alias("total_rows"),
        F.round(F.coalesce(F.avg(F.col("pu_zone").isNotNull().cast("double")), F.lit(0.0)), 4)
         .alias("pu_zone_nonnull_rate"),
        F.round(F.coalesce(F.avg(F.col("do_zone").isNotNull().cast("double")), F.lit(0.0)), 4)
         .alias("do_zone_nonnull_rate"),
    )


def metrics_long(metrics: DataFrame, namespace: str | None = "lakegov") -> DataFrame:
    """Wide numeric metrics -> (MetricName, Value, Unit). Non-numeric
    columns are dropped; without a namespace nothing is exported."""
    numeric = [c for c, t in metrics.dtypes
               if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]
    if not namespace or not numeric:
        return metrics.sparkSession.createDataFrame([], "MetricName string, Value double, Unit string")
    cast = metrics.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    return (cast.unpivot([], numeric, "MetricName", "Value")
            .withColumn("Unit", F.lit("None")))
