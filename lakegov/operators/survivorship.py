"""Golden-record survivorship.

"Pick one row per business key by a priority order" is written as a max over
a (priority..., payload...) struct: a declarative aggregate with a partial
(map-side) phase, so a key holding a third of all candidate rows is reduced
inside each task before the shuffle — unlike a row_number window, which
would sort all of that key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_one(df: DataFrame, key: Sequence[str], priority: Sequence[Column], payload: Sequence[str]) -> DataFrame:
    """Per key, the payload of the row with the greatest ``priority`` tuple
    (compare element by element; all must be non-null for a total order)."""
    pri = [p.alias(f"_p{i}") for i, p in enumerate(priority)]
    best = F.max(F.struct(*pri, *[F.col(c).alias(c) for c in payload])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in payload])


def survivorship_zone(candidates: DataFrame, key: str = "location_id",
                      attrs: Sequence[str] = ("borough", "zone", "service_zone")) -> DataFrame:
    """Manual override first, then completeness (borough and zone both
    present), then the latest approval; remaining ties go to the greatest
    batch id. ``candidates`` carries: key, attrs, is_override (bool),
    approved_at (timestamp), batch_id."""
    complete = F.col("borough").isNotNull() & F.col("zone").isNotNull()
    priority = [F.coalesce(F.col("is_override"), F.lit(False)), complete,
                F.coalesce(F.col("approved_at").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")),
                F.coalesce(F.col("batch_id"), F.lit(""))]
    return pick_one(candidates, [key], priority, [*attrs, "is_override", "approved_at", "batch_id"])


def survivorship_vendor(candidates: DataFrame, key: str = "vendor_id",
                        attrs: Sequence[str] = ("vendor_name",)) -> DataFrame:
    """Source priority — the steward-managed source (rank 1) always beats
    raw input (higher ranks); within a source the latest record wins, then
    the greatest record id. ``candidates``: key, attrs, source_rank (int),
    updated_at, record_id."""
    priority = [-F.col("source_rank").cast("int"),
                F.coalesce(F.col("updated_at").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")),
                F.coalesce(F.col("record_id").cast("bigint"), F.lit(-1).cast("bigint"))]
    return pick_one(candidates, [key], priority, [*attrs, "source_rank"])
