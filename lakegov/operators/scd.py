"""SCD2 golden publish, golden views and upserts.

Parquet tables have no row-level UPDATE; every "update" here is a pure
function from (old table, incoming rows) to the next table version, which
the caller writes to a *new* version folder (never over a path being read).
Each upsert is one co-partitioned full outer join on the table key, and each
joined row emits its output row(s) in a single pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegov.functions.expr import record_hash

APPROVED = "APPROVED"


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


# H7 / C5 / C6 ----------------------------------------------------------------
def golden_schema(key: str, attrs: Sequence[str]) -> str:
    a = ", ".join(f"{c} string" for c in attrs)
    return (f"golden_sk bigint, {key} int, {a}, record_hash string, effective_from timestamp_ntz, "
            "effective_to timestamp_ntz, is_current boolean, source_batch_id string, created_at timestamp_ntz")


def empty_golden(spark, key: str, attrs: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], golden_schema(key, attrs))


def scd2_publish(golden: DataFrame, records: DataFrame, batch_id: str, key: str, attrs: Sequence[str],
                 as_of, next_sk_from: int | None = None) -> DataFrame:
    """Publish the APPROVED records of one batch into an SCD2 golden table.

    * a current row whose hash differs from the incoming one is expired
      (effective_to = as_of, is_current = false);
    * an incoming key with no current row, or with a different hash, gets a
      new current row (effective_from = as_of);
    * history rows, unchanged current rows and keys absent from the batch
      are kept as they are. Re-publishing the same batch is a no-op.

    One full outer join of the current versions and the incoming rows on the
    key (both unique per key), then each joined row emits its 0–2 output rows;
    expired versions are passed on as they are, without a shuffle."""
    at = _ts(as_of)
    inc = (records.filter((F.col("batch_id") == batch_id) & (F.col("status") == APPROVED))
           .select(F.col(key).cast("int").alias(key), *[F.col(c).cast("string").alias(c) for c in attrs])
           .withColumn("_new_hash", record_hash(*attrs)))
    gcols = golden.columns
    c = golden.filter("is_current").select(*[F.col(x).alias(f"_g_{x}") for x in gcols], F.col(key).alias("_k"))
    i = inc.select(*[F.col(x).alias(f"_i_{x}") for x in [key, *attrs]], "_new_hash", F.col(key).alias("_ik"))
    j = c.join(i, F.col("_k") == F.col("_ik"), "full_outer")

    has_cur, has_inc = F.col(f"_g_{key}").isNotNull(), F.col(f"_i_{key}").isNotNull()
    changed = has_cur & has_inc & (F.col("_g_record_hash") != F.col("_new_hash"))
    old_row = F.struct(
        F.col("_g_golden_sk").alias("golden_sk"), F.col(f"_g_{key}").alias(key),
        *[F.col(f"_g_{a}").alias(a) for a in attrs],
        F.col("_g_record_hash").alias("record_hash"), F.col("_g_effective_from").alias("effective_from"),
        F.when(changed, at).otherwise(F.col("_g_effective_to")).alias("effective_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("_g_is_current")).alias("is_current"),
        F.col("_g_source_batch_id").alias("source_batch_id"), F.col("_g_created_at").alias("created_at"))
    new_row = F.struct(
        F.lit(None).cast("bigint").alias("golden_sk"), F.col(f"_i_{key}").alias(key),
        *[F.col(f"_i_{a}").alias(a) for a in attrs],
        F.col("_new_hash").alias("record_hash"), at.alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"),
        F.lit(batch_id).alias("source_batch_id"), at.alias("created_at"))
    rows = F.array(F.when(has_cur, old_row), F.when(has_inc & (~has_cur | changed), new_row))
    out = j.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
    out = out.unionByName(golden.filter("NOT is_current").select(*out.columns))

    # new rows get fresh surrogate keys above every existing one
    if next_sk_from is None:
        mx = golden.agg(F.max("golden_sk")).first()[0]
        next_sk_from = (mx or 0) + 1
    return out.withColumn("golden_sk", F.coalesce(
        F.col("golden_sk"), F.monotonically_increasing_id() + F.lit(next_sk_from)))


# A14 -------------------------------------------------------------------------
def golden_current(golden: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The current view: one row per key."""
    return golden.filter(F.col("is_current")).select(
        key, *attrs, "effective_from", "effective_to", "is_current", "source_batch_id")


def golden_all(golden: DataFrame, key: str, attrs: Sequence[str], with_hash: bool = True) -> DataFrame:
    """The history view (every version)."""
    return golden.select("golden_sk", key, *attrs, *(["record_hash"] if with_hash else []),
                         "effective_from", "effective_to", "is_current", "source_batch_id", "created_at")


def snapshot(golden_view: DataFrame, snapshot_id: str, snapshot_ts) -> DataFrame:
    """B7 on a golden view: the published snapshot rows."""
    return golden_view.withColumns({"snapshot_id": F.lit(snapshot_id), "snapshot_ts": _ts(snapshot_ts)})


# C7 / C8 ---------------------------------------------------------------------
# --- fixed values: NULL sentinels of the snapshot compare ------------------
SENTINEL_INT = -1
SENTINEL_STR = ""
SENTINEL_TS = "1900-01-01 00:00:00"
SENTINEL_BOOL = False


def _sentinel(c: str, dtype: str) -> Column:
    if dtype in ("int", "bigint", "smallint", "tinyint", "float", "double") or dtype.startswith("decimal"):
        s = F.lit(SENTINEL_INT).cast(dtype)
    elif dtype.startswith("timestamp") or dtype == "date":
        s = F.lit(SENTINEL_TS).cast(dtype)
    elif dtype == "boolean":
        s = F.lit(SENTINEL_BOOL)
    else:
        s = F.lit(SENTINEL_STR)
    return s


def upsert_snapshot(target: DataFrame, staging: DataFrame, compare: Sequence[str], as_of,
                    key: str = "golden_sk", set_only: Sequence[str] = ("created_at",)) -> DataFrame:
    """Merge a snapshot into a master table keyed by golden_sk.

    * same key and any ``compare`` column differs (NULL read as its type's
      sentinel, so NULL equals '' / -1 / 1900-01-01 / false): the row takes the
      staging values, ``set_only`` columns are copied too but never compared,
      ``loaded_at`` is kept and ``updated_at`` = as_of;
    * same key, no difference: the target row is kept unchanged;
    * key only in staging: inserted with loaded_at = updated_at = as_of;
    * key only in target: kept."""
    at = _ts(as_of)
    types = dict(staging.dtypes)
    data_cols = [key, *compare, *[c for c in set_only if c in staging.columns and c not in compare]]
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.col(key).alias("_k"))
    s = staging.select(*[F.col(c).alias(f"_s_{c}") for c in data_cols], F.col(key).alias("_k"))
    j = t.join(s, "_k", "full_outer")
    has_t, has_s = F.col(f"_t_{key}").isNotNull(), F.col(f"_s_{key}").isNotNull()
    diff = F.lit(False)
    for c in compare:
        sen = _sentinel(c, types[c])
        diff = diff | (F.coalesce(F.col(f"_t_{c}"), sen) != F.coalesce(F.col(f"_s_{c}"), sen))
    take_s = (has_s & ~has_t) | (has_s & has_t & diff)
    out = [F.when(take_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in data_cols]
    out.append(F.when(has_t, F.col("_t_loaded_at")).otherwise(at).alias("loaded_at"))
    out.append(F.when(take_s, at).otherwise(F.col("_t_updated_at")).alias("updated_at"))
    return j.select(*out)


# C9 --------------------------------------------------------------------------
def upsert_records(target: DataFrame, incoming: DataFrame, key: Sequence[str], as_of,
                   update_cols: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE: incoming rows win on
    ``update_cols``; created_at is kept from the existing row (as_of for new
    rows); updated_at = as_of for every upserted row. Incoming must be unique
    per key (a primary key)."""
    at = _ts(as_of)
    t = target.select(*key, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in key],
                      F.lit(True).alias("_has_t"))
    i = incoming.select(*key, *[F.col(c).alias(f"_i_{c}") for c in update_cols], F.lit(True).alias("_has_i"))
    j = t.join(i, list(key), "full_outer")
    has_i = F.coalesce(F.col("_has_i"), F.lit(False))
    has_t = F.coalesce(F.col("_has_t"), F.lit(False))
    cols = [F.col(k) for k in key]
    cols += [F.when(has_i, F.col(f"_i_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in update_cols]
    cols.append(F.when(has_t, F.col("_t_created_at")).otherwise(at).alias("created_at"))
    cols.append(F.when(has_i, at).otherwise(F.col("_t_updated_at")).alias("updated_at"))
    return j.select(*cols)
