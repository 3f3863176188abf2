"""Registered master-data queries: matching, stewardship, survivorship, SCD2
golden publish, golden views, snapshot and record upserts, constraint checks.

All of them run on the ``part``-derived master records (they grow with the
part table); the vendor survivorship runs on ``supplier``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegov.operators import golden_store, matching, quality, scd, survivorship
from lakegov.plans import binding as B
from lakegov.plans import catalog, masters
from lakegov.plans.catalog import register, with_ctes
from lakegov.sources import seeds

KEY, BLOCK, NAME = "location_id", "borough", "zone"
ATTRS = ("borough", "zone", "service_zone")
SOURCE_FILE = "part.parquet"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


# ==========================================================================
# Spark plans
# ==========================================================================
def records(spark: SparkSession, sf: str, batch: str) -> DataFrame:
    return B.part_records(spark, sf, batch)


def matches(spark: SparkSession, sf: str, batch: str) -> DataFrame:
    return catalog.persisted(f"matches-{batch}", spark, sf, lambda: matching.match_records(
        records(spark, sf, batch), KEY, NAME, BLOCK, B.PART_AUTO, B.PART_STEWARD, batch_id=batch))


def staged(spark: SparkSession, sf: str, batch: str) -> DataFrame:
    return matching.stage_records(records(spark, sf, batch), matches(spark, sf, batch),
                                  KEY, NAME, BLOCK, batch, SOURCE_FILE)


def golden_v2(spark: SparkSession, sf: str) -> DataFrame:
    def publish_first() -> DataFrame:
        g0 = scd.empty_golden(spark, KEY, ATTRS)
        return scd.scd2_publish(g0, staged(spark, sf, B.BATCH_1), B.BATCH_1, KEY, ATTRS, T1, next_sk_from=1)

    def publish_both() -> DataFrame:
        # the stored first version gives the largest key that new versions are numbered above
        g1 = catalog.persisted("golden-first", spark, sf, publish_first)
        return scd.scd2_publish(g1, staged(spark, sf, B.BATCH_2), B.BATCH_2, KEY, ATTRS, T2)
    return catalog.persisted("golden", spark, sf, publish_both)


# ==========================================================================
# SQL forms
# ==========================================================================
def norm_sql(c: str, collapse: bool) -> str:
    s = f"upper(trim(regexp_replace({c}, '[^A-Za-z0-9 ]', ' ', 'g')))"
    return f"regexp_replace({s}, '\\s+', ' ', 'g')" if collapse else s


def match_ctes(batch: str, p: str) -> list[tuple[str, str]]:
    """CTEs {p}rec, {p}mem, {p}grp, {p}m (name-level matches) for one batch —
    brute force over all distinct-name pairs of a block."""
    score = ("CASE WHEN greatest(length(a._name), length(b._name)) = 0 THEN 0 ELSE CAST(round((1 - "
             "levenshtein(a._name, b._name) / greatest(length(a._name), length(b._name))) * 100) AS INTEGER) END")
    return [
        (f"{p}rec", B.PART_RECORDS_SQL[batch]),
        (f"{p}mem", f"SELECT location_id AS _id, {norm_sql('borough', False)} AS _block, "
                    f"{norm_sql('zone', True)} AS _name, length(zone) AS _raw_len, borough, zone, service_zone "
                    f"FROM {p}rec"),
        (f"{p}grp", f"SELECT _block, _name, COUNT(*) AS _n, max(_raw_len) AS _best_len, "
                    f"arg_max(_id, CAST(_raw_len AS BIGINT) * 4294967296 - _id) AS _best_id "
                    f"FROM {p}mem GROUP BY 1, 2"),
        (f"{p}pairs", f"""
SELECT a._block, a._name AS name_1, b._name AS name_2, CAST(a._n * b._n AS BIGINT) AS pair_count, {score} AS score,
  CASE WHEN a._best_len > b._best_len THEN a._best_id WHEN b._best_len > a._best_len THEN b._best_id
       ELSE least(a._best_id, b._best_id) END AS recommended_golden_id
FROM {p}grp a JOIN {p}grp b ON a._block = b._block AND a._name < b._name
UNION ALL
SELECT _block, _name, _name, CAST((_n * (_n - 1)) // 2 AS BIGINT),
  CASE WHEN length(_name) = 0 THEN 0 ELSE 100 END, _best_id
FROM {p}grp WHERE _n >= 2"""),
        (f"{p}m", f"""
SELECT '{batch}' AS batch_id, _block AS block, name_1, name_2, score,
  CASE WHEN score >= {B.PART_AUTO} THEN 'HIGH' ELSE 'MEDIUM' END AS confidence_tier,
  CASE WHEN score >= {B.PART_AUTO} THEN 'AUTO_MERGE' ELSE 'STEWARD_REVIEW' END AS action,
  pair_count, CAST(recommended_golden_id AS INTEGER) AS recommended_golden_id
FROM {p}pairs WHERE score >= {B.PART_STEWARD}"""),
        (f"{p}pn", f"""
SELECT DISTINCT block, name FROM (
  SELECT block, name_1 AS name FROM {p}m WHERE action = 'STEWARD_REVIEW'
  UNION ALL SELECT block, name_2 FROM {p}m WHERE action = 'STEWARD_REVIEW')"""),
        (f"{p}st", f"""
SELECT r.location_id, r.borough, r.zone, r.service_zone,
  CASE WHEN pn.name IS NOT NULL THEN 'PENDING' ELSE 'APPROVED' END AS status,
  '{batch}' AS batch_id, '{SOURCE_FILE}' AS source_file
FROM {p}rec r LEFT JOIN {p}pn pn
  ON pn.block = {norm_sql('r.borough', False)} AND pn.name = {norm_sql('r.zone', True)}"""),
    ]


M1 = match_ctes(B.BATCH_1, "b1_")
M2 = match_ctes(B.BATCH_2, "b2_")

HASH_SQL = "md5(concat_ws('|', coalesce({a}borough, ''), coalesce({a}zone, ''), coalesce({a}service_zone, '')))"

GOLDEN_CTES = M1 + M2 + [
    ("g1", f"""
SELECT location_id, borough, zone, service_zone, {HASH_SQL.format(a='')} AS record_hash,
  TIMESTAMP '{T1}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current,
  '{B.BATCH_1}' AS source_batch_id, TIMESTAMP '{T1}' AS created_at
FROM b1_st WHERE status = 'APPROVED'"""),
    ("inc2", f"SELECT location_id, borough, zone, service_zone, {HASH_SQL.format(a='')} AS new_hash "
             f"FROM b2_st WHERE status = 'APPROVED'"),
    ("g2", f"""
SELECT g.location_id, g.borough, g.zone, g.service_zone, g.record_hash, g.effective_from,
  CASE WHEN i.new_hash IS NOT NULL AND i.new_hash <> g.record_hash THEN TIMESTAMP '{T2}' ELSE g.effective_to END
    AS effective_to,
  CASE WHEN i.new_hash IS NOT NULL AND i.new_hash <> g.record_hash THEN FALSE ELSE g.is_current END AS is_current,
  g.source_batch_id, g.created_at
FROM g1 g LEFT JOIN inc2 i ON i.location_id = g.location_id
UNION ALL
SELECT i.location_id, i.borough, i.zone, i.service_zone, i.new_hash, TIMESTAMP '{T2}', CAST(NULL AS TIMESTAMP),
  TRUE, '{B.BATCH_2}', TIMESTAMP '{T2}'
FROM inc2 i LEFT JOIN g1 g ON g.location_id = i.location_id
WHERE g.location_id IS NULL OR g.record_hash <> i.new_hash"""),
]


# ==========================================================================
# matching
# ==========================================================================
@register("part_matches", with_ctes(M1, "SELECT * FROM b1_m"))
def q_part_matches(spark, sf):
    """Name-level match table of the part master (exact, no pair expansion)."""
    return matches(spark, sf, B.BATCH_1)


@register("part_matches_batch2", with_ctes(M2, "SELECT * FROM b2_m"))
def q_part_matches_b2(spark, sf):
    """Same on batch 2 (changed names, new keys with duplicate names)."""
    return matches(spark, sf, B.BATCH_2)


@register("match_summary", with_ctes(M1, """
SELECT action, confidence_tier, COUNT(*) AS name_pairs, SUM(pair_count) AS record_pairs,
  MIN(score) AS min_score, MAX(score) AS max_score
FROM b1_m GROUP BY 1, 2"""))
def q_match_summary(spark, sf):
    """Record-pair volumes per action/tier (what a steward queue holds)."""
    return (matches(spark, sf, B.BATCH_1).groupBy("action", "confidence_tier")
            .agg(F.count(F.lit(1)).alias("name_pairs"), F.sum("pair_count").alias("record_pairs"),
                 F.min("score").alias("min_score"), F.max("score").alias("max_score")))


# ==========================================================================
# stewardship
# ==========================================================================
@register("pending_ids", with_ctes(M1, """
SELECT DISTINCT m._id AS location_id FROM b1_mem m JOIN b1_pn pn ON pn.block = m._block AND pn.name = m._name"""))
def q_pending_ids(spark, sf):
    return matching.pending_ids(matches(spark, sf, B.BATCH_1), records(spark, sf, B.BATCH_1), KEY, NAME, BLOCK)


@register("record_status", with_ctes(M1, "SELECT * FROM b1_st"))
def q_record_status(spark, sf):
    return staged(spark, sf, B.BATCH_1)


REVIEW_SQL = f"""
SELECT '{B.BATCH_1}' AS batch_id, CAST(m._id AS INTEGER) AS location_id, m.borough AS block, m.zone AS name,
  CAST(q.partner_id AS INTEGER) AS best_partner_id, q.partner_name, q.score
FROM b1_mem m JOIN (
  SELECT *, row_number() OVER (PARTITION BY _block, _name ORDER BY score DESC, best_len DESC, partner_id) AS place FROM (
    SELECT p._block, p.name_1 AS _name, p.name_2 AS partner_name, p.score, g._best_id AS partner_id, g._best_len AS best_len
    FROM b1_pairs p JOIN b1_grp g ON g._block = p._block AND g._name = p.name_2
    WHERE p.name_1 <> p.name_2 AND p.score >= {B.PART_STEWARD} AND p.score < {B.PART_AUTO}
    UNION ALL
    SELECT p._block, p.name_2, p.name_1, p.score, g._best_id, g._best_len
    FROM b1_pairs p JOIN b1_grp g ON g._block = p._block AND g._name = p.name_1
    WHERE p.name_1 <> p.name_2 AND p.score >= {B.PART_STEWARD} AND p.score < {B.PART_AUTO})) q
ON q._block = m._block AND q._name = m._name AND q.place = 1"""


@register("review_queue", with_ctes(M1, REVIEW_SQL))
def q_review_queue(spark, sf):
    """H3/H4: every record under review with its best partner."""
    return matching.review_queue(records(spark, sf, B.BATCH_1), KEY, NAME, BLOCK, B.PART_AUTO, B.PART_STEWARD, B.BATCH_1)


DECISIONS_SQL = """
SELECT batch_id, location_id,
  CASE WHEN location_id % 3 = 0 THEN 'REJECTED' ELSE 'APPROVED' END AS decision,
  CASE WHEN location_id % 4 = 0 THEN upper(zone) END AS zone
FROM b1_st WHERE status = 'PENDING'"""


def decisions(st: DataFrame) -> DataFrame:
    k = F.col(KEY)
    return st.filter(F.col("status") == matching.PENDING).select(
        "batch_id", KEY,
        F.when(k % 3 == 0, F.lit(matching.REJECTED)).otherwise(F.lit(matching.APPROVED)).alias("decision"),
        F.when(k % 4 == 0, F.upper("zone")).alias("zone"))


@register("steward_decisions", with_ctes(M1 + [("d", DECISIONS_SQL)], """
SELECT r.location_id, r.borough, COALESCE(d.zone, r.zone) AS zone, r.service_zone,
  COALESCE(d.decision, r.status) AS status, r.batch_id, r.source_file
FROM b1_st r LEFT JOIN d ON d.batch_id = r.batch_id AND d.location_id = r.location_id"""))
def q_steward_decisions(spark, sf):
    """H6: decisions on the pending records set status and correct names."""
    st = staged(spark, sf, B.BATCH_1)
    return matching.apply_decisions(st, decisions(st), KEY, attrs=("zone",))


# ==========================================================================
# survivorship
# ==========================================================================
def zone_candidates(spark, sf) -> DataFrame:
    b1 = records(spark, sf, B.BATCH_1).select(KEY, *ATTRS, F.lit(False).alias("is_override"),
                                              F.lit(T1).cast("timestamp_ntz").alias("approved_at"),
                                              F.lit(B.BATCH_1).alias("batch_id"))
    b2 = records(spark, sf, B.BATCH_2).select(KEY, *ATTRS, F.lit(False).alias("is_override"),
                                              F.lit(T2).cast("timestamp_ntz").alias("approved_at"),
                                              F.lit(B.BATCH_2).alias("batch_id"))
    k = F.col(KEY)
    b3 = (records(spark, sf, B.BATCH_1).filter(k % 9 == 0)
          .select(KEY, "borough", F.lit(None).cast("string").alias("zone"), "service_zone",
                  F.lit(False).alias("is_override"), F.lit(T3).cast("timestamp_ntz").alias("approved_at"),
                  F.lit("batch_003").alias("batch_id")))
    ov = (records(spark, sf, B.BATCH_1).filter(k % 50 == 0)
          .select(KEY, "borough", F.concat(F.upper("zone"), F.lit(" *")).alias("zone"), "service_zone",
                  F.lit(True).alias("is_override"), F.lit(T1).cast("timestamp_ntz").alias("approved_at"),
                  F.lit("manual").alias("batch_id")))
    return b1.unionByName(b2).unionByName(b3).unionByName(ov)


ZONE_CAND_SQL = f"""
SELECT location_id, borough, zone, service_zone, FALSE AS is_override, TIMESTAMP '{T1}' AS approved_at,
  '{B.BATCH_1}' AS batch_id FROM c1
UNION ALL SELECT location_id, borough, zone, service_zone, FALSE, TIMESTAMP '{T2}', '{B.BATCH_2}' FROM c2
UNION ALL SELECT location_id, borough, NULL, service_zone, FALSE, TIMESTAMP '{T3}', 'batch_003'
  FROM c1 WHERE location_id % 9 = 0
UNION ALL SELECT location_id, borough, upper(zone) || ' *', service_zone, TRUE, TIMESTAMP '{T1}', 'manual'
  FROM c1 WHERE location_id % 50 = 0"""


@register("survivorship_zone", with_ctes(
    [("c1", B.PART_RECORDS_SQL[B.BATCH_1]), ("c2", B.PART_RECORDS_SQL[B.BATCH_2]), ("cand", ZONE_CAND_SQL)], """
SELECT location_id, borough, zone, service_zone, is_override, approved_at, batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY is_override DESC,
    (borough IS NOT NULL AND zone IS NOT NULL) DESC, approved_at DESC, batch_id DESC) AS rn FROM cand)
WHERE rn = 1"""))
def q_survivorship_zone(spark, sf):
    """Override > completeness > latest approval."""
    return survivorship.survivorship_zone(zone_candidates(spark, sf))


@register("survivorship_vendor", with_ctes(
    [("cand", f"""
SELECT CAST(s_suppkey % 8 AS INTEGER) AS vendor_id, s_name AS vendor_name, 2 AS source_rank,
  CAST(NULL AS TIMESTAMP) AS updated_at, s_suppkey AS record_id FROM supplier
UNION ALL SELECT vendor_id, vendor_name, 1, TIMESTAMP '{T1}', 0 FROM ({seeds.seed_sql('vendor')})""")], """
SELECT vendor_id, vendor_name, source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY source_rank,
    COALESCE(updated_at, TIMESTAMP '0001-01-01') DESC, record_id DESC) AS rn FROM cand)
WHERE rn = 1"""))
def q_survivorship_vendor(spark, sf):
    """Steward table beats raw supplier-derived vendors (8 hot keys)."""
    s = B.table(spark, sf, "supplier")
    raw = s.select((F.col("s_suppkey") % 8).cast("int").alias("vendor_id"), F.col("s_name").alias("vendor_name"),
                   F.lit(2).alias("source_rank"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
                   F.col("s_suppkey").alias("record_id"))
    stew = seeds.seed(spark, "vendor").select("vendor_id", "vendor_name", F.lit(1).alias("source_rank"),
                                               F.lit(T1).cast("timestamp_ntz").alias("updated_at"),
                                               F.lit(0).cast("bigint").alias("record_id"))
    return survivorship.survivorship_vendor(raw.unionByName(stew))


# ==========================================================================
# SCD2 golden
# ==========================================================================
@register("scd2_publish", with_ctes(GOLDEN_CTES, "SELECT * FROM g2"))
def q_scd2_publish(spark, sf):
    """Two batches published in turn (golden_sk omitted from the compare)."""
    return golden_v2(spark, sf).drop("golden_sk")


@register("golden_store_publish", with_ctes(GOLDEN_CTES, "SELECT * FROM g2"))
def q_golden_store_publish(spark, sf):
    """C5, C6 incrementally: both batches published into a bucketed store; history is not read."""
    def build(base: str) -> DataFrame:
        for batch, at in ((B.BATCH_1, T1), (B.BATCH_2, T2)):
            golden_store.publish(spark, f"{base}/golden", staged(spark, sf, batch), batch, KEY, ATTRS, at, buckets=8)
        return golden_store.golden(spark, f"{base}/golden", KEY, ATTRS)
    return catalog._memo("golden-store", spark, sf, build).drop("golden_sk")


@register("golden_current", with_ctes(GOLDEN_CTES, """
SELECT location_id, borough, zone, service_zone, effective_from, effective_to, is_current, source_batch_id
FROM g2 WHERE is_current"""))
def q_golden_current(spark, sf):
    return scd.golden_current(golden_v2(spark, sf), KEY, ATTRS)


@register("golden_history_counts", with_ctes(GOLDEN_CTES, """
SELECT source_batch_id, is_current, COUNT(*) AS versions, COUNT(DISTINCT location_id) AS keys
FROM g2 GROUP BY 1, 2"""))
def q_golden_history_counts(spark, sf):
    """A14 all-view rolled up: versions per batch and currency."""
    g = scd.golden_all(golden_v2(spark, sf), KEY, ATTRS)
    return g.groupBy("source_batch_id", "is_current").agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct(KEY).alias("keys"))


@register("golden_constraints", with_ctes(GOLDEN_CTES, """
SELECT 'one_current:location_id' AS "constraint", CAST(location_id AS VARCHAR) AS detail
FROM g2 WHERE is_current GROUP BY location_id HAVING COUNT(*) > 1"""))
def q_golden_constraints(spark, sf):
    """B13 on the golden table: at most one current row per key (expect none)."""
    return quality.check_constraints(golden_v2(spark, sf), one_current_per=[KEY])


# ==========================================================================
# Snapshot upsert; C9: record upsert
# ==========================================================================
SNAP_COLS = ["golden_sk", "location_id", "borough", "zone", "service_zone", "effective_from", "effective_to",
             "is_current", "source_batch_id", "created_at", "snapshot_id", "snapshot_ts"]
SNAP_COMPARE = ["location_id", "borough", "zone", "service_zone", "effective_from", "effective_to", "is_current",
                "source_batch_id", "snapshot_id", "snapshot_ts"]

SNAP_TARGET_SQL = f"""
SELECT p_partkey AS golden_sk, CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough, p_name AS zone,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS service_zone,
  TIMESTAMP '{T1}' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current,
  '{B.BATCH_1}' AS source_batch_id, TIMESTAMP '{T1}' AS created_at, 'snap_001' AS snapshot_id,
  TIMESTAMP '{T1}' AS snapshot_ts, TIMESTAMP '{T1}' AS loaded_at, TIMESTAMP '{T1}' AS updated_at
FROM part WHERE p_partkey % 13 <> 0"""

SNAP_STAGING_SQL = f"""
SELECT p_partkey AS golden_sk, CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough, p_name AS zone,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_type END AS service_zone,
  TIMESTAMP '{T1}' AS effective_from,
  CASE WHEN p_partkey % 5 = 0 THEN TIMESTAMP '{T2}' END AS effective_to,
  NOT (p_partkey % 5 = 0) AS is_current, '{B.BATCH_1}' AS source_batch_id,
  CASE WHEN p_partkey % 11 = 0 THEN TIMESTAMP '{T2}' ELSE TIMESTAMP '{T1}' END AS created_at,
  CASE WHEN p_partkey % 3 = 0 THEN 'snap_001' ELSE 'snap_002' END AS snapshot_id,
  CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T2}' END AS snapshot_ts,
  md5(p_name) AS record_hash
FROM part
UNION ALL
SELECT p_partkey + 1000000000, CAST(p_partkey AS INTEGER), p_brand, p_name || ' II', p_type, TIMESTAMP '{T2}',
  NULL, TRUE, '{B.BATCH_2}', TIMESTAMP '{T2}', 'snap_002', TIMESTAMP '{T2}', md5(p_name || ' II')
FROM part WHERE p_partkey % 5 = 0"""


def _snap_frames(spark, sf):
    p = B.table(spark, sf, "part")
    k = F.col("p_partkey")
    t1, t2 = F.lit(T1).cast("timestamp_ntz"), F.lit(T2).cast("timestamp_ntz")
    null_ts = F.lit(None).cast("timestamp_ntz")
    target = p.filter(k % 13 != 0).select(
        k.alias("golden_sk"), k.cast("int").alias("location_id"), F.col("p_brand").alias("borough"),
        F.col("p_name").alias("zone"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("service_zone"),
        t1.alias("effective_from"), null_ts.alias("effective_to"), F.lit(True).alias("is_current"),
        F.lit(B.BATCH_1).alias("source_batch_id"), t1.alias("created_at"), F.lit("snap_001").alias("snapshot_id"),
        t1.alias("snapshot_ts"), t1.alias("loaded_at"), t1.alias("updated_at"))
    old = p.select(
        k.alias("golden_sk"), k.cast("int").alias("location_id"), F.col("p_brand").alias("borough"),
        F.col("p_name").alias("zone"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.col("p_type")).alias("service_zone"),
        t1.alias("effective_from"), F.when(k % 5 == 0, t2).alias("effective_to"),
        (~(k % 5 == 0)).alias("is_current"), F.lit(B.BATCH_1).alias("source_batch_id"),
        F.when(k % 11 == 0, t2).otherwise(t1).alias("created_at"),
        F.when(k % 3 == 0, F.lit("snap_001")).otherwise(F.lit("snap_002")).alias("snapshot_id"),
        F.when(k % 3 == 0, t1).otherwise(t2).alias("snapshot_ts"),
        F.md5("p_name").alias("record_hash"))
    new = p.filter(k % 5 == 0).select(
        (k + F.lit(B.NEW_KEY_OFFSET)).alias("golden_sk"), k.cast("int").alias("location_id"),
        F.col("p_brand").alias("borough"), F.concat("p_name", F.lit(" II")).alias("zone"),
        F.col("p_type").alias("service_zone"), t2.alias("effective_from"), null_ts.alias("effective_to"),
        F.lit(True).alias("is_current"), F.lit(B.BATCH_2).alias("source_batch_id"), t2.alias("created_at"),
        F.lit("snap_002").alias("snapshot_id"), t2.alias("snapshot_ts"),
        F.md5(F.concat("p_name", F.lit(" II"))).alias("record_hash"))
    return target, old.unionByName(new)


def _sentinel_sql(c: str) -> str:
    s = {"location_id": "-1", "is_current": "false"}.get(c)
    if s is None:
        s = "TIMESTAMP '1900-01-01'" if c in ("effective_from", "effective_to", "snapshot_ts") else "''"
    return s


SNAP_DIFF = " OR ".join(f"COALESCE(t.{c}, {_sentinel_sql(c)}) <> COALESCE(s.{c}, {_sentinel_sql(c)})"
                        for c in SNAP_COMPARE)
SNAP_DATA = ["golden_sk", *SNAP_COMPARE, "created_at"]


@register("snapshot_upsert", with_ctes([("tgt", SNAP_TARGET_SQL), ("stg", SNAP_STAGING_SQL)], f"""
SELECT {', '.join(f"CASE WHEN s.golden_sk IS NOT NULL AND (t.golden_sk IS NULL OR {SNAP_DIFF}) THEN s.{c} ELSE t.{c} END AS {c}"
                  for c in SNAP_DATA)},
  CASE WHEN t.golden_sk IS NOT NULL THEN t.loaded_at ELSE TIMESTAMP '{T3}' END AS loaded_at,
  CASE WHEN s.golden_sk IS NOT NULL AND (t.golden_sk IS NULL OR {SNAP_DIFF}) THEN TIMESTAMP '{T3}'
       ELSE t.updated_at END AS updated_at
FROM tgt t FULL OUTER JOIN stg s ON t.golden_sk = s.golden_sk"""))
def q_snapshot_upsert(spark, sf):
    """C7 + C8: sentinel compare (NULL = ''), created_at copied not compared,
    extra record_hash column ignored."""
    target, staging = _snap_frames(spark, sf)
    return scd.upsert_snapshot(target, staging, SNAP_COMPARE, T3)


REC_TARGET_SQL = f"""
SELECT '{B.BATCH_1}' AS batch_id, CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough, p_name AS zone,
  p_type AS service_zone, 'APPROVED' AS status, '{SOURCE_FILE}' AS source_file,
  TIMESTAMP '{T1}' AS created_at, TIMESTAMP '{T1}' AS updated_at
FROM part"""
REC_INCOMING_SQL = f"""
SELECT '{B.BATCH_1}' AS batch_id, CAST(p_partkey AS INTEGER) AS location_id, p_brand AS borough,
  p_name || ' v2' AS zone, p_type AS service_zone, 'PENDING' AS status, 'fix.csv' AS source_file
FROM part WHERE p_partkey % 4 = 0
UNION ALL
SELECT '{B.BATCH_2}', CAST(p_partkey AS INTEGER), p_brand, p_name, p_type, 'APPROVED', 'b2.csv'
FROM part WHERE p_partkey % 6 = 0"""
REC_UPDATE = ["borough", "zone", "service_zone", "status", "source_file"]


@register("record_upsert", with_ctes([("tgt", REC_TARGET_SQL), ("inc", REC_INCOMING_SQL)], f"""
SELECT COALESCE(t.batch_id, i.batch_id) AS batch_id, COALESCE(t.location_id, i.location_id) AS location_id,
  {', '.join(f"CASE WHEN i.location_id IS NOT NULL THEN i.{c} ELSE t.{c} END AS {c}" for c in REC_UPDATE)},
  CASE WHEN t.location_id IS NOT NULL THEN t.created_at ELSE TIMESTAMP '{T2}' END AS created_at,
  CASE WHEN i.location_id IS NOT NULL THEN TIMESTAMP '{T2}' ELSE t.updated_at END AS updated_at
FROM tgt t FULL OUTER JOIN inc i ON t.batch_id = i.batch_id AND t.location_id = i.location_id"""))
def q_record_upsert(spark, sf):
    """ON CONFLICT (batch_id, key) DO UPDATE — last write wins, created_at kept."""
    p = B.table(spark, sf, "part")
    k = F.col("p_partkey")
    base = [k.cast("int").alias("location_id"), F.col("p_brand").alias("borough")]
    target = p.select(F.lit(B.BATCH_1).alias("batch_id"), *base, F.col("p_name").alias("zone"),
                      F.col("p_type").alias("service_zone"), F.lit("APPROVED").alias("status"),
                      F.lit(SOURCE_FILE).alias("source_file"), F.lit(T1).cast("timestamp_ntz").alias("created_at"),
                      F.lit(T1).cast("timestamp_ntz").alias("updated_at"))
    inc = p.filter(k % 4 == 0).select(F.lit(B.BATCH_1).alias("batch_id"), *base,
                                      F.concat("p_name", F.lit(" v2")).alias("zone"),
                                      F.col("p_type").alias("service_zone"), F.lit("PENDING").alias("status"),
                                      F.lit("fix.csv").alias("source_file"))
    inc = inc.unionByName(p.filter(k % 6 == 0).select(
        F.lit(B.BATCH_2).alias("batch_id"), *base, F.col("p_name").alias("zone"),
        F.col("p_type").alias("service_zone"), F.lit("APPROVED").alias("status"), F.lit("b2.csv").alias("source_file")))
    return scd.upsert_records(target, inc, ["batch_id", KEY], T2, REC_UPDATE)


# ==========================================================================
# D1, B13, B6, B1–B3 over master records
# ==========================================================================
DIRTY_SQL = f"""
SELECT batch_id, location_id, borough, zone, service_zone,
  CASE WHEN location_id % 17 = 0 THEN 'UNKNOWN' ELSE 'APPROVED' END AS status
FROM (SELECT '{B.BATCH_2}' AS batch_id, * FROM ({B.PART_RECORDS_SQL[B.BATCH_2]}))
UNION ALL
SELECT '{B.BATCH_2}', CAST(p_partkey AS INTEGER), p_brand, p_name, p_type, 'PENDING' FROM part WHERE p_partkey % 19 = 0"""


def dirty_records(spark, sf) -> DataFrame:
    r = records(spark, sf, B.BATCH_2).select(F.lit(B.BATCH_2).alias("batch_id"), "*")
    r = r.withColumn("status", F.when(F.col(KEY) % 17 == 0, F.lit("UNKNOWN")).otherwise(F.lit("APPROVED")))
    p = B.table(spark, sf, "part").filter(F.col("p_partkey") % 19 == 0)
    dup = p.select(F.lit(B.BATCH_2).alias("batch_id"), F.col("p_partkey").cast("int").alias(KEY),
                   F.col("p_brand").alias("borough"), F.col("p_name").alias("zone"),
                   F.col("p_type").alias("service_zone"), F.lit("PENDING").alias("status"))
    return r.unionByName(dup)


@register("duplicate_keys", with_ctes([("d", DIRTY_SQL)], """
SELECT batch_id, location_id, COUNT(*) AS n FROM d GROUP BY 1, 2 HAVING COUNT(*) > 1"""))
def q_duplicate_keys(spark, sf):
    """Repeated (batch_id, key) with their counts."""
    return quality.duplicate_keys(dirty_records(spark, sf), ["batch_id", KEY])


@register("constraint_violations", with_ctes([("d", DIRTY_SQL)], """
SELECT 'not_null:service_zone' AS "constraint", CAST(NULL AS VARCHAR) AS detail FROM d WHERE service_zone IS NULL
UNION ALL SELECT 'enum:status', status FROM d WHERE status NOT IN ('APPROVED', 'PENDING', 'REJECTED')
UNION ALL SELECT 'primary_key:batch_id,location_id', batch_id || ',' || CAST(location_id AS VARCHAR)
  FROM d GROUP BY batch_id, location_id HAVING COUNT(*) > 1"""))
def q_constraint_violations(spark, sf):
    """NOT NULL, enumerated status and primary key as violation rows."""
    return quality.check_constraints(
        dirty_records(spark, sf), not_null=["service_zone"],
        enums={"status": ["APPROVED", "PENDING", "REJECTED"]}, key=["batch_id", KEY])


@register("drop_null_keys", with_ctes([("r", B.PART_RECORDS_SQL[B.BATCH_2])], """
SELECT * FROM r WHERE location_id IS NOT NULL AND zone IS NOT NULL AND service_zone IS NOT NULL"""))
def q_drop_null_keys(spark, sf):
    """Rows with a NULL in any required column are dropped."""
    return quality.drop_null_keys(records(spark, sf, B.BATCH_2), [KEY, "zone", "service_zone"])


@register("canonical_zone", """
SELECT CAST(p_partkey AS INTEGER) AS locationid, p_brand AS borough, p_name AS zone, p_type AS service_zone
FROM part""")
def q_canonical_zone(spark, sf):
    """Header variants (' LocationID ', 'Service Zone', ...) resolved
    to the canonical four columns with an int key."""
    p = B.table(spark, sf, "part")
    raw = p.select(F.col("p_partkey").cast("string").alias(" LocationID "), F.col("p_brand").alias("Borough"),
                   F.col("p_name").alias("ZONE"), F.col("p_type").alias("Service Zone"))
    hdr = quality.normalize_headers(raw)
    quality.require_columns(hdr, ["locationid", "borough", "zone", "service zone"], "zone master")
    return quality.canonical_zone(hdr)


# ==========================================================================
# Vendor and rate-code masters: publish, snapshot, staging, merge, dimension
# ==========================================================================
#: domain -> (table, key, name) whose keys are doubled, so that keys of new records (2 key + 1) are free
MASTER_SOURCES = {"vendor": ("supplier", "s_suppkey", "s_name"), "rate_code": ("customer", "c_custkey", "c_name")}


def master_records(spark, sf, domain: masters.Domain, batch: str) -> DataFrame:
    """Batch 1: every row of the source. Batch 2: names of keys divisible by 4
    change, keys ending in 3 also arrive as new ones; keys divisible by 9 stay pending in both."""
    source, key, name = MASTER_SOURCES[domain.name]
    t = B.table(spark, sf, source).select(F.col(key).cast("int").alias("k"), F.col(name).alias("n"))
    if batch == B.BATCH_2:
        new = t.filter("k % 10 = 3").select((2 * F.col("k") + 1).alias("id"), "k", "n")
        t = t.withColumn("n", F.when(F.col("k") % 4 == 0, F.concat("n", F.lit(" II"))).otherwise(F.col("n")))
        t = t.select((2 * F.col("k")).alias("id"), "k", "n").unionByName(new)
    else:
        t = t.select((2 * F.col("k")).alias("id"), "k", "n")
    return t.select(F.col("id").cast("int").alias(domain.key), F.col("n").alias(domain.attrs[0]),
                    F.when(F.col("k") % 9 == 0, F.lit(matching.PENDING)).otherwise(F.lit(matching.APPROVED)).alias("status"),
                    F.lit(batch).alias("batch_id"))


def loaded_master(spark, sf, domain: masters.Domain) -> str:
    """Both batches published, snapshotted and loaded in turn; the root folder."""
    def build(base: str) -> str:
        for batch, snapshot, at, loaded in ((B.BATCH_1, "snap_001", T1, T1), (B.BATCH_2, "snap_002", T2, T3)):
            masters.publish(spark, base, domain, master_records(spark, sf, domain, batch), batch, at, buckets=8)
            masters.publish_snapshot(spark, base, domain, snapshot, at)
            masters.load_master(spark, base, domain, loaded)
        return base
    return catalog._memo(f"master-{domain.name}", spark, sf, build)


def master_ctes(d: masters.Domain) -> list[tuple[str, str]]:
    source, key, name = MASTER_SOURCES[d.name]
    attr = d.attrs[0]
    return [
        ("b1", f"SELECT CAST(2 * {key} AS INTEGER) AS id, {name} AS n FROM {source} WHERE {key} % 9 <> 0"),
        ("b2", f"""
SELECT CAST(2 * {key} AS INTEGER) AS id, CASE WHEN {key} % 4 = 0 THEN {name} || ' II' ELSE {name} END AS n FROM {source} WHERE {key} % 9 <> 0
UNION ALL SELECT CAST(2 * {key} + 1 AS INTEGER), {name} FROM {source} WHERE {key} % 10 = 3 AND {key} % 9 <> 0"""),
        ("g", f"""
SELECT b1.id, b1.n, TIMESTAMP '{T1}' AS effective_from, CASE WHEN b2.n <> b1.n THEN TIMESTAMP '{T2}' END AS effective_to,
  NOT COALESCE(b2.n <> b1.n, FALSE) AS is_current, '{B.BATCH_1}' AS source_batch_id, TIMESTAMP '{T1}' AS loaded_at
FROM b1 LEFT JOIN b2 USING (id)
UNION ALL
SELECT b2.id, b2.n, TIMESTAMP '{T2}', NULL, TRUE, '{B.BATCH_2}', TIMESTAMP '{T3}'
FROM b2 LEFT JOIN b1 USING (id) WHERE b1.id IS NULL OR b1.n <> b2.n"""),
        ("m", f"""
SELECT id AS {d.key}, n AS {attr}, effective_from, effective_to, is_current, source_batch_id, 'snap_002' AS snapshot_id,
  TIMESTAMP '{T2}' AS snapshot_ts, effective_from AS created_at, loaded_at, TIMESTAMP '{T3}' AS updated_at FROM g"""),
    ]


@register("vendor_master_upsert", with_ctes(master_ctes(masters.VENDOR), "SELECT * FROM m"))
def q_vendor_master_upsert(spark, sf):
    """Vendor master after two batches: publish, snapshot, staging load, merge (golden_sk left out)."""
    return masters.master(spark, loaded_master(spark, sf, masters.VENDOR), masters.VENDOR).drop("golden_sk")


@register("ratecode_master_upsert", with_ctes(master_ctes(masters.RATE_CODE), "SELECT * FROM m"))
def q_ratecode_master_upsert(spark, sf):
    """Rate-code master after two batches, by the same path."""
    return masters.master(spark, loaded_master(spark, sf, masters.RATE_CODE), masters.RATE_CODE).drop("golden_sk")


@register("ratecode_dim", with_ctes(master_ctes(masters.RATE_CODE), """
SELECT rate_code_id, rate_code_name, row_number() OVER (ORDER BY rate_code_id) AS ratecode_sk FROM m WHERE is_current"""))
def q_ratecode_dim(spark, sf):
    """The dimension over the current rows of the loaded rate-code master."""
    root = loaded_master(spark, sf, masters.RATE_CODE)
    return masters.dimension(spark, root, masters.RATE_CODE, seeds.seed(spark, "rate_code"))
