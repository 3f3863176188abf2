"""Runs without rows of a class, unique golden keys, NULL names, layers that follow their input, folder streams."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF0001
from lakegov.operators import matching, scd
from lakegov.plans import binding as B
from lakegov.plans import catalog, catalog_gov
from lakegov.sources import lake


def test_empty_class_is_an_empty_table(spark, tmp_path):
    reasoned = spark.range(5).select("id", F.lit("X_NULL").alias("bad_reason"))
    good, bad = lake.write_split(reasoned, f"{tmp_path}/good", f"{tmp_path}/bad", "r1")
    assert spark.read.parquet(good).count() == 0 and spark.read.parquet(good).columns == ["id", "bad_reason"]
    assert spark.read.parquet(bad).count() == 5
    good, bad = lake.write_split(reasoned.withColumn("bad_reason", F.lit("")), f"{tmp_path}/good", f"{tmp_path}/bad", "r1")
    assert spark.read.parquet(good).count() == 5 and spark.read.parquet(bad).count() == 0
    assert not [n for n in os.listdir(f"{tmp_path}/good__staging") if not n.endswith(".crc")]


def test_golden_keys_are_unique_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        recs = spark.range(600).selectExpr("cast(id AS int) AS k", "concat('n', id) AS name", "'APPROVED' AS status", "'b1' AS batch_id")
        g1 = scd.scd2_publish(scd.empty_golden(spark, "k", ["name"]), recs, "b1", "k", ["name"], "2024-01-01", next_sk_from=1)
        path = f"{catalog.work_dir(spark, 'golden-test')}/t"
        g1.write.parquet(path)
        two = recs.withColumns({"name": F.concat(F.lit("m"), "k"), "batch_id": F.lit("b2")})
        g2 = scd.scd2_publish(spark.read.parquet(path), two, "b2", "k", ["name"], "2024-02-01").cache()
        assert g2.count() == 1200 and g2.select("golden_sk").distinct().count() == 1200
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_null_names_and_blocks_have_no_partner(spark):
    r = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "same"), (4, None, "same"), (5, "a", "x y"), (6, "a", "X Y")],
                              "id long, block string, name string")
    out = matching.match_records(r, "id", "name", "block", 90, 80).collect()
    assert [(x.name_1, x.name_2, x.recommended_golden_id) for x in out] == [("X Y", "X Y", 5)]
    assert dict(matching.match_records(r, "id", "name", "block", 90, 80).dtypes)["recommended_golden_id"] == "bigint"


def writable_copy(tmp_path):
    """A copy of the test tables whose folder may be written (the given one may not)."""
    sf = f"{tmp_path}/sf"
    os.mkdir(sf)
    for n in os.listdir(SF0001):
        shutil.copyfile(f"{SF0001}/{n}", f"{sf}/{n}")
    return sf


def test_layers_follow_their_input(spark, tmp_path):
    sf = writable_copy(tmp_path)
    before = catalog_count(spark, sf)
    more = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    os.remove(f"{sf}/lineitem.parquet")
    more.union(more).write.parquet(f"{sf}/lineitem.parquet")
    assert catalog_count(spark, sf) == 2 * before


def catalog_count(spark, sf):
    return catalog.QUERIES["validation_counts"](spark, sf).first().total_rows


def test_stream_reads_a_table_folder(spark, tmp_path):
    sf = writable_copy(tmp_path)
    part = B.table(spark, SF0001, "part")
    os.remove(f"{sf}/part.parquet")
    part.repartition(3).write.parquet(f"{sf}/part.parquet")
    want = catalog_gov.q_ingest_stream(spark, SF0001)
    got = catalog_gov.q_ingest_stream(spark, sf)
    assert got.columns == want.columns and got.count() > 0
