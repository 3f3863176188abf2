"""Stored layers: built once per session and folder, read back whole, lineage cut."""

from pyspark.sql import functions as F

from lakegov.plans import catalog


def test_layer_is_built_once_and_read_back(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))

    a = catalog.persisted("test-layer", spark, "/fixture/layers-1", build)
    b = catalog.persisted("test-layer", spark, "/fixture/layers-1", build)
    assert len(calls) == 1 and a is b
    assert a.count() == 1000 and a.agg(F.sum("k")).first()[0] == sum(range(1000))
    # the stored table is read, the builder's plan is not re-run
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Relation" in plan


def test_other_folder_builds_its_own_layer(spark):
    a = catalog.persisted("test-layer", spark, "/fixture/layers-2", lambda: spark.range(3))
    b = catalog.persisted("test-layer", spark, "/fixture/layers-3", lambda: spark.range(5))
    assert (a.count(), b.count()) == (3, 5)
