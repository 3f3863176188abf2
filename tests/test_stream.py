"""L1: file-arrival stream processes each upload once, across restarts."""

from pyspark.sql import functions as F

from lakegov.operators import matching
from lakegov.session import work_dir
from lakegov.streaming.ingest import ingest_stream, run_to_completion


def test_new_files_processed_once(spark):
    base = work_dir(spark, "stream-test")
    src, sink, ckpt = f"{base}/uploads", f"{base}/sink", f"{base}/_ckpt"
    schema = "location_id int, borough string, zone string"

    def transform(df, batch_id):
        return matching.match_records(df, "location_id", "zone", "borough", 89, 80, batch_id=f"mb{batch_id}")

    spark.createDataFrame([(1, "Q", "Corona"), (2, "Q", "Corona")], schema).write.parquet(f"{src}/f1")
    run_to_completion(ingest_stream(spark, f"{src}/f1", schema, sink, ckpt, transform))
    first = spark.read.parquet(sink)
    assert first.count() == 1 and first.first().pair_count == 1

    # a re-run with no new files adds nothing (checkpointed offsets)
    run_to_completion(ingest_stream(spark, f"{src}/f1", schema, sink, ckpt, transform))
    assert spark.read.parquet(sink).count() == 1

    # a new upload in the watched folder is picked up alone
    spark.createDataFrame([(3, "M", "SoHo"), (4, "M", "Soho")], schema).write.mode("append").parquet(f"{src}/f1")
    run_to_completion(ingest_stream(spark, f"{src}/f1", schema, sink, ckpt, transform))
    out = spark.read.parquet(sink)
    assert out.count() == 2
    assert out.select(F.countDistinct("micro_batch_id")).first()[0] == 2
