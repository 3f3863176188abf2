"""New-file trigger for master uploads (L1).

A Structured Streaming file source watches the upload folder; each
micro-batch of newly arrived files runs the batch operator (matching and
staging) through ``foreachBatch`` and appends to a Parquet sink. The
checkpoint (offsets + commits) lives in the shared checkpoint folder, so a
restarted or re-run job picks up exactly the files it has not processed —
``trigger(availableNow=True)`` processes everything pending and stops, which
suits a scheduled run; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_stream(spark: SparkSession, source: str, schema: T.StructType | str, sink: str,
                  checkpoint: str, transform: Callable[[DataFrame, int], DataFrame],
                  fmt: str = "parquet", glob: str | None = None, available_now: bool = True,
                  processing_time: str | None = None, max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery. Each micro-batch is
    ``transform(batch_df, batch_id)`` appended to ``sink`` tagged with its
    batch id. Writing is idempotent per batch id (dynamic partition
    overwrite), so a batch replayed after a failure replaces its own output."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source)

    def run_batch(batch_df: DataFrame, batch_id: int) -> None:
        out = transform(batch_df, batch_id).withColumn("micro_batch_id", F.lit(batch_id).cast("bigint"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("micro_batch_id").parquet(sink))

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_to_completion(query, timeout_s: float | None = None) -> None:
    """Wait for an availableNow stream to drain, however long that takes;
    re-raise its failure. Only a caller's own ``timeout_s`` stops it early."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError("stream did not finish in time")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
