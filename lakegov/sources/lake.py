"""Lake sources and sinks.

Paths may be local or any Hadoop file system (s3a://, abfss://, hdfs://).
Listing and metadata work is done by Spark sources (binaryFile without its
content column), never by driver-side loops over objects.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A1 --------------------------------------------------------------------------
def read_raw(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Whole raw prefix; monthly files may differ in columns and in the types of
    a column. Files that merge are one scan, as always. Where types differ, the
    files are grouped by type: every group is one scan whose columns are cast
    to a type that holds all months, and the scans are united. A column that is
    missing from a month is null there."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    try:
        return reader.parquet(path)
    except Exception as e:
        if not (merge_schema and _cannot_merge(e)):
            raise
    files = sorted(r.path for r in list_files(spark, path).filter(F.col("path").endswith(".parquet")).select("path").toLocalIterator())
    groups = schema_groups(spark, files)
    target = common_types([schema for schema, _ in groups])
    out = None
    for schema, members in groups:
        own = {f.name.lower(): f.name for f in schema.fields}
        scan = spark.read.schema(schema).parquet(*members).select(*[
            (F.col(f"`{own[n.lower()]}`").cast(t) if n.lower() in own else F.lit(None).cast(t)).alias(n) for n, t in target.items()])
        out = scan if out is None else out.unionByName(scan)
    return out


def _cannot_merge(error: Exception) -> bool:
    said = str(error).upper()
    return "CANNOT_MERGE" in said or "FAILED TO MERGE" in said or "FAILED MERGING" in said


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files whose schemas merge, with the merged schema. Spark merges the
    footers of many files in one distributed job; where that fails the list is
    halved, so m changes of type among n files in path order take about m log n
    such jobs, not one per file. Groups of equal types become one."""
    def merged(part: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
        try:
            return [(spark.read.option("mergeSchema", "true").parquet(*part).schema, list(part))]
        except Exception as e:
            if len(part) == 1 or not _cannot_merge(e):
                raise
        half = len(part) // 2
        return merged(part[:half]) + merged(part[half:])

    out: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, part in merged(files):
        key = schema.simpleString().lower()
        out.setdefault(key, (schema, []))[1].extend(part)
    return list(out.values())


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def common_types(schemas: Sequence[T.StructType]) -> dict[str, str]:
    """{column: type that holds it in every schema}: the type itself where it is
    the same, bigint for whole numbers, double for numbers, text for the rest
    (typed later by ``cast_existing`` and ``parse_ts``)."""
    kinds: dict[str, list[str]] = {}
    names: dict[str, str] = {}
    for schema in schemas:
        for f in schema.fields:
            names.setdefault(f.name.lower(), f.name)
            kinds.setdefault(f.name.lower(), []).append(f.dataType.simpleString())

    def holds(found: set[str]) -> str:
        if len(found) == 1:
            return next(iter(found))
        if found <= set(_WHOLE):
            return "bigint"
        if found <= {*_WHOLE, "float", "double"} or all(k in (*_WHOLE, "float", "double") or k.startswith("decimal") for k in found):
            return "double"
        return "string"

    return {names[n]: holds(set(k)) for n, k in kinds.items()}


# A2 --------------------------------------------------------------------------
def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header on, inference off: every column a string, 'N/A' stays text."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


# A3 --------------------------------------------------------------------------
def jdbc_read_options(url: str, domain: str, view: str = "all", jdbc_options: dict | None = None,
                      bounds: tuple[int, int] | None = None, rows_per_part: int = 500_000) -> dict[str, str]:
    """Options of a JDBC read of one domain's golden view. With ``bounds`` (the
    smallest and largest ``golden_sk``, from the caller's catalog or the last
    commit) the read is split into ranges of about ``rows_per_part`` keys, one
    connection each; without them it is one connection. Caller's options win."""
    opts = {"url": url, "dbtable": f"v_mdm_{domain}_golden_{view}", "fetchsize": "10000"}
    if bounds is not None:
        low, high = bounds
        parts = max(1, -(-(high - low + 1) // rows_per_part))
        opts |= {"partitionColumn": "golden_sk", "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(parts)}
    return opts | (jdbc_options or {})


def read_golden(spark: SparkSession, source: str, domain: str, view: str = "all",
                jdbc_options: dict | None = None, bounds: tuple[int, int] | None = None) -> DataFrame:
    """Golden table of one domain. ``source`` is a lake path holding the golden
    Parquet table (default), or a JDBC URL when ``jdbc_options`` are given, read
    with ``jdbc_read_options`` (split on ``golden_sk`` where ``bounds`` are given)."""
    if jdbc_options is not None:
        return spark.read.format("jdbc").options(**jdbc_read_options(source, domain, view, jdbc_options, bounds)).load()
    df = spark.read.parquet(f"{source.rstrip('/')}/{domain}")
    return df.filter(F.col("is_current")) if view == "current" else df


# A4 --------------------------------------------------------------------------
def list_files(spark: SparkSession, base: str) -> DataFrame:
    """(path, modificationTime, length) of every file under ``base``; the
    listing is distributed and file contents are never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(base).select("path", "modificationTime", "length"))


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """One row: the folder of the newest file under ``base`` (the latest run /
    snapshot), with that file and its time. Ties go to the first path in
    listing order (path ascending), matching a strict '>' scan. Errors if
    nothing is found (checked on the one-row result)."""
    files = list_files(spark, base).filter(~F.col("path").endswith("/"))
    t_max = files.agg(F.max("modificationTime").alias("t"))
    winner = (files.join(t_max, files.modificationTime == t_max.t, "left_semi")
              .agg(F.min("path").alias("latest_file"), F.max("modificationTime").alias("modified_at")))
    return winner.select(
        F.regexp_extract("latest_file", r"^(.*/)[^/]*$", 1).alias("latest_dir"),
        "latest_file", "modified_at")


def _commits_path(base: str) -> str:
    return f"{base.rstrip('/')}__commits"


def commit(spark: SparkSession, base: str, version: str, note: str = "{}") -> None:
    """Mark one version of ``base`` as complete: a one-row file of its own next to
    the table, written last. A version without a marker was cut short."""
    row = spark.createDataFrame([(version, note)], "version string, note string").coalesce(1)
    row.write.mode("overwrite").parquet(f"{_commits_path(base)}/commit={_safe(version)}")


def _safe(version: str) -> str:
    """The version as one folder name that partition discovery leaves as text."""
    return "v-" + "".join(c if c.isalnum() or c in "-_." else f"%{ord(c):02X}" for c in version)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """(version, note, committed_at) of every marker; no rows where nothing was committed."""
    path, schema = _commits_path(base), "version string, note string, commit string"
    if not file_state(spark, path):
        return spark.createDataFrame([], "version string, note string, committed_at timestamp")
    return spark.read.schema(schema).parquet(path).select("version", "note", F.col("_metadata.file_modification_time").alias("committed_at"))


def write_version(df: DataFrame, base: str, version: str, key: str = "version") -> str:
    """A whole version of a table in its folder, then its marker."""
    out = write_run(df, base, version, key)
    commit(df.sparkSession, base, version)
    return out


def latest_committed(spark: SparkSession, base: str) -> str | None:
    """The newest complete version by the time of its marker (of equal times the
    larger name), in one aggregate; runs that were cut short are passed over."""
    newest = commits(spark, base).agg(F.max_by("version", F.struct("committed_at", "version")).alias("v")).first()
    return newest["v"]


def read_latest(spark: SparkSession, base: str, key: str = "version") -> DataFrame:
    """Rows of the newest complete version."""
    version = latest_committed(spark, base)
    if version is None:
        raise FileNotFoundError(f"{base} has no complete version")
    return spark.read.parquet(f"{base.rstrip('/')}/{key}={version}")


def resolve_latest(spark: SparkSession, base: str) -> str:
    """Folder of the newest complete run; of a table without markers, that of its newest file."""
    version = latest_committed(spark, base)
    if version is not None:
        for folder in (version, f"run_id={version}", f"version={version}"):
            out = f"{base.rstrip('/')}/{folder}"
            if _fs(spark, out).exists(_path(spark, out)):
                return out + "/"
    row = latest_version(spark, base).first()
    if row is None or row.latest_file is None:
        raise FileNotFoundError(f"{base} holds no file")
    return row.latest_dir


# A5 --------------------------------------------------------------------------
def write_run(df: DataFrame, base: str, run_id: str, key: str = "run_id") -> str:
    """Idempotent per-run overwrite at <base>/<key>=<run_id>/."""
    out = f"{base.rstrip('/')}/{key}={run_id}"
    df.write.mode("overwrite").parquet(out)
    return out


def write_split(reasoned: DataFrame, good_base: str, bad_base: str, run_id: str,
                observation: Observation | None = None) -> tuple[str, str]:
    """B11 + A5: the reasoned rows are computed and stored once (counts ride
    along as an Observation) and then written in place as the validated and
    the quarantine run folder, each a plain filtered write. Nothing is moved
    or renamed, and a class without rows is an empty table with its schema."""
    staged = reasoned
    if observation is not None:
        staged = staged.observe(observation,
                                F.count_if(F.col("bad_reason") == "").alias("good_rows"),
                                F.count_if(F.col("bad_reason") != "").alias("bad_rows"))
    # stored next to (not under) the validated prefix, so listings never see it
    tmp = f"{good_base.rstrip('/')}__staging/run_id={run_id}"
    staged.write.mode("overwrite").parquet(tmp)
    spark = reasoned.sparkSession
    rows = spark.read.schema(reasoned.schema).parquet(tmp)
    good_out = write_run(rows.filter(F.col("bad_reason") == ""), good_base, run_id)
    bad_out = write_run(rows.filter(F.col("bad_reason") != ""), bad_base, run_id)
    _fs(spark, tmp).delete(_path(spark, tmp), True)
    return good_out, bad_out


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def file_state(spark: SparkSession, path: str) -> tuple:
    """(bytes, files, newest time of the folder itself) below ``path``, none where
    it does not exist: changes when its data do. Two calls whatever the number
    of files: the file system sums the folder up itself."""
    fs, p = _fs(spark, path), _path(spark, path)
    if not fs.exists(p):
        return ()
    summed = fs.getContentSummary(p)
    return (summed.getLength(), summed.getFileCount(), fs.getFileStatus(p).getModificationTime())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a later one has replaced (nothing to do where it is gone)."""
    _fs(spark, path).delete(_path(spark, path), True)


# A6 --------------------------------------------------------------------------
def replace_batch(df: DataFrame, target: str, batch_col: str = "batch_id") -> None:
    """Delete-then-append per batch: dynamic partition overwrite replaces only
    the batch folders present in ``df``; other batches are untouched."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch_col).parquet(target))


def read_batches(spark: SparkSession, target: str, schema: T.StructType, batch_col: str = "batch_id") -> DataFrame:
    """A table of batch folders under the schema it was written with: batch ids
    stay the text they were ('001' is not 1), so a batch is replaced, never doubled."""
    fields = [f for f in schema.fields if f.name != batch_col]
    return spark.read.schema(T.StructType([*fields, T.StructField(batch_col, T.StringType())])).parquet(target)


# A7 --------------------------------------------------------------------------
def write_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """One-row metrics as JSON at a fixed path (overwritten each run); with a
    run id a per-run copy is kept as well, so runs never lose their metrics."""
    # one row: computed once, whatever the number of documents it goes to
    one = metrics.sparkSession.createDataFrame(metrics.limit(1).collect(), metrics.schema).coalesce(1)
    one.write.mode("overwrite").json(path)
    if run_id is not None:
        one.write.mode("overwrite").json(f"{path.rstrip('/')}_runs/run_id={run_id}")


# A8 --------------------------------------------------------------------------
METRICS_SCHEMA = T.StructType([
    T.StructField("total_rows", T.LongType()),
    T.StructField("pu_zone_nonnull_rate", T.DoubleType()),
    T.StructField("do_zone_nonnull_rate", T.DoubleType()),
])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics document with absent fields as 0. A missing document is not an
    exception: one row with ``read_error='METRICS_READ_ERROR'`` is returned."""
    try:
        df = spark.read.schema(METRICS_SCHEMA).json(path)
        df.schema  # noqa: B018 - resolve the path now
        return df.select(
            *[F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name) for f in METRICS_SCHEMA],
            F.lit(None).cast("string").alias("read_error"))
    except Exception as e:  # path absent / unreadable
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame(
            [(None, None, None, "METRICS_READ_ERROR")],
            T.StructType(list(METRICS_SCHEMA.fields) + [T.StructField("read_error", T.StringType())]))


def metrics_json(metrics: DataFrame) -> str:
    """The metrics row as a JSON string (for logs / notifications)."""
    row = metrics.select(F.to_json(F.struct(*metrics.columns)).alias("j")).first()
    return row.j if row else json.dumps({})


# A9 --------------------------------------------------------------------------
def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Catalog entry over lake files (a temp view; no data copy)."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return df


# A10 -------------------------------------------------------------------------
def load_staging(spark: SparkSession, src: str, schema: T.StructType | str, target: str) -> DataFrame:
    """Truncate + bulk load: read with the staging schema (columns by name,
    extras ignored) and overwrite the staging table."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    df = spark.read.parquet(src)
    cols = {c.lower(): c for c in df.columns}
    df = df.select(*[
        (F.col(f"`{cols[f.name.lower()]}`").cast(f.dataType) if f.name.lower() in cols
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


# A11 -------------------------------------------------------------------------
def stage_curated(curated: DataFrame, run_id: str | None = None) -> DataFrame:
    """Full load, or one run's slice (partition filter on run_id)."""
    return curated if run_id is None else curated.filter(F.col("run_id") == run_id)


def empty_like(df: DataFrame) -> DataFrame:
    """The zero-row clone of a table's schema."""
    return df.limit(0)


# A13 -------------------------------------------------------------------------
LAYERS = ("staging", "mdm", "dim", "fact", "dq")


def ensure_layers(spark: SparkSession, layers: Sequence[str] = LAYERS, prefix: str = "lakegov_") -> list[str]:
    names = []
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
        names.append(f"{prefix}{layer}")
    return names
