"""Partitioned Parquet, raw JSON lines, seeds and written layers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyward.session import LAYERS, shared_folder
from tallyward.sources import versions

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_bronze(spark: SparkSession, root: str, quarter: str | None = None, columns: Sequence[str] | None = None,
                partition: str = "quarter") -> DataFrame:
    """A partitioned table; the quarter filter prunes folders, the column list prunes the scan.

    Partition values are texts as written: ``007`` stays ``007``.
    """
    df = _as_written(spark, root, partition)
    if quarter is not None:
        df = df.where(F.col(partition) == quarter)
    return df.select(*columns) if columns else df


def _as_written(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """The table with its partition column as text, whatever its values look like."""
    columns = [f for f in spark.read.parquet(root).schema if f.name != partition]
    return spark.read.schema(StructType([*columns, StructField(partition, StringType())])).parquet(root)


def present_partitions(spark: SparkSession, root: str, partition: str) -> DataFrame | None:
    """Distinct partition values of a table, or None when there is no table yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    # The folder names are the list: no data file is opened.
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    values = [unquote(n.partition("=")[2]) for n in names if n.startswith(f"{partition}=")]
    return spark.createDataFrame([(None if v == "__HIVE_DEFAULT_PARTITION__" else v,) for v in values],
                                 f"{partition} string")


def missing_partitions(wanted: DataFrame, roots: Sequence[str], partition: str) -> DataFrame:
    """Wanted partitions that at least one of the tables does not have."""
    spark = wanted.sparkSession
    complete = wanted
    for root in roots:
        present = present_partitions(spark, root, partition)
        complete = complete.limit(0) if present is None else complete.join(present, partition, "left_semi")
    return wanted.join(complete, partition, "left_anti")


def write_partitions(df: DataFrame, path: str, partition: str, force: bool = False) -> None:
    """Replace whole partitions; without ``force`` those already present are skipped.

    The rebalance hint writes files of even size: a partition that holds most of the
    rows is written by many tasks.
    """
    if not force:
        present = present_partitions(df.sparkSession, path, partition)
        if present is not None:
            df = df.join(present, partition, "left_anti")
    (
        df.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full refresh (or append) of a table that ``read_table`` reads.

    A refresh is a new version, published when it is complete: it may read the table itself, and a failure at any
    step leaves a whole table, the old or the new one. An append adds files to the version in use.
    """
    if mode == "overwrite":
        versions.write_version(df, path)
    else:
        df.write.mode(mode).parquet(versions.current_folder(df.sparkSession, path) or path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The version in use of a table, or plain files."""
    return versions.read_version(spark, path)


def append_json(spark: SparkSession, path: str, schema: StructType, table: str, day_of: str, day: str) -> None:
    """Append JSON lines (plain or gzip) by day; fields outside the schema are ignored.

    A line that is not JSON fails the load; nothing of it is appended as an empty row.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn(day, F.to_date(F.col(day_of)))
    rows.write.mode("append").partitionBy(day).parquet(table)


def land_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "gzip").json(path)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small curated CSV with given types. Its file size lets Spark decide to broadcast it."""
    return spark.read.csv(path, schema=schema, header=True)


def _position(kind: str, column: str) -> Column:
    """A number that grows with the column: the value itself, or the first six characters of a text."""
    c = F.col(column)
    if kind == "string":
        return F.conv(F.rpad(F.substring(F.hex(F.encode(c, "utf-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.unix_date(c).cast("double") if kind == "date" else c.cast("double")


BITS = 6


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """The place of a row on a curve that keeps rows near that are near in every column.

    Each column is cut at its quantiles (one aggregate over ``df``, ``2 ** BITS`` numbers per column come back), and the
    bits of the bucket numbers are taken in turn, the highest first. A null is in the lowest bucket.
    """
    kinds = dict(df.dtypes)
    places = {c: _position(kinds[c], c) for c in columns}
    steps = [i / 2 ** BITS for i in range(1, 2 ** BITS)]
    cuts = df.agg(*[F.percentile_approx(p, steps, 10_000).alias(c) for c, p in places.items()]).first()
    out = F.lit(0).cast("bigint")
    for k, (c, place) in enumerate(places.items()):
        # In Spark's order, where NaN is the highest number.
        bounds = sorted(map(float, cuts[c] or []), key=lambda x: (x != x, x))
        spread = [sum((n >> bit & 1) << bit * len(columns) + k for bit in range(BITS)) for n in range(len(bounds) + 1)]
        out = out + F.transform(F.array(place), _step(bounds, spread))[0]
    return out


def _step(bounds: Sequence[float], results: Sequence[int]) -> Callable[[Column], Column]:
    """``results[n]`` for a number that is not below ``n`` of the sorted bounds, by halving; a null is below all."""
    def half(place: Column, low: int, high: int) -> Column:
        if low == high:
            return F.lit(results[low]).cast("bigint")
        middle = (low + high) // 2
        return F.when(place >= F.lit(bounds[middle]), half(place, middle + 1, high)).otherwise(half(place, low, middle))

    return lambda place: half(place, 0, len(bounds))


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows dealt and sorted so that a filter on any of the columns needs few files and row groups.

    One column: ranges of it. Several: ranges of their interleaved bits. A row number is the last key, so that equal
    rows, a hot key among them, spread over files.
    """
    if len(columns) == 1:
        keyed = df.withColumn("__row", F.monotonically_increasing_id())
        return keyed.repartitionByRange(columns[0], "__row").sortWithinPartitions(columns[0]).drop("__row")
    keyed = df.withColumn("__curve", interleaved(df, columns)).withColumn("__row", F.monotonically_increasing_id())
    return keyed.repartitionByRange("__curve", "__row").sortWithinPartitions("__curve", *columns).drop("__curve", "__row")


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is shuffled inside is removed from disk when its write ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str, kind: str = "table", cluster_by: Sequence[str] = (),
                path: str | None = None) -> DataFrame:
    """A layer as a lazy view or as a written table that is read back.

    A table cuts the lineage: later jobs read files that survive the loss of executors, with real sizes for join
    planning. ``cluster_by`` lays rows out by these columns (see ``clustered``), so that files and row groups outside a
    filter are skipped; ``df`` is then read twice or three times. Without ``path`` the shared folder of the session is
    used.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    spark = df.sparkSession
    target = path or shared_folder(spark, name)
    out = clustered(df, cluster_by) if cluster_by else df
    with dropped_shuffles(spark):
        out.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def written_layer(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The layer ``name`` of an input folder, written once per session."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in LAYERS:
        LAYERS[key] = materialise(build(), name)
    return LAYERS[key]


def write_history(versions: DataFrame, path: str, snapshot: str) -> None:
    """Store open versions and those closed by ``snapshot`` in a table by the snapshot that closed them.

    Every snapshot has its own id, also one of the same day, so only the open partition
    and that of this snapshot are replaced; older closed versions are never read or
    written again. Loading a snapshot again closes nothing and leaves its partition alone.
    The rows are written aside first because they come from the table they replace.
    """
    ready = materialise(versions, "history")
    (
        ready.withColumn("closed_by", F.when(F.col("valid_to").isNull(), "open").otherwise(f"snapshot {snapshot}"))
        .hint("rebalance", "closed_by").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("closed_by").parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("closed_by")


def layer_volumes(spark: SparkSession, tables: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows, files, bytes and last change per ``(layer, table, type, path)``, from file metadata."""
    parts = []
    for layer, name, kind, path in tables:
        files = read_table(spark, path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
            F.count(F.lit(1)).alias("n"),
            F.max("_metadata.file_size").alias("bytes"),
            F.max("_metadata.file_modification_time").alias("changed"))
        parts.append(files.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
            F.max("changed").alias("last_modified_at"),
        ).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_id"), F.lit(kind).alias("table_type"),
            "row_count", "size_bytes",
            F.round(F.col("size_bytes") / 1024 ** 2, 2).alias("size_mb"), "last_modified_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def layer_paths(layers: Mapping[str, Mapping[str, str]], kind: str = "table") -> list[tuple[str, str, str, str]]:
    return [(layer, name, kind, path) for layer, tables in layers.items() for name, path in tables.items()]
