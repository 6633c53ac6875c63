"""One row per event id over the whole table, however late a copy comes.

The ids that were loaded are a table of their own, dealt to folders by hash. A micro-batch is a few ids against many, so
the large side is only filtered: Spark prunes it to the buckets and ids of the batch, and what it finds is taken from
the batch. A stream's state and horizon play no part, so copies after weeks or from a query with another checkpoint are
found as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyward.operators.dedup import dedup_events
from tallyward.sources import versions
from tallyward.streaming.intake import write_batch

BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def seen_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """``(id, batch_id, bucket)`` of everything loaded, or None before the first batch."""
    folder = versions.current_folder(spark, path)
    return None if folder is None else spark.read.schema("id STRING, batch_id STRING, bucket INT").parquet(folder)


def new_rows(batch: DataFrame, key: str, order: Sequence[str | Column], path: str, batch_id: str,
             buckets: int = BUCKETS) -> DataFrame:
    """The first delivery in the batch of every id that no other batch has loaded.

    Ids loaded under this ``batch_id`` do not count, so a batch that runs again gives the same rows. Rows without an id
    cannot be told apart and stay. ``batch`` is read twice: persist it.
    """
    named = batch.where(F.col(key).isNotNull())
    first = dedup_events(named, key, order)
    loaded = seen_ids(batch.sparkSession, path)
    if loaded is not None:
        ids = named.select(F.col(key).cast("string").alias("id"), _bucket(key, buckets).alias("bucket")).distinct()
        found = loaded.where(F.col("batch_id") != batch_id).join(ids, ["bucket", "id"], "left_semi").select(
            F.col("id").alias("__seen"))
        first = first.join(found, F.col(key).cast("string") == F.col("__seen"), "left_anti")
    return first.unionByName(batch.where(F.col(key).isNull()))


def remember(rows: DataFrame, key: str, path: str, batch_id: str, buckets: int = BUCKETS) -> None:
    """Add the ids of loaded rows to the table. Adding a batch twice changes nothing that ``new_rows`` asks."""
    spark = rows.sparkSession
    ids = rows.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("id"), F.lit(batch_id).alias("batch_id"), _bucket(key, buckets).alias("bucket"))
    folder = versions.current_folder(spark, path)
    if folder is None:
        folder = f"{path.rstrip('/')}/version-first"
        ids.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        versions.publish(spark, path.rstrip("/"), "version-first")
        return
    ids.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(folder)


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the ids as one row each and few files per bucket, as a new version that is published when complete.

    Of an id the row of its first batch by name stays.
    """
    ids = seen_ids(spark, path)
    if ids is None:
        return
    slim = ids.groupBy("bucket", "id").agg(F.min("batch_id").alias("batch_id")).select("id", "batch_id", "bucket")
    name = f"version-{len(versions.commits(spark, path)) + 1}-{spark.sparkContext.applicationId}"
    slim.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/{name}")
    versions.publish(spark, path.rstrip("/"), name)
    versions.forget(spark, path.rstrip("/"))


def _loaded_schema(batch: DataFrame) -> StructType:
    return StructType([*batch.schema, StructField("batch_id", StringType())])


def unique_batch(table: str, seen: str, key: str, order: Sequence[str | Column], buckets: int = BUCKETS,
                 compact_every: int = 100, prefix: str = "batch") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that loads every id once into ``table``.

    First the rows, under the batch's own partition, then their ids: a failure between the two makes the batch run
    again with the same result.
    """
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        name = f"{prefix}-{query}-{number:08d}"
        batch.persist()
        try:
            write_batch(new_rows(batch, key, order, seen, name, buckets), name, table)
            loaded = spark.read.schema(_loaded_schema(batch)).parquet(table).where(F.col("batch_id") == name)
            remember(loaded, key, seen, name, buckets)
            if compact_every and number % compact_every == compact_every - 1:
                compact(spark, seen)
        finally:
            batch.unpersist()

    return run
