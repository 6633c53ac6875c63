"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import WORD, pick, stage

MOST_EPOCHS = 3
ROWS_PER_BUCKET = 1_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``(source, source_size, n_docs, target)`` from ``(source, source_size, n_docs)``, one row per source.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes; a target stops at three
    times its source's size, and what is over is shared again. That is the level L with target = min(limit, L * weight):
    with sources by limit / weight, the first k are at their limit, k being the smallest number for which the rest
    stays below. All sums are whole numbers, so the targets do not depend on the order of summing.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    placed = sizes.withColumn("__weight", F.element_at(cycle, (
        (F.row_number().over(ordered) - 1) % len(weights) + 1)))
    placed = placed.withColumn("__limit", F.col("source_size") * MOST_EPOCHS)
    by_ratio = Window.orderBy(F.col("__limit") / F.col("__weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    steps = placed.withColumns({
        "__left": F.sum("source_size").over(everything) - F.coalesce(F.sum("__limit").over(before), F.lit(0)),
        "__weights": F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0))})
    # The first source whose limit is not reached by the level of the remaining ones; all later ones share that level.
    free = F.col("__left") * F.col("__weight") <= F.col("__limit") * F.col("__weights")
    first = F.min(F.when(free, F.struct(F.col("__limit") / F.col("__weight"), "source",
                                        F.col("__left"), F.col("__weights")))).over(everything)
    steps = steps.withColumns({"__first": first, "__free": F.coalesce(free, F.lit(False))})
    level = F.col("__first.__left").cast("double") * F.col("__weight") / F.col("__first.__weights")
    return steps.select("source", "source_size", "n_docs", F.when(
        F.col("__free"), level).otherwise(F.col("__limit").cast("double")).alias("target"))


def sampling_key(weight: Column, *seeds: Column) -> Column:
    """An exponential number with rate ``weight`` drawn from a hash: small keys come first, reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*seeds), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / weight


def mix(documents: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3),
        seed: int = 7) -> DataFrame:
    """``(doc_id, source, size, source_size, target, epochs, taken)``, one row per document row.

    ``size`` is the number of words of the text (null: 0). Every document is taken for each complete epoch that fits
    into its source's target; the rest of the target is drawn by Efraimidis-Spirakis sampling: exponential keys with
    the document's quality weight as rate, sorted within the source, prefix sums against the rest. A document is drawn
    when at least half of it lies below the rest, so a source misses its target by half a document at most. ``quality``
    (doc_id, quality 0 or 1) doubles the rate of good documents and halves that of bad ones; unlabelled ones, also
    those with a null id, have rate 1, several labels count as the best. Repeated rows are separate documents; rows of
    equal key are taken in the order of id and size. A null source is a source. Empty texts have size 0 and are taken
    0 words. An empty table has no result.

    A source is cut into buckets by ranges of the key, about ``ROWS_PER_BUCKET`` rows each: the prefix sums of whole
    buckets come from one row per bucket, and only the bucket in which the rest ends is sorted row by row.
    """
    return _mixed(documents, quality, weights, seed).drop("text_hash")


def draw(documents: DataFrame, columns: tuple[str, ...], **options) -> DataFrame:
    """The named columns of every document, once for each time that ``mix`` takes it.

    Rows that repeat an id, a source and a text share their draws; which of them is repeated makes no difference
    unless they differ in another column.
    """
    times = _mixed(documents, **options).where("epochs > 0").groupBy("doc_id", "source", "text_hash").agg(
        F.sum("epochs").alias("__times"))
    times = times.toDF("__id", "__source", "__hash", "__times")
    rows = pick(documents, *dict.fromkeys(("doc_id", "source", "text", *columns))).withColumn("__text", _text_hash())
    rows = rows.join(times, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
                     & (F.col("__text") == F.col("__hash")))
    one = Window.partitionBy("doc_id", "source", "__text").orderBy(F.lit(1))
    rows = rows.withColumn("__row", F.row_number().over(one)).where("__row = 1")
    return rows.withColumn("__copy", F.explode(F.expr("sequence(1, __times)"))).select(*columns)


def _text_hash() -> Column:
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def _mixed(documents: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3),
           seed: int = 7) -> DataFrame:
    rows = pick(documents, "doc_id", "source", "text").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _text_hash().alias("text_hash"))
    if quality is not None:
        best = pick(quality, "doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").alias("__good"))
        rows = rows.join(best, "doc_id", "left")
    else:
        rows = rows.withColumn("__good", F.lit(None).cast("int"))
    rate = F.when(F.col("__good") > 0, 2.0).when(F.col("__good") <= 0, 0.5).otherwise(1.0)
    key = sampling_key(rate, F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text_hash"))
    rows = stage(rows.select("doc_id", "source", "text_hash", "size", key.alias("key")), "mix-rows")

    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goals = source_targets(totals, weights)
    goals = goals.withColumn("epochs", F.least(F.lit(MOST_EPOCHS), F.coalesce(
        F.floor(F.try_divide("target", "source_size")), F.lit(0))).cast("long"))
    goals = stage(goals.withColumns({
        "rest": F.col("target") - F.col("epochs") * F.col("source_size"),
        "n_buckets": (F.col("n_docs") / ROWS_PER_BUCKET).cast("long") + 1}), "mix-goals")

    goal = goals.select(F.col("source").alias("__source"), *[c for c in goals.columns if c not in ("source", "n_docs")])
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    # 1 - exp(-key) spreads the keys evenly over the buckets for rate 1 and keeps their order for every rate.
    placed = placed.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * F.col("n_buckets")))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"), F.first("rest").alias("rest"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    sums = sums.select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"), "before", "bucket_size")
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")),
                         "left").drop("__source", "__bucket")
    whole = F.col("before") + F.col("bucket_size") <= F.col("rest")
    none = F.col("before") >= F.col("rest")
    columns = ["doc_id", "source", "text_hash", "size", "source_size", "target", "epochs"]
    settled = placed.where(whole | none).select(*columns, whole.alias("drawn"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = placed.where(~whole & ~none)
    reached = F.col("before") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0)) + F.col("size") / 2
    cut = cut.select(*columns, (reached <= F.col("rest")).alias("drawn"))
    out = settled.unionAll(cut)
    epochs = F.col("epochs") + F.col("drawn").cast("long")
    return out.select("doc_id", "source", "text_hash", "size", "source_size", "target", epochs.alias("epochs"),
                      (F.col("size") * epochs).alias("taken"))
