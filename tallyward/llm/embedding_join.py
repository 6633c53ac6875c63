"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors whose cosine reaches the threshold lie within epsilon of each other, and so do their projections on any
orthonormal directions. Distinct vectors are sorted by label and by the grid cells of their leading principal
coordinates and cut into sequence intervals (blocks). Blocks are the leaves of a tree of intervals; the join goes down
this tree pair by pair and leaves out pairs whose bounding boxes are further apart than epsilon.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import partitions, pick, stage
from tallyward.llm.components import Forest, components

DIMENSIONS = 12  # leading principal coordinates of the grid and of the bounding boxes
BLOCK = 512
FANOUT = 3  # bits: eight children to a node
SLACK = 1e-9


def _unit(flat: np.ndarray, dimension: int) -> np.ndarray:
    rows = flat.reshape(-1, dimension).astype(np.float64)
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def principal_directions(vectors: DataFrame, dimension: int, how_many: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of all unit vectors (dimension x how_many).

    Each task sums the products of its vectors; one matrix of fixed size per task is added up.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(batch.column(0).flatten().to_numpy(), dimension)
                total += unit.T @ unit
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["line", "sums"])

    lines = vectors.select("vector").mapInArrow(work, "line int, sums array<double>")
    sums = lines.select("line", F.posexplode("sums").alias("place", "x")).groupBy("line", "place").agg(
        F.sum("x").alias("x"))
    matrix = np.zeros((dimension, dimension))
    for line, place, x in sums.collect():  # dimension squared numbers
        matrix[line, place] = x
    _, axes = np.linalg.eigh((matrix + matrix.T) / 2)
    return axes[:, ::-1][:, :how_many]


_PROJECTED = "rep long, copies long, label string, vector array<double>, cells array<int>"
_BLOCKS = "label string, part int, seq int, reps binary, copies binary, vectors binary, low array<double>, high array<double>"


def _grid(axes: np.ndarray, dimension: int, epsilon: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(batch.column(3).flatten().to_numpy(), dimension)
            cells = np.floor(unit @ axes / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(list(unit), pa.list_(pa.float64())),
                 pa.array(list(cells), pa.list_(pa.int32()))], names=["rep", "copies", "label", "vector", "cells"])

    return work


def _cut(axes: np.ndarray, dimension: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of one partition as blocks of one label and at most ``BLOCK`` rows."""
        seq, pending = 0, None

        def block(label, part, reps, copies, unit):
            nonlocal seq
            place = unit @ axes
            seq += 1
            return (label, part, seq - 1, reps.tobytes(), copies.tobytes(), unit.tobytes(),
                    place.min(0).tolist(), place.max(0).tolist())

        def emit(rows):
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                     pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=[f.split()[0] for f in _BLOCKS.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            labels = np.array(batch.column(2).to_pylist())
            reps, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            unit = batch.column(3).flatten().to_numpy().reshape(-1, dimension)
            part = batch.column(4)[0].as_py()
            heads = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(labels)], strict=True):
                mine = (str(labels[a]), part, reps[a:b], copies[a:b], unit[a:b])
                if pending and pending[0] == mine[0]:
                    mine = (*mine[:2], *(np.concatenate([x, y]) for x, y in zip(pending[2:], mine[2:], strict=True)))
                elif pending:
                    yield emit([block(*pending)])
                while len(mine[2]) > BLOCK:
                    yield emit([block(*mine[:2], *(x[:BLOCK] for x in mine[2:]))])
                    mine = (*mine[:2], *(x[BLOCK:] for x in mine[2:]))
                pending = mine
        if pending:
            yield emit([block(*pending)])

    return work


def _pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """``(a, b)``, a <= b: pairs of blocks of one label whose boxes come within epsilon, found from the top down."""
    most = blocks.agg(F.max("part").alias("part"), F.max("seq").alias("seq")).first()
    bits = max(1, int(most["seq"]).bit_length())
    height = math.ceil((bits + int(most["part"]).bit_length()) / FANOUT)
    leaves = blocks.select("label", "block", (F.shiftleft("part", bits) + F.col("seq")).alias("node"), "low", "high")
    boxes = [leaves]
    for _ in range(height):
        parts = range(_box_size(blocks))
        upper = boxes[-1].groupBy("label", F.shiftright("node", FANOUT).alias("node")).agg(
            F.array(*[F.min(F.col("low")[i]) for i in parts]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in parts]).alias("high"))
        boxes.append(upper)
    pairs = boxes[-1].select("label", F.col("node").alias("a"), F.col("node").alias("b"))
    for box in reversed(boxes[:-1]):
        def child(name: str, box: DataFrame = box) -> DataFrame:
            return box.select(F.col("label").alias(f"{name}_label"), F.shiftright("node", FANOUT).alias(f"{name}_up"),
                              F.col("node").alias(f"{name}_node"), F.col("low").alias(f"{name}_low"),
                              F.col("high").alias(f"{name}_high"))
        both = pairs.join(child("l"), (F.col("label") == F.col("l_label")) & (F.col("a") == F.col("l_up")))
        both = both.join(child("r"), (F.col("label") == F.col("r_label")) & (F.col("b") == F.col("r_up")))
        gap = F.aggregate(F.arrays_zip("l_low", "l_high", "r_low", "r_high"), F.lit(0.0), lambda s, x: s + F.pow(
            F.greatest(F.lit(0.0), x["l_low"] - x["r_high"], x["r_low"] - x["l_high"]), F.lit(2.0)))
        pairs = both.where((F.col("l_node") <= F.col("r_node")) & (gap <= epsilon * epsilon + SLACK)).select(
            "label", F.col("l_node").alias("a"), F.col("r_node").alias("b"))
    name = leaves.select("label", "node", "block")
    out = pairs.join(name.select("label", F.col("node").alias("a"), F.col("block").alias("left")), ["label", "a"])
    out = out.join(name.select("label", F.col("node").alias("b"), F.col("block").alias("right")), ["label", "b"])
    return out.select("left", "right")


def _box_size(blocks: DataFrame) -> int:
    return blocks.select(F.size("low")).first()[0]


_FOUND = "a long, b long, links long"


def _join(threshold: float, dimension: int):
    def work(table: pa.Table) -> pa.Table:
        """Of one pair of blocks: per vector the number of others it links with (b null), and a spanning forest."""
        rows = sorted(table.to_pylist(), key=lambda r: r["side"])
        ids, copies, unit = ([np.frombuffer(r[c], t) for r in rows] for c, t in (
            ("reps", "<i8"), ("copies", "<i8"), ("vectors", "<f8")))
        unit = [x.reshape(-1, dimension) for x in unit]
        self_pair = len(rows) == 1
        i, j = np.nonzero(unit[0] @ unit[-1].T >= threshold - SLACK)
        if self_pair:
            i, j = i[i < j], j[i < j]
        # The matrix product may round otherwise than a plain sum of products; what is near is computed again.
        exact = np.concatenate([np.einsum("ij,ij->i", unit[0][i[s:s + 65536]], unit[-1][j[s:s + 65536]])
                                for s in range(0, len(i), 65536)] or [np.zeros(0)])
        i, j = i[exact >= threshold], j[exact >= threshold]
        left = np.bincount(i, copies[-1][j], minlength=len(ids[0])).astype(np.int64)
        right = np.bincount(j, copies[0][i], minlength=len(ids[-1])).astype(np.int64)
        out = [(a, None, n) for side, counts in ((0, left), (-1, right)) for a, n in zip(
            ids[side].tolist(), counts.tolist(), strict=True) if n]
        shift = 0 if self_pair else len(ids[0])
        forest = Forest(shift + len(ids[-1]))
        names = ids[0].tolist() + ([] if self_pair else ids[1].tolist())
        for x, y in zip(i.tolist(), (j + shift).tolist(), strict=True):
            if forest.join(x, y):
                out.append((names[x], names[y], 0))
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])

    return work


def near_vectors(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``embeddings`` (vec_id, embedding, label).

    Two vectors link when their labels are equal and not null and their cosine, in double precision, is at least
    ``threshold`` (which has to be above 0). Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths. ``n_links`` counts the other vectors linked directly,
    copies included; ``component_id`` is the smallest vec_id reachable by links, itself included; ``kept`` says that a
    vector is that one. A null vec_id takes part, but is the smallest only if all of a component are; repeated rows are
    copies. An empty table has no result. Equal vectors of a label are joined once, with their number of copies.
    """
    rows = pick(embeddings, "vec_id", "embedding", "label").withColumn("vec_id", F.col("vec_id").cast("long"))
    wide = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad & F.exists(
        "vector", lambda x: x != 0)
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), wide.alias("vector"))
    # Minus zero is zero.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    key = ["label", "vector"]
    good = rows.where("usable")
    classes = good.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    name = F.xxhash64("label", "vector")
    classes = stage(classes.select(*key, "copies", "first", name.alias("rep")), "vector-classes")
    found = [_links(classes.where(F.size("vector") == n), n, threshold)
             for (n,) in sorted(classes.select(F.size("vector")).distinct().collect())]  # lengths of vectors
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    degree = links.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    labels = components(links.where("b IS NOT NULL")).withColumnRenamed("node", "rep").withColumnRenamed(
        "label", "place")
    placed = classes.select("rep", "copies", "first").join(degree, "rep", "left").join(labels, "rep", "left")
    placed = placed.withColumn("place", F.coalesce("place", "rep"))
    least = placed.groupBy("place").agg(F.min("first").alias("component_id"))
    placed = stage(placed.join(least, "place").select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vector-placed")
    own = rows.select("vec_id", F.when(F.col("usable"), name).alias("rep"))
    return own.join(placed, "rep", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))


def _links(classes: DataFrame, dimension: int, threshold: float) -> DataFrame:
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    axes = principal_directions(classes, dimension, min(DIMENSIONS, dimension))
    projected = classes.select("rep", "copies", "label", "vector").mapInArrow(
        _grid(axes, dimension, epsilon), _PROJECTED)
    ordered = projected.repartitionByRange(partitions(classes.sparkSession), "label", "cells", "rep")
    ordered = ordered.sortWithinPartitions("label", "cells", "rep").withColumn("part", F.spark_partition_id())
    blocks = ordered.select("rep", "copies", "label", "vector", "part").mapInArrow(_cut(axes, dimension), _BLOCKS)
    blocks = stage(blocks.withColumn("block", F.shiftleft(F.col("part").cast("long"), 32) + F.col("seq")),
                   "vector-blocks")
    pairs = stage(_pairs(blocks.withColumns({c: F.col(c).cast("long") for c in ("part", "seq")}), epsilon),
                  "vector-pairs")
    content = blocks.select("block", "reps", "copies", "vectors")
    sides = pairs.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    sides = sides.join(content, "block").withColumn("side", (F.col("block") == F.col("right")).cast("int"))
    found = sides.groupBy("left", "right").applyInArrow(_join(threshold, dimension), _FOUND)
    return stage(found, "vector-links")
