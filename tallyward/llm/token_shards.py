"""Token ids as binary shards, compressed by pair grammars, with random access to every document.

Shard file (one binary value, little endian): the magic ``TWRP1``, four unsigned 32-bit numbers (documents, rules,
symbols, vocabulary size), then arrays: rules as pairs of symbols (2 x uint32), the number of ids each rule expands to
(uint32), the first symbol of every document and the end (uint32), the symbols (uint16 when all fit, else uint32).
Symbols below the vocabulary size are ids; symbol ``vocabulary + i`` is rule i.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.bpe import encode_batches
from tallyward.llm.common import partitions, pick, ramp, stage

MAGIC = b"TWRP1"
HEAD = struct.Struct("<IIII")
SLOT_BITS = 18


def _slot(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def compress(ids: np.ndarray, lengths: np.ndarray, vocabulary_size: int, rounds: int = 4, rules_per_round: int = 4000,
             least: int = 6) -> bytes:
    """A shard of documents given as joined ids and their lengths.

    Every round counts all pairs of neighbouring symbols inside documents and replaces the most frequent ones (at most
    ``rules_per_round``, each seen at least ``least`` times) by new symbols; of overlapping pairs the more frequent
    one is replaced, of equal ones the left one. Rules may use symbols of earlier rounds.
    """
    symbols = ids.astype(np.int64)
    begins = np.r_[0, np.cumsum(lengths)]
    last = np.zeros(len(symbols), bool)
    last[begins[1:][lengths > 0] - 1] = True
    pairs, n_rules = [np.zeros((0, 2), np.int64)], 0
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        key = symbols[:-1] << 32 | symbols[1:]
        ordered = np.sort(key[~last[:-1]])
        if not len(ordered):
            break
        cut = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[cut, len(ordered)])
        top = np.flatnonzero(counts >= least)
        if not len(top):
            break
        top = top[np.argsort(-counts[top], kind="stable")][:rules_per_round]
        chosen = ordered[cut[top]]  # by falling count
        # A direct table of the chosen pairs. Of two in one slot the more frequent is kept, the other has its turn later.
        backward = chosen[::-1]
        held, ranks = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, np.int32)
        held[_slot(backward)] = backward
        ranks[_slot(backward)] = np.arange(len(chosen) - 1, -1, -1)
        slot = _slot(key)
        rank = np.full(len(symbols) + 1, len(chosen), np.int32)
        hit = np.flatnonzero((held[slot] == key) & ~last[:-1])
        rank[1:-1][hit] = ranks[slot[hit]]
        # rank[i + 1] belongs to the pair at i: replaced where it beats the pair before and is not beaten by the next.
        here = rank[1:-1]
        take = np.flatnonzero((here < len(chosen)) & (here < rank[:-2]) & (here <= rank[2:]))
        if not len(take):
            break
        seen = np.zeros(len(chosen), bool)
        seen[here[take]] = True
        used, number = np.flatnonzero(seen), (np.cumsum(seen) - 1)[here[take]]
        pairs.append(np.stack([chosen[used] >> 32, chosen[used] & 0xFFFFFFFF], 1))
        symbols[take] = vocabulary_size + n_rules + number
        last[take] = last[take + 1]
        keep = np.ones(len(symbols), bool)
        keep[take + 1] = False
        begins = np.r_[0, np.cumsum(keep)][begins]
        symbols, last = symbols[keep], last[keep]
        n_rules += len(used)
    rules = np.concatenate(pairs)
    sizes: list[int] = []
    for a, b in rules.tolist():
        sizes.append(sum(1 if x < vocabulary_size else sizes[x - vocabulary_size] for x in (a, b)))
    width = "<u2" if vocabulary_size + n_rules <= 1 << 16 else "<u4"
    return b"".join([MAGIC, HEAD.pack(len(lengths), n_rules, len(symbols), vocabulary_size),
                     rules.astype("<u4").tobytes(), np.array(sizes, "<u4").tobytes(), begins.astype("<u4").tobytes(),
                     symbols.astype(width).tobytes()])


class Shard:
    """A shard file opened for reading. Only the symbols of the documents asked for are expanded."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, n_rules, n_symbols, self.vocabulary_size = HEAD.unpack_from(data, len(MAGIC))
        at = len(MAGIC) + HEAD.size
        rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 8 * n_rules
        self.rule_sizes = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self.begins = np.frombuffer(data, "<u4", self.n_docs + 1, at).astype(np.int64)
        at += 4 * (self.n_docs + 1)
        width = "<u2" if self.vocabulary_size + n_rules <= 1 << 16 else "<u4"
        self.symbols = np.frombuffer(data, width, n_symbols, at)
        size = self.vocabulary_size
        whole: list[list[int]] = []
        for a, b in rules.tolist():
            whole.append(([a] if a < size else whole[a - size]) + ([b] if b < size else whole[b - size]))
        self.flat = np.array([i for x in whole for i in x], np.int64)
        self.starts = np.cumsum(self.rule_sizes) - self.rule_sizes

    def sizes(self) -> np.ndarray:
        """Ids of every document, from the expansion lengths alone."""
        one = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.vocabulary_size
        one[rule] = self.rule_sizes[self.symbols[rule].astype(np.int64) - self.vocabulary_size]
        return np.diff(np.r_[0, np.cumsum(one)][self.begins])

    def read(self, first: int, end: int | None = None) -> np.ndarray:
        """Ids of the documents from ``first`` up to ``end``."""
        symbols = self.symbols[self.begins[first]:self.begins[first + 1 if end is None else end]].astype(np.int64)
        rule = symbols >= self.vocabulary_size
        number = symbols[rule] - self.vocabulary_size
        sizes = np.ones(len(symbols), np.int64)
        sizes[rule] = self.rule_sizes[number]
        out = np.repeat(symbols, sizes)
        inside = np.repeat(rule, sizes)
        out[inside] = self.flat[np.repeat(self.starts[number], sizes[rule]) + ramp(sizes[rule])]
        return out


def write_shards(documents: DataFrame, vocabulary: str, vocabulary_size: int, end_id: int = 1,
                 shard_ids: int = 2_000_000) -> DataFrame:
    """Write all texts as shards in ascending doc_id order and return the written table.

    Columns: ``part`` and ``seq`` (the order of the shards), ``doc_ids``, ``n_ids`` and ``shard`` (the file). Each
    document's ids end with ``end_id``; a null or empty text is the end id alone. A null doc_id comes first, repeated
    ids are ordered by a hash of their text, so equal rows are interchangeable. A shard takes whole documents until it
    has ``shard_ids`` ids (a longer document is a shard of its own); an empty table has no shards.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list = []
        parts: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        seq = part = total = 0

        def shard() -> pa.RecordBatch:
            flat, sizes = np.concatenate(parts), np.concatenate(lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([len(flat)], pa.int64()), pa.array([compress(flat, sizes, vocabulary_size)], pa.binary())],
                names=["part", "seq", "doc_ids", "n_ids", "shard"])

        for batch in encode_batches(batches, vocabulary):
            if not batch.num_rows:
                continue
            part = batch.column(1)[0].as_py()
            column = batch.column(2)
            sizes = np.diff(column.offsets.to_numpy())
            ids = np.insert(column.flatten().to_numpy(), np.cumsum(sizes), end_id)
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            keys = batch.column(0).to_pylist()
            at = 0
            while at < len(keys):
                done = int(ends[at - 1]) if at else 0
                fit = max(at + (not names), int(np.searchsorted(ends, done + shard_ids - total, "right")))
                if fit > at:
                    names += keys[at:fit]
                    parts.append(ids[done:ends[fit - 1]])
                    lengths.append(sizes[at:fit])
                    total += int(ends[fit - 1]) - done
                at = fit
                if at < len(keys) or total >= shard_ids:
                    yield shard()
                    names, parts, lengths, total, seq = [], [], [], 0, seq + 1
        if names:
            yield shard()

    rows = pick(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(
        partitions(documents.sparkSession), F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select("doc_id", F.spark_partition_id().alias("part"), "text")
    return stage(ordered.mapInArrow(
        work, "part int, seq int, doc_ids array<long>, n_ids long, shard binary"), "token-shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """``(part, seq, base)``: ids in all shards before. One row per partition meets in one task, not one per shard."""
    sizes = shards.select("part", "seq", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("here", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_base") + F.col("here")).alias("base"))


def read_shards(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the shard files."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, keys, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(data)
                flat = shard.read(0, shard.n_docs).astype("<u4")
                ends = np.cumsum(shard.sizes())
                starts = np.r_[0, ends[:-1]]
                sums = [zlib.crc32(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([part] * len(keys), pa.int32()),
                     pa.array([seq] * len(keys), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "part", "seq", "within", "n_tokens", "ids_crc32"])

    read = shards.select("part", "seq", "doc_ids", "shard").mapInArrow(
        work, "doc_id long, part int, seq int, within long, n_tokens long, ids_crc32 long")
    return read.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
