"""Alignment of the tokens of two tokenizers by interval coalescing over bytes."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pick, ramp, release, slices, span_codes, stage, text_bytes

CACHE_ENTRIES = 400_000
SLICE, BLOCK = 512 << 10, 2 << 20  # bytes of text
# A page is packed and unpacked whole outside the heap; by default a hundred rows are taken before its size is looked at.
PAGES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
_BLANK = "▁"


class _Bytes:
    """The bytes of every id of a vocabulary: their lengths, where each begins, and all of them joined."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.begins[ids], sizes) + ramp(sizes)]


@cache
def _decimal(size: int) -> _Bytes:
    """Numbers below ``size`` as text, each with a comma behind it."""
    return _Bytes([str(i).encode() + b"," for i in range(size)])


def _byte_level() -> dict[str, int]:
    """The byte of every stand-in letter: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in plain else next(spare)): b for b in range(256)}


class ByteTokens:
    """A byte-level BPE file of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task on each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_level()
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes = _Bytes([bytes(letters.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)])

    def encode(self, chunks: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)
        return [x.ids for x in found]


class PieceTokens:
    """A sentencepiece model, which adds the space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = _Bytes([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(_BLANK, " ").encode()
                             for i, n in enumerate(names)])
        # Whether no piece continues over a space: then what stands before a space and after it are encoded apart.
        self.cuts = not any(_BLANK in n.lstrip(_BLANK) for n in names)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode(chunks, num_threads=1)


class Pair:
    """Two tokenizers, and a bounded memory of the chunks that they have encoded."""

    def __init__(self, first: str, second: str):
        self.sides = (ByteTokens(first), PieceTokens(second))
        self.clear()

    def clear(self) -> None:
        self.codes = np.zeros(0, np.uint64)
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in self.sides]

    def _chunks(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and owner of the chunks of all texts: each text is cut at its spaces, which go with what
        follows.

        At a space between two characters that are no space (nor the stand-in of one) both tokenizers begin a token
        whatever stands around it: the first one's pattern takes a space together with the visible character behind it,
        and no piece of the second one continues over a space. The space itself is added again by both encoders.
        """
        if not self.sides[1].cuts or len(flat) < 3:
            begins = starts[:-1]
            ends = starts[1:]
            owner = np.arange(len(begins))
        else:
            cut = np.zeros(len(flat), bool)
            before, behind = flat[:-2], flat[2:]
            # 0x81 ends the stand-in of a space; 0xC2 and 0xE1 to 0xE3 begin all white space beyond ASCII.
            cut[1:-1] = (flat[1:-1] == 32) & (before != 32) & (before != 0x81) & (behind > 32) & (behind != 0xC2)
            cut[1:-1] &= (behind < 0xE1) | (behind > 0xE3)
            cut[starts[starts < len(flat)]] = False  # before the first character stands the added space
            cut[starts[1:][starts[1:] > starts[:-1]] - 1] = False
            at = np.flatnonzero(cut)
            texts = np.flatnonzero(starts[1:] > starts[:-1])
            # A chunk begins behind its space, a text's first chunk with the text.
            begins = np.r_[starts[:-1][texts], at + 1]
            order = np.argsort(begins, kind="stable")
            owner = np.r_[texts, np.searchsorted(starts, at, "right") - 1][order]
            begins = begins[order]
            stops = np.r_[begins[1:] - 1, len(flat)]
            final = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
            stops[final] = starts[owner[final] + 1]
            return begins, stops, owner
        some = ends > begins
        return begins[some], ends[some], owner[some]

    def encode(self, flat: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both tokenizers: ids of all texts joined, and the text of each id."""
        if len(self.codes) > CACHE_ENTRIES:
            self.clear()
        begin, end, owner = self._chunks(flat, starts)
        codes = span_codes(flat, begin, end)
        distinct, place, inverse = np.unique(codes, return_index=True, return_inverse=True)
        new = np.ones(len(distinct), bool)
        if len(self.codes):
            new = self.codes[np.minimum(np.searchsorted(self.codes, distinct), len(self.codes) - 1)] != distinct
        if new.any():
            data, where = flat.tobytes(), place[new]
            chunks = [data[a:b].decode() for a, b in zip(begin[where].tolist(), end[where].tolist(), strict=True)]
            merged = np.r_[self.codes, distinct[new]]
            order = np.argsort(merged)
            for i, side in enumerate(self.sides):
                found = side.encode(chunks)
                size = np.fromiter(map(len, found), np.int64, len(found))
                starts_, sizes_, ids = self.kept[i]
                fresh = np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))
                self.kept[i] = (np.r_[starts_, len(ids) + np.cumsum(size) - size][order], np.r_[sizes_, size][order],
                                np.r_[ids, fresh])
            self.codes = merged[order]
        at = np.searchsorted(self.codes, distinct)[inverse] if len(distinct) else inverse
        out = []
        for begins, sizes, ids in self.kept:
            n = sizes[at]
            out.append((ids[np.repeat(begins[at], n) + ramp(n)].astype(np.int64), np.repeat(owner, n)))
        return out


@cache
def pair(first: str, second: str) -> Pair:
    return Pair(first, second)


class Aligned:
    """Tokens of the texts of one slice in groups.

    ``ids``, ``side`` (0: first tokenizer, 1: second), ``owner`` (the text), ``start``, ``end`` (bytes, counted over the
    slice) and ``group`` (counted over the slice), in order of group, side and place. ``link_a`` and ``link_b`` are the
    positions of tokens whose ranges end together.
    """

    def __init__(self, flat: np.ndarray, starts: np.ndarray, tokens: Pair):
        # With the space before each text: text i begins at starts[i] + i.
        n = len(starts) - 1
        bounds = starts + np.arange(n + 1)
        spaced = np.insert(flat, starts[:-1], 32) if n else flat
        sizes = np.diff(starts)
        good = sizes > 0
        found = tokens.encode(flat, starts)
        for side, (ids, owner) in zip(tokens.sides, found, strict=True):
            length = np.bincount(owner, side.bytes.sizes[ids], minlength=n).astype(np.int64)
            good &= length == sizes + 1
        for side, (ids, owner) in zip(tokens.sides, found, strict=True):
            ids, owner = ids[good[owner]], owner[good[owner]]
            want = spaced[np.repeat(good, sizes + 1)]
            wrong = np.flatnonzero(side.bytes.spell(ids) != want)
            texts = np.flatnonzero(good)
            ends = np.cumsum(sizes[texts] + 1)
            good[texts[np.unique(np.searchsorted(ends, wrong, "right"))]] = False
        parts = []
        for i, (side, (ids, owner)) in enumerate(zip(tokens.sides, found, strict=True)):
            ids, owner = ids[good[owner]], owner[good[owner]]
            size = side.bytes.sizes[ids]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
            begins = np.cumsum(size) - size
            begins += np.repeat(bounds[owner[first]] - begins[first], np.diff(np.r_[first, len(owner)]))
            parts.append((ids, np.full(len(ids), i), owner, begins, begins + size))
        ids, side, owner, start, end = [np.concatenate(x) for x in zip(*parts, strict=True)]
        # Interval coalescing: a group begins where a start reaches the running maximum of the ends before it.
        order = np.lexsort((side, start))
        reach = np.maximum.accumulate(end[order])
        fresh = np.r_[True, start[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, bool)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(fresh) - 1
        inside = np.argsort(group * 2 + side, kind="stable")
        self.ids, self.side, self.owner = ids[inside], side[inside], owner[inside]
        self.start, self.end, self.group = start[inside], end[inside], group[inside]
        self.good, self.n_texts, self.bounds = good, n, bounds
        a, b = np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1)
        low = np.searchsorted(self.end[b], self.end[a], "left")
        n_same = np.searchsorted(self.end[b], self.end[a], "right") - low
        self.link_a, self.link_b = np.repeat(a, n_same), b[np.repeat(low, n_same) + ramp(n_same)]

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all pairs of a first and a second token that share a byte, each inside one group."""
        a, b = np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1)
        low = np.searchsorted(self.end[b], self.start[a], "right")
        n = np.maximum(np.searchsorted(self.start[b], self.end[a], "left") - low, 0)
        return np.repeat(a, n), b[np.repeat(low, n) + ramp(n)]

    def per_text(self, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.owner[at], weights, minlength=self.n_texts).astype(np.int64)

    def first_of_group(self) -> np.ndarray:
        return np.flatnonzero(np.r_[True, self.group[1:] != self.group[:-1]]) if len(self.ids) else np.zeros(0, np.int64)

    def written(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text: ids in order, empty without tokens."""
        ids, last = self.ids, len(self.ids)
        if not last:
            return [b""] * self.n_texts
        names = _decimal(1 << int(ids.max()).bit_length())
        size = names.sizes[ids]
        out = names.spell(ids)
        stops = np.cumsum(size) - 1
        new_group = self.group[1:] != self.group[:-1]
        mark = np.where(new_group, 59, np.where(self.side[1:] != self.side[:-1], 124, 44))
        out[stops[:-1]] = mark
        edge = np.searchsorted(self.owner, np.arange(self.n_texts + 1))
        place = np.r_[0, stops + 1][edge].tolist()
        data = out.tobytes()
        return [data[a:max(a, b - 1)] for a, b in zip(place[:-1], place[1:], strict=True)]


def align(documents: DataFrame, first: str, second: str) -> DataFrame:
    """``(doc_id, groups)``: per text its groups as ``array<struct<start, end, a array<int>, b array<int>>>``.

    ``start`` and ``end`` are bytes of the text with a space before it; ``a`` and ``b`` hold the ids of both tokenizers
    (files ``first`` and ``second``) inside them. A null or empty text, or one whose tokens do not spell it, has no
    groups. Repeated rows stay, null ids stay null, further columns are left out, an empty table has no result.
    """
    one = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(ids, pa.int32()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = Aligned(*text_bytes(batch.column(1)), pair(first, second))
            head, n_groups = found.first_of_group(), len(found.first_of_group())
            sides = [found.side == i for i in (0, 1)]
            tail = np.r_[head[1:], len(found.ids)] - 1
            base = found.bounds[found.owner[head]]
            fields = [pa.array(found.start[head] - base), pa.array(found.end[tail] - base)]
            fields += [lists(found.ids[s], np.bincount(found.group[s], minlength=n_groups)) for s in sides]
            groups = pa.StructArray.from_arrays(fields, fields=list(one))
            counts = found.per_text(head)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), groups)],
                names=["doc_id", "groups"])

    rows = pick(documents, "doc_id", "text")
    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, groups array<struct<start: long, end: long, "
                                 "a: array<int>, b: array<int>>>")


_BLOCK = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, links binary, pairs array<long>, counts array<long>")
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")
_COPIED = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(first: str, second: str):
    def block(number: int, held: list[tuple]) -> pa.RecordBatch:
        doc_ids, n_a, n_b, n_groups, n_links, digests, pairs, places, counts = zip(*held, strict=True)
        known, at = np.unique(np.concatenate(pairs), return_inverse=True)
        sums = np.bincount(at, np.concatenate(counts), minlength=len(known)).astype(np.int64)
        cut = np.cumsum([0, *map(len, pairs)])
        kind = "<u2" if len(known) <= 1 << 16 else "<u4"
        links = b"".join([at[a:b][place].astype(kind).tobytes()
                          for a, b, place in zip(cut[:-1], cut[1:], places, strict=True)])
        row = [number, *(np.concatenate(x) for x in (doc_ids, n_a, n_b, n_groups, n_links)), sum(digests, []), links,
               known, sums]
        kinds = [pa.int64()] + [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string()), pa.binary()]
        kinds += [pa.list_(pa.int64())] * 2
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)],
                                          names=[f.split()[0] for f in _BLOCK.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in slices(batches, "text", SLICE):
            flat, starts = text_bytes(batch.column(1))
            found = Aligned(flat, starts, pair(first, second))
            linked = found.ids[found.link_a] << 32 | found.ids[found.link_b]
            pairs, place, counts = np.unique(linked, return_inverse=True, return_counts=True)
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in found.written()]
            held.append((np.array(batch.column(0).to_pylist(), object), found.per_text(np.flatnonzero(found.side == 0)),
                         found.per_text(np.flatnonzero(found.side == 1)), found.per_text(found.first_of_group()),
                         found.per_text(found.link_a), digests, pairs, place.astype("<u4"), counts))
            size += len(flat)
            if size >= BLOCK:
                yield block(part << 32 | seq, held)
                seq, held, size = seq + 1, [], 0
        if held:
            yield block(part << 32 | seq, held)

    return work


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the corpus-wide counts of their pairs become their documents."""
    pair.cache_clear()  # a worker that has encoded texts holds both tokenizers, which are done with
    release()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            count, best = [row[c].values.to_numpy() if row[c].is_valid else np.zeros(0, np.int64) for c in ("total", "best")]
            links = np.frombuffer(row["links"].as_buffer(), "<u2" if len(count) <= 1 << 16 else "<u4")
            n_links = row["n_links"].values.to_numpy()
            owner = np.repeat(np.arange(len(n_links)), n_links)
            sums = [np.zeros(len(n_links), np.int64) for _ in range(2)]
            np.add.at(sums[0], owner, best[links])
            np.add.at(sums[1], owner, count[links])
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, *(row[c].values for c in _COPIED), *map(pa.array, sums),
                 row["groups_sha256"].values], names=[f.split()[0] for f in _OUT.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, total, best)``: links of every pair of ids over all blocks, and whether it is its second id's highest."""
    total = stage(blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("one")).groupBy(
        F.col("one.pairs").alias("pair")).agg(F.sum("one.counts").alias("total")), "align-totals")
    second = F.col("pair").bitwiseAND((1 << 32) - 1)
    highest = total.groupBy(second.alias("second")).agg(F.max("total").alias("highest"))
    return total.withColumn("second", second).join(highest, "second").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))


def alignment_report(documents: DataFrame, first: str, second: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per row of ``documents``.

    Links are the pairs of a first and a second token whose byte ranges end together. ``count_sum`` adds up, over a
    text's links, how many links of the whole corpus hold the same pair of ids; ``n_best`` counts the links whose pair
    is the most frequent one of its second id (ties included). ``groups_sha256`` is the digest of the groups written as
    ``a1,a2|b1;a3|b2,b3``, or empty without tokens. Cases as in ``align``.

    Texts are encoded once, in slices of about half a MB (a longer text is a slice of its own), into a written table of one row
    per block of about 2 MB: what its documents hold, its distinct pairs with their numbers, and its links as places
    among these. Only distinct pairs of blocks are shuffled by pair; their counts come back to the block, not to the
    driver.
    """
    rows = pick(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    blocks = stage(rows.mapInArrow(_blocks(first, second), _BLOCK), "align-blocks", **PAGES)
    known = pair_counts(blocks)
    told = blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(known, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "total", "best"))).alias("told"))
    told = told.select("block", F.col("told.total").alias("total"), F.col("told.best").alias("best"))
    return blocks.drop("pairs", "counts").join(told, "block", "left").mapInArrow(_sums, _OUT)
