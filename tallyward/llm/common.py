"""Helpers shared by the operators: column choice, written tables, words of a batch of texts as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact name (the first of that name); all others, clashing or not, are left out."""
    places = [df.columns.index(name) for name in names]
    return df.toDF(*[f"__{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"__{i}").alias(name) for i, name in zip(places, names)])


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


# -- texts of one Arrow batch as numpy arrays --------------------------------------------------------------------

# Odd 64-bit multipliers of the rolling hash; any odd numbers with well mixed bits do.
_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xD6E8FEB86659FD93 | 1
_P_INV = pow(_P, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, kept until longer ones are needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = (n + (1 << 20) - 1) >> 20 << 20
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def distinct_sorted(codes: list[np.ndarray]) -> np.ndarray:
    """The distinct ones of many 64-bit numbers in order, by sorting in place (``np.unique`` fills a hash table first)."""
    code = np.concatenate([*codes, np.zeros(0, np.uint64)])
    code.sort()
    first = np.ones(len(code), bool)
    np.not_equal(code[1:], code[:-1], out=first[1:])
    return code[first]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column joined, and where each text starts (one more entry than texts); null: empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]] if len(offsets) else flat[:0], offsets - offsets[0]


def span_codes(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: a rolling hash by prefix sums, then mixed. An empty range is 0."""
    size = len(flat)
    letters = flat.astype(np.uint64)
    letters += np.uint64(1)
    letters *= _power(_P, size)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(letters, out=total[1:])
    return mix((total[end] - total[begin]) * _power(_P_INV, size + 1)[begin])


def words_of(flat: np.ndarray, starts: np.ndarray, fold: bool = False) -> tuple[np.ndarray, ...]:
    """Words of joined texts: first byte, end, 64-bit hash, and per text the number of its first word.

    ``fold`` lower-cases A-Z. Texts are kept apart even where no white space does.
    """
    size = len(flat)
    if not size:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    space = _SPACE[flat]
    edge = np.empty(size + 1, bool)
    edge[0] = edge[size] = True
    np.not_equal(space[1:], space[:-1], out=edge[1:size])
    edge[starts] = True
    cuts = np.flatnonzero(edge)
    runs = ~space[cuts[:-1]]
    begin, end = cuts[:-1][runs], cuts[1:][runs]
    return begin, end, span_codes(FOLD[flat] if fold else flat, begin, end), np.searchsorted(begin, starts)


def windows(code: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text, and the place of each one's first word."""
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * np.uint64(_Q) + code[i:i + n]
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + width <= ends)
    return mix(total[at]), at


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for every length l, joined."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


@cache
def _libc():
    return ctypes.CDLL(None)


def release() -> None:
    """Give memory that arrays have left back to the machine: a worker outlives its task and would hold its peak."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have about ``most`` bytes; a longer single text is a batch of its own."""
    for batch in batches:
        flat, starts = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            release()
            at = end
