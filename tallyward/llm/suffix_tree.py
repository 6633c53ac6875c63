"""Scores of texts by a probabilistic suffix tree, beside a smoothed unigram model.

A text is a sequence of symbols: the letters of its words, each word closed by an end-of-word symbol, and one end symbol
in place of a further word, so the model is a distribution over texts. A context is the ``DEPTH`` or fewer symbols before
a symbol, across word boundaries and back to the start of the text. A context is a state when its next-symbol
distribution diverges enough from that of its longest proper suffix. A symbol is scored in the state of the longest suffix.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import (
    _SPACE, FOLD, distinct_sorted, mix, partitions, pick, release, slices, stage, text_bytes, words_of)

DEPTH = 5
PIECE = 1 << 20  # bytes of text worked on at once
PIECES = 16  # pieces in a block
SLICE = 64 << 20  # bytes of text for each slice of the codes
UNIT = 2.0 ** -36  # log10 probabilities are sent as multiples of this
WORD = -1  # ``b`` of a word
PRIOR = 2.0  # weight of the next shorter context in a smoothed distribution, in observations
DIVERGENCE = 2.0  # a state gains this many nats for each symbol it predicts

START, WORD_END, TEXT_END, UNKNOWN = 0x110000, 0x110001, 0x110002, 0x110003
N_CODE_POINTS = 0x110000
_BASE = 0x9E3779B97F4A7C15


def _spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next symbols of all words joined (letters, then the end of the word), owner and place in the word of each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    symbols = np.insert(letters, np.cumsum(sizes), WORD_END)
    sizes = sizes + 1
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    return symbols, owner, np.arange(len(symbols)) - begins[owner]


def _contexts(symbols: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Context hashes of every symbol for depths 0 to DEPTH; 0 where the word is not that long.

    The last symbol of a context that reaches the start of its word is START.
    """
    padded = np.r_[np.zeros(DEPTH, np.int64), symbols]
    total = np.zeros(len(symbols), np.uint64)
    out = [mix(total + np.uint64(1))]
    power = 1
    for depth in range(1, DEPTH + 1):
        before = padded[DEPTH - depth:len(padded) - depth]
        before = np.where(place == depth - 1, START, before).astype(np.uint64)
        total = total + (before + np.uint64(1)) * np.uint64(power)
        power = power * _BASE % (1 << 64)
        out.append(np.where(place >= depth - 1, mix(total + np.uint64(depth + 1)), np.uint64(0)))
    return out


def _step(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    # Not symmetric: a context and a symbol of swapped values differ.
    return mix(context * np.uint64(_BASE) + mix(symbol.astype(np.uint64) + np.uint64(77)))


_START_CONTEXTS = [int(c[0].astype(np.int64)) for c in _contexts(np.array([TEXT_END]), np.array([0]))[:2]]


# -- words of the corpus -----------------------------------------------------------------------------------------

def word_counts(documents: DataFrame) -> DataFrame:
    """``(word, c)``: every word of (text, held_out) with its number in texts that are not held out (may be 0)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, starts = text_bytes(batch.column(0))
            begin, end, code, first = words_of(flat, starts, fold=True)
            if not len(code):
                continue
            train = np.repeat(~batch.column(1).to_numpy(zero_copy_only=False), np.diff(first))
            _, at, inverse = np.unique(code, return_index=True, return_inverse=True)
            counts = np.bincount(inverse, train).astype(np.int64)
            data = FOLD[flat].tobytes()
            words = [data[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)],
                                             names=["word", "c"])

    return documents.select("text", "held_out").mapInArrow(work, "word string, c long").groupBy("word").agg(
        F.sum("c").alias("c"))


# -- the tree ----------------------------------------------------------------------------------------------------

def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, context, parent, symbol, n) summed over all words of a task."""
    names = ["depth", "context", "parent", "symbol", "n"]
    held: list[np.ndarray] = []
    weights: list[np.ndarray] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, n = np.concatenate(held, axis=1), np.concatenate(weights)
        code = _step(keys[1].view(np.uint64), keys[3])
        _, at, inverse = np.unique(code, return_index=True, return_inverse=True)
        return keys[:, at], np.bincount(inverse, n)

    for batch in batches:
        batch = batch.filter(pa.compute.greater(batch.column(1), 0))
        if not batch.num_rows:
            continue
        symbols, owner, place = _spell(batch.column(0).to_pylist())
        n = batch.column(1).to_numpy().astype(float)[owner]
        contexts = _contexts(symbols, place)
        for depth, context in enumerate(contexts):
            there = context != 0
            parent = contexts[depth - 1][there] if depth else np.zeros(there.sum(), np.uint64)
            held.append(np.stack([np.full(there.sum(), depth), context[there].view(np.int64), parent.view(np.int64),
                                  symbols[there]]))
            weights.append(n[there])
        if sum(map(len, weights)) > 1_000_000:
            keys, n = merged()
            held, weights = [keys], [n]
            if len(n) > 500_000:  # bounded memory: what has gathered so far goes on to Spark's aggregation
                yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(n.astype(np.int64))], names=names)
                held, weights = [], []
    if held:
        keys, n = merged()
        yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(n.astype(np.int64))], names=names)


def fit_states(words: DataFrame, n_texts: int, most_states: int | None = None,
               divergence: float = DIVERGENCE) -> DataFrame:
    """``(depth, context, parent, symbol, n)`` of the states of single words: all contexts retained by the test.

    A context is retained when coding what follows it by its own distribution instead of its suffix's saves at least
    ``divergence`` nats for each symbol it predicts, and so are all its suffixes; with ``most_states`` only those of
    the largest savings. For studies of words with ``Tree``; ``score`` fits whole texts and has no such limit.
    """
    ends = words.sparkSession.createDataFrame(
        [(0, _START_CONTEXTS[0], 0, TEXT_END, n_texts), (1, _START_CONTEXTS[1], _START_CONTEXTS[0], TEXT_END, n_texts)],
        "depth long, context long, parent long, symbol long, n long").where("n > 0")
    seen = words.select("word", "c").mapInArrow(
        _observe, "depth long, context long, parent long, symbol long, n long").unionAll(ends)
    seen = stage(seen.groupBy("depth", "context", "parent", "symbol").agg(F.sum("n").alias("n")).withColumn(
        "total", F.sum("n").over(Window.partitionBy("context"))), "tree-counts")
    above = seen.select(F.col("context").alias("parent"), "symbol", (F.col("n") / F.col("total")).alias("above"))
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("above")))
    tested = seen.where("depth > 0").join(above, ["parent", "symbol"]).groupBy("depth", "context", "parent").agg(
        gain.alias("gain"), F.count(F.lit(1)).alias("n_symbols"))
    chosen = tested.where(F.col("gain") >= divergence * F.col("n_symbols"))
    if most_states is not None:
        chosen = chosen.orderBy(F.desc("gain"), "context").limit(most_states)
    chosen = stage(chosen.select("depth", "context", "parent"), "tree-chosen")
    kept = chosen.select("context").unionAll(chosen.select(F.col("parent").alias("context")))
    last = chosen
    for _ in range(DEPTH - 1):  # the suffixes of a retained context are states too
        last = tested.select("depth", "context", "parent").join(
            last.select(F.col("parent").alias("context")).distinct(), "context", "left_semi")
        kept = kept.unionAll(last.select("context")).unionAll(last.select(F.col("parent").alias("context")))
    root = seen.where("depth = 0").select("context")
    states = kept.unionAll(root).distinct()
    return seen.join(states, "context", "left_semi").select("depth", "context", "parent", "symbol", "n")


class Tree:
    """The states as sorted arrays: log10 probabilities of the seen next symbols, and what unseen ones lose."""

    def __init__(self, rows: pa.Table, prior: float = PRIOR):
        columns = [rows.column(i).to_numpy() for i in range(5)]
        depth, context, parent, symbol, n = columns
        context, parent = context.view(np.uint64), parent.view(np.uint64)
        self.states, inverse = np.unique(context, return_inverse=True)
        total = np.bincount(inverse, n, minlength=len(self.states)) if len(n) else np.zeros(0)
        self.lost = np.log10(prior / (total + prior))
        code = _step(context, symbol)
        order = np.argsort(code)
        self.codes = code[order]
        root = depth == 0
        self.alphabet = np.unique(symbol[root])
        # Root: one more observation for every known symbol, and one for all unknown ones together.
        size = n[root].sum() + len(self.alphabet) + 1
        self.unknown = math.log10(1 / size / N_CODE_POINTS)
        p = np.zeros(len(n))
        p[root] = (n[root] + 1) / size
        for d in range(1, DEPTH + 1):
            here = depth == d
            if here.any():
                # A symbol seen after a context was seen after its suffix, which is a state.
                up = order[np.searchsorted(self.codes, _step(parent[here], symbol[here]))]
                p[here] = (n[here] + prior * p[up]) / (total[inverse[here]] + prior)
        self.logs = np.log10(p, where=p > 0, out=np.full(len(p), -np.inf))[order]

    def score(self, words: list[str]) -> np.ndarray:
        """log10 probability of every word, its end included."""
        symbols, owner, place = _spell(words)
        return np.bincount(owner, self._letters(symbols, place), minlength=len(words))

    def text_end(self) -> float:
        return float(self._letters(np.array([TEXT_END]), np.array([0]))[0])

    def _letters(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        contexts = _contexts(symbols, place)
        out = np.full(len(symbols), self.unknown)
        if not len(self.states):
            return out
        level = np.zeros(len(symbols), np.int64)
        number = np.zeros((DEPTH + 1, len(symbols)), np.int64)
        for depth, context in enumerate(contexts):
            at = np.minimum(np.searchsorted(self.states, context), len(self.states) - 1)
            number[depth] = at
            level[(self.states[at] == context) & (level == max(0, depth - 1))] = depth
        lost = np.zeros(len(symbols))
        open_ = np.ones(len(symbols), bool)
        for depth in range(DEPTH, -1, -1):
            here = np.flatnonzero(open_ & (level >= depth))
            code = _step(contexts[depth][here], symbols[here])
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            out[here[hit]] = self.logs[at[hit]] + lost[here[hit]]
            open_[here[hit]] = False
            lost[here[~hit]] += self.lost[number[depth][here[~hit]]] if depth else 0.0
        out[open_] = self.unknown + lost[open_]
        return out


# -- the tree of whole texts --------------------------------------------------------------------------------------

# A gram is a symbol and the DEPTH symbols before it, 21 bits each: the symbol and the nearest two in ``a``, the other
# three in ``b``. The part of a gram that depth d knows is what is left under the masks of d.
_BITS = 21
_ONE, _TWO, _ALL = (1 << _BITS) - 1, (1 << 2 * _BITS) - 1, (1 << 3 * _BITS) - 1
_MASKS = [(_ONE, 0), (_TWO, 0), (_ALL, 0), (_ALL, _ONE), (_ALL, _TWO), (_ALL, _ALL)]


def _symbols(flat: np.ndarray, starts: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of joined texts with words ending at the bytes ``end``, and how many each text has."""
    letter = ~_SPACE[flat]
    letters = np.frombuffer(FOLD[flat[letter]].tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
    before = np.r_[0, np.cumsum(letter & ((flat & 0xC0) != 0x80))]
    closes, stops = before[end], before[starts[1:]]
    symbols = np.insert(letters, np.r_[closes, stops], np.repeat([WORD_END, TEXT_END], [len(closes), len(stops)]))
    return symbols, np.diff(np.r_[0, stops + np.searchsorted(end, starts[1:], "right") + np.arange(1, len(starts))])


def _grams(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a`` and ``b`` of the gram of every symbol; START stands in every place before the text."""
    padded = np.insert(symbols, np.repeat(np.cumsum(sizes) - sizes, DEPTH), START)
    near = padded.copy()
    near[1:] |= padded[:-1] << _BITS
    near[2:] |= padded[:-2] << 2 * _BITS
    far = np.zeros_like(near)
    far[3:] = near[:-3]
    own = padded != START
    return near[own], far[own]


def _gram_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    code = mix(b.view(np.uint64) + np.uint64(77))
    code += a.view(np.uint64) * np.uint64(_BASE)
    return mix(code)


_BLANK = bytes(32 if _SPACE[i] else int(FOLD[i]) for i in range(256))


class Alphabet:
    """Numbers for the symbols of some texts, so that a gram is one number of six digits; START has number 0."""

    DIGIT = 10  # bits

    def __init__(self):
        letters = [i for i in range(33, 127) if FOLD[i] == i]
        self.symbols = [START, WORD_END, TEXT_END, *letters]
        self.number = np.zeros(N_CODE_POINTS, np.uint16)  # of letters; 0: none yet
        self.number[letters] = np.arange(3, len(self.symbols))
        self.number[32] = 1  # the space behind a word stands for its end

    def digits(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The symbols of joined texts by number, DEPTH times START before each text, and how many others each has.

        None, and nothing changes, when there are too many different letters.
        """
        folded = np.frombuffer(flat.tobytes().translate(_BLANK), np.uint8)
        space = folded == 32
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]  # the first space after a word
        inner = starts[(starts > 0) & (starts < len(flat))]
        keep[inner] = ~space[inner]
        data = folded[keep]
        if len(data) and data.max() > 127:
            data = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
            keep &= (flat & 0xC0) != 0x80
        number = self.number[data]
        if not number.all():
            new = np.array(sorted(set(data[number == 0].tolist())))
            if len(self.symbols) + len(new) > 1 << self.DIGIT:
                return None
            self.number[new] = np.arange(len(self.symbols), len(self.symbols) + len(new))
            self.symbols += new.tolist()
            number = self.number[data]
        # After the letters of a text: the end of a word that no space follows, the end of the text.
        bounds = np.r_[0, np.cumsum(keep, dtype=np.int32)][starts].astype(np.int64)
        open_ = np.diff(starts) > 0
        open_[open_] = ~space[starts[1:][open_] - 1]
        values = np.tile(np.array([0] * DEPTH + [1, 2], np.uint16), (len(open_), 1))
        there = np.ones(values.shape, bool)
        there[:, DEPTH] = open_
        at = np.repeat(np.stack([bounds[:-1], bounds[1:]], 1), [DEPTH, 2], axis=1)
        return np.insert(number, at[there], values[there]).astype(np.int32), np.diff(bounds) + open_ + 1

    @staticmethod
    def pack(digit: np.ndarray, bits: int = DIGIT) -> np.ndarray:
        """The gram of every symbol."""
        near = digit.copy()
        near[1:] |= digit[:-1] << bits
        near[2:] |= digit[:-2] << 2 * bits
        gram = near.astype(np.int64)
        gram[3:] |= near[:-3].astype(np.int64) << 3 * bits
        return gram[digit > 0]

    def grams(self, packed: np.ndarray, bits: int = DIGIT) -> tuple[np.ndarray, np.ndarray]:
        """``a`` and ``b`` of packed grams."""
        symbols, mask = np.array(self.symbols), (1 << bits) - 1
        digits = [symbols[packed >> i * bits & mask] for i in range(DEPTH + 1)]
        return tuple(x | y << _BITS | z << 2 * _BITS for x, y, z in (digits[:3], digits[3:]))


class Counter:
    """Counts of packed grams, gathered by sorting."""

    RAW, MOST, ROWS = 4_000_000, 2_000_000, 500_000

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.alphabet = Alphabet()
        self.raw: list[np.ndarray] = []
        self.gram = self.n = np.zeros(0, np.int64)

    def add(self, gram: np.ndarray, held_out: np.ndarray) -> None:
        self.raw.append(gram << 1 | held_out)
        if sum(map(len, self.raw)) > self.RAW:
            self._gather()

    def _gather(self) -> None:
        key = np.concatenate([*self.raw, np.zeros(0, np.int64)])
        self.raw.clear()
        key.sort()
        n = ~key & 1
        key >>= 1
        gram, n = self._sums(key, n)
        gram, n = np.concatenate([self.gram, gram]), np.concatenate([self.n, n])
        order = np.argsort(gram, kind="stable")  # two sorted runs: they are merged
        self.gram, self.n = self._sums(gram[order], n[order])

    @staticmethod
    def _sums(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
        return gram[first], np.add.reduceat(n, first) if len(first) else n

    def rows(self) -> Iterator[tuple[np.ndarray, ...]]:
        """All that has gathered, as ``a``, ``b`` and ``n``; it starts anew."""
        self._gather()
        for i in range(0, len(self.gram), self.ROWS):
            yield (*self.alphabet.grams(self.gram[i:i + self.ROWS]), self.n[i:i + self.ROWS])
        self.clear()


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each entry's code among the distinct codes, and these, by first appearance (a hash table, no sort)."""
    place, distinct = pd.factorize(code)
    return place.astype(np.int32), distinct


def text_counts(documents: DataFrame) -> DataFrame:
    """``(a, b, n)``: every gram of (text, held_out) with its number in texts that are not held out (may be 0).

    Rows whose ``b`` is ``WORD`` count words instead; their ``a`` is the word's 64-bit hash.
    """
    names = ["a", "b", "n"]

    def merged(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        place, distinct = _distinct(_gram_codes(a, b))
        at = np.empty(len(distinct), np.int32)
        at[place[::-1]] = np.arange(len(place) - 1, -1, -1, dtype=np.int32)
        return a[at], b[at], np.bincount(place, n, minlength=len(distinct)).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # words, and grams of pieces with too many different letters
        n_held = n_merged = 0
        counter = Counter()

        def packed() -> Iterator[pa.RecordBatch]:
            for columns in counter.rows():
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=names)

        def merge() -> None:
            nonlocal held, n_held, n_merged
            rows = tuple(map(np.concatenate, zip(*held, strict=True)))
            held.clear()
            held.append(merged(*rows))
            n_held = n_merged = len(held[0][0])

        for batch in slices(batches, "text", PIECE):
            flat, starts = text_bytes(batch.column(0))
            _, end, code, first = words_of(flat, starts, fold=True)
            train = ~batch.column(1).to_numpy(zero_copy_only=False)
            digits = counter.alphabet.digits(flat, starts)
            if digits is None:
                yield from packed()
                digits = counter.alphabet.digits(flat, starts)
            if digits is not None:
                counter.add(Alphabet.pack(digits[0]), np.repeat(~train, digits[1]))
                if len(counter.gram) > Counter.MOST:  # bounded memory: this goes on to Spark's aggregation
                    yield from packed()
            else:
                symbols, sizes = _symbols(flat, starts, end)
                held.append(merged(*_grams(symbols, sizes), np.repeat(train, sizes)))
                n_held += len(held[-1][0])
            held.append(merged(code.view(np.int64), np.full(len(code), WORD), np.repeat(train, np.diff(first))))
            n_held += len(held[-1][0])
            if n_held > n_merged + 800_000:
                merge()
                if n_held > 1_200_000:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, held[0])], names=names)
                    held, n_held, n_merged = [], 0, 0
        if held:
            merge()
            yield pa.RecordBatch.from_arrays([*map(pa.array, held[0])], names=names)
        yield from packed()
        release()

    return documents.select("text", "held_out").mapInArrow(work, "a long, b long, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n"))


def _fit_part(divergence: float, prior: float):
    """Of all grams that share their two nearest context symbols, the probabilities as ``alpha + beta * p1``.

    ``p1`` is the probability of the symbol by the depth below 2; ``state`` says that a context of depth 2 or more that
    ends in those two symbols is a state.
    """
    def work(table: pa.Table) -> pa.Table:
        a, b, n, n1, t1 = [table.column(c).to_numpy() for c in ("a", "b", "n", "n1", "t1")]
        levels = []
        up_n, up_total = n1, t1
        for mask_a, mask_b in _MASKS[2:]:
            # Numbers of the (context, symbol) and of the context of each gram at this depth.
            below = b & mask_b
            _, at, inverse = np.unique(_gram_codes(a & mask_a, below), return_index=True, return_inverse=True)
            count = np.bincount(inverse, n)
            _, context = np.unique(_gram_codes(a >> _BITS, below)[at], return_inverse=True)
            total = np.bincount(context, count)
            some = count > 0
            own = at[some]
            gain = np.bincount(context[some], count[some] * np.log(
                count[some] / total[context[some]] / (up_n[own] / up_total[own])), minlength=len(total))
            kept = (total > 0) & (gain >= divergence * np.bincount(context[some], minlength=len(total)))
            levels.append((count[inverse], total[context][inverse], kept, context[inverse]))
            up_n, up_total = levels[-1][:2]
        states, deeper = [], np.zeros(len(n), bool)
        for _, total, kept, context in reversed(levels):  # the suffixes of a retained context are states too
            kept = kept | (np.bincount(context, deeper, minlength=len(kept)) > 0)
            deeper = kept[context]
            states.append(deeper)
        alpha, beta = np.zeros(len(n)), np.ones(len(n))
        for (count, total, _, _), state in zip(levels, reversed(states), strict=True):
            alpha = np.where(state, (count + prior * alpha) / (total + prior), alpha)
            beta = np.where(state, prior * beta / (total + prior), beta)
        release()
        return pa.table({"a": a, "b": b, "alpha": alpha, "beta": beta, "state": states[-1]})

    return work


def fit_texts(grams: DataFrame, divergence: float = DIVERGENCE, prior: float = PRIOR,
              n_parts: int | None = None) -> DataFrame:
    """``(a, b, log)``: the log10 probability of the symbol of every gram, of training or not.

    A context is a state when coding what follows it by its own distribution instead of its suffix's saves at least
    ``divergence`` nats for each symbol it predicts; all of them and their suffixes are, whatever their number. In a
    state p = (n + prior * p of the next shorter context) / (total + prior).
    """
    spark = grams.sparkSession
    roots = grams.groupBy(F.col("a").bitwiseAND(_ONE).alias("symbol")).agg(F.sum("n").alias("n0"))
    pairs = stage(grams.groupBy(F.col("a").bitwiseAND(_TWO).alias("pair")).agg(F.sum("n").alias("n1")), "tree-pairs")
    n, size = roots.agg(F.coalesce(F.sum("n0"), F.lit(0)), F.count(F.when(F.col("n0") > 0, 1))).first()
    size += n + 1  # one more observation for every known symbol, and one for all unknown ones together
    last = F.shiftright("pair", _BITS)
    own = Window.partitionBy("last")
    counted = F.when(F.col("n1") > 0, F.col("n1") * F.log(F.col("n1") / F.col("t1") / (F.col("n0") / F.lit(n))))
    pairs = stage(pairs.withColumn("last", last).withColumn("symbol", F.col("pair").bitwiseAND(_ONE)).join(
        roots, "symbol").withColumn("t1", F.sum("n1").over(own)).withColumn("gain", counted).withColumn(
        "kept", F.sum("gain").over(own) >= divergence * F.count("gain").over(own)).select(
        "pair", "last", "n1", "t1", "n0", F.coalesce("kept", F.lit(False)).alias("kept")), "tree-pairs")
    near = pairs.select("pair", "n1", "t1")
    parts = grams.withColumn("pair", F.col("a").bitwiseAND(_TWO)).join(near, "pair").withColumn(
        "part", F.expr(f"pmod(xxhash64(shiftright(a, {_BITS})), {n_parts or 4 * partitions(spark)})"))
    fitted = stage(parts.select("part", "a", "b", "n", "n1", "t1").groupBy("part").applyInArrow(
        _fit_part(divergence, prior), "a long, b long, alpha double, beta double, state boolean"), "tree-parts", compression="zstd")
    suffixes = fitted.where("state").select(F.shiftright(F.col("a").bitwiseAND(_TWO), _BITS).alias("last")).distinct()
    p0 = F.when(F.col("n0") > 0, (F.col("n0") + 1) / F.lit(size)).otherwise(1 / size / N_CODE_POINTS)
    p1 = F.when(F.col("kept") | F.col("deeper"), (F.col("n1") + prior * p0) / (F.col("t1") + prior)).otherwise(p0)
    first = pairs.join(suffixes.withColumn("deeper", F.lit(True)), "last", "left").select(
        "pair", p1.alias("p1"))
    return fitted.withColumn("pair", F.col("a").bitwiseAND(_TWO)).join(first, "pair").select(
        "a", "b", F.log10(F.col("alpha") + F.col("beta") * F.col("p1")).alias("log"))


# -- scores of texts ---------------------------------------------------------------------------------------------

# Kind 0: codes of words and grams that a block asks of a slice, or the values of them; kind 1: some documents of a
# block; kind 2: codes and their values. ``check`` is the CRC of the
# block's texts, of kind 1 the place of the piece.
_ASKED = "kind int, slice int, block long, check long, codes binary, numbers binary, held binary, doc_ids array<long>"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
          "double": pa.float64(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, compressed by planes of bytes: small ones and such of similar size become short."""
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(data: bytes, dtype: str = "<u8") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(dtype).ravel()


def _values(code: np.ndarray, value: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted codes, all of them in the sorted ``code``; asked in order, so that the search stays in cache."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), value.dtype)
    out[order] = value[np.searchsorted(code, wanted[order])]
    return out


def _by_slice(code: np.ndarray, n_slices: int) -> list[tuple[int, int, int]]:
    """(slice, begin, end) of the sorted codes; slices are ranges of codes, empty ones are left out."""
    to = ((code >> np.uint64(40)) * np.uint64(n_slices)) >> np.uint64(24)
    cuts = np.searchsorted(to, np.arange(n_slices + 1, dtype=np.uint64)).tolist()
    return [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]


def _gaps(code: np.ndarray) -> bytes:
    return _pack(np.diff(code, prepend=np.uint64(0)))


def _codes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=np.uint64)


def _gram_set(flat: np.ndarray, starts: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The distinct codes of all grams."""
    alphabet = Alphabet()
    digits = alphabet.digits(flat, starts)
    if digits is None:
        return pd.unique(_gram_codes(*_grams(*_symbols(flat, starts, end))))
    packed = distinct_sorted([Alphabet.pack(digits[0]).view(np.uint64)])
    return _gram_codes(*alphabet.grams(packed.view(np.int64)))


def _gram_places(flat: np.ndarray, starts: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each gram's code, the distinct codes, and how many grams each text has."""
    alphabet = Alphabet()
    digits = alphabet.digits(flat, starts)
    if digits is None:
        symbols, sizes = _symbols(flat, starts, end)
        return (*_distinct(_gram_codes(*_grams(symbols, sizes))), sizes)
    digit, sizes = digits
    bits, low = (len(alphabet.symbols) - 1).bit_length(), len(digit).bit_length()
    packed = Alphabet.pack(digit, bits)
    if (DEPTH + 1) * bits + low > 63:
        place, distinct = _distinct(packed)
    else:  # a gram and its place are one number to sort
        packed <<= low
        packed |= np.arange(len(packed))
        packed.sort()
        order = packed & ((1 << low) - 1)
        packed >>= low
        fresh = np.ones(len(packed), bool)
        np.not_equal(packed[1:], packed[:-1], out=fresh[1:])
        place, distinct = np.empty(len(packed), np.int32), packed[fresh]
        place[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return place, _gram_codes(*alphabet.grams(distinct, bits)), sizes


def _asked(flat: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the words and of the grams: the place of each one's code, the distinct codes, and how many each text has."""
    _, end, code, first = words_of(flat, starts, fold=True)
    return [(*_distinct(code), np.diff(first)), _gram_places(flat, starts, end)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(block, is its last piece, piece): both readers of the documents cut them into the same pieces and blocks."""
    last = None
    for seq, piece in enumerate(slices(batches, "text", PIECE)):
        if last is not None:
            yield part << 32 | (seq - 1) // PIECES, seq % PIECES == 0, last
        last, part = piece, piece.column(3)[0].as_py()
    if last is not None:
        yield part << 32 | seq // PIECES, True, last


def _ask(n_slices: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, check = [], 0
        for block, ends, piece in _blocks(batches):
            flat, starts = text_bytes(piece.column(2))
            check = zlib.crc32(flat, check)
            _, end, code, _ = words_of(flat, starts, fold=True)
            held += [pd.unique(code), _gram_set(flat, starts, end)]
            if ends:
                code = distinct_sorted(held)
                yield _batch([(0, i, block, check, _gaps(code[a:b]), b"", b"", None)
                              for i, a, b in _by_slice(code, n_slices)], _ASKED)
                held, check = [], 0

    return work


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for seq, (block, _, piece) in enumerate(_blocks(batches)):
        flat, starts = text_bytes(piece.column(2))
        held = piece.column(1).to_numpy(zero_copy_only=False)
        yield _batch([(1, 0, block, seq, zstandard.compress(flat.tobytes(), 1), _pack(starts.astype("<i8")),
                       held.astype("u1").tobytes(), piece.column(0).to_pylist())], _ASKED)


def _tell(n_slices: int, words: bool):
    """Codes and values by slice: numbers of words, or log10 probabilities of grams, negative and in ``UNIT``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, value = [batch.column(i).to_numpy() for i in range(3)]
            code = a.view(np.uint64) if words else _gram_codes(a, b)
            value = value if words else np.rint(-value / UNIT).astype(np.int64)
            order = np.argsort(code)
            code, value = code[order], value[order]
            yield _batch([(2, i, 0, 0, _gaps(code[a:b]), _pack(value[a:b]), b"", None)
                          for i, a, b in _by_slice(code, n_slices)], _ASKED)

    return work


def _answer(table: pa.Table) -> pa.Table:
    """Of one slice: the values of the codes that each block asks for, in its order."""
    rows = table.select(["kind", "slice", "block", "check", "codes", "numbers"]).to_pylist()
    told = [r for r in rows if r["kind"] == 2]
    code = np.concatenate([_codes(r["codes"]) for r in told] or [np.zeros(0, "<u8")])
    order = np.argsort(code)
    code = code[order]
    value = np.concatenate([_unpack(r["numbers"], "<i8") for r in told] or [np.zeros(0, "<i8")])[order]
    out = [(0, r["slice"], r["block"], r["check"], b"", _pack(value[np.searchsorted(code, _codes(r["codes"]))]), b"", None)
           for r in rows if r["kind"] == 0]
    release()
    return pa.Table.from_batches([_batch(out, _ASKED)])


_SCORED = "doc_id long, held_out boolean, n_words long, known long, base double, logs double"


def _sum_block(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    heads = sorted((r for r in rows if r["kind"] == 1), key=lambda r: r["check"])
    answers = sorted((r for r in rows if r["kind"] == 0), key=lambda r: r["slice"])
    pieces, check = [], 0
    for r in heads:
        flat = np.frombuffer(zstandard.decompress(r["codes"]), np.uint8)
        check = zlib.crc32(flat, check)
        pieces.append(_asked(flat, _unpack(r["numbers"], "<i8")))
    code = distinct_sorted([x[1] for piece in pieces for x in piece])
    value = np.concatenate([_unpack(r["numbers"], "<i8") for r in answers] or [np.zeros(0, "<i8")])
    if len(code) != len(value) or any(r["check"] != check for r in answers):
        raise RuntimeError("the documents came in another order when they were read again; write them to a table first")
    out: list[tuple] = []
    for head, ((word, words, n_words), (gram, grams, n_grams)) in zip(heads, pieces, strict=True):
        counts, logs = _values(code, value, words)[word], _values(code, value, grams)[gram]
        n = len(n_words)
        of_word, of_gram = np.repeat(np.arange(n), n_words), np.repeat(np.arange(n), n_grams)
        known = np.bincount(of_word, counts > 0, minlength=n).astype(np.int64)
        out += zip(head["doc_ids"], (np.frombuffer(head["held"], "u1") > 0).tolist(), n_words.tolist(), known.tolist(),
                   np.bincount(of_word, np.log10(counts + 1), minlength=n).tolist(),
                   (-UNIT * np.bincount(of_gram, logs, minlength=n)).tolist(), strict=True)
    release()
    return pa.Table.from_batches([_batch(out, _SCORED)])


def score(documents: DataFrame, fold: int = 7, held: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``documents``.

    A text's tokens are its words (A-Z lower-cased) and one end. Both models learn from the texts that are not held
    out: those whose ``crc32(doc_id as text) mod fold`` is not ``held`` (a null id counts as empty text). ``base_score``
    is the sum of log10((c + 1) / (N + V + 1)) over the tokens, ``score`` the log10 probability that the tree gives the
    text, ``n_known`` the tokens seen in training. A null or empty text is its end alone. Repeated rows are separate
    texts; an empty table has no result; without training texts every symbol is unknown.

    Words and grams (a symbol and its context) are counted once over the corpus, and every distinct gram is scored once,
    in written tables. A block of documents asks ranges of a 64-bit hash for the values of its distinct words and grams,
    so no vocabulary and no tree is held whole by any task, nor by the driver. A symbol's log10 probability is rounded to
    ``UNIT``. The documents are read three times and have to come in the same order, as from a table of files.
    """
    spark = documents.sparkSession
    rows = pick(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.select("doc_id", (F.crc32(text_id) % fold == held).alias("held_out"), "text")
    n_texts, n_bytes = rows.agg(F.count(F.when(~F.col("held_out"), 1)),
                                F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_slices = max(partitions(spark), -(-n_bytes // SLICE))
    counts = stage(text_counts(rows), "tree-counts", compression="zstd")
    words, grams = counts.where(F.col("b") == WORD), counts.where(F.col("b") != WORD)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    n_train = totals[0] + n_texts
    size = n_train + totals[1] + (n_texts > 0) + 1

    parted = rows.withColumn("part", F.spark_partition_id())
    asked = parted.mapInArrow(_ask(n_slices), _ASKED)
    told = words.mapInArrow(_tell(n_slices, True), _ASKED).unionAll(
        fit_texts(grams, n_parts=4 * n_slices).mapInArrow(_tell(n_slices, False), _ASKED))
    answers = asked.unionAll(told).groupBy("slice").applyInArrow(_answer, _ASKED)
    sums = answers.unionAll(parted.mapInArrow(_heads, _ASKED)).groupBy("block").applyInArrow(_sum_block, _SCORED)
    n_tokens = F.col("n_words") + 1
    return sums.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("known") + int(n_texts > 0)).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(n_texts + 1) - n_tokens * math.log10(size)).alias("base_score"),
        F.col("logs").alias("score"))
