"""BPE encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyward.llm.common import FOLD, pick, ramp, slices, text_bytes, words_of

# White space of the vocabulary's pattern (Unicode White_Space) and the pattern that splits a text.
SPACES = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"

NONE = np.int64(1) << 40
CACHE_ENTRIES = 600_000


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Merges as sorted pair keys with ranks and results, symbols of single bytes, and the tokens by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        order = np.argsort(left << 32 | right)
        self.keys = (left << 32 | right)[order]
        self.ranks = np.arange(len(merges))[order]
        self.results = np.array([ids[a + b] for a, b in merges], np.int64)[order]
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + WORD_END] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: t for t, i in ids.items()}, **{i: t for t, i in self.special.items()}}
        self.tokens = [names.get(i, "").encode() for i in range(max(names) + 1)]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words joined, and the number of ids of each word (no word is empty).

        All words are one flat array. In every round each unfinished word replaces the occurrences of its pair of
        lowest rank, left to right; words without a known pair are finished.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[letters]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[letters[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[1:] == owner[:-1])
            rank = np.full(len(symbols), NONE)
            rank[:-1][known] = self.ranks[at[known]]
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[begins, len(owner)])
            lowest = np.minimum.reduceat(rank, begins)
            finished = np.repeat(lowest == NONE, sizes)
            if finished.any():
                done.append((owner[finished], symbols[finished]))
            hit = np.flatnonzero((rank == np.repeat(lowest, sizes)) & ~finished)
            if not len(hit):
                break
            # Overlapping occurrences (only of a symbol with itself): every second one of a run, from the left.
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            hit = hit[ramp(np.diff(np.r_[run, len(hit)])) % 2 == 0]
            symbols[hit] = self.results[at[hit]]
            keep = ~finished
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners = np.concatenate([o for o, _ in done])
        flat = np.concatenate([s for _, s in done])[np.argsort(owners, kind="stable")]
        return flat, np.bincount(owners, minlength=len(words))


@cache
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts by their distinct white-space separated chunks, of which a bounded number is remembered.

    Chunks are told apart by a 64-bit hash.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(PIECES + r"|\n")
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")")
        self.clear()

    def clear(self) -> None:
        self.codes = np.zeros(0, np.uint64)  # sorted
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _split(self, text: str) -> list[str]:
        # Lower-cased letter by letter, as the tokenizer does: no final sigma.
        return self.pieces.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _words(self, chunks: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Words of all chunks joined, and the number of words of each; a special token is a word of its own.

        Chunks hold no line end, and nothing composes across one, so they are split together.
        """
        words = self._split("\n".join([c.decode() for c in chunks]) + "\n")
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, words), bool, len(words)))
        counts = np.diff(np.r_[-1, ends]) - 1
        marked = [i for i, c in enumerate(chunks) if b"<|" in c and self.special.search(c.decode())]
        if marked:
            begins = np.r_[0, ends + 1]
            parts = [words[begins[i]:ends[i]] for i in range(len(chunks))]
            for i in marked:
                parts[i] = [w for part in self.special.split(chunks[i].decode())
                            for w in ([part] if part in self.vocabulary.special else self._split(part))]
            return [w for p in parts for w in p], np.fromiter(map(len, parts), np.int64, len(parts))
        return [w for w in words if w != "\n"], counts

    def _learn(self, codes: np.ndarray, chunks: list[bytes]) -> None:
        words, n_words = self._words(chunks)
        place: dict[str, int] = {}
        used = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
        # Words are lower case, and "<|" splits from letters: only a special token reads like one.
        special = {i: self.vocabulary.special[w] for w, i in place.items() if w in self.vocabulary.special}
        ids, counts = self.vocabulary.merge([w.encode() for w in place]) if place else (used, used)
        begins = np.cumsum(counts) - counts
        if special:
            at = np.fromiter(special, np.int64)
            ids[begins[at]] = np.fromiter(special.values(), np.int64)
            counts[at] = 1
        sizes = counts[used]
        flat = ids[np.repeat(begins[used], sizes) + ramp(sizes)]
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(n_words)]
        self.flat = _room(self.flat, self.used + len(flat))
        self.flat[self.used:self.used + len(flat)] = flat
        codes = np.r_[self.codes, codes]
        order = np.argsort(codes)
        self.codes = codes[order]
        self.starts = np.r_[self.starts, self.used + np.r_[0, ends[:-1]]][order]
        self.lengths = np.r_[self.lengths, np.diff(np.r_[0, ends])][order]
        self.used += len(flat)

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.codes):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return at, self.codes[at] == codes

    def encode(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (joined bytes and their starts) joined, and the number of ids of each text."""
        if len(self.codes) > CACHE_ENTRIES:
            self.clear()
        # Folding A-Z first makes more chunks equal. Not in a text where a letter may be followed by a combining mark
        # (a few compose in lower case only) or where a folded string could look like a special token.
        folded = FOLD[flat]
        odd = (flat == 0xCC) | (flat == 0xCD)
        odd[:-1] |= (flat[:-1] == 60) & (flat[1:] == 124)
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(odd), "right") - 1):
            folded[starts[i]:starts[i + 1]] = flat[starts[i]:starts[i + 1]]
        begin, end, codes, first = words_of(folded, starts)
        distinct, place, inverse = np.unique(codes, return_index=True, return_inverse=True)
        _, known = self._find(distinct)
        if not known.all():
            data = folded.tobytes()
            new = place[~known]
            self._learn(distinct[~known], [data[a:b] for a, b in zip(begin[new].tolist(), end[new].tolist(),
                                                                      strict=True)])
        at = self._find(distinct)[0][inverse] if len(distinct) else inverse
        sizes = self.lengths[at]
        ids = self.flat[np.repeat(self.starts[at], sizes) + ramp(sizes)]
        return ids, np.diff(np.r_[0, np.cumsum(sizes)][first])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    wider = np.zeros(max(size, 2 * len(array)), array.dtype)
    wider[:len(array)] = array
    return wider


@cache
def encoder(path: str) -> Encoder:
    return Encoder(load(path))


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches with a text column become batches of about ``most`` bytes with ``ids`` (list of int32) in its place, last."""
    for batch in slices(batches, "text", most):
        place = batch.schema.get_field_index("text")
        ids, counts = encoder(path).encode(*text_bytes(batch.column(place)))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(ids, pa.int32()))
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [lists], names=[*names, "ids"])


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """The tokens joined by blanks: the vocabulary has no decoder of its own. Unknown ids are left out."""
    tokens = load(path).tokens
    return b" ".join([t for i in ids.tolist() if 0 <= i < len(tokens) and (t := tokens[i])])


def _lists(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    column = batch.column(batch.schema.get_field_index("ids"))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bounds = column.offsets.to_numpy() - column.offsets[0].as_py()
    return (flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def encode(documents: DataFrame, vocabulary: str, *keep: str) -> DataFrame:
    """``(doc_id, *keep, ids array<int>)`` of every whole text; one row per row.

    A null or empty text, or one of white space only, has no ids. A special token written out in a text is its id.
    Repeated rows stay; a null id stays null; an empty table has no result. ``keep`` names further columns to carry.
    ``vocabulary`` is the path of the tokenizer file, which every executor must have. Each task works on slices of
    2 MB of text (a longer text is a slice of its own) and remembers at most ``CACHE_ENTRIES`` chunks.
    """
    rows = pick(documents, "doc_id", *keep, "text")
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)]) + ", ids array<int>"
    return rows.mapInArrow(lambda batches: encode_batches(batches, vocabulary, 2 << 20), schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, text)`` of rows (doc_id, ids): tokens joined by blanks, word ends visible; null ids: empty text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(np.array(x if x is not None else [], np.int64), vocabulary).decode()
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = pick(encoded, "doc_id", "ids")
    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: each text encoded and decoded again in the same task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in encode_batches(batches, vocabulary):
            rows = [(len(ids), hashlib.sha256(ids.astype("<u4")).hexdigest(),
                     hashlib.sha256(decode_ids(ids, vocabulary)).hexdigest()) for ids in _lists(batch)]
            counts, encoded, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()),
                 pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = pick(documents, "doc_id", "text")
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(work, schema)
