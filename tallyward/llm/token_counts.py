"""Token counts by a whole-token shortcut: most pre-tokens are one token, which is proved once, offline."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyward.llm.bpe import PIECES, WORD_END, Vocabulary, load
from tallyward.llm.common import FOLD, pick, slices, span_codes, text_bytes, words_of

CACHE_ENTRIES = 600_000


def split_words(text: str) -> list[str]:
    """Pre-tokens of a text without special tokens: composed, lower-cased letter by letter, cut by the pattern."""
    return regex.findall(PIECES, unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def _codes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return span_codes(np.frombuffer(b"".join(words), np.uint8), np.r_[0, ends[:-1]], ends)


def _surface(vocabulary: Vocabulary) -> list[tuple[int, bytes]]:
    """Tokens that end a word, with the bytes they stand for."""
    letters = {}
    for byte, token in enumerate(vocabulary.inner.tolist()):
        letters[vocabulary.tokens[token].decode()] = byte
    end = WORD_END.encode()
    special = set(vocabulary.special.values())
    return [(i, bytes(letters[c] for c in token[:-len(end)].decode())) for i, token in enumerate(vocabulary.tokens)
            if token.endswith(end) and len(token) > len(end) and i not in special]


def prove_whole(vocabulary: Vocabulary) -> tuple[np.ndarray, list[bytes]]:
    """The words that are one token: their sorted 64-bit hashes, and the words.

    A vocabulary entry is proved when its bytes are text, the pre-tokenizer gives that text back as one piece, and the
    merges of that piece end in this one entry. An entry that no merge reaches, or that merges leave for another split,
    is not; a word without proof is merged as any other, so the shortcut changes no count.
    """
    tried = []
    for token, data in _surface(vocabulary):
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        if split_words(text) == [text]:
            tried.append((token, data))
    ids, counts = vocabulary.merge([data for _, data in tried])
    first = ids[np.cumsum(counts) - counts]
    words = [data for (token, data), n, i in zip(tried, counts.tolist(), first.tolist(), strict=True)
             if n == 1 and i == token]
    return np.sort(_codes(words)), words


class Counter:
    """Numbers of tokens of texts, by their distinct white-space separated chunks; a bounded number is remembered.

    A chunk that is a proved word counts 1 at once, by its hash. Other chunks are cut into pre-tokens; proved ones among
    them count 1, and only the rest is merged.
    """

    def __init__(self, vocabulary: Vocabulary, whole: np.ndarray):
        self.vocabulary, self.whole = vocabulary, whole
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.clear()

    def clear(self) -> None:
        self.codes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _proved(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.whole):
            return np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self.whole, codes), len(self.whole) - 1)
        return self.whole[at] == codes

    def _pieces(self, chunk: str) -> tuple[int, list[str]]:
        """Special tokens written out in a chunk (one token each), and the pre-tokens of what lies between."""
        if "<|" not in chunk or self.special is None:
            return 0, split_words(chunk)
        parts = self.special.split(chunk)
        return len(parts) - 1, [w for part in parts for w in split_words(part)]

    def _learn(self, chunks: list[bytes]) -> np.ndarray:
        """Tokens of each chunk."""
        counts = np.zeros(len(chunks), np.int64)
        words, owner = [], []
        for i, chunk in enumerate(chunks):
            counts[i], own = self._pieces(chunk.decode())
            words += own
            owner += [i] * len(own)
        if words:
            distinct: dict[str, int] = {}
            place = np.fromiter((distinct.setdefault(w, len(distinct)) for w in words), np.int64, len(words))
            data = [w.encode() for w in distinct]
            size = np.ones(len(data), np.int64)
            rest = np.flatnonzero(~self._proved(_codes(data)))
            if len(rest):
                size[rest] = self.vocabulary.merge([data[i] for i in rest.tolist()])[1]
            np.add.at(counts, np.array(owner), size[place])
        return counts

    def count(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each text; texts are given as joined bytes and their starts."""
        if len(self.codes) > CACHE_ENTRIES:
            self.clear()
        # A-Z are folded first, so that more chunks are equal; not in a text where a letter may be followed by a mark
        # that composes with its lower case only, or where folding could spell a special token.
        folded = FOLD[flat]
        odd = (flat == 0xCC) | (flat == 0xCD)
        odd[:-1] |= (flat[:-1] == 60) & (flat[1:] == 124)
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(odd), "right") - 1).tolist():
            folded[starts[i]:starts[i + 1]] = flat[starts[i]:starts[i + 1]]
        begin, end, codes, first = words_of(folded, starts)
        size = np.ones(len(codes), np.int64)
        open_ = np.flatnonzero(~self._proved(codes))
        distinct, place, inverse = np.unique(codes[open_], return_index=True, return_inverse=True)
        new = np.ones(len(distinct), bool)
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, distinct), len(self.codes) - 1)
            new = self.codes[at] != distinct
        if new.any():
            data = folded.tobytes()
            where = open_[place[new]]
            learnt = self._learn([data[a:b] for a, b in zip(begin[where].tolist(), end[where].tolist(), strict=True)])
            all_codes = np.r_[self.codes, distinct[new]]
            order = np.argsort(all_codes)
            self.codes, self.counts = all_codes[order], np.r_[self.counts, learnt][order]
        if len(distinct):
            size[open_] = self.counts[np.searchsorted(self.codes, distinct)][inverse]
        return np.diff(np.r_[0, np.cumsum(size)][first])


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 2048, *keep: str) -> DataFrame:
    """``(doc_id, *keep, n_bytes, n_tokens, over_limit)`` of every whole text, one row per row of ``documents``.

    ``n_bytes`` is the length in UTF-8, ``n_tokens`` what the tokenizer of the file ``vocabulary`` gives without tokens
    it would add; a special token written out in a text is one token. ``over_limit`` says that a text has more than
    ``limit`` tokens. A null or empty text, or one of white space only, has no tokens. Repeated rows stay, a null id
    stays null, columns not named in ``keep`` are left out whatever their names, an empty table has no result.

    The proof runs once, on the driver, over the vocabulary; its hashes (8 bytes for each entry at most) are broadcast.
    Each task works on slices of 8 MB of text (a longer text is a slice of its own) and remembers ``CACHE_ENTRIES``
    chunks. Chunks and words are told apart by 64-bit hashes.
    """
    rows = pick(documents, "doc_id", *keep, "text")
    kinds = dict(rows.dtypes)
    whole = documents.sparkSession.sparkContext.broadcast(prove_whole(load(vocabulary))[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load(vocabulary), whole.value)
        for batch in slices(batches, "text", 8 << 20):
            flat, starts = text_bytes(batch.column(batch.schema.get_field_index("text")))
            n = counter.count(flat, starts)
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(np.diff(starts), pa.int64()), pa.array(n, pa.int64()),
                                                    pa.array(n > limit)],
                names=[*names, "n_bytes", "n_tokens", "over_limit"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep))
    return rows.mapInArrow(work, schema + ", n_bytes long, n_tokens long, over_limit boolean")
