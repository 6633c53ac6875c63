"""Quality rules: counts of words, symbols and repeats, and divergence from language references."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import mix, pick, slices, span_codes, text_bytes, windows, words_of

SLICE = 1 << 20  # bytes of text worked on at once

# Frequent function words of four languages; their shares are learned from the corpus.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he his but at are this have from or had an they "
          "which you were one all we".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er "
          "hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se le ce il sont avec son "
          "ou aux".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es lo como más pero sus le ya o este sí "
          "porque".split(),
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})

# Character classes: by the first byte of a character; the bytes that continue one have no class.
LOWER, UPPER, DIGIT, SPACE, SYMBOL, PUNCTUATION, CONTROL, OTHER, NOTHING = range(9)
N_CLASSES = 8
SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, PUNCTUATION, np.uint8)
_CLASS[0:32] = CONTROL
_CLASS[127] = CONTROL
_CLASS[list(b" \t\n\v\f\r")] = SPACE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = UPPER
_CLASS[97:123] = LOWER
_CLASS[list(SYMBOLS)] = SYMBOL
_CLASS[128:192] = NOTHING
_CLASS[192:] = OTHER


def _class_counts(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = len(starts) - 1
    place = np.repeat(np.arange(n, dtype=np.int64) * (NOTHING + 1), np.diff(starts))
    place += _CLASS[flat]
    return np.bincount(place, minlength=n * (NOTHING + 1)).reshape(n, NOTHING + 1)[:, :N_CLASSES]


def _common_codes() -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in WORDS]
    flat = np.frombuffer(b" ".join(raw), np.uint8)
    code = words_of(flat, np.array([0, len(flat)]))[2]
    order = np.argsort(code)
    return code[order], order


_CODES, _ORDER = _common_codes()


def _common_counts(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text the number of every common word (A-Z lower-cased, no letter or digit beside it) and of the others.

    Punctuation next to a word is turned into white space first, so that ``the,`` counts as ``the``.
    """
    bare = flat.copy()
    bare[np.isin(_CLASS[flat], [SYMBOL, PUNCTUATION, CONTROL])] = 32
    _, _, code, first = words_of(bare, starts, fold=True)
    n, width = len(starts) - 1, len(WORDS) + 1
    at = np.minimum(np.searchsorted(_CODES, code), len(_CODES) - 1)
    word = np.where(_CODES[at] == code, _ORDER[at], len(WORDS))
    owner = np.repeat(np.arange(n), np.diff(first))
    return np.bincount(owner * width + word, minlength=n * width).reshape(n, width)


def _repeats(code: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Per text the words inside 3-word windows that are found twice or more in it."""
    key, at = windows(code, first, 3)
    owner = np.repeat(np.arange(n), np.diff(first))
    key = mix(key + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(code), bool)
    if len(twice):
        hit = at[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
        for i in range(3):
            covered[hit + i] = True
    return np.bincount(owner[covered], minlength=n)


def _line_repeats(flat: np.ndarray, starts: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line. A line ends at \\n or at the end of the text."""
    breaks = np.flatnonzero(flat == 10)
    heads = np.unique(np.r_[starts[:-1], breaks + 1])
    heads = heads[heads < len(flat)]
    owner = np.searchsorted(starts, heads, "right") - 1
    ends = np.minimum(starts[owner + 1], np.r_[breaks, len(flat)][np.searchsorted(breaks, heads)])
    has_word = np.r_[begin, len(flat)][np.searchsorted(begin, heads)] < ends
    heads, ends, owner = heads[has_word], ends[has_word], owner[has_word]
    key = mix(span_codes(flat, heads, ends) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    again = np.r_[False, key[order][1:] == key[order][:-1]][:len(order)]
    return np.bincount(owner[order][again], minlength=n)


def _js(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (0 to 1) of each row's histogram to one reference histogram."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    q = reference / max(reference.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _word_distance(words: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The larger of two distances: of the histograms, and of the shares of common words in them.

    The distance of the shares counts where the text has the smaller one (a few texts without common words lower the
    reference), in units of the distance of a text without any, which is 1.
    """
    share = np.stack([words[:, :-1].sum(1), words[:, -1]], 1)
    normal = np.array([reference[:-1].sum(), reference[-1]])
    none = _js(np.array([[0.0, 1.0]]), normal)[0]
    fewer = share[:, 0] * normal.sum() < normal[0] * share.sum(1)
    return np.maximum(_js(words, reference), np.where(fewer, _js(share, normal) / max(none, 1e-12), 0.0))


def fit_references(documents: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """Per language the character classes and common words of all its documents together.

    Every text counts; rows with a null language do not. The result has one entry of fixed size for each language that
    occurs, also for those without a list of common words.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", SLICE):
            flat, starts = text_bytes(batch.column(1))
            both = np.hstack([_class_counts(flat, starts), _common_counts(flat, starts)])
            names = np.array(batch.column(0).to_pylist())
            for name in np.unique(names):
                total[str(name)] = total.get(str(name), 0) + both[names == name].sum(0)
        rows = [(name, i, int(x)) for name, counts in total.items() for i, x in enumerate(counts)]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                                          pa.array(columns[2], pa.int64())], names=["lang", "bin", "n"])

    rows = pick(documents, "lang", "text").where("lang IS NOT NULL")
    sums = rows.mapInArrow(work, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found: dict[str, list[int]] = {}
    for lang, place, n in sums.collect():  # languages x (classes + words)
        found.setdefault(lang, [0] * (N_CLASSES + len(WORDS) + 1))[place] = n
    return {lang: (x[:N_CLASSES], x[N_CLASSES:]) for lang, x in sorted(found.items())}


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "class_distance double, word_distance double, kept boolean")


def judge(documents: DataFrame, references: Mapping[str, tuple[list[int], list[int]]], keep: tuple[str, ...] = (),
          class_limit: float = 0.3, word_limit: float = 0.5, least_words: int = 80) -> DataFrame:
    """``(doc_id, *keep, counts, base_failed, class_distance, word_distance, kept)``, one row per row.

    Base rules: fewer than 50 words, or more than half of the words in repeated 3-word windows. A document that passes
    them, and whose ``lang`` has a reference, is compared by the Jensen-Shannon distance of its character classes and of
    its common words: with all references of languages that have a list of common words if its own is one of them, else
    with the character classes of its own language alone (word distance 0). Common words are compared (of these also by their share alone: a text without any has distance 1, whatever their share in the
    reference); the nearest reference counts. It is rejected when either distance is above its limit. Documents with
    fewer than ``least_words`` words are not compared (their histograms say too little), nor are those whose language is
    unknown or has no reference: then the distances are null and the base rules decide. A null or empty text has no words and fails.
    Repeated rows, null ids and further columns in ``keep`` pass through; an empty table has no result.
    """
    refs = [(np.array(a, float), np.array(b, float)) for lang, (a, b) in references.items() if lang in COMMON_WORDS]
    others = {lang: np.array(a, float) for lang, (a, _) in references.items() if lang not in COMMON_WORDS}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            place = batch.schema.get_field_index("text")
            flat, starts = text_bytes(batch.column(place))
            n = batch.num_rows
            begin, _, code, first = words_of(flat, starts)
            classes = _class_counts(flat, starts)
            n_words = np.diff(first)
            word_chars = classes.sum(1) - classes[:, SPACE]
            repeats = _repeats(code, first, n)
            failed = (n_words < 50) | (100 * repeats > 50 * n_words)
            langs = np.array([x or "" for x in batch.column(batch.schema.get_field_index("__lang")).to_pylist()], object)
            by_class, by_word, compared = np.zeros(n), np.zeros(n), np.zeros(n, bool)
            listed = np.flatnonzero(np.isin(langs, [x for x in references if x in COMMON_WORDS]))
            if len(listed):
                words = _common_counts(flat, starts)[listed]
                each_class = np.stack([_js(classes[listed], a) for a, _ in refs])
                each_word = np.stack([_word_distance(words, b) for _, b in refs])
                nearest = np.argmin(each_class / class_limit + each_word / word_limit, 0)
                for out, each in ((by_class, each_class), (by_word, each_word)):
                    out[listed] = each[nearest, np.arange(len(listed))]
                compared[listed] = True
            for lang in others.keys() & set(langs):
                own = langs == lang
                by_class[own] = _js(classes[own], others[lang])
                compared |= own
            compared &= n_words >= least_words
            kept = ~failed & ~(compared & ((by_class > class_limit) | (by_word > word_limit)))
            names = [x for x in batch.schema.names if x not in ("text", "__lang")]
            out = [batch.column(batch.schema.get_field_index(x)) for x in names]
            numbers = [n_words, word_chars, classes[:, SYMBOL], _line_repeats(flat, starts, begin, n), repeats]
            out += [pa.array(x, pa.int64()) for x in numbers] + [pa.array(failed)]
            out += [pa.array(x, pa.float64(), mask=~compared) for x in (by_class, by_word)] + [pa.array(kept)]
            yield pa.RecordBatch.from_arrays(out, names=[*names, *[x.split()[0] for x in SCHEMA.split(", ")]])

    rows = pick(documents, *dict.fromkeys(("doc_id", *keep, "lang", "text"))).withColumn("__lang", F.col("lang"))
    rows = rows.select("doc_id", *keep, "__lang", "text")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(work, ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)) + ", " + SCHEMA)


def keep_good(documents: DataFrame, references: Mapping[str, tuple[list[int], list[int]]], columns: tuple[str, ...],
              **limits) -> DataFrame:
    """The documents that ``judge`` keeps, with the named columns. Texts travel through the task once."""
    marked = pick(documents, *columns).withColumn("__whole", F.col("text"))
    rest = tuple(c for c in columns if c not in ("doc_id", "text"))
    judged = judge(marked, references, (*rest, "__whole"), **limits).where("kept")
    return judged.withColumnRenamed("__whole", "text").select(*columns)
