"""The operators against plain versions on small inputs, with nulls, ties, repeats, clashing columns and empty tables."""

import base64
import gzip
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import (
    bpe, chat, embedding_join, group_join, mixing, quality, queries, secrets, suffix_tree, token_shards, url_rules)
from tallyward.llm import components as components_module
from tallyward.llm.components import components

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    queries.ship(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """Hard cases followed by the documents of the smallest folder."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    near = [f"w{i}" for i in range(100)]
    hard = [(-1, None, None, None, None), (-2, "", "en", "a", 0), (-3, " \t\n\x0b\x0c\r", "en", "a", 6),
            (-4, "one two", "xx", "b", 7), (-5, "One  TWO", None, "b", 8), (-6, long, "en", "b", len(long)),
            (None, "no id here", "de", None, 10), (-7, "Ünï cödé 漢字\u00a0x\u0085y \x1c ΑΣ ǅ", "de", "ü", 9),
            (-8, " ".join(near), "en", "c", 0), (-9, " ".join(["new", *near[1:]]), "en", "c", 0),
            (-10, " ".join([*near[:90], *(f"z{i}" for i in range(10))]), "en", "c", 0),
            (-11, "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "en", "c", 0)]
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = hard + rows + [hard[3], rows[0]]
    return rows, spark.createDataFrame(rows, DOCS).repartition(5)


def clashing(df):
    """The frame with extra columns whose names operators use inside or differ in case only."""
    extra = ["host", "rule", "__0", "TEXT", "Doc_ID", "size", "bucket", "ids", "label", "gid", "n", "key", "tokens"]
    names = df.columns + [x for x in extra if x not in df.columns]
    values = [F.col(f"`{c}`") for c in df.columns] + [F.lit("x")] * (len(names) - len(df.columns))
    return df.select(*values).toDF(*names)


def groups(links, items):
    parent = {x: x for x in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in items}


# -- 1 and 5 -----------------------------------------------------------------------------------------------------

@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def test_bpe_equals_the_library(spark, corpus, tokenizer):
    rows, df = corpus
    got = Counter((r.doc_id, tuple(r.ids)) for r in bpe.encode(clashing(df), queries.vocabulary()).collect())
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert got == want
    back = bpe.round_trip(df, queries.vocabulary()).collect()
    text = {r[0]: tokenizer.decode(tokenizer.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)
            for r in rows}
    assert len(back) == len(rows)
    for r in back:
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_bpe_decode(spark, tokenizer):
    df = spark.createDataFrame([(1, [320, 49407, 1]), (2, None), (3, []), (4, [-5, 99999])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(df, queries.vocabulary()).collect()}
    assert got == {1: tokenizer.decode([320, 49407, 1], skip_special_tokens=False), 2: "", 3: "", 4: ""}


def test_merge_of_overlapping_pairs(tokenizer):
    encoder = bpe.Encoder(bpe.load(queries.vocabulary()))
    texts = ["a" * n for n in range(1, 40)] + ["!" * 300, "ababababab" * 20, "ééééé", "\U0001f389" * 9]
    data = [t.encode() for t in texts]
    flat = np.frombuffer(b"".join(data), np.uint8)
    ids, counts = encoder.encode(flat, np.r_[0, np.cumsum([len(x) for x in data])])
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_that_compose_in_lower_case_only(tokenizer):
    encoder = bpe.Encoder(bpe.load(queries.vocabulary()))
    for text in ["J\u030c A\u030a T\u0308x", "İSTANBUL ΣΑΣ", "a<|endoftext|>B"]:
        data = np.frombuffer(text.encode(), np.uint8)
        assert encoder.encode(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids


def test_token_shards(spark, corpus, tokenizer):
    rows, df = corpus
    shards = token_shards.write_shards(clashing(df), queries.vocabulary(), 49_408, shard_ids=20_000)
    assert shards.count() > 3
    got = sorted((r.doc_id if r.doc_id is not None else -math.inf, r.start, r.n_tokens, r.ids_crc32)
                 for r in token_shards.read_shards(shards).collect())
    ids = {r[:2]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    ordered = sorted(rows, key=lambda r: -math.inf if r[0] is None else r[0])
    start, want = 0, []
    for r in ordered:
        own = ids[r[:2]]
        want.append((r[0] if r[0] is not None else -math.inf, start, len(own), zlib.crc32(np.array(own, "<u4"))))
        start += len(own)
    assert got == want
    assert token_shards.read_shards(token_shards.write_shards(df.limit(0), queries.vocabulary(), 49_408)).count() == 0


def test_shard_random_access():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 500, 0, 3000, 7, 0])
    ids = np.concatenate([rng.integers(0, 4) * 8 + np.arange(8) for _ in range(500)])[:lengths.sum()]
    data = token_shards.compress(ids, lengths, 100)
    shard = token_shards.Shard(data)
    assert len(data) < len(ids) and len(shard.symbols) < len(ids) / 2
    assert shard.sizes().tolist() == lengths.tolist()
    ends = np.cumsum(lengths)
    for i, n in enumerate(lengths):
        assert shard.read(i).tolist() == ids[ends[i] - n:ends[i]].tolist()
    with pytest.raises(ValueError):
        token_shards.Shard(b"other file")


# -- 2 -----------------------------------------------------------------------------------------------------------

def plain_verdict(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(FOLD)
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


URLS = [None, "", "net/x", "http://NET/", "http://net", "http://a.example.net/en/x?q#f", "http://example.net/en", "x://",
        "http://example.net/en/", "http://notexample.net/", "http://examplenet/", "https://m.example.com/de/?a=://b",
        "http://org/fr/", "http://a..org/fr/x", "http://example.com:80/de/", "http://x.org/fr", "http://a.b.c.d.net#x",
        "ftp://Ünï.net/π", "http:// sp ace.net/ a"]


def test_url_rules(spark):
    rules = queries.RULES + [("net", "/x", "allow"), ("a.example.net", "/", "block"), ("example.net", "/en/x", "block"),
                             ("net", "/x", "block")]
    pages = clashing(spark.createDataFrame(
        [(i, u) for i, u in enumerate(URLS * 2)] + [(None, URLS[3])], "page_id long, url string"))
    rule_rows = clashing(spark.createDataFrame(rules + [(None, "/", "block"), ("x", None, "block")],
                                               "host string, path string, verdict string"))
    got = url_rules.judge(pages, rule_rows).collect()
    assert len(got) == 2 * len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url, rules)
    none = url_rules.judge(pages, rule_rows.limit(0)).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")} and len(none) == len(got)
    assert url_rules.judge(pages.limit(0), rule_rows).count() == 0


# -- 3 -----------------------------------------------------------------------------------------------------------

def plain_vectors(rows, threshold=0.93):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(
            x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float) / np.linalg.norm(v), label) for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    links = [(a, b) for x, (a, v, k) in enumerate(good) for b, w, m in good[x + 1:]
             if k == m and len(v) == len(w) and v @ w >= threshold]
    degree = Counter(x for link in links for x in link)
    return degree, groups(links, range(len(rows)))


def test_embedding_join(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        base = rng.normal(size=16)
        for j in range(rng.integers(1, 4)):
            rows.append((len(rows), (base + rng.normal(size=16) * 0.15 * j).tolist(), int(i % 3)))
    rows += [(len(rows) + i, [1.0] * 15 + [x], 7) for i, x in enumerate([0.0, -0.0, 0.0, 1.0])]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 3, [2.0] * 3]
    rows += [(len(rows) + i, v, 7) for i, v in enumerate(odd)]
    rows += [(len(rows), [1.0] * 16, None), (len(rows) + 1, [1.0] * 16, None)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7))
    got = {r.vec_id: r for r in embedding_join.near_vectors(df).collect()}
    degree, place = plain_vectors(rows)
    assert len(got) == len(rows) and any(degree.values())
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[i], place[i], place[i] == i)
    assert embedding_join.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (None, 5), (200, 100), (100, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and got[100] == got[101] == got[200] != got[0]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 4 -----------------------------------------------------------------------------------------------------------

KEY = "AKIA" + "QWERTYUIOPASDFGH"


def nested(text, *layers):
    for layer in layers:
        text = {"url": lambda t: quote(t, safe=""), "b64": lambda t: base64.b64encode(t.encode()).decode(),
                "gzip": lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode(),
                "zlib": lambda t: base64.urlsafe_b64encode(zlib.compress(t.encode())).decode(),
                "uni": lambda t: "".join(f"\\u{ord(c):04x}" for c in t)}[layer](text)
    return text


@pytest.mark.parametrize("layers", [("url",), ("b64",), ("gzip",), ("zlib",), ("uni",), ("b64", "b64"), ("gzip", "url"),
                                    ("uni", "b64", "url"), ("url", "gzip", "b64"), ("b64", "uni")])
def test_secret_in_layers(layers):
    inner = nested(f"é see {KEY} ok", *layers)
    text = f"some words {inner} and more"
    base, spans = secrets.find(text)
    found = [(a, b) for a, kind, b in spans if secrets.KINDS[kind] == "access"]
    inside = [(a, b) for a, b in found if text.index(inner) <= a < b <= text.index(inner) + len(inner)]
    assert inside and set(base) <= set(spans)
    assert KEY not in secrets.redact(text, spans) and secrets.redact(text, spans).endswith("and more")


def test_base64_span_is_tight():
    text = "x " + nested(f"0123456789 {KEY} 0123456789", "b64") + " y"
    (start, _, end), = secrets.find(text)[1]
    assert 2 + 11 * 4 // 3 - 2 <= start and end - start <= 20 * 4 / 3 + 4


def test_secret_cycles_and_plain_text():
    assert secrets.find("%25%32%35%25%32%35 100%% a%20b &#37;41") == ([], [])
    assert secrets.find("") == ([], [])
    assert secrets.find("token=token:abcdefgh")[0] == []
    assert secrets.find("ſecret=abcdefgh")[0] == [] and secrets.find("API-KEY api_key : 'abcdef'")[0] == [(8, 0, 25)]


@pytest.mark.parametrize("layers", [("b64",), ("gzip",), ("b64", "b64"), ("gzip", "url"), ("b64", "gzip")])
def test_every_copy_of_a_blob_is_opened(layers):
    inner = nested(f"see {KEY} ok", *layers)
    text = f"first {inner} then {inner} and {inner} end"
    spans = secrets.find(text)[1]
    for m in re.finditer(re.escape(inner), text):
        assert any(m.start() <= a < b <= m.end() and secrets.KINDS[kind] == "access" for a, kind, b in spans)
    assert inner not in secrets.redact(text, spans) and secrets.redact(text, spans).count("[SECRET]") == 3


@pytest.mark.parametrize("odd", ["\ufeff", "\u00a0", "\u200b", "\x1b[0m", "\x00"])
def test_odd_characters_hide_nothing(odd):
    for layers in [("url",), ("b64",), ("gzip",), ("b64", "gzip")]:
        inner = nested(f"{odd} see {KEY} ok", *layers)
        spans = secrets.find(f"a {inner} b")[1]
        assert [1] == [kind for _, kind, _ in spans] and inner not in secrets.redact(f"a {inner} b", spans)
    raw = base64.b64encode(b"\xff\xfe " + KEY.encode() + b" \x80").decode()
    assert [kind for _, kind, _ in secrets.find(f"a {raw} %FF%41" + "KIA" + KEY[4:])[1]] == [1, 1]


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("layer", ["b64", "gzip"])
def test_wrapped_base64(width, end, layer):
    rng = np.random.default_rng(1)
    words = " ".join(map(str, rng.integers(0, 1 << 40, 30)))
    for shift in range(0, 48, 5):
        inner = nested(f"{'x' * shift} see {KEY} and {words} password=hunter2hunter {words}", layer)
        wrapped = end.join(inner[i:i + width] for i in range(0, len(inner), width))
        for before, after in [("", ""), ("mail: ", " end"), ("Content-Transfer-Encoding-base64\n", "\nregards")]:
            text = before + wrapped + after
            spans = secrets.find(text)[1]
            assert {1, 0} <= {kind for _, kind, _ in spans}
            assert all(len(before) <= a < b <= len(before) + len(wrapped) for a, _, b in spans)


def test_long_streams_are_scanned_in_pieces():
    for filler in ["lorem ipsum, ", "x"]:
        inner = nested(filler * 3000 + f" {KEY} " + filler * 3000 + " password=hunter2hunter " + filler * 9, "gzip")
        text = f"a {inner} b"
        assert secrets.find(text, 5000)[1] == secrets.find(text)[1] == [(2, 0, len(text) - 2), (2, 1, len(text) - 2)]


def test_scan_documents(spark, corpus):
    rows, df = corpus
    hard = spark.createDataFrame([(900, f"password='hunter2x' {KEY} " + "a1" * 15, None, None, None)], DOCS)
    got = {r.doc_id: r for r in secrets.scan_documents(clashing(df.unionAll(hard)), redacted=True).collect()}
    assert (got[900].n_assign, got[900].n_access, got[900].n_hex) == (1, 1, 1)
    assert got[900].spans == "assign:0:18,access:20:40,hex:41:71" and got[-1].text is None
    assert got[-2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.scan_documents(df).count() == len(rows) and secrets.scan_documents(df.limit(0)).count() == 0


# -- 6 -----------------------------------------------------------------------------------------------------------

def plain_counts(text):
    own, text = words(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    triples = list(zip(own, own[1:], own[2:]))
    twice = {t for t, n in Counter(triples).items() if n > 1}
    covered = {i + k for i, t in enumerate(triples) if t in twice for k in range(3)}
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_rules(spark, corpus):
    rows, df = corpus
    junk = " ".join(f"$$$ {i * 7919 % 1000:03d}%% ##" for i in range(100))
    more = [(901, "a\nb c\n\na\n b c\nb c\n", "en", "s", 1), (902, junk, "en", "s", 1), (903, "x y z " * 40, "en", "s", 1)]
    references = quality.fit_references(df)
    both = clashing(df.unionAll(spark.createDataFrame(more, DOCS)))
    got = quality.judge(both, references).collect()
    text = {(r[0]): r[1] for r in rows + more}
    assert len(got) == len(rows) + len(more)
    for r in got:
        want = plain_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in got}
    assert not by_id[902].base_failed and not by_id[902].kept and by_id[903].base_failed
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    assert all(r.kept or r.base_failed for r in got if r.doc_id in good)
    assert all(r.kept == (not r.base_failed) for r in quality.judge(df, {}).collect())
    assert quality.fit_references(df.limit(0)) == {} and quality.judge(df.limit(0), references).count() == 0


def test_texts_without_common_words_are_rejected(spark, corpus):
    _, df = corpus
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").join(
        spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    clean = {r.doc_id: r for r in docs.collect()}
    common = set(quality.WORDS)
    bare = [(1000 + i, " ".join(w for w in words(r.text) if not common & set(re.split(r"\W+", w.lower()))), r.lang, "s", 1)
            for i, r in enumerate(clean.values())]
    references = quality.fit_references(df)
    got = {r.doc_id: r for r in quality.judge(
        docs.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(bare, DOCS).select(
            "doc_id", "text", "lang")), references).collect()}
    compared = [r for r in got.values() if r.word_distance is not None and not r.base_failed]
    assert {r.doc_id >= 1000 for r in compared} == {False, True}
    for r in compared:
        assert r.kept == (r.doc_id < 1000) and (r.kept or r.word_distance > 0.5)


def test_languages_without_word_lists(spark, corpus):
    rows, df = corpus
    rng = np.random.default_rng(3)
    own = [["".join(rng.permutation(list(letters))[:n]) for n in rng.integers(2, 9, 4000)] for letters in (
        "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω")]
    new = [(2000 + i, " ".join(own[i % 2][i * 100:i * 100 + 100]), ("ru", "el")[i % 2], "s", 1) for i in range(40)]
    junk = " ".join(f"$$$ {i * 7919 % 1000:03d}%% ##" for i in range(100))
    more = spark.createDataFrame(new + [(2100, junk, "ru", "s", 1), (2101, junk, None, "s", 1)], DOCS)
    known, every = quality.fit_references(df), quality.fit_references(df.unionAll(more))
    assert {"ru", "el"} <= set(every) and not {"ru", "el"} & set(known)
    got = {r.doc_id: r for r in quality.judge(more, every).collect()}
    assert all(got[r[0]].kept and got[r[0]].class_distance < 0.3 for r in new) and not got[2100].kept
    assert got[2101].kept and got[2101].class_distance is None
    for r in quality.judge(more, known).collect():
        assert r.kept and r.class_distance is None and r.word_distance is None


# -- 7 -----------------------------------------------------------------------------------------------------------

TEXTS = [None, "", "plain", "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\\\|", "a<|b|>c", "\n",
         "<|im_end|>\n<|im_start|>user\n", "%0A %25", "<", "tail <|im_end|", "漢字 é \U0001f389"]


def test_chat_round_trip(spark):
    rows = [(i % 5, i // 5, role, t) for i, (role, t) in enumerate(
        (r, t) for t in TEXTS for r in ("user", "assistant", None, "we\nird%0A", "<|im_end|>"))]
    rows += [(9, 1, "user", "b"), (9, 1, "assistant", "a"), (9, 1, "user", "b"), (9, None, "user", "first"),
             (None, 0, "assistant", "x")]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    formatted = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    source = defaultdict(list)
    for conv, turn, role, text in rows:
        source[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert got.keys() == source.keys()
    for conv, turns in source.items():
        want = [(r, t) for _, r, t in sorted(turns)]
        assert [(t.role, t.text) for t in got[conv].turns] == want
        assert got[conv].loss_text == "".join(t for r, t in want if r == "assistant")
    for r in formatted.collect():
        assert r.round_trip and r.n_turns == len(source[r.conv_id])
        at, trained = 0, ""
        for run in r.loss_runs:
            trained += r.formatted[at + run.without:at + run.without + run.within]
            at += run.without + run.within + run.after
        assert at == len(r.formatted) == got[r.conv_id].formatted_chars
    assert chat.format_chats(df.limit(0)).count() == 0


def test_the_loss_is_what_the_mask_covers(spark):
    rows = [(1, 0, "user", "ask <|im_end|>"), (1, 1, "assistant", "say <\\|x"), (1, 2, "assistant", "more <|im_start|>")]
    formatted = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert chat.read_back(formatted).first().loss_text == "say <\\|xmore <|im_start|>"
    later = F.transform("loss_runs", lambda r: r.withField("without", r["without"] + 1).withField("after", r["after"] - 1))
    assert chat.read_back(formatted.withColumn("loss_runs", later)).first().loss_text != "say <\\|xmore <|im_start|>"
    with pytest.raises(Exception, match="parse back"):
        chat.read_back(formatted.withColumn("round_trip", F.lit(False))).collect()


@pytest.mark.parametrize("before", ["", "/api/", "https://h.net/v1/", "x-", "abc", "a_b-", "abcde", "ab/c", "abcdef"])
@pytest.mark.parametrize("behind", ["", "/x", "-tail", "/x/yz", "a", "abc."])
def test_encoded_text_beside_its_alphabet(before, behind):
    plain = "id=7 token=abcdefgh1 end"
    for data in (plain.encode(), gzip.compress(plain.encode())):
        if data[:1] == b"\x1f" and (behind == "a" or behind[:1] in ("-", "a")):
            continue  # what follows a stream at once is still read as its trailer
        for blob in (base64.b64encode(data).decode().rstrip("="), base64.urlsafe_b64encode(data).decode()):
            text = f"see {before}{blob}{behind} there"
            base, spans = secrets.find(text)
            found = [s for s in spans if s not in base and s[1] == 0]
            assert found, text
            start, end = text.index(blob), text.index(blob) + len(blob)
            assert all(a < end and start < b for a, _, b in found)
            assert data[:1] == b"\x1f" or any(start <= a < b <= end for a, _, b in found)


def test_broken_grammar_has_no_turns(spark):
    bad = ["x", "<|im_start|>user", "<|im_start|>user\nx<|im_end|>", "<|im_start|>u\nx<|im_end|>y<|im_end|>\n",
           "z<|im_start|>u\nx<|im_end|>\n"]
    df = spark.createDataFrame([(x,) for x in bad], "s string")
    assert [r.p for r in df.select(chat.parse(F.col("s")).alias("p")).collect()] == [None] * len(bad)


# -- 8 -----------------------------------------------------------------------------------------------------------

def plain_jaccard(rows, width=5, percent=80):
    sets = []
    for _, text, *_ in rows:
        own = words((text or "").translate(FOLD))
        sets.append({tuple(own[i:i + width]) for i in range(len(own) - width + 1)} or ({tuple(own)} if own else set()))
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, groups(links, range(len(rows)))


def family(rng, n, changes, base=None):
    """Texts that differ from a common one in a few words, so that some pairs link and some do not."""
    base = base or [f"b{x}" for x in rng.integers(0, 10 ** 9, 120)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, len(own), rng.integers(0, changes + 1)):
            own[at] = f"c{rng.integers(0, 10 ** 9)}"
        out.append(" ".join(own))
    return out


def test_jaccard_classes(spark, corpus, monkeypatch):
    monkeypatch.setattr(group_join, "GROUP", 8)
    rng = np.random.default_rng(11)
    shared = [f"s{i}" for i in range(60)]
    texts = family(rng, 120, 6) + family(rng, 60, 3) + family(rng, 40, 9) + [
        " ".join([*(f"q{i}_{j}" for j in range(6)), *shared]) for i in range(40)]
    rows = corpus[0] + [(10_000 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = clashing(spark.createDataFrame(rows, DOCS).repartition(6))
    got = group_join.jaccard_classes(df).collect()
    sets, place = plain_jaccard(rows)
    members = defaultdict(list)
    for i, p in place.items():
        members[p].append(i)
    want = Counter()
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        for i in own:
            want[rows[i][0], len(sets[i]), min(ids, default=None)] += 1
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.first for r in got) == len(members)
    assert group_join.jaccard_classes(df.limit(0)).count() == 0
    kept = Counter((r.doc_id, r.text) for r in group_join.keep_first(df, ("doc_id", "text")).collect())
    assert sum(kept.values()) == len(members) and all(any((rows[i][0], rows[i][1]) in kept for i in own) for own in members.values())


def test_one_document_of_each_group_stays(spark):
    """Null and repeated ids: a document is its id and its text."""
    base = [f"w{i}" for i in range(60)]
    near = " ".join(["new", *base[1:]])
    other = " ".join(f"x{i}" for i in range(60))
    rows = [(None, " ".join(base)), (None, near), (None, other), (1, other + " y"), (2, near + " z"), (2, " ".join(base)),
            (2, " ".join(base)), (3, ""), (3, None), (4, None), (None, ""), (5, "alone here")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(4)
    kept = Counter((r.doc_id, r.text) for r in group_join.keep_first(df, ("doc_id", "text")).collect())
    assert sum(kept.values()) == 7 and kept[1, other + " y"] == 1 and (None, other) not in kept
    assert kept[3, ""] == kept[3, None] == kept[4, None] == kept[None, ""] == kept[5, "alone here"] == 1
    assert sum(kept[x] for x in [(2, near + " z"), (2, " ".join(base))]) == 1 and not {(None, " ".join(base)), (None, near)} & set(kept)


def test_shared_passages_do_not_meet(spark, monkeypatch):
    """Texts that share most of a passage and cannot link are gone before the join of tokens; those that can are found."""
    passage = [f"p{i}" for i in range(84)]
    apart = [" ".join([*passage, *(f"u{i}_{j}" for j in range(20))]) for i in range(200)]
    close = [" ".join([*passage, *(f"v{i}_{j}" for j in range(6))]) for i in range(30)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(apart + close)]
    pairs = []
    asked = group_join.stage

    def watch(df, name):
        out = asked(df, name)
        if name == "jaccard-asked":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(group_join, "stage", watch)
    got = {r.doc_id: r.component_id for r in group_join.jaccard_classes(spark.createDataFrame(rows, DOCS)).collect()}
    sets, place = plain_jaccard(rows)
    assert all((got[a] == got[b]) == (place[a] == place[b]) for a in got for b in got)
    assert max(pairs) < 500


def test_large_classes_take_few_rounds(spark, monkeypatch):
    """Rounds of components do not grow with a group of near copies or the links of one centre; a round is a pass of the cluster."""
    names = []
    asked = group_join.stage

    def watch(df, name):
        names.append(name)
        return asked(df, name)

    monkeypatch.setattr(components_module, "stage", watch)
    star = [(3 * i, 1) for i in range(2, 3000)]
    got = components(spark.createDataFrame(star, "a long, b long")).collect()
    assert len(got) == 2999 and len({r.label for r in got}) == 1 and names.count("moves") == 1
    names.clear()
    monkeypatch.setattr(group_join, "stage", watch)
    monkeypatch.setattr(group_join, "GROUP", 8)
    base = [f"b{x}" for x in range(300)]
    near = [" ".join([*base[:i], f"c{i}", *base[i + 1:]]) for i in range(300)]
    apart = [" ".join([*base[:60], *(f"d{i}_{j}" for j in range(240))]) for i in range(5)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(near + apart + near[:2])]
    got = {r.doc_id: r.component_id for r in group_join.jaccard_classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: i if 300 <= i < 305 else 0 for i in range(len(rows))}
    assert names.count("moves") <= 3 and names.count("jaccard-bounded") == 1


# -- 9 -----------------------------------------------------------------------------------------------------------

def test_suffix_tree_scores(spark, corpus):
    rows, df = corpus
    got = suffix_tree.score(clashing(df)).collect()
    assert len(got) == len(rows)
    tokens = [[*words((r[1] or "").translate(FOLD)), None] for r in rows]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2 for r in rows]
    counts = Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    total = sum(counts.values())
    want = defaultdict(list)
    for r, own, h in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in own)
        want[r[0]].append((h, len(own), sum(counts[t] > 0 for t in own), total, base))
    for r in got:
        assert any((r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and math.isclose(
            r.base_score, w[4], rel_tol=1e-9) for w in want[r.doc_id])
        assert r.score < 0
    again = Counter((r.doc_id, round(r.score, 6)) for r in suffix_tree.score(df.repartition(3)).collect())
    assert again == Counter((r.doc_id, round(r.score, 6)) for r in got)
    assert suffix_tree.score(df.limit(0)).count() == 0


def test_contexts_pay_off_on_held_out_words(spark):
    folder_words = [w for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() for w in words(r.text)]
    train, held = folder_words[::2], folder_words[1::2]
    counts = spark.createDataFrame(list(Counter(train).items()), "word string, c long")
    tree = suffix_tree.Tree(suffix_tree.fit_states(counts, 100).toArrow())
    flat = suffix_tree.Tree(suffix_tree.fit_states(counts, 100, most_states=0).toArrow())
    assert tree.score(held).sum() > 0.8 * flat.score(held).sum()


def test_tree_is_a_distribution(spark):
    counts = spark.createDataFrame([("ab", 5), ("abc", 3), ("ba", 2), ("zero", 0)], "word string, c long")
    tree = suffix_tree.Tree(suffix_tree.fit_states(counts, 4, divergence=0.0).toArrow())
    # After every prefix the next symbols (letters, ends, and the share of unknown ones) sum to one.
    for prefix in ["", "a", "ab", "q", "abq"]:
        total = 0.0
        for symbol in [*map(ord, "abc"), suffix_tree.WORD_END, suffix_tree.TEXT_END]:
            symbols = np.array([*map(ord, prefix), symbol])
            total += 10 ** tree._letters(symbols, np.arange(len(symbols)))[-1]
        symbols = np.array([*map(ord, prefix), ord("Q")])
        unknown = 10 ** tree._letters(symbols, np.arange(len(symbols)))[-1] * suffix_tree.N_CODE_POINTS
        assert math.isclose(total + unknown, 1, rel_tol=1e-9)


def plain_tree(texts, held, depth=suffix_tree.DEPTH):
    """log10 probability of every text; every context in a dictionary."""
    def grams(text):
        symbols = [x for w in words((text or "").translate(FOLD)) for x in (*w, "END")] + ["STOP"]
        full = ["START"] * depth + symbols
        return [(tuple(full[i:i + depth]), s) for i, s in enumerate(symbols)]

    counts = [defaultdict(Counter) for _ in range(depth + 1)]
    for text, out in zip(texts, held, strict=True):
        for context, symbol in [] if out else grams(text):
            for d in range(depth + 1):
                counts[d][context[depth - d:]][symbol] += 1
    states = set()
    for d in range(1, depth + 1):
        for context, after in counts[d].items():
            up, total = counts[d - 1][context[1:]], after.total()
            gain = sum(n * math.log(n / total / (up[s] / up.total())) for s, n in after.items())
            if gain >= suffix_tree.DIVERGENCE * len(after):
                states |= {context[i:] for i in range(d)}
    root = counts[0][()]
    size = root.total() + len(root) + 1

    def p(context, symbol):
        if not context:
            return (root[symbol] + 1) / size if root[symbol] else 1 / size / suffix_tree.N_CODE_POINTS
        up, after = p(context[1:], symbol), counts[len(context)][context]
        prior = suffix_tree.PRIOR
        return (after[symbol] + prior * up) / (after.total() + prior) if context in states else up

    return [sum(math.log10(p(*gram)) for gram in grams(text)) for text in texts], states


def test_suffix_tree_equals_a_plain_one(spark, corpus):
    rows, _ = corpus
    rows = [r for r in rows if r[0] != -6][:70]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2 for r in rows]
    want, states = plain_tree([r[1] for r in rows], held)
    assert any("END" in context[:-1] for context in states)
    got = sorted((r.doc_id or 0, r.score) for r in suffix_tree.score(spark.createDataFrame(rows, DOCS)).collect())
    for (doc, score), (own, plain) in zip(got, sorted((r[0] or 0, x) for r, x in zip(rows, want, strict=True)), strict=True):
        assert doc == own and math.isclose(score, plain, rel_tol=1e-9)


def test_word_order_counts(spark):
    rng = np.random.default_rng(5)
    pairs = [("alpha", "zulu"), ("bravo", "yankee"), ("carol", "xray"), ("delta", "whisky")]
    texts = [" ".join(w for i in rng.integers(0, 4, 40) for w in pairs[i]) for _ in range(60)]
    shuffled = [" ".join(rng.permutation(t.split())) for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 7 == 2][:20]
    more = [(i, t) for i, t in zip(held, shuffled, strict=True)] + [(i, t) for i, t in zip(held, texts, strict=False)]
    by_id = defaultdict(list)
    for r in suffix_tree.score(docs.unionAll(spark.createDataFrame(more, "doc_id long, text string"))).collect():
        by_id[r.doc_id].append((r.base_score, r.score))
    for i in held:
        (base, low), (again, high) = sorted(by_id[i], key=lambda x: x[1])
        assert math.isclose(base, again) and high > low / 2


# -- 10 ----------------------------------------------------------------------------------------------------------

def plain_targets(sizes, weights=(1, 2, 3)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 20, "c": 1000, None: 5}, {"a": 0, "b": 0}, {"x": 7},
                                   {"a": 1, "b": 1, "c": 1, "d": 900, "ü": 2, "Z": 50}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = plain_targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_mix(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    rows, df = corpus
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(None, 1), (5, None)],
                                   "doc_id long, quality int")
    got = mixing.mix(clashing(df), labels).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    for r in got:
        assert r.taken == r.size * r.epochs and r.epochs <= 3 and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    want = plain_targets(sizes)
    for r in got:
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    again = mixing.mix(df.repartition(3), labels).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    drawn = Counter(r.doc_id for r in mixing.draw(df, ("doc_id", "text"), quality=labels).collect())
    epochs = Counter()
    for r in got:
        epochs[r.doc_id] += r.epochs
    assert drawn == Counter({k: v for k, v in epochs.items() if v})
    assert mixing.mix(df.limit(0), labels).count() == 0


def test_good_documents_are_drawn_more_often(spark):
    rows = [(i, "a b c d", "en", "s", 0) for i in range(4000)] + [(-1, "x " * 8000, "en", "t", 0)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    got = [r for r in mixing.mix(spark.createDataFrame(rows, DOCS), labels).collect() if r.source == "s"]
    drawn = Counter(r.doc_id % 2 for r in got if r.epochs > min(x.epochs for x in got))
    assert drawn[1] > 1.5 * drawn[0] > 0


@pytest.mark.parametrize("texts", [
    [], [""], [None, "", " ", "a", " a", "a ", "  A  b\t", "\n", "é É", "x\x00y \x85 \x1c", "漢字 b", "😀", "", "end"],
    ["".join(chr(0x4E00 + i) for i in range(900)), "b c"], ["".join(chr(0x4E00 + i) for i in range(1500)), "b c"]])
def test_packed_grams(texts):
    """Grams by numbered symbols are those of the symbols, also where there are too many letters to number."""
    flat, starts = suffix_tree.text_bytes(bpe.pa.array(texts, bpe.pa.string()))
    end = suffix_tree.words_of(flat, starts, fold=True)[1]
    symbols, sizes = suffix_tree._symbols(flat, starts, end)
    a, b = suffix_tree._grams(symbols, sizes)
    alphabet = suffix_tree.Alphabet()
    digits = alphabet.digits(flat, starts)
    if digits is not None:
        packed = alphabet.grams(alphabet.pack(digits[0]))
        assert packed[0].tolist() == a.tolist() and packed[1].tolist() == b.tolist()
        assert digits[1].tolist() == sizes.tolist()
    place, distinct, counts = suffix_tree._gram_places(flat, starts, end)
    codes = suffix_tree._gram_codes(a, b).tolist()
    assert distinct[place].tolist() == codes and len(distinct) == len(set(codes)) and counts.tolist() == sizes.tolist()
    assert sorted(suffix_tree._gram_set(flat, starts, end).tolist()) == sorted(set(codes))


def test_text_counts_over_alphabets(spark):
    """One task meets more letters than an alphabet holds, in one text and over several, and hands its counts on."""
    texts = ["ab ab", "".join(chr(0x4E00 + i) for i in range(700)), "ab", "".join(chr(0x5E00 + i) for i in range(700)),
             "".join(chr(0x6E00 + i) for i in range(1500)), "ab Ab", ""]
    rows = [(t * 3, i % 3 == 2) for i, t in enumerate(texts * 2)]
    size, want = 1 << 20, Counter()
    for text, held_out in rows:
        symbols = [suffix_tree.START] * suffix_tree.DEPTH
        for word in words(text.translate(FOLD)):
            symbols += [*map(ord, word), suffix_tree.WORD_END]
            want["word"] += not held_out
        symbols.append(suffix_tree.TEXT_END)
        for i in range(suffix_tree.DEPTH, len(symbols)):
            a, b = (sum(symbols[i - j - k] << 21 * k for k in range(3)) for j in (0, 3))
            want[a, b] += not held_out
    padded = [(t + " " * size, h) for t, h in rows]  # each text is a piece of its own
    got = suffix_tree.text_counts(spark.createDataFrame(padded, "text string, held_out boolean").coalesce(1)).collect()
    assert {(r.a, r.b): r.n for r in got if r.b != suffix_tree.WORD} == {k: n for k, n in want.items() if k != "word"}
    assert sum(r.n for r in got if r.b == suffix_tree.WORD) == want["word"]
