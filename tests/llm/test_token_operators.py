"""Token counts, token alignment and turn repair against the libraries and plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyward.llm import alignment, bpe, queries, token_counts, turn_repair

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TALKS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    queries.ship(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """Hard cases followed by the documents of the smallest folder."""
    long = " ".join(f"word{i % 977} x" for i in range(60_000))
    hard = [None, "", " \t\n\x0b\x0c\r", " ", "  two  spaces ", "one two", "Ünï cödé 漢字 x\u0085y \x1c ΑΣ ǅ", long,
            "a   b  c  d 　 e", "x▁y ▁ z", "▁", "tab\t x\n y \n\n z", "Привет мир и ещё",
            "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "<s> </s> <unk> <0x41>", "a\x00b \x01 c", "J̌ Å x",
            "nul \x7f \x1f x", "don't 's x'll 'RE", "\U0001f389\U0001f389 \U0001f389", "fox " * 50, "same", "same",
            "a" * 400, "end ", "é ́x", "​ ​q", "\x1c y \x1d z", "﻿bom", "a  b   c    d"]
    rows = [(-i - 1, t, "en", "s", 0) for i, t in enumerate(hard)] + [(None, "no id here", None, None, None)]
    rows += [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [rows[5], rows[-1]]
    return rows, spark.createDataFrame(rows, DOCS).repartition(4)


def clashing(df):
    extra = ["n_bytes", "TEXT", "Doc_ID", "ids", "pair", "block", "at", "role_", "piece", "kind", "Turn"]
    extra = [x for x in extra if x not in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[F.lit("x")] * len(extra)).toDF(*df.columns, *extra)


# -- token counts ------------------------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark, corpus):
    from tokenizers import Tokenizer

    rows, df = corpus
    library = Tokenizer.from_file(queries.vocabulary())
    want = Counter((r[0], len((r[1] or "").encode()), n, n > 2048) for r in rows
                   for n in [len(library.encode(r[1] or "", add_special_tokens=False).ids)])
    assert Counter(map(tuple, token_counts.count_tokens(clashing(df), queries.vocabulary()).collect())) == want
    assert any(x[3] for x in want)
    assert token_counts.count_tokens(df.limit(0), queries.vocabulary()).count() == 0
    kept = token_counts.count_tokens(df, queries.vocabulary(), 3, "lang")
    assert kept.columns == ["doc_id", "lang", "n_bytes", "n_tokens", "over_limit"]


def test_proof_of_whole_tokens():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary())
    vocabulary = bpe.load(queries.vocabulary())
    codes, words = token_counts.prove_whole(vocabulary)
    assert len(codes) == len(set(codes.tolist())) == len(words) > 20_000
    for encoded in library.encode_batch([w.decode() for w in words], add_special_tokens=False):
        assert len(encoded.ids) == 1
    # Without any proof the counts are the same: the shortcut only saves merges.
    text = "The quick brown fox, 1234 jumps!? <|endoftext|> über".encode()
    counts = [token_counts.Counter(vocabulary, c).count(bpe.np.frombuffer(text, bpe.np.uint8), bpe.np.array([0, len(text)]))
              for c in (codes, codes[:0])]
    assert counts[0] == counts[1] == len(library.encode(text.decode(), add_special_tokens=False).ids)


# -- alignment ---------------------------------------------------------------------------------------------------

def plain_alignment(rows):
    """Tokens of whole texts by the libraries, groups by the common ends."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    letters = alignment._byte_level()
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in
             first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            hexed = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            b.append((i, bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            out.append((doc_id, [], [], []))
            continue
        ends = [list(itertools.accumulate(len(x) for _, x in side)) for side in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = defaultdict(lambda: ([], []))
        for k, (side, places) in enumerate(zip((a, b), ends)):
            for (i, _), end in zip(side, places):
                groups[next_cut(cuts, end)][k].append(i)
        links = [(i, j) for (i, _), x in zip(a, ends[0]) if x in set(ends[1])
                 for j in [b[ends[1].index(x)][0]]] if len(a) < 5000 else [
                     (g[0][-1], g[1][-1]) for _, g in sorted(groups.items())]
        out.append((doc_id, [groups[c] for c in cuts], links, ends))
    return out


def next_cut(cuts, end):
    import bisect

    return cuts[bisect.bisect_left(cuts, end)]


def test_alignment_equals_a_plain_version(spark, corpus):
    rows, df = corpus
    files = [queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")]
    plain = plain_alignment(rows)
    count = Counter(x for _, _, links, _ in plain for x in links)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    want = Counter()
    for doc_id, groups, links, ends in plain:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want[(doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
              sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
              hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    got = alignment.alignment_report(clashing(df), *files)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(1 for x in want if not x[1]) >= 4
    groups = {(r.doc_id, tuple((tuple(g.a), tuple(g.b)) for g in r.groups)) for r in
              alignment.align(df, *files).collect()}
    assert groups == {(d, tuple((tuple(a), tuple(b)) for a, b in g)) for d, g, *_ in plain}
    assert alignment.alignment_report(df.limit(0), *files).count() == 0
    assert alignment.alignment_report(df.where("text IS NULL"), *files).select("n_a", "count_sum").distinct().collect() == [
        (0, 0)]


def test_overlaps_stay_inside_groups():
    tokens = alignment.pair(queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model"))
    data = "Zürich's overlapping tokenisations, 12345".encode()
    found = alignment.Aligned(alignment.np.frombuffer(data, "u1"), alignment.np.array([0, len(data)]), tokens)
    a, b = found.overlaps()
    assert (found.group[a] == found.group[b]).all() and (found.start[a] < found.end[b]).all()
    want = {(i, j) for i in range(len(found.ids)) for j in range(len(found.ids)) if found.side[i] < found.side[j]
            and max(found.start[i], found.start[j]) < min(found.end[i], found.end[j])}
    assert set(zip(a.tolist(), b.tolist())) == want


# -- turn repair -------------------------------------------------------------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?")


def best_by_enumeration(rows):
    """The best of all repairs with at most two inserts in a row."""
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]
    per_row = []
    for initial, fault in rows:
        more = int(fault == 1)
        ways = [("D", "", 3)]
        if fault != 2:
            ways += [("K", initial or "?", more), ("R", "u", 2 + more), ("R", "a", 2 + more)]
        per_row.append(ways)
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for ways in itertools.product(*per_row):
            roles = "".join(g + w[1] for g, w in zip(gaps, ways)) + gaps[-1]
            if GOOD.fullmatch(roles):
                audit = "".join("I" * len(g) + w[0] for g, w in zip(gaps, ways)) + "I" * len(gaps[-1])
                one = (sum(w[2] for w in ways) + 2 * sum(map(len, gaps)), audit)
                best = min(best or one, one)
    return best


def best_by_tuples(rows, at=0, state=0, memo=None):
    """(cost, audit) by recursion over the rows; no integers."""
    memo = {} if memo is None else memo
    if (at, state) in memo:
        return memo[at, state]
    following = {0: "su", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}

    def edit(letter, cost, rest):
        return (cost + rest[0], letter + rest[1])

    def row_edits(state):
        if at == len(rows):
            return [(0, "")] if state in (0, 3) else []
        initial, fault = rows[at]
        more = int(fault == 1)
        ways = [edit("D", 3, best_by_tuples(rows, at + 1, state, memo))]
        if fault != 2:
            if initial in following[state] and initial:
                ways.append(edit("K", more, best_by_tuples(rows, at + 1, after[initial], memo)))
            new = following[state][-1]
            ways.append(edit("R", 2 + more, best_by_tuples(rows, at + 1, after[new], memo)))
        return ways

    ways = row_edits(state)
    one = after[following[state][-1]]
    ways += [edit("I", 2, w) for w in row_edits(one)]
    two = after[following[one][-1]]
    ways += [edit("I", 2, edit("I", 2, w)) for w in row_edits(two)]
    memo[at, state] = min(ways)
    return memo[at, state]


def test_integer_minimum_equals_enumeration():
    kinds = [(r, f) for r in ("s", "u", "a", "x", "") for f in (0, 1, 2)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert turn_repair.solve(list(rows)) == best_by_enumeration(rows) == best_by_tuples(rows)
    draw = random.Random(5)
    for _ in range(400):
        rows = [draw.choice(kinds) for _ in range(draw.randrange(3, 40))]
        assert turn_repair.solve(rows) == best_by_tuples(rows)
        cuts = sorted(draw.randrange(len(rows) + 1) for _ in range(draw.randrange(4)))
        pieces = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        chosen, tail = turn_repair.join_pieces([turn_repair.solve_piece(p) for p in pieces])
        assert "".join(a for _, a in chosen) + tail == best_by_tuples(rows)[1]


def plain_report(talks):
    """Damage, faults and repair in plain Python, one conversation at a time."""
    by_talk = defaultdict(list)
    for conv, turn, role, text in talks:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by_talk[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = Counter()
    for conv, rows in by_talk.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else
                          "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = best_by_tuples([(r[:1], {"": 0, "truncated": 1}.get(f, 2)) for (_, r, _), f in zip(rows, faults)])
        lines, state, left = [], "", list(rows)
        for letter in audit:
            _, role, text = (None, "", "") if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in rows if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        out[(conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
             *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
             hashlib.sha256("\n".join(lines).encode()).hexdigest())] += 1
    return out


def hard_talks():
    talks = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes!"), (-1, 3, "assistant", "a"),
             (-2, 0, "", "x."), (-2, 1, "User", "x."), (-2, 2, "system", "\u0085"), (-2, 2, "system", "\u0085"),
             (-3, None, "user", " \t\n"), (-3, None, "assistant", "ok?\n "), (-3, 9, "user", "same."), (-3, 9, "user", "same."),
             (-3, 9, "assistant", "other.  ")]
    talks += [(-4, i, ("user", "assistant")[i % 2], "ok." if i % 3 else f"turn {i}.") for i in range(6000)]
    talks += [(-5, 7, "user", "equal.")] * 3000
    return talks


def test_repair_equals_a_plain_version(spark):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(60_000)
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    talks = hard_talks() + [tuple(r) for r in given.collect()]
    df = spark.createDataFrame(talks, TALKS).repartition(5)
    got = turn_repair.repair_report(clashing(df))
    try:
        assert Counter(map(tuple, got.collect())) == plain_report(talks)
    finally:
        sys.setrecursionlimit(limit)
    assert turn_repair.repair_report(df.limit(0)).count() == 0


def test_repaired_turns_are_legal(spark):
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet").withColumn("dropped", F.lit(False))
    edits, _ = turn_repair.repair(given)
    talks = defaultdict(str)
    for r in edits.where("edit <> 'D'").orderBy("conv_id", "at", "number").collect():
        talks[r.conv_id] += r.role[0]
    assert talks and all(GOOD.fullmatch(x) for x in talks.values())


@pytest.mark.parametrize("name, table, key", [
    ("op11_token_alignment", "documents", "doc_id"), ("op12_token_counts", "documents", "doc_id")])
def test_every_row_is_answered(spark, name, table, key):
    got = Counter(r[key] for r in queries.QUERIES[name](spark, FOLDER).select(key).collect())
    assert got == Counter(r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect())


def test_every_conversation_is_answered(spark):
    talks = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, queries.QUERIES["op13_turn_repair"](spark, FOLDER).collect())) == plain_report(talks)


def test_alignment_holds_little_text_at_a_time(spark, monkeypatch):
    """Rows of the written table are of about 2 MB of text, batches to Python tasks of a few MB."""
    files = [queries.vocabulary(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    texts = spark.range(60, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("the same few words "), 5_000).alias("text"))
    found = texts.mapInArrow(alignment._blocks(*files), alignment._BLOCK).select(F.size("doc_ids").alias("n")).collect()
    assert sum(r.n for r in found) == 60 and max(r.n for r in found) * 95_000 < 3 << 20
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size)
    monkeypatch.setattr(alignment, "alignment_report", lambda *_: spark.conf.get(size))
    try:
        spark.conf.unset(size)
        assert int(queries.QUERIES["op11_token_alignment"](spark, FOLDER)) == queries.BATCH
    finally:
        spark.conf.set(size, before)
