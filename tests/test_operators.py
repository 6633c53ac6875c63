"""Operators against brute force and on their edge cases."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyward.sources.lake import read_history, write_history
from tallyward.operators import aggregates, attribution, dedup, history, intervals, joins, nesting, quality, ranking, reshape, terms


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_by_versions_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 5), ("b", None, 7), ("b", None, 8), (None, 1, 1), (None, 2, 2)], "k STRING, v INT, p INT")
    out = dedup.latest_by(df, ["k"], [F.col("v").desc_nulls_last(), F.col("p").desc()])
    assert rows(out) == sorted([("a", 2, 5), ("b", None, 8), (None, 2, 2)], key=repr)


def test_latest_by_limits_before_the_shuffle(spark):
    df = dedup.latest_by(spark.range(100).selectExpr("id % 7 AS k", "id"), ["k"], [F.col("id").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_last_source_wins(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a")], "k INT, v STRING")
    b = spark.createDataFrame([(2, "b"), (None, "b")], "k INT, v STRING")
    assert rows(dedup.upsert_by_key([a, b], "k")) == sorted([(1, "a"), (2, "b"), (None, "b")], key=repr)


def test_group_count_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k STRING, v INT")
    assert rows(dedup.with_group_count(df, ["k"])) == sorted([("a", 1, 2), ("a", 2, 2), (None, 3, 1)], key=repr)


def test_first_with_count(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", 0, "q")], "k STRING, n INT, v STRING")
    out = dedup.first_with_count(df, ["k"], [-F.col("n"), F.col("v")], ["v", "n"])
    assert rows(out) == [("a", "y", 3, 3), ("b", "q", 0, 1)]


ALIASES = [("BRAND", "P1", False), ("GENERIC", "P2", True), ("SHARED", "P3", False)]


def test_attribution_rules(spark):
    aliases = spark.createDataFrame(ALIASES, "alias STRING, product_id STRING, requires_owner BOOLEAN")
    df = spark.createDataFrame([
        (1, "BRAND", "GENERIC", False), (2, None, "GENERIC", True), (3, None, "GENERIC", False),
        (4, "X", None, True), (5, None, None, True), (6, "GENERIC", "SHARED", False), (7, None, "GENERIC", None)],
        "id INT, name STRING, ingr STRING, owner BOOLEAN")
    out = attribution.attribute(df, aliases, "name", "ingr", "owner").select("id", "product_id", "match_method")
    assert rows(out) == [(1, "P1", "drug name"), (2, "P2", "active ingredient")]
    free = attribution.attribute(df, aliases, "name", "ingr", keep_unmatched=True).select("id", "product_id")
    assert rows(free) == sorted([(1, "P1"), (2, "P2"), (3, "P2"), (4, None), (5, None), (6, "P2"), (7, "P2")], key=repr)
    kept = attribution.attribute(df, aliases, "name", "ingr", "owner", keep_unmatched=True).select("id", "product_id")
    assert rows(kept) == sorted(
        [(1, "P1"), (2, "P2"), (3, None), (4, None), (5, None), (6, None), (7, None)], key=repr)


def brute_terms(texts, aliases, word):
    found = {}
    for key, text in texts:
        for alias, product in aliases:
            if text is not None and re.search(f"(^|[^{word}]){re.escape(alias)}([^{word}]|$)", text.upper()):
                found[key, product] = max(found.get((key, product), 0), len(alias))
    return sorted(((k, p, n) for (k, p), n in found.items()), key=repr)


@pytest.mark.parametrize("word", ["A-Z0-9", "A-Z"])
def test_term_search_equals_regex_and_brute_force(spark, word):
    rng = random.Random(7)
    pieces = ["AB", "A", "B1", "1", "-", " ", "  ", ".", "(", "AB-1", "É", "\\E", "X"]
    aliases = [("AB", "P1"), ("AB-1", "P1"), ("A B1", "P2"), ("-", "P3"), ("B1", "P4"), ("1", "P5"), ("-AB", "P6"),
               ("AB.", "P7"), ("A", "P8"), ("É", "P9"), ("A.B", "P10"), ("(A", "P11"), ("\\E", "P12"), ("AB  X", "P13")]
    texts = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))) for i in range(300)] + [(300, None), (301, "")]
    df = spark.createDataFrame(texts, "id INT, t STRING")
    table = spark.createDataFrame(aliases, "alias STRING, product_id STRING")
    expected = brute_terms(texts, aliases, word)
    assert rows(terms.match_terms(df, "id", "t", table, word)) == sorted(expected, key=repr)
    assert rows(terms.match_terms_regex(df, "id", "t", aliases, word)) == sorted(expected, key=repr)


def test_match_or_search_prefers_key_then_longest(spark):
    aliases = spark.createDataFrame([("AB", "P1"), ("AB CD", "P2"), ("EF", "P3")], "alias STRING, product_id STRING")
    df = spark.createDataFrame([
        (1, "EF", "ab cd"), (2, None, "x ab cd 5"), (3, "ZZ", "ab1"), (4, None, "abc"), (5, None, None)],
        "id INT, brand STRING, text STRING")
    out = terms.match_or_search(df, "id", "brand", "text", aliases).select("id", "product_id")
    assert rows(out) == sorted([(1, "P3"), (2, "P2"), (3, "P1"), (4, None), (5, None)], key=repr)


def test_exists_substring(spark):
    pairs = spark.createDataFrame(
        [("P1", "Multiple Sclerosis Relapse"), ("P1", "Headache"), ("P2", "Multiple Sclerosis"), (None, "x"), ("P1", "Asthma")],
        "p STRING, r STRING")
    known = spark.createDataFrame([("P1", "multiple sclerosis"), ("P1", "ASTHMA"), (None, "x")], "p STRING, term STRING")
    out = terms.exists_substring(pairs, known, "p", "term", "r")
    assert rows(out) == sorted([("P1", "Multiple Sclerosis Relapse", True), ("P1", "Headache", False),
                                ("P2", "Multiple Sclerosis", False), (None, "x", False), ("P1", "Asthma", True)], key=repr)


@pytest.mark.parametrize("shortest", [0, 1, 2, 3, 4])
def test_exists_substring_equals_brute_force(spark, shortest):
    rng = random.Random(shortest)
    draw = lambda low, high: "".join(rng.choice("abAÉ x") for _ in range(rng.randint(low, high)))
    pairs = [(rng.choice(["P", "Q", None]), draw(0, 12)) for _ in range(300)] + [("P", None), ("P", "aba"), ("P", "aba")]
    known = [(rng.choice(["P", "Q", "R"]), draw(shortest, shortest + 3)) for _ in range(12)] + [("P", None)]
    found = terms.exists_substring(
        spark.createDataFrame(pairs, "p STRING, r STRING"), spark.createDataFrame(known, "p STRING, term STRING"),
        "p", "term", "r")
    want = [(p, r, any(k == p and t is not None and r is not None and t.lower() in r.lower() for k, t in known))
            for p, r in pairs]
    assert rows(found) == sorted(want, key=repr)


def test_no_text_meets_all_terms(spark):
    """A text meets the terms that share a rare stretch with it, not the others of its key."""
    texts = spark.createDataFrame([("P", f"word {i} tail") for i in range(200)], "p STRING, r STRING")
    known = spark.createDataFrame([("P", f"{i} tail") for i in range(200)], "p STRING, term STRING")
    out = terms.exists_substring(texts, known, "p", "term", "r").where("is_related")
    assert out.count() == 200


def test_terms_of_several_words_are_verified_where_they_stand(spark):
    aliases = [("OF THE SEA", "P1"), ("THE SEA", "P2"), ("SEA", "P3"), ("THE  SEA", "P4"), ("THE THE", "P5"), ("OF-THE.SEA", "P6"),
               ("SEA OF THE", "P7"), ("GONE WORD", "P8")]
    texts = [(1, "of the sea"), (2, "the the sea"), (3, "of the  sea"), (4, "sea of the sea of the"), (5, "OF-THE.SEA!"),
             (6, "of the"), (7, "the the the"), (8, ""), (None, "the sea")]
    df = spark.createDataFrame(texts, "id INT, t STRING")
    table = spark.createDataFrame(aliases, "alias STRING, product_id STRING")
    for counts in (None, terms.word_counts(df, "t")):
        got = terms.match_terms(df, "id", "t", table, counts=counts)
        assert rows(got) == sorted(brute_terms(texts, aliases, "A-Z0-9"), key=repr)


def test_plain_aliases_need_one_pass_and_no_text_is_shuffled(spark, tmp_path):
    """What equals an alias is found while the texts are read; only key, product and alias go on."""
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, f"brand#{i % 30} promo|brand#{i % 7} small") for i in range(300)] + [(1, None), (None, "Brand#3")],
                          "id INT, t STRING").write.parquet(path)
    df = spark.read.parquet(path)
    aliases = [("BRAND#1", "P1"), ("BRAND#3", "P2"), ("PROMO", "P3"), ("SMALL", "P1"), ("BRAND#2 PROMO", "P4")]
    found = terms.match_terms(df, "id", "t", spark.createDataFrame(aliases, "alias STRING, product_id STRING"))
    texts = [tuple(r) for r in df.collect()]
    assert rows(found) == sorted(brute_terms(texts, aliases, "A-Z0-9"), key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] parquet") == 1
    assert "collect_list" not in plan and "collect_set" not in plan


def test_aliases_of_many_words_and_line_ends(spark):
    aliases = [("A B C D E", "P1"), ("B C D E", "P2"), ("A\nB", "P3"), ("AB\n", "P4"), ("E A", "P5")]
    texts = [(1, "a b c d e"), (2, "a b c d  e"), (3, "a\nb"), (4, "ab"), (5, "ab\nx"), (6, "b c d e a b c d e a"), (6, "x e a"), (7, "")]
    df = spark.createDataFrame(texts, "id INT, t STRING")
    table = spark.createDataFrame(aliases, "alias STRING, product_id STRING")
    assert rows(terms.match_terms(df, "id", "t", table)) == sorted(brute_terms(texts, aliases, "A-Z0-9"), key=repr)
    none = terms.match_terms(df, "id", "t", table.where("alias = ''"))
    assert none.collect() == [] and none.columns == ["id", "product_id", "best_alias_length"]


def test_overlap_equals_self_join(spark):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    runs = []
    for i in range(400):
        start = base + dt.timedelta(seconds=rng.randint(0, 400))
        end = None if rng.random() < 0.1 else start + dt.timedelta(seconds=rng.choice([0, 1, 5, 60, 300]))
        runs.append((i, rng.choice(["a", "a", "a", "b", None]), start, end))
    expected = {i: any(o[1] == k and k is not None and o[0] != i and o[2] < s and o[3] is not None and o[3] > s for o in runs)
                for i, k, s, _ in runs}
    df = spark.createDataFrame(runs, "id INT, k STRING, s TIMESTAMP, e TIMESTAMP")
    for width in (1, 37, 86_400):
        out = intervals.overlaps_previous(df, "k", "s", "e", width, "hit")
        assert {r.id: r.hit for r in out.collect()} == expected


def test_scd2_cases_and_idempotence(spark):
    first = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (4, "d", 4)], "k INT, note STRING, v INT")
    second = spark.createDataFrame([(1, "A", 1), (2, "b", 2), (4, "d", None), (5, "e", 5)], "k INT, note STRING, v INT")
    start = history.start_history(first, "2024-01-01")
    once = history.scd2_merge(start, second, "k", ["v"], "2024-02-01")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert rows(once) == sorted([
        (1, "a", 1, d1, None), (2, "b", None, d1, d2), (2, "b", 2, d2, None), (3, "c", 3, d1, None),
        (4, "d", 4, d1, d2), (4, "d", None, d2, None), (5, "e", 5, d2, None)], key=repr)
    assert rows(history.scd2_merge(once, second, "k", ["v"], "2024-03-01")) == rows(once)
    assert {r.k for r in history.as_of(once, "2024-02-01").collect()} == {1, 2, 3, 4, 5}
    assert len(history.as_of(once, "2024-01-31").collect()) == 4


def test_history_table_rewrites_open_rows_only(spark, tmp_path):
    path = str(tmp_path / "history")
    first = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "k INT, v INT")
    second = spark.createDataFrame([(1, 1), (2, 9)], "k INT, v INT")
    third = spark.createDataFrame([(1, 5), (2, 9)], "k INT, v INT")
    whole = history.start_history(first, "2024-01-01")
    for snapshot, day in ((second, "2024-02-01"), (second, "2024-02-01"), (third, "2024-03-01")):
        whole = history.scd2_merge(whole, snapshot, "k", ["v"], day)
    write_history(history.start_history(first, "2024-01-01"), path, "1")
    for name, snapshot, day in (("2", second, "2024-02-01"), ("2", second, "2024-02-01"), ("3", third, "2024-03-01")):
        table = read_history(spark, path)
        write_history(history.scd2_step(history.open_versions(table), snapshot, "k", ["v"], day), path, name)
    assert rows(read_history(spark, path).select(*whole.columns)) == rows(whole)


def test_nest_makes_one_document_per_parent(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k INT")
    items = [(1, 2, "x"), (1, 1, "y"), (None, 1, "lost")] + [(2, 7, "same")] * 25 + [(2, i % 9, "z") for i in range(20_000)]
    child = spark.createDataFrame(items, "k INT, seq INT, v STRING")
    docs = nesting.nest(parent, {"items": (child, ["seq", "v"]), "vals": (child, ["v"])}, "k").collect()
    got = {r.k: r for r in docs}
    assert len(docs) == 3 and got[3]["items"] == [] and got[3].vals == []
    assert [tuple(x) for x in got[1]["items"]] == [(1, "y"), (2, "x")] and got[1].vals == ["x", "y"]
    assert [tuple(x) for x in got[2]["items"]] == sorted(i[1:] for i in items if i[0] == 2)


def test_rank_in_equals_rank(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 3, 3), ("b", 1, 4), (None, 2, 5), ("a", 9, 6)],
                               "g STRING, v INT, i INT")
    got = {r.i: r["rank"] for r in ranking.rank_in(df, ["g"], "v").collect()}
    assert got == {6: 1, 1: 2, 2: 2, 3: 4, 4: 1, 5: 1}


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1), ("e", None)], "k STRING, v INT")
    assert rows(ranking.top_n(df, "v", 2)) == [("a", 3), ("b", 2), ("c", 2)]
    assert len(rows(ranking.top_n(df, "v", 10))) == 4


def test_prior_period_gaps(spark):
    df = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2), ("a", 2023, 4)], "g STRING, y INT, v INT")
    out = ranking.prior_period(df, ["g"], "y", "v", "p")
    assert rows(out) == sorted([("a", 2020, 1, None), ("a", 2021, 2, 1), ("a", 2023, 4, None)], key=repr)
    gone = {r.y: (r.v, r.p) for r in ranking.prior_period(df, ["g"], "y", "v", "p", include_gone=True).collect()}
    assert gone == {2020: (1, None), 2021: (2, 1), 2022: (None, 2), 2023: (4, None), 2024: (None, 4)}


def test_unpivot_equals_union_loop(spark):
    df = spark.createDataFrame([("x", "1", None, "9"), ("y", None, "*", None)],
                               "id STRING, Amt_2020 STRING, Amt_2021 STRING, Cnt_2021 STRING")
    out = reshape.unpivot_groups(df, ["id"], {"Amt": "amt", "Cnt": "cnt"}, [2020, 2021])
    loop = None
    for y in (2020, 2021):
        have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
        one = df.select("id", F.lit(y).cast("bigint").alias("year"), have(f"Amt_{y}").alias("amt"), have(f"Cnt_{y}").alias("cnt"))
        loop = one if loop is None else loop.union(one)
    assert rows(out) == rows(loop)
    assert reshape.discover_suffixes(df) == ["2020", "2021"]


def test_slicer_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c STRING")
    assert rows(reshape.slice_rows(df, drop={"c": ["a"]})) == sorted([("b",), (None,)], key=repr)
    assert rows(reshape.slice_rows(df, drop={"c": ["a", None]})) == [("b",)]
    assert rows(reshape.slice_rows(df, keep={"c": ["a"]})) == [("a",)]


def test_codes_and_flags(spark):
    df = spark.createDataFrame([(1, "HO"), (1, "DE"), (1, "HO"), (2, None), (3, "LT"), (3, None)], "k INT, c STRING")
    out = df.groupBy("k").agg(aggregates.codes_text("c").alias("t"), aggregates.any_flag("c", "DE").alias("d"))
    assert rows(out) == [(1, "DE|HO", True), (2, None, None), (3, "LT", False)]


def test_matrix_recounts_distinct_totals(spark):
    df = spark.createDataFrame([("r1", "a", 1), ("r1", "b", 1), ("r2", "a", 1), ("r2", "a", 2), ("r2", "z", 9)],
                               "r STRING, c STRING, id INT")
    got = {x.r: (x.a, x.b, x.Total) for x in aggregates.matrix(df, "r", "c", ["a", "b"], distinct="id").collect()}
    assert got == {"r1": (1, 1, 1), "r2": (2, None, 2), "Total": (2, 1, 2)}


def test_volumes_and_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "k STRING, n INT")
    assert rows(aggregates.volumes(df, "k", ["n"])) == sorted([("a", 3), (None, 4), ("TOTAL", 7)], key=repr)
    got = {r.column: r for r in aggregates.profile(df, ["k"]).collect()}["k"]
    assert (got.n_rows, got.n_null, got.n_distinct, got.min_value, got.top_value) == (3, 1, 1, "a", "a")


def test_star_skips_inactive_and_snowflakes(spark):
    fact = spark.createDataFrame([("p1", 1), ("p9", 2)], "pid STRING, v INT")
    dims = {"product": spark.createDataFrame([("p1", "a1")], "pid STRING, area STRING"),
            "area": spark.createDataFrame([("a1", 7)], "area STRING, sort INT")}
    out = joins.star(fact, dims, [("pid", "product", "pid", True), ("area", "area", "area", True), ("pid", "area", "area", False)])
    assert rows(out) == sorted([("p1", 1, "a1", 7), ("p9", 2, None, None)], key=repr)


def test_share_counts_cases_without_part(spark):
    whole = spark.createDataFrame([("P", 1), ("P", 2), ("P", 3), ("P", 3)], "p STRING, c INT")
    parts = spark.createDataFrame([("P", 1, "x"), ("P", 1, "x"), ("P", 2, "y")], "p STRING, c INT, i STRING")
    out = aggregates.share_of_total(parts, whole, "p", "i", "c", 0.3)
    assert [(r.i, r.cases, round(r.share_of_product_cases, 4)) for r in out.orderBy("i").collect()] == [
        ("x", 1, 0.3333), ("y", 1, 0.3333)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, None, None), (2, "z", 3)], "k INT, c STRING, v INT")
    parent = spark.createDataFrame([(1,)], "id INT")
    report = quality.run_checks(df, "t", [
        quality.Check("unique", "k"), quality.Check("not_null", "k"), quality.Check("accepted_values", "c", values=("a", "b")),
        quality.Check("relationships", "k", to=parent, field_name="id"), quality.Check("expression_is_true", expression="v >= 0"),
        quality.Check("unique_combination", columns=("k", "c"))])
    got = {r.test_name: (r.failures, r.status) for r in report.collect()}
    assert got == {"unique:k": (1, "fail"), "not_null:k": (1, "fail"), "accepted_values:c": (1, "fail"),
                   "relationships:k": (1, "fail"), "expression_is_true:v >= 0": (1, "fail"),
                   "unique_combination:k_c": (0, "pass")}


@pytest.mark.parametrize("as_of,status", [("2024-01-02", "pass"), ("2024-01-05", "warn"), ("2024-02-01", "error")])
def test_freshness(spark, as_of, status):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts TIMESTAMP")
    assert quality.freshness(df, "ts", as_of, 2, 7).first().status == status
    assert quality.freshness(df.limit(0), "ts", as_of, 2, 7).first().status == "error"


def test_standard_checks_cover_all_kinds(spark):
    from tallyward.plans.checks import check_tables, standard_checks

    products = spark.createDataFrame([("P1",)], "product_id STRING")
    suite = [c for checks in standard_checks(products).values() for c in checks]
    kinds = {k: sum(c.kind == k for c in suite) for k in {c.kind for c in suite}}
    assert kinds == {"unique": 20, "not_null": 26, "accepted_values": 3, "relationships": 5, "expression_is_true": 2,
                     "unique_combination": 2}
    runs = spark.createDataFrame([("r",), ("r",), (None,)], "run_id STRING")
    assert {r.test_name: r.failures for r in check_tables({"ingestion_runs": runs}, products).collect()} == {
        "unique:run_id": 1, "not_null:run_id": 1}


def test_one_row_per_recall(spark):
    from tallyward.plans import trials
    columns = ("recall_number STRING, brand_key STRING, product_description STRING, classification STRING, status STRING, "
               "reason_category STRING, reason_for_recall STRING, voluntary_mandated STRING, recall_initiation_date DATE, "
               "classification_date DATE, termination_date DATE")
    day = dt.date(2031, 1, 2)
    rest = ("c", "s", "r", "t", "v", day)
    staged = spark.createDataFrame([
        ("D9", None, "nothing known", *rest, day, None), ("D9", "LOREM", "x", *rest, None, None),
        ("D9", "LOREM", "x", *rest, day, None), ("D8", None, "tablets of lorem", *rest, None, None)], columns)
    aliases = spark.createDataFrame([("LOREM", "P")], "alias STRING, product_id STRING")
    got = {r.recall_number: r for r in trials.recalls(staged, aliases).collect()}
    assert trials.recalls(staged, aliases).count() == 2
    assert (got["D9"].product_id, got["D9"].classification_date, got["D8"].product_id) == ("P", day, "P")
