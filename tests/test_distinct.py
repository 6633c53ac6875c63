"""Stored distinct counts against counting all rows again."""

import random
from collections import defaultdict

import pytest

from tallyward.operators import distinct
from tallyward.sources.lake import materialise


@pytest.fixture(scope="module")
def loads(spark):
    """Three loads of (id, a, b) with ids of several buckets, repeats within and across loads, and nulls."""
    draw = random.Random(11)
    rows = [[(draw.choice([None, *range(0, 200_000, 997)]), draw.choice(["u", "v", None]), draw.randrange(3))
             for _ in range(500)] for _ in range(3)]
    numbers = spark.range(0, 200_000).selectExpr("id", "id * 3 AS number")
    return rows, [spark.createDataFrame(r, "id BIGINT, a STRING, b INT").join(numbers, "id", "left") for r in rows]


@pytest.mark.parametrize("form", [distinct.bitmap_cells, distinct.list_cells])
def test_merged_loads_equal_one_count(loads, form):
    rows, frames = loads
    cells = distinct.merge_cells([form(f, ["a", "b"]) for f in frames], ["a", "b"])
    want = defaultdict(set)
    for i, a, b in [r for load in rows for r in load]:
        if i is not None:
            for level, key in enumerate([(a, b), (a, None), (None, b), (None, None)]):
                want[level, *key].add(i)
    got = distinct.count_unions(cells, [["a", "b"], ["a"], ["b"], []]).collect()
    assert {(r.level, r.a, r.b): r.cases for r in got} == {k: len(v) for k, v in want.items()}
    # Merging again, also with parts of itself, changes nothing.
    twice = distinct.merge_cells([cells, cells.where("a = 'u'"), form(frames[0], ["a", "b"])], ["a", "b"])
    assert sorted(map(tuple, distinct.count_cells(twice, ["b"]).collect())) == sorted(
        (b, len(v)) for (level, _, b), v in want.items() if level == 2)
    assert cells.groupBy("a", "b", "bucket").count().where("count > 1").isEmpty()


def test_matrix_equals_counting_again(spark, loads):
    from tallyward.operators.aggregates import matrix

    rows, frames = loads
    cells = distinct.merge_cells([distinct.bitmap_cells(f, ["a", "b"]) for f in frames], ["a", "b"])
    whole = frames[0].unionAll(frames[1]).unionAll(frames[2]).where("id IS NOT NULL")
    show = lambda df: sorted(map(repr, df.collect()))
    assert show(distinct.matrix_of_cells(cells, "b", "a", ["u", "v"])) == show(matrix(whole, "b", "a", ["u", "v"], distinct="id"))


def test_numbers_are_dense_and_stay(spark):
    first = spark.createDataFrame([(x,) for x in ["p", "q", "q", None, "r"]], "k STRING").repartition(3)
    one = distinct.number_keys(first, "k", keep=materialise)
    assert sorted(r.number for r in one.collect()) == [0, 1, 2]
    more = spark.createDataFrame([(x,) for x in ["q", "s", "t", None, "s"]], "k STRING").repartition(4)
    two = {r.k: r.number for r in distinct.number_keys(more, "k", one, keep=materialise).collect()}
    assert {k: two[k] for k in "pqr"} == {r.k: r.number for r in one.collect()}
    assert sorted(two.values()) == [0, 1, 2, 3, 4] and set(two) == set("pqrst")
    none = distinct.number_keys(first.limit(0), "k", keep=materialise)
    assert none.count() == 0
    assert sorted(r.number for r in distinct.number_keys(more, "k", none, keep=materialise).collect()) == [0, 1, 2]


def test_no_rows_no_cells(loads):
    _, frames = loads
    for form in (distinct.bitmap_cells, distinct.list_cells):
        assert distinct.count_cells(form(frames[0].limit(0), ["a"]), ["a"]).count() == 0
