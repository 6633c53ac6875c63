"""Event contract, routing, restarts, replays and stream against batch."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import sequence
from tallyward.streaming import intake, seen

MESSAGE = "topic STRING, partition BIGINT, offset BIGINT, key STRING, value STRING"
LOADED = ["event_id", "source_quarter", "received_at", *intake.CASE_FIELDS, "patient", "drugs", "reactions", "outcomes"]


def suspect(role="PS", name=None, ingredient=None):
    return {"drug_seq": "3", "role_cod": role, "drugname": name, "prod_ai": ingredient}


def report(number=70, without=(), **fields):
    event = {"event_id": f"id-{number}", "event_type": "report", "schema_version": 2, "source_quarter": "2031Q2",
             "received_at": "2031-05-06 07:08:09", "primaryid": str(number), "caseid": str(number // 10),
             "fda_dt": "20310505", "patient": {"sex": "M"}, "drugs": [suspect(name="Lorem")], "reactions": ["Ipsum"], **fields}
    return {k: v for k, v in event.items() if k not in without}


def messages(spark, events, start=0):
    values = [e if isinstance(e, str) else json.dumps(e) for e in events]
    return spark.createDataFrame([("top", i % 2, start + i, None, v) for i, v in enumerate(values)], MESSAGE)


def checked(spark, events):
    return intake.validate(intake.parse(messages(spark, events)), intake.REQUIRED_FIELDS, intake.report_rules())


def errors(spark, events):
    return [r.errors for r in checked(spark, events).orderBy("offset").collect()]


@pytest.mark.parametrize("event,expected", [
    (report(), []),
    (report(without=["event_id", "caseid"]), ["missing event_id", "missing caseid"]),
    (report(received_at="", fda_dt=""), ["missing fda_dt", "missing received_at"]),
    (report(fda_dt="20310230"), ["invalid fda_dt"]), (report(fda_dt="2031"), ["invalid fda_dt"]),
    (report(drugs=[]), ["no drugs"]), (report(without=["drugs"]), ["no drugs"]),
    (report(drugs=[suspect("SS"), suspect(None)]), ["no primary suspect drug"]),
    (report(drugs=[suspect("C"), suspect("PS")]), []),
    (report(reactions=[]), ["no reactions"]), (report(without=["reactions", "drugs"]), ["no drugs", "no reactions"]),
    ("{\"event_id\": ", ["invalid json"]), ("", ["invalid json"]), ("12", ["invalid json"]), ("[{}]", ["invalid json"])])
def test_contract(spark, event, expected):
    assert sorted(errors(spark, [event])[0]) == sorted(expected)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["primaryid", "caseid", "fda_dt", "drugs", "reactions"]), min_size=1, max_size=5, unique=True))
def test_whatever_is_taken_away_is_named(spark, gone):
    found = errors(spark, [report(without=gone)])[0]
    assert len(found) == len(gone)


def test_dead_letters_are_the_messages_themselves(spark):
    bad = report(8, reactions=[], caseid=None)
    dead, = intake.dead_letters(checked(spark, [report(7), bad])).collect()
    assert (dead.topic, dead.partition, dead.offset, json.loads(dead.value)) == ("top", 1, 1, bad)
    assert dead.error == "missing caseid; no reactions"


def test_valid_rows_are_typed_and_placed(spark):
    row, = intake.valid_rows(checked(spark, [report(7)]), ["event_id", "received_at"]).collect()
    assert row.asDict() == {"event_id": "id-7", "received_at": datetime(2031, 5, 6, 7, 8, 9),
                            "kafka_partition": 0, "kafka_offset": 0}


def test_metrics_name_time_and_target(spark):
    row = intake.batch_metrics(checked(spark, [report(1), report(2, drugs=[]), "x"]), "top", "g", 6, 2.0, uri="u").first()
    assert (row.messages, row.valid, row.invalid, row.consumer_lag, row.uri, row.throughput_msg_per_sec) == (3, 1, 2, 6, "u", 1.5)
    assert isinstance(row.batch_ts, datetime)
    empty = intake.batch_metrics(checked(spark, [report()]).limit(0), "top", "g").first()
    assert (empty.messages, empty.valid, empty.invalid, empty.invalid_rate) == (0, 0, 0, None)


class Chain:
    """A topic as a folder, with the sinks of an intake that reads it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.sinks = {kind: f"{folder}/{kind}" for kind in ("valid", "dead", "metrics")}
        self.work = intake.intake_batch(self.sinks, LOADED, intake.REQUIRED_FIELDS, intake.report_rules(), topic="top", key="caseid")

    def send(self, events, start=0):
        messages(self.spark, events, start).coalesce(2).write.mode("append").parquet(f"{self.folder}/topic")

    def drain(self, checkpoint="cp"):
        stream = intake.open_stream(self.spark, "parquet", MESSAGE, max_per_trigger=1, path=f"{self.folder}/topic")
        intake.start(stream, self.work, f"{self.folder}/{checkpoint}", once=True).awaitTermination()

    def table(self, kind="valid"):
        return self.spark.read.parquet(self.sinks[kind])

    def ids(self):
        return sorted(r.event_id for r in self.table().collect())


@pytest.fixture
def chain(spark, tmp_path):
    return Chain(spark, tmp_path)


def test_stream_loads_what_a_batch_would(spark, chain):
    events = [report(i, reactions=["r"] * (i % 4)) for i in range(30)] + ["torn {"]
    chain.send(events)
    chain.drain()
    assert chain.ids() == sorted(f"id-{i}" for i in range(30) if i % 4)
    assert chain.table("dead").count() == 9
    sums = chain.table("metrics").agg(F.sum("messages"), F.sum("valid"), F.sum("invalid")).first()
    assert tuple(sums) == (31, 22, 9)
    chain.drain()
    chain.send([report(99)], 50)
    chain.drain()
    assert len(chain.ids()) == 23


def test_a_replayed_batch_replaces_itself(spark, chain):
    for _ in range(2):
        chain.work(messages(spark, [report(1), report(2)]), 0)
        chain.work(messages(spark, [report(3), "x"]), 1)
    assert chain.ids() == ["id-1", "id-2", "id-3"] and chain.table("dead").count() == 1


def test_a_new_checkpoint_adds_to_the_table(spark, chain):
    chain.send([report(1)])
    chain.drain("first")
    chain.send([report(2)], 1)
    chain.drain("second")  # starts anew: its first batches have the numbers of the first query's
    assert chain.ids() == ["id-1", "id-1", "id-2"]
    assert chain.table().select("batch_id").distinct().count() >= 2


def test_the_table_can_be_staged_and_enriched_as_it_is(spark, chain):
    chain.send([
        report(1, outcomes=["HO", "DE"]), report(2, drugs=[suspect("C", "Lorem"), suspect(name="x", ingredient=" dolor.")]),
        report(3, drugs=[suspect(name="unknown")]), report(1)])
    chain.drain()
    staged = intake.stage_events(chain.table())
    aliases = spark.createDataFrame([("LOREM", "A", False), ("DOLOR", "B", True)],
                                    "alias STRING, product_id STRING, requires_owner BOOLEAN")
    got = {r.event_id: r for r in intake.enrich_stream(staged, aliases).collect()}
    assert {k: (r.product_id, r.drug_count) for k, r in got.items()} == {
        "id-1": ("A", 1), "id-2": ("B", 2), "id-3": (None, 1)}
    assert got["id-2"].is_serious is False and str(got["id-2"].received_date) == "2031-05-06"


def test_rows_of_a_key_stay_in_order(spark):
    """Read by partition, each key is in order; a key that has nearly all rows is in several partitions."""
    df = spark.range(4000).selectExpr("CASE WHEN id % 10 = 0 THEN concat('k', id % 7) ELSE 'hot' END AS k", "(id * 101) % 4000 AS o")
    placed = sequence.in_key_order(df, "k", "o").select(
        "k", "o", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")).collect()
    for key in {r.k for r in placed}:
        mine = sorted((r.i, r.o, r.p) for r in placed if r.k == key)
        assert [o for _, o, _ in mine] == sorted(o for _, o, _ in mine)
    with_aqe = {r.p for r in placed if r.k == "hot"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = sequence.in_key_order(df, "k", "o").where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread > 4 and with_aqe


def test_places_in_a_key(spark):
    rows = [("a", o) for o in (5, -3, 12, 12, 99, 1000, None)] + [("b", 1), (None, 7), (None, 2), (None, None)]
    df = spark.createDataFrame(rows, "k STRING, o BIGINT").withColumn("at", F.monotonically_increasing_id())
    for span in (1, 10, 1_000_000):
        got = sequence.number_in_key(df, "k", "o", ties=["at"], span=span)
        assert got.columns == ["k", "o", "at", "place"]
        want = []
        for key in ("a", "b", None):
            mine = sorted([r for r in df.collect() if r.k == key], key=lambda r: (r.o is not None, r.o or 0, r.at))
            want += [(r.k, r.o, r.at, i + 1) for i, r in enumerate(mine)]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


class Loads:
    """Batches loaded once per id, as a stream with a checkpoint of its own would send them."""

    def __init__(self, spark, folder, **options):
        self.spark, self.table, self.seen = spark, f"{folder}/table", f"{folder}/seen"
        self.work = seen.unique_batch(self.table, self.seen, "id", ["at"], buckets=4, **options)

    def send(self, rows, number, query="direct"):
        self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
        try:
            self.work(self.spark.createDataFrame(rows, "id STRING, at BIGINT"), number)
        finally:
            self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)

    def rows(self):
        return sorted(((r.id, r.at) for r in self.spark.read.parquet(self.table).collect()), key=repr)


def test_an_id_is_loaded_once_for_good(spark, tmp_path):
    loads = Loads(spark, tmp_path, compact_every=0)
    loads.send([("x", 1), ("y", 2), ("x", 3), (None, 4), (None, 5)], 0)
    loads.send([("y", 6), ("z", 7)], 1)
    loads.send([("x", 8), ("z", 9), ("w", 10)], 0, "another checkpoint")
    want = sorted([("x", 1), ("y", 2), (None, 4), (None, 5), ("z", 7), ("w", 10)], key=repr)
    assert loads.rows() == want
    for _ in range(2):  # a batch that runs again replaces itself
        loads.send([("y", 6), ("z", 7)], 1)
    assert loads.rows() == want
    seen.compact(spark, loads.seen)
    ids = seen.seen_ids(spark, loads.seen)
    assert sorted(r.id for r in ids.collect()) == ["w", "x", "y", "z"]
    loads.send([("w", 11), ("v", 12)], 2)
    assert loads.rows() == sorted([*want, ("v", 12)], key=repr)


def test_a_load_that_dies_before_its_ids_are_kept(spark, tmp_path, monkeypatch):
    loads = Loads(spark, tmp_path)
    loads.send([("x", 1)], 0)
    remember = seen.remember

    def die(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(seen, "remember", die)
    with pytest.raises(RuntimeError):
        loads.send([("x", 2), ("y", 3)], 1)
    monkeypatch.setattr(seen, "remember", remember)
    loads.send([("x", 2), ("y", 3)], 1)
    loads.send([("y", 4)], 2)
    assert loads.rows() == [("x", 1), ("y", 3)]


def test_compaction_comes_with_the_batches(spark, tmp_path):
    loads = Loads(spark, tmp_path, compact_every=2)
    for n in range(6):
        loads.send([("same", n), (f"id{n}", n)], n)
    assert loads.rows() == sorted([("same", 0), *((f"id{n}", n) for n in range(6))])
    assert len(seen.seen_ids(spark, loads.seen).inputFiles()) <= 4


@pytest.mark.parametrize("horizon,kept", [("2 hours", 4), ("40 days", 3)])
def test_copies_within_the_horizon(spark, tmp_path, horizon, kept):
    """The state of an id goes with the batch after the watermark has passed it."""
    for i, (name, day) in enumerate([("x", 3), ("y", 15), ("z", 15), ("x", 17)]):
        rows = [(name, datetime(2031, 5, day))] * 2
        spark.createDataFrame(rows, "id STRING, ts TIMESTAMP").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = intake.open_stream(spark, "parquet", "id STRING, ts TIMESTAMP", max_per_trigger=1, path=str(tmp_path / "in" / "*"))
    intake.dedup_stream(stream, "id", "ts", horizon).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == kept


@pytest.mark.parametrize("progress,lag", [
    (None, 0), ({}, 0), ({"sources": [{"endOffset": None, "latestOffset": None}]}, 0),
    ({"sources": [{"endOffset": {"a": {"0": 11}}, "latestOffset": {"a": {"0": 15, "1": 2}, "b": {"0": 1}}}]}, 7),
    ({"sources": [{"endOffset": '{"a": {"0": 9}}', "latestOffset": '{"a": {"0": 4}}'}]}, 0)])
def test_lag(progress, lag):
    assert intake.consumer_lag(progress) == lag
