"""Readers and writers on small files written by the tests."""

import gzip
import json
import logging
import time

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyward.session import clear_layers, shared_folder
from tallyward.sources import delimited, documents, lake, runlog, versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- delimited text ------------------------------------------------------------------------------------------------

COLUMNS = ["alpha", "beta", "gamma"]


def landed(folder, **files):
    for name, lines in files.items():
        (folder / f"{name}.txt").write_bytes("\n".join(lines).encode("latin-1"))
    return str(folder)


def test_aligned_frame_keeps_the_listed_columns(spark):
    wide = spark.createDataFrame([("q", "w", "e", "r")], "` Gamma` STRING, ALPHA STRING, surplus STRING, `Unnamed: 9` STRING")
    out, strange = delimited.align_columns(wide, COLUMNS)
    assert out.columns == COLUMNS and rows(out) == [("w", None, "q")] and strange == ["surplus"]


def test_each_file_has_its_own_header(spark, tmp_path):
    path = landed(tmp_path, one=["ALPHA|beta|Gamma", "1|2|3", "4|5|"], two=["gamma|delta| alpha ", "c|d|a", "", "f||"],
                  three=["beta", "only"], blank=["", "  "])
    read = delimited.read_fixed(spark, path, COLUMNS, sep="|")
    assert rows(read.rows) == rows(spark.createDataFrame(
        [("1", "2", "3"), ("4", "5", None), ("a", None, "c"), (None, None, "f"), (None, "only", None)],
        "a STRING, b STRING, c STRING"))
    assert read.rejected.isEmpty()
    assert [(r.file.rsplit("/", 1)[1], r.name) for r in read.unexpected.collect()] == [("two.txt", "delta")]


@pytest.mark.parametrize("line,expected", [
    ("x|y|z", ("x", "y", "z")), ("x|y|z|", ("x", "y", "z")), ("x", ("x", None, None)), ("|\"y|", (None, '"y', None)),
    ("ß|Ã|þ", ("ß", "Ã", "þ")), ("x|y|z||", None), ("x|y|z|w", None), ("x|y|z|w|", None)])
def test_rows_of_any_width(spark, tmp_path, line, expected):
    read = delimited.read_fixed(spark, landed(tmp_path, f=["alpha|beta|gamma", line]), COLUMNS, sep="|")
    assert (rows(read.rows), rows(read.rejected)) == (([expected], []) if expected else ([], [(line,)]))


def test_a_header_that_ends_with_a_separator(spark, tmp_path):
    read = delimited.read_fixed(spark, landed(tmp_path, f=["beta$alpha$", "1$2$", "3$4"]), COLUMNS)
    assert rows(read.rows) == [("2", "1", None), ("4", "3", None)] and read.unexpected.isEmpty()


# -- partitioned tables --------------------------------------------------------------------------------------------

def spread(spark, **values):
    return spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "part STRING, v INT")


def test_loading_again_replaces_only_when_forced(spark, tmp_path):
    path = str(tmp_path / "table")
    lake.write_partitions(spread(spark, p007=[1, 2], p1=[3]), path, "part")
    lake.write_partitions(spread(spark, p1=[30], p2=[4]), path, "part")
    assert rows(lake.read_bronze(spark, path, partition="part").select("part", "v")) == [
        ("p007", 1), ("p007", 2), ("p1", 3), ("p2", 4)]
    lake.write_partitions(spread(spark, p1=[30, 31]), path, "part", force=True)
    one = lake.read_bronze(spark, path, "p1", ["v"], partition="part")
    assert rows(one) == [(30,), (31,)]
    assert "PartitionFilters: [isnotnull(part" in one._jdf.queryExecution().executedPlan().toString()


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("007", 1), ("7", 2), ("a b/c", 3), (None, 4)], "part STRING, v INT")
    lake.write_partitions(df, path, "part")
    assert rows(lake.read_bronze(spark, path, partition="part").select("part", "v")) == rows(df)
    assert rows(lake.read_bronze(spark, path, "007", ["v"], partition="part")) == [(1,)]
    assert rows(lake.present_partitions(spark, path, "part")) == rows(df.select("part"))


def test_a_partition_is_missing_if_one_table_lacks_it(spark, tmp_path):
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    wanted = spark.createDataFrame([("x",), ("y",), ("z",)], "part STRING")
    assert lake.missing_partitions(wanted, [both, one], "part").count() == 3
    lake.write_partitions(spread(spark, x=[1], y=[1]), both, "part")
    lake.write_partitions(spread(spark, y=[1], z=[1]), one, "part")
    assert rows(lake.missing_partitions(wanted, [both, one], "part")) == [("x",), ("z",)]


def test_a_table_may_be_refreshed_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_table(spark.range(6), path)
    lake.write_table(lake.read_table(spark, path).where("id % 2 = 0"), path)
    assert rows(lake.read_table(spark, path)) == [(0,), (2,), (4,)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        lake.write_table(lake.read_table(spark, path).selectExpr("1 div (id - 2) AS id"), path)
    assert rows(lake.read_table(spark, path)) == [(0,), (2,), (4,)]
    lake.write_table(spark.range(4, 5), path, "append")
    assert lake.read_table(spark, path).count() == 4


@pytest.mark.parametrize("step", ["publish", "forget"])
def test_a_refresh_that_dies_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    lake.write_table(spark.range(3), path)
    before = lake.read_table(spark, path)

    def die(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(versions, step, die)
    with pytest.raises(RuntimeError):
        lake.write_table(spark.range(10), path)
    assert lake.read_table(spark, path).count() == (3 if step == "publish" else 10)
    assert before.count() == 3  # who has begun to read goes on
    monkeypatch.undo()
    lake.write_table(spark.range(4), path)
    assert lake.read_table(spark, path).count() == 4


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        lake.write_table(spark.range(n), path)
    assert len(list(tmp_path.glob("t/version-*"))) == len(list(tmp_path.glob("t/_commits/0*"))) == versions.KEPT
    assert versions.current_folder(spark, str(tmp_path / "none")) is None


def touched(folder, **ranges):
    """Files whose ranges meet the filter, and all files, by the Parquet footers."""
    files = sorted(folder.glob("part-*.parquet"))
    hit = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        place = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        hit += any(all((st := g.column(place[c]).statistics) and st.min <= high and st.max >= low
                       for c, (low, high) in ranges.items()) for g in groups)
    return hit, len(files)


def test_layout_by_several_columns_skips_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(40_000).selectExpr("(id * 7919) % 1000 AS a", "(id * 104729) % 997 AS b", "concat('n', id % 50) AS c",
                                            "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS hot", "id")
        lake.materialise(df, "z", cluster_by=["a", "b"], path=str(tmp_path / "z"))
        lake.materialise(df, "one", cluster_by=["hot"], path=str(tmp_path / "one"))
        lake.materialise(df.withColumn("a", F.when(F.col("a") > 10, F.col("a"))), "text", cluster_by=["c", "a"], path=str(tmp_path / "text"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for folder in ("z", "one", "text"):
        assert sorted(r.id for r in spark.read.parquet(str(tmp_path / folder)).select("id").collect()) == list(range(40_000))
    for ranges in ({"a": (100, 120)}, {"b": (500, 520)}):
        hit, files = touched(tmp_path / "z", **ranges)
        assert files > 40 and hit <= files / 3
    assert touched(tmp_path / "z", a=(100, 120), b=(500, 520))[0] <= 6
    assert touched(tmp_path / "text", c=("n7", "n7"))[0] <= 64 / 3
    # A value that a third of the rows have stands in many files, so no task wrote all of it.
    assert touched(tmp_path / "one", hot=(5, 5))[0] > 15 and touched(tmp_path / "one", hot=(30_000, 31_000))[0] <= 4


def test_headers_are_sent_not_lines(spark, tmp_path):
    folder = landed(tmp_path, a=["ALPHA$beta$gamma", "1$2$3"], b=["gamma$alpha", "6$4"])
    read = delimited.read_fixed(spark, folder, COLUMNS)
    assert rows(read.rows) == [("1", "2", "3"), ("4", None, "6")]
    plan = read.rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan


# -- documents -----------------------------------------------------------------------------------------------------

DAYS = "n BIGINT, seen TIMESTAMP"


def json_file(path, lines):
    with gzip.open(path, "wt") as out:
        out.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(path)


def test_appended_lines(spark, tmp_path):
    schema = spark.createDataFrame([], DAYS).schema
    table = str(tmp_path / "table")
    good = json_file(tmp_path / "a.jsonl.gz", [{"n": 4, "seen": "2031-03-04T05:06:07", "more": [1]}, {"n": 5}])
    for _ in range(3):
        lake.append_json(spark, good, schema, table, "seen", "day")
    out = spark.read.parquet(table)
    assert out.columns == ["n", "seen", "day"] and out.count() == 6
    with pytest.raises(Exception, match="MALFORMED"):
        lake.append_json(spark, json_file(tmp_path / "b.jsonl.gz", [{"n": 6}, "{cut"]), schema, table, "seen", "day")
    assert spark.read.parquet(table).count() == 6


def test_rates_without_a_number_are_left_out(spark, tmp_path):
    head = "KEY,FREQ,CURRENCY,CURRENCY_DENOM,TIME_PERIOD,OBS_VALUE"
    (tmp_path / "r.csv").write_text("\n".join([head, "a,D,SEK,EUR,2031-01-02,11.5", "b,D,NOK,EUR,2031-01-02,-", "c,D,NOK,EUR,,12",
                                              "d,D,DKK,EUR,2031-01-02,", "e,D,SEK,EUR,2031-01-01,11.25"]))
    out = documents.read_fx(spark, str(tmp_path / "r.csv"))
    assert out.columns == ["rate_date", "currency", "base_currency", "rate"]
    assert [(str(r.rate_date), r.currency, r.rate) for r in out.collect() if r.rate_date] == [
        ("2031-01-01", "SEK", 11.25), ("2031-01-02", "SEK", 11.5)]


def study(**modules):
    return {"protocolSection": modules}


def test_flat_studies(spark, tmp_path):
    docs = [
        study(identificationModule={"nctId": "N7"}, designModule={"phases": ["PHASE1"], "enrollmentInfo": {"count": 12}},
              sponsorCollaboratorsModule={"collaborators": [{"name": "K"}, {"name": "L"}, {"name": "K"}]},
              conditionsModule={"conditions": ["c1", "c2"], "keywords": ["k1", "k2"]},
              contactsLocationsModule={"locations": [{"country": "Chile"}, {"country": "Peru"}, {"country": "Chile"}, {}]}),
        study(identificationModule={"nctId": "N8"}, designModule={"phases": []}), {"hasResults": True}]
    (tmp_path / "s.jsonl").write_text("\n".join(map(json.dumps, docs)))
    flat = documents.flatten_studies(
        documents.read_documents(spark, str(tmp_path / "s.jsonl"), documents.STUDY_SCHEMA), "2031-01-01")
    got = {r.nct_id: r.asDict() for r in flat.collect()}
    assert len(got) == 3 and len(flat.columns) == 26
    assert (got["N7"]["phases"], got["N7"]["enrollment_count"], got["N7"]["countries"], got["N7"]["location_count"]) == (
        "PHASE1", 12, "Chile|Peru", 4)
    assert "K|L" in got["N7"].values() and "k1|k2" in got["N7"].values()
    assert got["N8"]["phases"] is None and got["N8"]["location_count"] == 0 and got[None]["has_results"]


@pytest.mark.parametrize("names,expected", [(["B", "A", "B"], "B|A|B"), ([], None), (None, None), (["", "A"], "|A")])
def test_flat_recalls(spark, tmp_path, names, expected):
    (tmp_path / "r.json").write_text(json.dumps([{"recall_number": "Z", "openfda": {"brand_name": names}}]))
    df = documents.read_documents(spark, str(tmp_path / "r.json"), documents.RECALL_SCHEMA, multiline=True)
    assert [r.brand_names for r in documents.flatten_recalls(df).collect()] == [expected]


def test_wide_rows_are_text_whatever_they_hold(spark, tmp_path):
    lines = [{"Name": "x", "Spnd_2031": 2.50, "Spnd_2030": "*"}, {"Spnd_2029": 8}]
    (tmp_path / "w.json").write_text("\n".join(map(json.dumps, lines)))
    df, years = documents.read_wide(spark, str(tmp_path / "w.json"))
    assert years == ["2029", "2030", "2031"] and {k for _, k in df.dtypes} == {"string"}
    (tmp_path / "w.json").write_text(json.dumps(lines))
    assert documents.read_wide(spark, str(tmp_path / "w.json"), multiline=True)[0].count() == 2


# -- records -------------------------------------------------------------------------------------------------------

def test_a_run_leaves_its_record(spark, tmp_path):
    log = str(tmp_path / "log")
    with runlog.RunRecord(spark, "prices", log, "cron") as run:
        run.loaded(41, files=2, size=900, target="here")
    row = spark.read.schema(runlog.RUN_SCHEMA).parquet(log).first()
    assert (row.source, row.status, row.rows_loaded, row.files_written, row.bytes_written, row.target, row.triggered_by) == (
        "prices", "success", 41, 2, 900, "here", "cron")
    assert row.started_at <= row.finished_at and row.duration_sec >= 0 and row.error_message is None


@pytest.mark.parametrize("error,status,text", [
    (OSError("long " * 900), "failed", "long " * 900), (KeyboardInterrupt(), "cancelled", "KeyboardInterrupt")])
def test_an_error_is_recorded_and_goes_on(spark, tmp_path, error, status, text):
    log = str(tmp_path / "log")
    with pytest.raises(type(error)), runlog.RunRecord(spark, "prices", log):
        raise error
    assert [(r.status, r.error_message) for r in spark.read.parquet(log).collect()] == [(status, text)]


def test_a_log_out_of_reach_hides_nothing(spark, tmp_path, caplog):
    (tmp_path / "file").write_text("no folder")
    with caplog.at_level(logging.WARNING):
        with pytest.raises(ZeroDivisionError), runlog.RunRecord(spark, "prices", str(tmp_path / "file" / "log")):
            raise ZeroDivisionError
        with runlog.RunRecord(spark, "prices", str(tmp_path / "file" / "log")):
            pass
    assert caplog.text.count("run record not written") == 2


def test_result_records(spark, tmp_path):
    log = str(tmp_path / "log")
    tests = spark.createDataFrame([("t", "unique:k", 3, "fail")], "table_name STRING, test_name STRING, failures BIGINT, status STRING")
    models = spark.createDataFrame([("m", "success", 12, 2.25)], "node_name STRING, status STRING, bytes_billed INT, execution_time_sec DOUBLE")
    runlog.log_results(tests, "i", "2031-01-01 00:00:00", "dev", log)
    runlog.log_results(models, "i", "2031-01-01 00:00:00", "dev", log, "model")
    out = spark.read.schema(runlog.RESULT_SCHEMA).parquet(log)
    assert len(out.columns) == 13
    assert rows(out.select("node_id", "status", "failures", "bytes_billed", "execution_time_sec")) == [
        ("model.m", "success", None, 12, 2.25), ("test.t.unique:k", "fail", 3, None, None)]


def test_volumes_of_layers(spark, tmp_path):
    full, empty = str(tmp_path / "full"), str(tmp_path / "empty")
    spark.range(21).repartition(2).write.parquet(full)
    spark.range(0).write.parquet(empty)
    got = {r.table_id: r for r in lake.layer_volumes(spark, lake.layer_paths({"l": {"full": full, "empty": empty}})).collect()}
    assert (got["full"].row_count, got["empty"].row_count) == (21, 0) and got["full"].size_bytes > 0


def test_shared_folder_is_fresh_and_can_be_cleared(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(first)
    clear_layers(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(first)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(f.getName()) for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks)
            if f.getName().startswith("shuffle_")}


def test_a_written_layer_leaves_no_shuffle_files(spark):
    """They stay for as long as the frame is known to the driver otherwise."""
    before = shuffle_files(spark)
    df = spark.range(10_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count()
    layer = lake.materialise(df, "counted")
    wait = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < wait:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert layer.count() == 100 and df.count() == 100
    assert spark.conf.get(lake.CLEANUP) == "false"


@pytest.mark.parametrize("kind", ["double", "string", "timestamp_ntz"])
def test_places_on_the_curve_by_counting_bounds(spark, kind):
    """Each value is compared with a few bounds once, not with all of them for every bit."""
    numbers = [None, 5.0, 5.0, -1.5, 0.0, 1e9] + [float(i * i % 97) for i in range(200)]
    numbers += [float("nan"), float("inf"), float("-inf")] if kind == "double" else []
    df = spark.createDataFrame([(x, i % 5) for i, x in enumerate(numbers)], "x DOUBLE, y INT")
    if kind == "string":
        df = df.withColumn("x", F.col("x").cast("string"))
    elif kind == "timestamp_ntz":
        df = df.withColumn("x", F.timestamp_seconds(F.col("x")).cast(kind))
    columns = ["x", "y"]
    out = df.withColumn("curve", lake.interleaved(df, columns))
    places = {c: lake._position(dict(df.dtypes)[c], c) for c in columns}
    steps = [i / 2 ** lake.BITS for i in range(1, 2 ** lake.BITS)]
    cuts = df.agg(*[F.percentile_approx(p, steps, 10_000).alias(c) for c, p in places.items()]).first()
    for r in out.select("curve", *[F.array(*[F.lit(b) <= places[c] for b in cuts[c]]).alias(c) for c in columns]).collect():
        want = sum((sum(map(bool, r[c])) >> bit & 1) << bit * 2 + k for k, c in enumerate(columns) for bit in range(lake.BITS))
        assert r.curve == want
    assert "filter(" not in out._jdf.queryExecution().optimizedPlan().toString()
