"""Event intake in batch form and as running streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.gallery import Tables, query
from tallyward.gallery.readings import SEEDS_SQL, aliases, raw_drugs
from tallyward.operators import sequence
from tallyward.operators.nesting import nest
from tallyward.plans import observability
from tallyward.plans.measures import measure
from tallyward.plans.reports import batches_over_time
from tallyward.session import shared_folder
from tallyward.sources.lake import materialise
from tallyward.streaming import intake, seen


def event_messages(t: Tables) -> DataFrame:
    """Orders with their lines as nested JSON messages; some lack fields or are cut open."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    drugs = raw_drugs(t).select(F.col("primaryid").cast("bigint").alias("o_orderkey"), *intake.DRUG_FIELDS)
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("pt"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_returnflag", "l_linenumber")
    codes = F.when(F.col("l_returnflag") == "R", "DE").when(F.col("l_returnflag") == "A", "HO")
    docs = nest(t.orders, {
        "drugs": (drugs, intake.DRUG_FIELDS),
        "reactions": (lines.join(part, "l_partkey"), ["pt"]),
        "outcomes": (lines.select("o_orderkey", codes.alias("code")).where("code IS NOT NULL"), ["code"]),
    }, "o_orderkey")
    none = F.lit(None).cast("string")
    case = {
        "primaryid": F.when(F.col("o_totalprice") < 9000, "").otherwise(F.col("o_orderkey").cast("string")),
        "caseid": F.col("o_custkey").cast("string"),
        "fda_dt": F.when(priority == "5-LOW", F.date_format("o_orderdate", "yyyyMM"))
        .when((priority != "4-NOT SPECIFIED") | (status != "P"), F.date_format("o_orderdate", "yyyyMMdd")),
        "mfr_sndr": F.lower(priority)}
    body = F.to_json(F.struct(
        F.md5(F.col("o_orderkey").cast("string")).alias("event_id"), F.lit("report").alias("event_type"),
        F.lit(1).cast("bigint").alias("schema_version"), F.lit("2000Q1").alias("source_quarter"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("received_at"),
        *[case.get(f, none).alias(f) for f in intake.CASE_FIELDS],
        F.struct(*[none.alias(f) for f in intake.PATIENT_FIELDS]).alias("patient"), "drugs", "reactions", "outcomes"))
    broken = (status == "P") & (priority == "1-URGENT")
    return docs.select(
        F.lit("intake").alias("topic"),
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).cast("bigint").alias("partition"),
        F.col("o_orderkey").alias("offset"), F.col("o_custkey").cast("string").alias("key"),
        F.when(broken, F.concat(F.lit("["), body)).otherwise(body).alias("value"), "o_orderdate")


def checked(t: Tables) -> DataFrame:
    return intake.validate(intake.parse(event_messages(t)), intake.REQUIRED_FIELDS, intake.report_rules())


MESSAGES_SQL = """
line_facts AS (
  SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linenumber <= 2) AS ps, count(*) FILTER (l_returnflag IN ('A', 'R'))
    AS outcomes, bool_or(l_returnflag = 'R') AS death FROM lineitem GROUP BY 1),
checked AS (
  SELECT o.*, coalesce(n, 0) AS n, coalesce(outcomes, 0) AS outcomes, coalesce(death, false) AS death,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'invalid json' ELSE concat_ws('; ',
      CASE WHEN o_totalprice < 9000 THEN 'missing primaryid' END,
      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'missing fda_dt' END,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'invalid fda_dt' END,
      CASE WHEN n IS NULL THEN 'no drugs' END, CASE WHEN n > 0 AND ps = 0 THEN 'no primary suspect drug' END,
      CASE WHEN n IS NULL THEN 'no reactions' END) END AS errors
  FROM orders o LEFT JOIN line_facts ON l_orderkey = o_orderkey)
"""


@query("intake_errors", f"""WITH {MESSAGES_SQL}
SELECT errors AS error, count(*) AS n FROM checked WHERE errors != '' GROUP BY 1""")
def intake_errors(t: Tables) -> DataFrame:
    return intake.dead_letters(checked(t)).groupBy("error").agg(F.count("*").alias("n"))


@query("intake_batches", f"""WITH {MESSAGES_SQL}
SELECT year(o_orderdate) AS batch, count(*) AS messages, count(*) FILTER (errors = '') AS valid,
  count(*) FILTER (errors != '') AS invalid, round(count(*) FILTER (errors != '') / count(*), 6) AS invalid_rate
FROM checked GROUP BY 1""")
def intake_batches(t: Tables) -> DataFrame:
    rows = checked(t).withColumn("batch", F.year("o_orderdate").cast("bigint"))
    return intake.batch_metrics(rows, "intake", "loader", by=["batch"]).select(
        "batch", "messages", "valid", "invalid", F.round("invalid_rate", 6).alias("invalid_rate"))


def stream_batches(t: Tables) -> DataFrame:
    """Lines as batch records: one per order date, with lag and throughput."""
    batches = t.lineitem.groupBy(F.to_date("l_shipdate").alias("batch_ts"), "l_linestatus").agg(
        F.count("*").alias("messages"), F.count_if(F.col("l_returnflag") == "R").alias("invalid"),
        F.max("l_linenumber").cast("bigint").alias("consumer_lag"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("throughput_msg_per_sec"),
    ).withColumn("valid", F.col("messages") - F.col("invalid"))
    return observability.stream_batches(batches)


_BATCH_SQL = """WITH b AS (SELECT CAST(l_shipdate AS DATE) AS batch_ts, l_linestatus, count(*) AS messages,
  count(*) FILTER (l_returnflag = 'R') AS invalid, max(l_linenumber) AS lag,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS thr FROM lineitem GROUP BY 1, 2)"""


@query("stream_measures", f"""{_BATCH_SQL}
SELECT l_linestatus, CAST(sum(messages) AS BIGINT) AS stream_messages, CAST(sum(messages - invalid) AS BIGINT) AS stream_valid,
  CAST(sum(invalid) AS BIGINT) AS stream_invalid, round(sum(invalid) / sum(messages), 6) AS stream_invalid_rate,
  CAST(max(lag) AS BIGINT) AS stream_max_lag, round(avg(thr), 6) AS stream_avg_throughput FROM b GROUP BY 1""")
def stream_measures(t: Tables) -> DataFrame:
    names = ["stream_messages", "stream_valid", "stream_invalid", "stream_invalid_rate", "stream_max_lag",
             "stream_avg_throughput"]
    out = measure(names, stream_batches(t), ["l_linestatus"])
    return out.withColumns({c: F.round(c, 6) for c in ("stream_invalid_rate", "stream_avg_throughput")})


@query("report_batches", f"""{_BATCH_SQL}
SELECT batch_ts, CAST(sum(messages - invalid) AS BIGINT) AS stream_valid, CAST(sum(invalid) AS BIGINT) AS stream_invalid,
  CAST(max(lag) AS BIGINT) AS stream_max_lag, round(avg(thr), 6) AS stream_avg_throughput FROM b GROUP BY 1""")
def report_batches(t: Tables) -> DataFrame:
    return batches_over_time(stream_batches(t)).withColumn(
        "stream_avg_throughput", F.round("stream_avg_throughput", 6))


def loaded_events(t: Tables) -> DataFrame:
    """Valid messages as the loaded table; status F was delivered twice."""
    fields = ["event_id", "source_quarter", "received_at", *intake.CASE_FIELDS, "patient", "drugs", "reactions", "outcomes"]
    valid = intake.valid_rows(checked(t), fields).withColumn("batch_id", F.lit("b1"))
    first = valid.withColumn("loaded_at", F.col("received_at") + F.expr("interval 90500 milliseconds"))
    again = valid.where("kafka_partition = 0").withColumns({
        "loaded_at": F.col("received_at") + F.expr("interval 1 hour"), "batch_id": F.lit("b2")})
    return first.unionByName(again)


@query("intake_stream", f"""WITH {SEEDS_SQL}, {MESSAGES_SQL},
suspects AS (SELECT * FROM (
  SELECT l_orderkey, upper(p_brand) AS name, upper(p_type) AS ingr, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, lower(p_brand) || '.. ', p_type) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2) WHERE rn = 1)
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS event_id, CAST(o_orderdate AS DATE) AS received_date, 90 AS intake_latency_sec,
  CAST(o_custkey AS VARCHAR) AS caseid, coalesce(b.product_id, i.product_id) AS product_id, n AS drug_count,
  n AS reaction_count, outcomes > 0 AS is_serious, death AS is_death, 'b1' AS batch_id
FROM checked JOIN suspects ON l_orderkey = o_orderkey LEFT JOIN aliases b ON b.alias = name
LEFT JOIN aliases i ON i.alias = ingr WHERE errors = ''""")
def intake_stream(t: Tables) -> DataFrame:
    staged = intake.stage_events(loaded_events(t))
    return intake.enrich_stream(staged, aliases(t)).select(
        "event_id", "received_date", "intake_latency_sec", "caseid", "product_id", "drug_count", "reaction_count",
        "is_serious", "is_death", "batch_id")


CASE_EVENT = ["event_id", "source_quarter", "received_at", *intake.CASE_FIELDS, "patient", "drugs", "reactions", "outcomes"]


def run_chain(t: Tables, topic: DataFrame, base: str, checkpoint: str) -> dict[str, str]:
    """Drain a folder of messages, standing for the topic, into the sinks below ``base``."""
    sinks = {kind: f"{base}/{kind}" for kind in ("valid", "dead", "metrics")}
    work = intake.intake_batch(sinks, CASE_EVENT, intake.REQUIRED_FIELDS, intake.report_rules(), topic="intake")
    intake.start(topic, work, f"{base}/{checkpoint}", once=True).awaitTermination()
    return sinks


def message_stream(t: Tables, base: str) -> DataFrame:
    messages = event_messages(t).drop("o_orderdate")
    messages.select("topic", "partition", "offset", "key", "value").write.parquet(f"{base}/topic")
    return intake.open_stream(t.spark, "parquet", "topic STRING, partition BIGINT, offset BIGINT, key STRING, value STRING",
                              max_per_trigger=4, path=f"{base}/topic")


@query("intake_chain", f"""WITH {SEEDS_SQL}, {MESSAGES_SQL},
suspects AS (SELECT * FROM (
  SELECT l_orderkey, upper(p_brand) AS name, upper(p_type) AS ingr, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, lower(p_brand) || '.. ', p_type) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2) WHERE rn = 1)
SELECT CAST(o_orderdate AS DATE) AS received_date, coalesce(b.product_id, i.product_id) AS product_id,
  count(*) AS cases, CAST(sum(n) AS BIGINT) AS drugs, count(*) FILTER (death) AS deaths, 2 * count(*) AS deliveries
FROM checked JOIN suspects ON l_orderkey = o_orderkey LEFT JOIN aliases b ON b.alias = name
LEFT JOIN aliases i ON i.alias = ingr WHERE errors = '' GROUP BY 1, 2""")
def intake_chain(t: Tables) -> DataFrame:
    """Messages streamed into the table by two queries with their own checkpoints, staged and enriched from the table.

    Every event is delivered once by each query; both deliveries stay in the table, staging takes the first.
    """
    base = shared_folder(t.spark, "intake-chain")
    topic = message_stream(t, base)
    run_chain(t, topic, base, "checkpoint-1")
    loaded = t.spark.read.parquet(run_chain(t, topic, base, "checkpoint-2")["valid"])
    twice = loaded.groupBy("event_id").agg(F.count("*").alias("deliveries"))
    events = intake.enrich_stream(intake.stage_events(loaded), aliases(t))
    return events.join(twice, "event_id").groupBy("received_date", "product_id").agg(
        F.count("*").alias("cases"), F.sum("drug_count").alias("drugs"), F.count_if("is_death").alias("deaths"),
        F.sum("deliveries").alias("deliveries"))


@query("intake_chain_batches", f"""WITH {MESSAGES_SQL}
SELECT 'valid' AS measure, count(*) FILTER (errors = '') AS n FROM checked
UNION ALL SELECT 'invalid', count(*) FILTER (errors != '') FROM checked
UNION ALL SELECT 'messages', count(*) FROM checked
UNION ALL SELECT 'events', count(*) FILTER (errors = '') FROM checked""")
def intake_chain_batches(t: Tables) -> DataFrame:
    """The batch report and measures from what the intake itself wrote."""
    base = shared_folder(t.spark, "intake-batches")
    sinks = run_chain(t, message_stream(t, base), base, "checkpoint")
    batches = observability.stream_batches(t.spark.read.parquet(sinks["metrics"]))
    shown = batches_over_time(batches).agg(F.sum("stream_valid").alias("valid"), F.sum("stream_invalid").alias("invalid"))
    total = measure(["stream_messages"], batches).select(F.col("stream_messages").alias("messages"))
    events = measure(["stream_events"], t.spark.read.parquet(sinks["valid"])).select(F.col("stream_events").alias("events"))
    parts = [f.select(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("n"))
             for f, c in ((shown, "valid"), (shown, "invalid"), (total, "messages"), (events, "events"))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query("enriched_on_stream", f"""WITH {SEEDS_SQL}, {MESSAGES_SQL},
suspects AS (SELECT * FROM (
  SELECT l_orderkey, upper(p_brand) AS name, upper(p_type) AS ingr, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, lower(p_brand) || '.. ', p_type) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2) WHERE rn = 1)
SELECT coalesce(b.product_id, i.product_id) AS product_id, count(*) AS n
FROM checked JOIN suspects ON l_orderkey = o_orderkey LEFT JOIN aliases b ON b.alias = name
LEFT JOIN aliases i ON i.alias = ingr WHERE errors = '' GROUP BY 1""")
def enriched_on_stream(t: Tables) -> DataFrame:
    """The enrichment itself as a running stream over staged events."""
    base = shared_folder(t.spark, "enriched")
    staged = intake.stage_events(loaded_events(t))
    staged.write.parquet(f"{base}/staged")
    schema = t.spark.read.parquet(f"{base}/staged").schema
    stream = t.spark.readStream.schema(schema).parquet(f"{base}/staged")
    intake.enrich_stream(stream, aliases(t)).writeStream.format("parquet").option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return t.spark.read.parquet(f"{base}/out").groupBy("product_id").agg(F.count("*").alias("n"))


# --- running streams over the event table ----------------------------------------------------

CLICK_FIELDS = ["event_id", "event_type", "user_id", "received_at", "amount"]
CLICK_SCHEMA = "event_id STRING, event_type STRING, user_id STRING, received_at STRING, amount DOUBLE"


def event_stream(t: Tables) -> DataFrame:
    """The event table as a file stream; the pattern matches one file or a folder of files."""
    return intake.open_stream(t.spark, "parquet", t.events.schema.simpleString()[7:-1].replace(":", " "),
                              path=t.path("events") + "*")


def click_messages(events: DataFrame) -> DataFrame:
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("received_at"), F.col("value").alias("amount")))
    cut = F.when(F.col("value").between(3, 4), F.lit("{bad")).when(F.col("value").between(4.5, 5), F.lit("[1]"))
    return events.select(
        F.lit("clicks").alias("topic"), F.lit(0).cast("bigint").alias("partition"), F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"), F.coalesce(cut, body).alias("value"))


def click_rules() -> list:
    return [(F.col("event.amount") < 1, "small amount")]


_CLICK_ERROR = """CASE WHEN value BETWEEN 3 AND 4 OR value BETWEEN 4.5 AND 5 THEN 'invalid json'
  WHEN event_type = 'error' AND value < 1 THEN 'missing event_type; small amount'
  WHEN event_type = 'error' THEN 'missing event_type' WHEN value < 1 THEN 'small amount' ELSE 'valid' END"""


@query("stream_intake", f"""SELECT {_CLICK_ERROR} AS outcome, count(*) AS n FROM events GROUP BY 1
UNION ALL SELECT 'messages', count(*) FROM events""")
def stream_intake(t: Tables) -> DataFrame:
    """A drained intake stream: loaded rows, dead letters and counted messages."""
    base = shared_folder(t.spark, "stream-intake")
    sinks = {kind: f"{base}/{kind}" for kind in ("valid", "dead", "metrics")}
    work = intake.intake_batch(
        sinks, CLICK_FIELDS, ["event_id", "event_type", "received_at"], click_rules(), CLICK_SCHEMA, topic="clicks")
    intake.start(click_messages(event_stream(t)), work, f"{base}/checkpoint", once=True).awaitTermination()
    read = t.spark.read.parquet
    valid = read(sinks["valid"]).agg(F.count("*").alias("n")).select(F.lit("valid").alias("outcome"), "n")
    dead = read(sinks["dead"]).groupBy(F.col("error").alias("outcome")).agg(F.count("*").alias("n"))
    counted = read(sinks["metrics"]).agg(F.sum("messages").alias("n")).select(F.lit("messages").alias("outcome"), "n")
    return valid.unionByName(dead).unionByName(counted)


@query("stream_windows", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS events
FROM events GROUP BY 1, 2""")
def stream_windows(t: Tables) -> DataFrame:
    """Events per day and type from the stream, open windows included: the last change of each window counts."""
    base = shared_folder(t.spark, "stream-windows")
    events = event_stream(t).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = intake.windowed(events, "ts", "1 day", ["event_type"], "60 days")
    counts.writeStream.outputMode("update").foreachBatch(
        lambda batch, number: intake.write_batch(batch, f"{number:08d}", f"{base}/table")).option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{base}/table").groupBy(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.max_by("events", "batch_id").alias("events"))


@query("batch_windows", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS events
FROM events GROUP BY 1, 2""")
def batch_windows(t: Tables) -> DataFrame:
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return intake.windowed(events, "ts", "1 day", ["event_type"], "0 seconds").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "events")


@query("stream_dedup", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event delivered twice, kept once."""
    base = shared_folder(t.spark, "stream-dedup")
    twice = event_stream(t).unionByName(event_stream(t)).withColumn("ts", F.col("ts").cast("timestamp"))
    intake.dedup_stream(twice, "event_id", "ts", "60 days").select("event_id", "event_type").writeStream.format(
        "parquet").outputMode("append").option("checkpointLocation", f"{base}/checkpoint").trigger(
        availableNow=True).start(f"{base}/table").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").groupBy("event_type").agg(F.count("*").alias("n"))


@query("order_in_key", """SELECT event_id, user_id,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events""")
def order_in_key(t: Tables) -> DataFrame:
    """The events in order of user and offset, written and read back, each with its place in its user's order."""
    ordered = materialise(sequence.in_key_order(t.events.select("user_id", "event_id"), "user_id", "event_id"), "ordered")
    return sequence.number_in_key(ordered, "user_id", "event_id", span=1000)


@query("place_by_time", """SELECT event_id, event_type,
  row_number() OVER (PARTITION BY event_type ORDER BY epoch(date_trunc('second', ts)), event_id) AS place FROM events""")
def place_by_time(t: Tables) -> DataFrame:
    """Places of few keys with very many rows, by a time that repeats."""
    timed = t.events.select("event_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("second"))
    return sequence.number_in_key(timed, "event_type", "second", ties=["event_id"], span=86_400).select(
        "event_id", "event_type", "place")


@query("stream_unique", """SELECT event_id, event_type, event_id AS kafka_offset, 4 AS deliveries FROM events""")
def stream_unique(t: Tables) -> DataFrame:
    """Every event is sent twice, the second time long after the first, and all of it is read again by a query with
    another checkpoint; the first delivery stays."""
    base = shared_folder(t.spark, "stream-unique")
    sent = t.events.select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("event_id").alias("kafka_offset"))
    again = sent.withColumn("kafka_offset", F.col("kafka_offset") + 1_000_000_000)
    for part in (sent, again):
        part.coalesce(1).write.mode("append").parquet(f"{base}/topic")
    schema = "event_id STRING, event_type STRING, kafka_offset BIGINT"
    work = seen.unique_batch(f"{base}/table", f"{base}/seen", "event_id", ["kafka_offset"], buckets=8, compact_every=2)
    for checkpoint in ("first", "second"):
        topic = intake.open_stream(t.spark, "parquet", schema, max_per_trigger=1, path=f"{base}/topic")
        intake.start(topic, work, f"{base}/{checkpoint}", once=True).awaitTermination()
    table = t.spark.read.schema(f"{schema}, batch_id STRING").parquet(f"{base}/table")
    sizes = t.spark.read.schema(schema).parquet(f"{base}/topic").groupBy("event_id").agg((2 * F.count("*")).alias("deliveries"))
    return table.join(sizes, "event_id").select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type", "kafka_offset", "deliveries")
