"""Event intake: read, validate, route, measure, de-duplicate, enrich."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.arrays import first_where, has, item_total
from tallyward.functions.dates import seconds_between
from tallyward.functions.text import clean_name
from tallyward.operators.attribution import attribute
from tallyward.operators.dedup import dedup_events
from tallyward.operators.sequence import in_key_order

CORRUPT = "_corrupt_record"

# The event contract.
REQUIRED_FIELDS = ["event_id", "primaryid", "caseid", "fda_dt", "received_at"]
CASE_FIELDS = ["primaryid", "caseid", "caseversion", "fda_dt", "event_dt", "rept_cod", "occp_cod",
               "reporter_country", "occr_country", "mfr_sndr"]
PATIENT_FIELDS = ["age", "age_cod", "sex", "wt", "wt_cod"]
DRUG_FIELDS = ["drug_seq", "role_cod", "drugname", "prod_ai", "route"]


def _fields(names: Sequence[str], sep: str) -> str:
    return ", ".join(f"{n}{sep} STRING" for n in names)


EVENT_SCHEMA = (
    "event_id STRING, event_type STRING, schema_version BIGINT, source_quarter STRING, received_at STRING, "
    + _fields(CASE_FIELDS, "")
    + f", patient STRUCT<{_fields(PATIENT_FIELDS, ':')}>, drugs ARRAY<STRUCT<{_fields(DRUG_FIELDS, ':')}>>"
    + ", reactions ARRAY<STRING>, outcomes ARRAY<STRING>"
)


def open_stream(spark: SparkSession, source: str, schema: str = "", max_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    """A Kafka topic (``source='kafka'``) or a folder of files of format ``source``.

    Progress lives in the checkpoint of the query, written after the batch is safe, so
    delivery is at least once. A new query on a topic starts with the oldest message kept.
    """
    if source == "kafka":
        options = {"startingOffsets": "earliest", **options}
    reader = spark.readStream.format(source).options(**options)
    if schema:
        reader = reader.schema(schema)
    if max_per_trigger:
        limit = "maxOffsetsPerTrigger" if source == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(limit, str(max_per_trigger))
    if source != "kafka":
        return reader.load()
    return reader.load().select(
        "topic", F.col("partition").cast("bigint").alias("partition"), "offset",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def parse(df: DataFrame, schema: str = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """The message with a struct ``event``; text that is not one JSON object is marked corrupt.

    Exploding a one-element array makes the struct a fixed input of what follows. As a plain
    column it would be parsed again for every field that a later filter looks at.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    event = F.from_json(F.col(value), f"{schema}, {CORRUPT} STRING", options)
    return df.select("*", F.explode(F.array(event)).alias("event"))


def report_rules(event: str = "event") -> list[tuple[Column, str]]:
    """The content rules of a safety report, after the required fields."""
    drugs, date = F.col(f"{event}.drugs"), F.col(f"{event}.fda_dt")
    given = F.coalesce(date, F.lit("")) != ""
    return [
        (given & (~date.rlike(r"^\d{8}$") | F.try_to_date(date, "yyyyMMdd").isNull()), "invalid fda_dt"),
        (item_total(drugs) == 0, "no drugs"),
        ((item_total(drugs) > 0)
         & ~F.coalesce(F.exists(drugs, lambda d: F.coalesce(d["role_cod"] == "PS", F.lit(False))), F.lit(False)),
         "no primary suspect drug"),
        (item_total(F.col(f"{event}.reactions")) == 0, "no reactions"),
    ]


def validate(df: DataFrame, required: Sequence[str], rules: Sequence[tuple[Column, str]],
             event: str = "event") -> DataFrame:
    """The message with ``errors``, an array of texts that is empty for a valid event."""
    corrupt = F.col(event).isNull() | F.col(f"{event}.{CORRUPT}").isNotNull()
    missing = [
        F.when(F.coalesce(F.col(f"{event}.{f}").cast("string"), F.lit("")) == "", F.lit(f"missing {f}"))
        for f in required]
    broken = [F.when(cond, F.lit(text)) for cond, text in rules]
    found = F.filter(F.array(*missing, *broken), lambda e: e.isNotNull())
    return df.withColumn("errors", F.when(corrupt, F.array(F.lit("invalid json"))).otherwise(found))


# Where a message stood, under the names of the loaded table.
POSITION = {"partition": "kafka_partition", "offset": "kafka_offset"}


def valid_rows(checked: DataFrame, schema_fields: Sequence[str], keep: Mapping[str, str] = POSITION,
               event: str = "event", received: str = "received_at") -> DataFrame:
    """Fields of the valid events, the time of receipt as a timestamp, and the position of the message."""
    fields = [F.try_to_timestamp(F.col(f"{event}.{f}")).alias(f) if f == received else F.col(f"{event}.{f}")
              for f in schema_fields]
    return checked.where(F.size("errors") == 0).select(*fields, *[F.col(c).alias(n) for c, n in keep.items()])


def dead_letters(checked: DataFrame, keep: Sequence[str] = ("topic", "partition", "offset", "key", "value")) -> DataFrame:
    """Invalid messages unchanged, with their errors in one text."""
    return checked.where(F.size("errors") > 0).select(*keep, F.array_join("errors", "; ").alias("error"))


def write_batch(df: DataFrame, batch_id: str, path: str) -> None:
    """Write under the batch's own partition; writing a batch again replaces it."""
    (
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    )


def batch_metrics(checked: DataFrame, topic: str, group: str, lag: int = 0, seconds: float = 0.0,
                  by: Sequence[str] = (), uri: str | None = None) -> DataFrame:
    """Time, messages, valid, invalid, invalid rate, lag, seconds, throughput and target of a batch (or per ``by``)."""
    n, bad = F.count(F.lit(1)), F.count_if(F.size("errors") > 0)
    return checked.groupBy(*by).agg(n.alias("messages"), (n - bad).alias("valid"), bad.alias("invalid")).select(
        *by, F.current_timestamp().alias("batch_ts"), F.lit(topic).alias("topic"), F.lit(group).alias("consumer_group"),
        "messages", "valid", "invalid",
        F.try_divide(F.col("invalid").cast("double"), F.col("messages").cast("double")).alias("invalid_rate"),
        F.lit(lag).cast("bigint").alias("consumer_lag"), F.lit(round(seconds, 2)).alias("batch_seconds"),
        F.round(F.col("messages") / F.lit(max(seconds, 0.001)), 1).alias("throughput_msg_per_sec"),
        F.lit(uri).cast("string").alias("uri"))


def consumer_lag(progress: Mapping | None) -> int:
    """Messages still waiting, from the progress record of a query on a topic (``query.lastProgress``)."""
    total = 0
    for source in (progress or {}).get("sources", []):
        done, newest = (
            json.loads(part) if isinstance(part := source.get(name) or {}, str) else part
            for name in ("endOffset", "latestOffset"))
        for topic, partitions in newest.items():
            total += sum(max(int(at) - int(done.get(topic, {}).get(p, 0)), 0) for p, at in partitions.items())
    return total


def route(checked: DataFrame, batch_id: str, sinks: Mapping[str, str], fields: Sequence[str], topic: str,
          group: str, started: float, keep: Mapping[str, str] = POSITION, key: str | None = None,
          lag: int = 0) -> None:
    """Valid rows to the table, the rest to the dead letters, counts to the metrics.

    With ``key`` the rows of a case stand in offset order, over several files where a case is large.
    """
    checked.persist()
    try:
        loaded = valid_rows(checked, fields, keep).withColumn("loaded_at", F.current_timestamp())
        if key:
            loaded = in_key_order(loaded, key, keep["offset"])
        write_batch(loaded, batch_id, sinks["valid"])
        write_batch(dead_letters(checked), batch_id, sinks["dead"])
        counts = batch_metrics(checked, topic, group, lag, time.monotonic() - started, uri=sinks["valid"])
        write_batch(counts, batch_id, sinks["metrics"])
    finally:
        checked.unpersist()


def intake_batch(sinks: Mapping[str, str], fields: Sequence[str], required: Sequence[str],
                 rules: Sequence[tuple[Column, str]], schema: str = EVENT_SCHEMA, topic: str = "intake",
                 group: str = "loader", prefix: str = "batch",
                 keep: Mapping[str, str] = POSITION, key: str | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of the intake.

    A batch is written under the id of the query and its number: the id belongs to the
    checkpoint, so a replay of a batch replaces it, and a query that starts anew with
    another checkpoint adds its own. The lag is that of the query's last progress record.
    """
    def run(batch: DataFrame, number: int) -> None:
        started = time.monotonic()
        spark = batch.sparkSession
        name = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        query = next((q for q in spark.streams.active if q.id == name), None)
        checked = validate(parse(batch, schema), required, rules)
        route(checked, f"{prefix}-{name}-{number:08d}", sinks, fields, topic, group, started, keep, key,
              consumer_lag(query.lastProgress if query else None))

    return run


def start(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 60,
          once: bool = False) -> StreamingQuery:
    """Run ``work`` on every micro-batch; ``once`` drains what is there and stops."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def dedup_stream(df: DataFrame, key: str, ts: str, horizon: str) -> DataFrame:
    """One row per event id within the horizon, on the stream."""
    return df.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def windowed(df: DataFrame, ts: str, width: str, by: Sequence[str], horizon: str) -> DataFrame:
    """Events per window and group. On a stream, rows later than ``horizon`` are dropped by the watermark.

    Append mode gives a window when the watermark has passed it, update mode with every change.
    """
    out = df.withWatermark(ts, horizon) if df.isStreaming else df
    counts = out.groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(F.col("window.start").alias("window_start"), *by, "events")


def stage_events(df: DataFrame) -> DataFrame:
    """Loaded events, first delivery only, with counts, primary suspect and flags."""
    first = dedup_events(df, "event_id", ["loaded_at", "kafka_partition", "kafka_offset"])
    suspect = first_where("drugs", lambda d: d["role_cod"] == "PS")
    return first.select(
        "event_id", "source_quarter", "received_at", "loaded_at",
        seconds_between("received_at", "loaded_at").alias("intake_latency_sec"),
        "primaryid", "caseid", F.upper("mfr_sndr").alias("sender"), "reporter_country",
        F.col("patient.sex").alias("sex"),
        item_total("drugs").alias("drug_count"), item_total("reactions").alias("reaction_count"),
        item_total("outcomes").alias("outcome_count"),
        clean_name(suspect["drugname"]).alias("ps_drugname_key"),
        clean_name(suspect["prod_ai"]).alias("ps_prod_ai_key"),
        (item_total("outcomes") > 0).alias("is_serious"), has("outcomes", "DE").alias("is_death"),
        "kafka_partition", "kafka_offset", "batch_id")


def enrich_stream(events: DataFrame, aliases: DataFrame) -> DataFrame:
    """Product of each event by name, else ingredient, without the owner rule; works on streams."""
    matched = attribute(events, aliases, "ps_drugname_key", "ps_prod_ai_key", keep_unmatched=True)
    return matched.select(
        "event_id", "received_at", F.to_date("received_at").alias("received_date"), "loaded_at",
        "intake_latency_sec", "caseid", "primaryid", "product_id", "reporter_country", "sex", "drug_count",
        "reaction_count", "is_serious", "is_death", "kafka_partition", "batch_id")
