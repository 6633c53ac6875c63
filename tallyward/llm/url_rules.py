"""Allow and block rules for URLs by a sort-merge range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import lower_ascii, partitions, pick, stage


def url_parts(url) -> tuple:
    """Host and path of a URL column: after the first ``://``; both empty without it or for null."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def _reversed_labels(host):
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels, path):
    """Reversed host and path as bytes. A host has no slash, so a rule's key is a prefix of the keys it covers."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path).cast("binary")


def rule_events(rules: DataFrame) -> DataFrame:
    """Interval ends of the rules in key order: ``(key, stack)``, the nested rules active from there on.

    A rule with key p covers [p, p + 0xFF): such intervals nest or are disjoint. The stack of a rule holds the rules
    whose key is a prefix of its own, outermost first; it is found with an equi join on the prefixes of each key.
    """
    known = rules.select(
        _key(_reversed_labels(F.col("host")), F.col("path")).alias("key"),
        F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                 (F.col("verdict") == "block").cast("int").alias("blocks"),
                 F.concat("host", "path").alias("rule")).alias("entry"),
    ).groupBy("key").agg(F.max("entry").alias("entry"))
    prefixes = known.select("key", F.explode(F.expr("sequence(1, octet_length(key))")).alias("n")).select(
        F.col("key").alias("inner_key"), F.expr("substring(key, 1, n)").alias("key"))
    stacks = prefixes.join(known, "key").groupBy("inner_key").agg(F.sort_array(F.collect_list(
        F.struct(F.expr("octet_length(key)").alias("depth"), "entry"))).alias("stack"))
    opened = stacks.select(F.col("inner_key").alias("key"), F.col("stack.entry").alias("stack"))
    closed = opened.select(F.concat("key", F.lit(b"\xff")).alias("key"),
                           F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    return opened.unionAll(closed)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, url, host, path, rule, verdict)``, one row per row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict ('allow' or 'block'). A rule fits its host and all subdomains when the path
    starts with the rule's path; of several the longest text wins, then the longer host, then 'block'. Without a rule:
    ``rule`` null, ``verdict`` the default. Null or unparsable URLs have an empty host and path. Rules with a null
    field are ignored; without rules or URLs every row gets the default or there are no rows.

    Every distinct (host, path) is probed with the reversed suffixes of its host (no more labels than any rule has).
    Probes and interval ends are range-partitioned and sorted together, with a salt so that equal keys may spread over
    partitions; a sweep carries the last stack seen to the probes that follow, and each partition starts with the
    stack that the partitions before it left.
    """
    spark = pages.sparkSession
    clean = pick(rules, "host", "path", "verdict").dropna().withColumn("host", lower_ascii(F.col("host")))
    deepest = clean.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 0
    host, path = url_parts(F.col("url"))
    rows = pick(pages, "page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    if not deepest:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    places = rows.select("host", "path").distinct().withColumn("labels", _reversed_labels(F.col("host")))
    probes = places.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(deepest))),
        lambda n: _key(F.slice("labels", F.lit(1), n), F.col("path")))).alias("key"))
    nothing = F.lit(None).cast("string")
    events = rule_events(clean).select(nothing.alias("host"), nothing.alias("path"), "key", "stack")
    ordered = events.withColumns({"kind": F.lit(0), "salt": F.lit(0).cast("bigint")}).unionByName(
        probes.withColumns({"kind": F.lit(1), "salt": F.xxhash64("host", "path")}), allowMissingColumns=True)
    ranged = stage(ordered.repartitionByRange(partitions(spark), "key", "kind", "salt")
                   .withColumn("block", F.spark_partition_id()), "url-sweep")

    left = ranged.groupBy("block").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = left.select("block", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    so_far = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("active", F.last("stack", ignorenulls=True).over(so_far)).where("kind = 1")
    best = swept.join(carried, "block", "left").select(
        "host", "path", F.element_at(F.expr("nullif(coalesce(active, carried), array())"), -1).alias("entry"),
    ).groupBy("host", "path").agg(F.max("entry").alias("entry"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "url", "host", "path", F.col("entry.rule").alias("rule"),
        F.when(F.col("entry.blocks") == 1, "block").when(F.col("entry.blocks") == 0, "allow")
        .otherwise(default).alias("verdict"))
