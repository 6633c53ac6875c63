"""Delimited text to a fixed all-string schema."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.text import literal_regex

# Column lists of the quarterly report tables.
REPORT_TABLES = {
    "demo": ["primaryid", "caseid", "caseversion", "i_f_code", "event_dt", "mfr_dt", "init_fda_dt", "fda_dt",
             "rept_cod", "auth_num", "mfr_num", "mfr_sndr", "lit_ref", "age", "age_cod", "age_grp", "sex",
             "e_sub", "wt", "wt_cod", "rept_dt", "to_mfr", "occp_cod", "reporter_country", "occr_country"],
    "drug": ["primaryid", "caseid", "drug_seq", "role_cod", "drugname", "prod_ai", "val_vbm", "route",
             "dose_vbm", "cum_dose_chr", "cum_dose_unit", "dechal", "rechal", "lot_num", "exp_dt", "nda_num",
             "dose_amt", "dose_unit", "dose_form", "dose_freq"],
    "reac": ["primaryid", "caseid", "pt", "drug_rec_act"],
    "outc": ["primaryid", "caseid", "outc_cod"],
    "rpsr": ["primaryid", "caseid", "rpsr_cod"],
    "ther": ["primaryid", "caseid", "dsg_drug_seq", "start_dt", "end_dt", "dur", "dur_cod"],
    "indi": ["primaryid", "caseid", "indi_drug_seq", "indi_pt"],
}


class FixedRead(NamedTuple):
    """Good rows, rejected raw lines and, by file, the columns the schema does not know."""

    rows: DataFrame
    rejected: DataFrame
    unexpected: DataFrame


MOST_HEADERS = 10_000


def align_columns(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The listed columns in order (missing ones null, as text) and the names left out.

    Names are trimmed and lower-cased; blank and unnamed columns are dropped silently.
    """
    names = {}
    for i, raw in enumerate(df.columns):
        name = raw.strip().lower()
        if name and not name.startswith("unnamed") and not (name.startswith("_c") and name[2:].isdigit()):
            names.setdefault(name, i)
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    picked = [
        (F.col(f"c{names[c]}") if c in names else F.lit(None)).cast("string").alias(c) for c in columns]
    return positional.select(*picked), sorted(set(names) - set(columns))


def _known(name: Column) -> Column:
    """A header name as the schema writes it; null for blank and unnamed columns."""
    plain = F.lower(F.trim(name))
    return F.when((plain != "") & ~plain.startswith("unnamed") & ~plain.rlike("^_c[0-9]+$"), plain)


def read_fixed(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "$",
               encoding: str = "ISO-8859-1") -> FixedRead:
    """Read header-first delimited text whose fields are never quoted.

    Every file has its own header, its first line that is not blank: columns are found by
    name, in any order; a missing one is null, ``unexpected`` lists the unknown ones as
    (file, name). Only an empty field is null. Short rows are padded; rows with more
    fields than their header are set aside in ``rejected`` (a single empty field after a
    trailing separator is not an extra field). A line equal to its file's header is a header.

    The headers, one row per file, go to the lines by broadcast while there are at most ``MOST_HEADERS`` files, so no
    line is shuffled; beyond that Spark chooses the join.
    """
    raw = spark.read.text(path).select(
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    ).where(F.trim("line") != "")
    # The header is in the file's first block, and the first of a task's lines of that block. One row per file.
    lines = raw.withColumn("at", F.monotonically_increasing_id())
    headers = lines.where("block = 0").groupBy("file").agg(F.min_by("line", "at").alias("header"))
    names = F.split("header", literal_regex(sep), -1)
    headers = headers.withColumn("names", F.transform(names, _known)).withColumn("width", F.size("names"))
    few = len(raw.inputFiles()) <= MOST_HEADERS
    parsed = raw.select("line", "file").join(F.broadcast(headers) if few else headers, "file").where("line <> header").withColumn(
        "f", F.split("line", literal_regex(sep), -1))
    # A trailing separator adds one empty field, which is not a field too many.
    trailing = (F.size("f") == F.col("width") + 1) & (F.element_at("f", -1) == "")
    good = (F.size("f") <= F.col("width")) | trailing

    def field(name: str) -> Column:
        place = F.array_position("names", F.lit(name)).cast("int")
        return F.nullif(F.get(F.col("f"), F.nullif(place, F.lit(0)) - 1), F.lit("")).alias(name)

    strange = headers.select("file", F.explode(F.array_distinct(F.filter("names", lambda n: n.isNotNull()))).alias("name"))
    return FixedRead(parsed.where(good).select(*[field(c) for c in columns]), parsed.where(~good).select("line"),
                     strange.where(~F.col("name").isin(list(columns))))
