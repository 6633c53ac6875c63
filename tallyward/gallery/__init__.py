"""Registered queries: the operators and jobs run on the given tables, each beside its SQL oracle.

``readings`` says how the retail tables stand in for reports, drugs, studies, runs and
events; the other modules register the queries.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallyward.session import tune
from tallyward.sources.lake import written_layer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A written table that all queries of this session and folder share; built when first asked for."""
        return written_layer(self.spark, self.folder, name, build)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name`` with its oracle."""
    def add(work: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: work(Tables(tune(spark), folder))
        if sql:
            ORACLES[name] = sql
        return work

    return add


def load() -> None:
    for module in ("safety", "spending", "trials", "operations", "metrics", "streams", "storage"):
        import_module(f"tallyward.gallery.{module}")
