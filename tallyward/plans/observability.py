"""Run, batch and test-result views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyward.functions import day, ratio, scan_cost
from tallyward.operators.intervals import overlaps_previous


def ingestion_runs(runs: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Runs with their date and the flag of runs that began inside an earlier run of the source."""
    flagged = overlaps_previous(runs, "source", "started_at", "finished_at", slice_seconds)
    return flagged.withColumn("run_date", day("started_at"))


def stream_batches(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({"batch_date": day("batch_ts"), "invalid_rate": ratio("invalid", "messages")})


def run_results(results: DataFrame, price_per_tib: float = 6.25) -> DataFrame:
    return results.withColumns({
        "run_date": day("run_started_at"), "estimated_cost_usd": scan_cost("bytes_billed", price_per_tib)})
