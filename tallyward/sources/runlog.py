"""Records of runs and of test results, appended to Parquet tables."""

from __future__ import annotations

import logging
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

logger = logging.getLogger(__name__)

# The columns of a run record.
RUN_SCHEMA = (
    "run_id STRING, source STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, "
    "duration_sec DOUBLE, rows_loaded BIGINT, files_written BIGINT, bytes_written BIGINT, target STRING, "
    "triggered_by STRING, error_message STRING"
)

# The columns of a result record.
RESULT_SCHEMA = (
    "invocation_id STRING, run_started_at TIMESTAMP, target_name STRING, node_id STRING, resource_type STRING, "
    "node_name STRING, status STRING, failures BIGINT, execution_time_sec DOUBLE, rows_affected BIGINT, "
    "bytes_processed BIGINT, bytes_billed BIGINT, message STRING"
)


def _names(schema: str) -> list[str]:
    return [column.partition(" ")[0] for column in schema.split(", ")]


class RunRecord:
    """One run of a loader. Leaving the block appends its record, whatever the outcome.

    An error leaves the block as it came: a record that cannot be written is only logged.
    """

    def __init__(self, spark: SparkSession, source: str, log: str, triggered_by: str = "local"):
        self.spark, self.log = spark, log
        self.values: dict[str, object] = dict.fromkeys(_names(RUN_SCHEMA))
        self.values |= {"run_id": uuid.uuid4().hex, "source": source, "triggered_by": triggered_by}
        self.loaded(0, 0, 0)

    def loaded(self, rows: int, files: int = 0, size: int = 0, target: str | None = None) -> None:
        """What the run has written so far."""
        self.values |= {"rows_loaded": rows, "files_written": files, "bytes_written": size, "target": target}

    def __enter__(self) -> RunRecord:
        self.values["started_at"], self._clock = datetime.now(timezone.utc), time.perf_counter()
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: object) -> bool:
        seconds = time.perf_counter() - self._clock
        self.values |= {"finished_at": datetime.now(timezone.utc), "duration_sec": round(seconds, 2), **_outcome(error)}
        try:
            self._append()
        except Exception as problem:
            logger.warning("run record not written: %s", problem)
        return False

    def _append(self) -> None:
        record = tuple(self.values.values())
        self.spark.createDataFrame([record], RUN_SCHEMA).write.mode("append").parquet(self.log)


def _outcome(error: BaseException | None) -> dict[str, str | None]:
    """Status and the whole error text."""
    if error is None:
        return {"status": "success", "error_message": None}
    if isinstance(error, Exception):
        return {"status": "failed", "error_message": str(error)}
    return {"status": "cancelled", "error_message": str(error) or type(error).__name__}


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row count taken while it is written, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def log_results(results: DataFrame, invocation_id: str, started_at: str, target: str, path: str,
                resource_type: str = "test") -> None:
    """Append test results (``run_checks``) or model results under an invocation id.

    Columns of ``RESULT_SCHEMA`` that ``results`` has are taken over; for test results the
    node is the table and the test. The others are null.
    """
    given = {
        "invocation_id": F.lit(invocation_id), "run_started_at": F.to_timestamp(F.lit(started_at)),
        "target_name": F.lit(target), "resource_type": F.lit(resource_type)}
    if "node_name" not in results.columns:
        given["node_name"] = F.concat_ws(".", "table_name", "test_name")
    given.setdefault("node_id", F.col("node_id") if "node_id" in results.columns else F.concat_ws(
        ".", F.lit(resource_type), given.get("node_name", F.col("node_name"))))
    wanted = StructType.fromDDL(RESULT_SCHEMA)
    columns = [given.get(f.name, F.col(f.name) if f.name in results.columns else F.lit(None)).cast(f.dataType).alias(f.name)
               for f in wanted]
    results.select(*columns).write.mode("append").parquet(path)
