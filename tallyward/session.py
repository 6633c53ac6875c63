"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. AQE replans joins from real sizes; the
# "force" flag lets it split a hot key even when that costs one more shuffle. Rows that are
# already sorted by their group are aggregated as they come, without a hash table.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tallyward", shared: str | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark; ``shared`` is its folder for written layers."""
    builder = SparkSession.builder
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_written: list[tuple[SparkSession, str]] = []
# Written layers by session, input folder and name; gone with ``clear_layers``.
LAYERS: dict[tuple[str, str, str], DataFrame] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path that every executor reaches: below ``spark.checkpoint.dir``, where unset below the warehouse.

    ``clear_layers`` removes what was written; without it the folders stay for later sessions.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/tallyward/{purpose}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def clear_layers(spark: SparkSession) -> None:
    """Remove the folders handed out to this session; frames read from them can no longer be used."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for owner, path in [x for x in _written if x[0] is spark]:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        _written.remove((owner, path))
    own = spark.sparkContext.applicationId
    for key in [k for k in LAYERS if k[0] == own]:
        del LAYERS[key]
