"""Session settings the library is laid out for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(builder: SparkSession.Builder, initial_partitions: int | None = None) -> SparkSession.Builder:
    """Adaptive execution with skew handling, and UTC.

    Shuffles start with ``initial_partitions`` (some thousands on a large cluster)
    and are merged to about 128 MB each. A join partition five times the median
    is split, which is how rows of an outsized key are spread over tasks.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Keep splitting where it costs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Column expressions do not record the Python line that made them.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if initial_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder
