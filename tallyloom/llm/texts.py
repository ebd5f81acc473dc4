"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import stage

#: Fixed value: white space that parts words (space and U+0009 to U+000D), for Java and RE2 patterns.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``max_bytes`` of ``column`` (one row at least).

    Long texts then cost memory in proportion to the longest text, not to the batch.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            n = n or 0
            if i > start and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


#: Spark drops the shuffle files of a statement when it has ended, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """``stage``, and free the shuffle files that led to the result: it is stored, and never worked out again."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(FREE_SHUFFLES, before)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names, so that other columns cannot clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def importable(spark: SparkSession) -> None:
    """Let Python workers on the driver's machine import this library from where the driver has it.

    Workers inherit the search path of the process that began the JVM, which may be older than the driver's
    own. On a cluster the library is shipped with the job, and this path is not there to be found.
    """
    here = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([here, *filter(None, paths)])
