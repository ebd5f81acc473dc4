"""The latest row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Before every real instant; stands for a missing one.
_NEVER = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def latest_per_key(rows: DataFrame, key: str, ts: str, ties: list[str]) -> DataFrame:
    """One row per key: of those with the greatest ``ts`` (NULL is the least), the greatest by ``ties``, then by the rest.

    The greatest instant per key is found first, by a hash aggregate over two narrow columns, which combines before
    the shuffle and sorts nothing. Rows of that instant are picked by a semi-join; only these few are compared in
    full. A key with very many rows is one row in the first step, and its rows are split by an adaptive join in the
    second.
    """
    columns = rows.columns
    timed = rows.withColumn("_at", F.expr(f"coalesce(CAST({ts} AS timestamp_ntz), {_NEVER})"))
    newest = timed.groupBy(F.col(key).alias("_key")).agg(F.max("_at").alias("_newest"))
    last = timed.join(newest, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_newest")), "left_semi")
    rest = [c for c in columns if c not in (key, *ties)]
    picked = last.groupBy(key).agg(F.max(F.struct(*ties, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in columns])
