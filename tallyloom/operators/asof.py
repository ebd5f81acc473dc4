"""As-of joins: the latest earlier row of another table, and a count of the earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_before(
    rows: DataFrame, touches: DataFrame, key: str, row_ts: str, touch_ts: str, value: str, collapse: bool = True,
    slice_hours: int = 24,
) -> DataFrame:
    """``rows`` with the ``value`` of the last touch of the same key at or before ``row_ts``.

    Every row is kept; without an earlier touch the value is NULL. Of touches at
    the same instant the greatest value wins.

    Rows are not paired with touches. The value is found once per key and instant
    and joined back to the rows; ``collapse=False`` skips that for rows that are
    already about one per key and instant. ``slice_hours`` is the width of a slice
    of the time line: all of a key's rows within it meet in one task.
    """
    if not collapse:
        return _along_time_line(rows, touches, key, row_ts, touch_ts, value, slice_hours)
    at = F.col(row_ts).cast("timestamp_ntz").alias("_at")
    instants = rows.filter(F.col(key).isNotNull()).select(key, at).distinct()
    found = _along_time_line(instants, touches, key, "_at", touch_ts, value, slice_hours)
    return rows.withColumn("_at", at).join(found, [key, "_at"], "left").drop("_at")


def _along_time_line(
    rows: DataFrame, touches: DataFrame, key: str, row_ts: str, touch_ts: str, value: str, slice_hours: int
) -> DataFrame:
    """Rows and touches in one line per key, cut into slices of equal time.

    A slice follows from the time alone, so it is the same in every run and one
    shuffle by key and slice brings a slice together, also of a key with very many
    rows. A window runs within each slice and key; what a slice inherits comes from
    a second window over one row per key and slice.
    """
    payload = [c for c in rows.columns if c != key]
    asked = rows.selectExpr(
        f"{key} AS _key", f"CAST({row_ts} AS timestamp_ntz) AS _ts", "1 AS _is_row", f"struct({', '.join(payload)}) AS _row"
    )
    seen = touches.selectExpr(f"{key} AS _key", f"CAST({touch_ts} AS timestamp_ntz) AS _ts", f"{value} AS v")
    touched = seen.filter("_key IS NOT NULL AND _ts IS NOT NULL").groupBy("_key", "_ts").agg(F.max("v").alias("v"))
    # 0 before 1: a touch at the very instant counts as earlier. Equal key and time fall in the same slice.
    line = asked.unionByName(
        touched.selectExpr("_key", "_ts", "0 AS _is_row", "named_struct('ts', _ts, 'v', v) AS _touch"),
        allowMissingColumns=True,
    )
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("_ts"))
    line = line.withColumn("_slice", F.floor(hours / F.lit(slice_hours)))

    within = Window.partitionBy("_key", "_slice").orderBy("_ts", "_is_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    in_slice = line.withColumn("_touch", F.last("_touch", ignorenulls=True).over(within)).filter("_is_row = 1")
    # What a slice leaves behind needs the touches and the names of the slices only.
    last_of_slice = line.filter("_key IS NOT NULL").groupBy("_key", "_slice").agg(F.max("_touch").alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = last_of_slice.select(
        "_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_inherited")
    )
    return in_slice.join(inherited, ["_key", "_slice"], "left").selectExpr(
        f"_key AS {key}", "_row.*", f"coalesce(_touch, _inherited).v AS {value}"
    )


def running_before(
    rows: DataFrame, touches: DataFrame, key: str, row_ts: str, touch_ts: str, weight: str, slice_hours: int = 24
) -> DataFrame:
    """``rows`` with ``times``, ``first_at`` and ``last_at``: the touches of the same key at or before ``row_ts``.

    ``weight`` is how many touches a row of ``touches`` stands for. Every row is kept, with 0 and NULLs where there
    is no earlier touch. As in ``latest_before`` both lie on one line, cut into slices of equal time: counts run within
    a slice, and a slice inherits the sums of the earlier ones, one row each.
    """
    payload = [c for c in rows.columns if c != key]
    asked = rows.selectExpr(f"{key} AS _key", f"CAST({row_ts} AS timestamp_ntz) AS _ts", "1 AS _is_row", f"struct({', '.join(payload)}) AS _row")
    seen = touches.selectExpr(f"{key} AS _key", f"CAST({touch_ts} AS timestamp_ntz) AS _ts", f"CAST({weight} AS bigint) AS n")
    seen = seen.filter("_key IS NOT NULL AND _ts IS NOT NULL").groupBy("_key", "_ts").agg(F.sum("n").alias("_n"))
    line = asked.unionByName(seen.selectExpr("_key", "_ts", "0 AS _is_row", "_n", "_ts AS _seen"), allowMissingColumns=True)
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("_ts"))
    line = line.withColumn("_slice", F.floor(hours / F.lit(slice_hours)))

    # 0 before 1: a touch at the very instant counts as earlier.
    within = Window.partitionBy("_key", "_slice").orderBy("_ts", "_is_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_slice = line.withColumns({
        "_times": F.sum("_n").over(within), "_first": F.min("_seen").over(within), "_last": F.max("_seen").over(within),
    }).filter("_is_row = 1")
    sums = line.filter("_key IS NOT NULL").groupBy("_key", "_slice").agg(
        F.sum("_n").alias("n"), F.min("_seen").alias("first"), F.max("_seen").alias("last")
    )
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = sums.select(
        "_key", "_slice", F.sum("n").over(earlier).alias("_times_before"), F.min("first").over(earlier).alias("_first_before"),
        F.max("last").over(earlier).alias("_last_before"),
    )
    return in_slice.join(inherited, ["_key", "_slice"], "left").selectExpr(
        f"_key AS {key}", "_row.*", "coalesce(_times, 0) + coalesce(_times_before, 0) AS times",
        "least(_first_before, _first) AS first_at", "greatest(_last, _last_before) AS last_at",
    )
