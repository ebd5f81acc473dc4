"""Best items per key as one label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import thousands


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key. ``order`` must be a total order within a key.

    Spark keeps only ``k`` rows per key in each task before the shuffle, so a key
    with very many rows does not gather in one task.
    """
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def top_k_label(
    rows: DataFrame, keys: list[str], item: str, order: list[Column], shown: Column, name: str, k: int = 3
) -> DataFrame:
    """``"A (12) | B (7)"``: the best items of each key with a figure each."""
    label = F.concat(F.col(item), F.lit(" ("), shown, F.lit(")"))
    best = top_k(rows.select(*keys, label.alias("label"), *rows.drop(*keys).columns), keys, order, k)
    return best.groupBy(*keys).agg(
        F.expr("listagg(label, ' | ') WITHIN GROUP (ORDER BY rank)").alias(name)
    )


def count_label(count: str) -> Column:
    return F.col(count).cast("string")


def euro_label(amount: str) -> Column:
    return F.concat(F.lit("€"), thousands(F.col(amount)))
