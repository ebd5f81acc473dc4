"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.tables import stage

# Hex digits of a hash: three make 4,096 buckets that are numbered side by side. Ids depend on it, so a dimension
# keeps the number it began with; a larger one begins with more (each digit makes the table of sizes 16 times longer).
BUCKET_DIGITS = 3


def assign_surrogate_keys(
    members: DataFrame, natural: list[str], id_name: str, existing: DataFrame | None = None, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Number the members 1, 2, 3 ... without gaps, each by its natural key alone.

    ``members`` is unique on ``natural``. Members in ``existing`` keep their row
    and id; new ones follow after its largest id.
    """
    if existing is None:
        return _numbered(members, natural, id_name, F.lit(0), bucket_digits)
    fresh = number_new_members(members, natural, id_name, existing, bucket_digits)
    return existing.select(*fresh.columns).unionByName(fresh)


def number_new_members(
    members: DataFrame, natural: list[str], id_name: str, existing: DataFrame, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """The members that ``existing`` lacks, numbered after its largest id."""
    new = members.join(existing.select(*natural), natural, "left_anti")
    largest = existing.agg(F.coalesce(F.max(id_name), F.lit(0).cast("long"))).scalar()
    return _numbered(new, natural, id_name, largest, bucket_digits)


def number_missing(
    rows: DataFrame, natural: list[str], id_name: str, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """``rows`` with an id for those that have none, after the largest there is.

    Known and new members come as one table and are read once: it is stored with its buckets, and the largest id,
    the bucket sizes and the numbers are all taken from there.
    """
    keyed = stage(_bucketed(rows, natural, bucket_digits), f"with_{id_name}")
    largest = keyed.agg(F.coalesce(F.max(id_name), F.lit(0).cast("long"))).scalar()
    known = keyed.filter(F.col(id_name).isNotNull()).select(*rows.columns)
    fresh = keyed.filter(F.col(id_name).isNull()).drop(id_name)
    others = [c for c in rows.columns if c != id_name]
    return known.unionByName(_in_bucket_order(fresh, others, natural, id_name, largest))


def _bucketed(members: DataFrame, natural: list[str], bucket_digits: int) -> DataFrame:
    text = F.concat_ws("\u001f", *[F.col(c).cast("string") for c in natural])
    return members.withColumn("_bucket", F.substring(F.md5(text), 1, bucket_digits))


def _numbered(members: DataFrame, natural: list[str], id_name: str, after: Column, bucket_digits: int) -> DataFrame:
    """The members are written once, since both the bucket sizes and the numbering read them."""
    keyed = stage(_bucketed(members, natural, bucket_digits), f"new_{id_name}")
    return _in_bucket_order(keyed, members.columns, natural, id_name, after)


def _in_bucket_order(keyed: DataFrame, columns: list[str], natural: list[str], id_name: str, after: Column) -> DataFrame:
    """Numbers run bucket by bucket in a hash of the natural key, and in key order within a bucket.

    They depend on the data only, not on how it is partitioned, and no window
    spans the whole table: the running total below is over the bucket sizes, at
    most 16 to the power of the bucket's digits.
    """
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_bucket", F.coalesce(F.sum("_size").over(so_far), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural))
    number = F.col("_before") + F.col("_place") + after
    return keyed.withColumn("_place", place).join(F.broadcast(before), "_bucket").select(
        number.cast("long").alias(id_name), *columns
    )
