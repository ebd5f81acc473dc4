"""Stored tables: create, replace, append what is new, and work folders.

A job that must fix a result before using it twice (surrogate keys, targets of
incremental loads) writes it here instead of relying on recomputation, so the loss
of an executor cannot change it. Tables proper are versioned (``sources.versions``):
a load shows whole or not at all, and may be repeated under its id. Work folders hold
plain Parquet that nobody else reads; ``scratch`` and ``clean_up`` delete them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.sources import versions

#: Session setting that sends the work folders of a job to one place.
SCRATCH = "tallyloom.scratch"


def _application_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder in ``spark.checkpoint.dir``.

    Without that setting there is no place that all executors see, and nothing is written.
    """
    return f"{spark.conf.get(SCRATCH, None) or _application_folder(spark)}/{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged meanwhile: for jobs whose results are stored elsewhere by then.

    Results that are still to be worked out must not leave the block. A block within another one belongs to it.
    """
    outer = spark.conf.get(SCRATCH, None)
    if outer:
        yield
        return
    folder = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    spark.conf.set(SCRATCH, folder)
    try:
        yield
    finally:
        spark.conf.unset(SCRATCH)
        remove_folder(spark, folder)


def clean_up(spark: SparkSession) -> None:
    """Delete all work folders of this application. Results not yet collected or stored may be among them."""
    remove_folder(spark, _application_folder(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result once so that several steps can read it.

    Spark plans each use of a DataFrame afresh, with the columns that use needs,
    so a result used in several branches would scan its inputs in each of them.
    The stored copy also lets a lost task be redone without its inputs.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder that nothing reads any more, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; a plain Parquet folder, which no load of this library has written, as it is."""
    if versions.latest(spark, path) is None and versions.Store(spark, path).names(""):
        return spark.read.parquet(path)
    return versions.read(spark, path)


def create_table(df: DataFrame, path: str, if_exists: str = "error") -> DataFrame:
    """Create table as select. ``if_exists``: ``error``, ``ignore`` or ``overwrite``."""
    return versions.create(df, path, if_exists)


def append_rows(df: DataFrame, path: str, load_id: str | None = None) -> DataFrame:
    """Insert-select into a stored table; with a ``load_id``, once however often it is called."""
    return versions.append(df, path, load_id)


def reload_table(df: DataFrame, path: str, load_id: str | None = None) -> DataFrame:
    """Truncate and reload as one step: readers see the old rows until the new ones are complete."""
    return versions.reload(df, path, load_id)


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of each key.

    Rows are made distinct first, which a hash aggregate does before the shuffle; of what is left each task keeps
    one row per key before the second one, so a key with many rows is not gathered.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*others))
    return df.distinct().withColumn("_place", place).filter("_place = 1").select(*df.columns)


def only_new(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, without the keys the target already holds."""
    return first_per_key(df.join(target.select(*keys), keys, "left_anti"), keys)


def insert_ignore(df: DataFrame, path: str, keys: list[str], load_id: str | None = None) -> DataFrame:
    """Append the rows whose key is not stored yet, one per key."""
    target = read_table(df.sparkSession, path)
    return append_rows(only_new(df, target, keys).select(*target.columns), path, load_id)


def delete_where(df: DataFrame, condition) -> DataFrame:
    """Rows for which the condition is not true; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def with_load_columns(df: DataFrame, load_ts: str, **flags: int) -> DataFrame:
    """Column defaults: a fixed load time and 0/1 flags."""
    df = df.withColumn("created_at", F.lit(load_ts).cast("timestamp_ntz"))
    return df.withColumns({name: F.lit(value) for name, value in flags.items()})


def union_sources(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Same-shaped tables as one, each row tagged with the table it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)
