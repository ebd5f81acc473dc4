"""The warehouse load from staging to facts, stage by stage into stored tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import warehouse as w
from tallyloom.sources.tables import append_rows, create_table, read_table, reload_table, scratch, stage


@dataclass(frozen=True)
class Warehouse:
    staging: DataFrame
    dims: w.Dimensions
    # The author dimension after the load by e-mail, and with the strict identities added.
    author_by_email: DataFrame
    author_by_person: DataFrame
    people: DataFrame
    fact: DataFrame

    @property
    def dims_by_email(self) -> w.Dimensions:
        return self.dims.with_author(self.author_by_email, "email")

    @property
    def dims_by_person(self) -> w.Dimensions:
        return self.dims.with_author(self.author_by_person, "email")


def together(*steps: Callable) -> list:
    """Results of steps that do not depend on each other, their jobs run side by side."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(step)) for step in steps]]


def load_warehouse(spark: SparkSession, staging: DataFrame, folder: str) -> Warehouse:
    """Build every table below ``folder``.

    Places and identities depend only on which texts occur together, so the staging table
    is read once for all dimensions of them, down to its distinct combinations, and once for the
    award names. Both fact loads share one look-up of its rows (``located_once``).
    Each dimension is stored before anything looks up its ids, and the next stage reads the
    stored table: its size is known to the planner, and its keys stay as they are whatever
    is recomputed later. Every table is replaced as a
    whole, so a load that fails leaves the tables before it as they were; what is stored
    on the way is deleted at the end.
    """
    with scratch(spark):
        return _load_warehouse(spark, staging, folder)


def _load_warehouse(spark: SparkSession, staging: DataFrame, folder: str) -> Warehouse:
    def store(df: DataFrame, name: str) -> DataFrame:
        return create_table(df, f"{folder}/{name}", "overwrite")

    texts = stage(w.person_texts(staging), "person_texts")

    def places():
        country = store(w.dim_country(texts), "dim_country")
        return country, store(w.dim_affiliation(texts, country), "dim_affiliation")

    def authors():
        by_email = store(w.dim_author(texts), "dim_author_by_email")
        return by_email, store(w.add_people(by_email, texts), "dim_author_by_person")

    def award_types():
        return store(w.dim_award_type(stage(w.award_texts(staging), "award_texts")), "dim_award_type")

    (country, affiliation), (by_email, by_person), award_type, people = together(
        places, authors, award_types, lambda: store(w.build_people(texts), "people")
    )
    dims = w.Dimensions(country, affiliation, award_type, by_person, "email")
    author = store(w.upsert_dimension(w.split_email_columns(by_person), people, "email_norm", "author_id"), "dim_author")
    before, dims = dims, dims.with_author(author, "email_norm")
    # Both loads share the look-up.
    rows = stage(w.located_once(staging, texts, dims, before, "strict"), "located")

    fact_path = f"{folder}/fact_award"
    first = reload_table(w.first_facts(rows), fact_path)
    append_rows(w.later_facts(rows, dims, first), fact_path, "incremental 1")
    return Warehouse(staging, dims, by_email, by_person, people, read_table(spark, fact_path))
