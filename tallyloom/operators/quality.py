"""Checks on a loaded warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import not_blank, person_key, plain_address
from tallyloom.operators.warehouse import (
    Dimensions,
    with_dimension_ids,
    with_match_keys,
    without_loaded,
)

_MATCH = ["country_key", "affiliation_key", "award_key", "person_key"]


def _person(null_as: str | None = "unknown"):
    return person_key(F.col("email"), F.col("name"), F.col("affiliation"), F.col("country"), null_as)


def check_row_parity(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact rows next to staging rows that name an award."""
    named = staging.filter(not_blank(F.col("award_certificate_type"))).agg(F.count("*").alias("stg_rows"))
    return named.withColumn("fact_rows", fact.agg(F.count("*")).scalar())


def check_member_parity(fact: DataFrame, award_type: DataFrame) -> DataFrame:
    counts = fact.groupBy("award_type_id").agg(F.count("*").alias("fact_cnt"))
    return counts.join(award_type, "award_type_id").select("award_name", "fact_cnt").orderBy(
        F.desc("fact_cnt"), "award_name"
    )


def count_pseudo(author: DataFrame, email: str = "email") -> DataFrame:
    return author.filter(F.col(email).endswith("@pseudo")).agg(F.count("*").alias("pseudo_authors"))


def identity_profile(staging: DataFrame) -> DataFrame:
    """Rows, given e-mails and identities. Counted over the distinct combinations."""
    combos = staging.groupBy(
        plain_address(F.col("email")).alias("email"), _person(None).alias("person")
    ).agg(F.count("*").alias("n"))
    return combos.agg(
        F.sum("n").alias("rows_total"),
        F.count_distinct("email").alias("distinct_real_emails"),
        F.count_distinct("person").alias("distinct_people_norm"),
    )


def count_authors(staging: DataFrame, author: DataFrame) -> DataFrame:
    people = staging.select(_person(None).alias("person")).distinct().agg(F.count("person").alias("authors_in_staging"))
    return people.withColumn("authors_in_dim_author", author.agg(F.count("*")).scalar())


def top_repeated_identities(staging: DataFrame, k: int = 20) -> DataFrame:
    """The identities with most rows; equal counts go by identity, a missing one first."""
    return staging.groupBy(_person(None).alias("email_norm")).agg(
        F.min("name").alias("sample_name"),
        F.min("affiliation").alias("sample_affiliation"),
        F.min("country").alias("sample_country"),
        F.count("*").alias("rows_for_person"),
    ).orderBy(F.desc("rows_for_person"), F.asc_nulls_first("email_norm")).limit(k)


def check_key(table: DataFrame, key: str) -> DataFrame:
    """Rows of a table, rows without a key, and keys held by more than one row."""
    by_key = table.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    blank = F.col("key").isNull() | (F.trim("key") == "")
    return by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank_keys"),
        F.count_if(~blank & (F.col("n") > 1)).alias("repeated_keys"),
    )


def check_constraints(dims: Dimensions, fact: DataFrame) -> DataFrame:
    """``check_key`` on the matching key of every dimension and on the fact's own id."""
    placed = F.concat_ws("|", "affiliation_key", F.col("country_id").cast("string"))
    tables = {
        "dim_country": check_key(dims.country, "country_key"),
        "dim_affiliation": check_key(dims.affiliation.withColumn("placed", placed), "placed"),
        "dim_award_type": check_key(dims.award_type, "award_key"),
        "dim_author": check_key(dims.author, dims.author_key),
        "fact_award": check_key(fact, "award_id"),
    }
    named = [report.select(F.lit(name).alias("table"), "*") for name, report in tables.items()]
    return reduce(DataFrame.unionByName, named)


def check_foreign_keys(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows whose id is in no row of the dimension, counted per distinct id."""
    reports = []
    for name in ("country", "affiliation", "award_type", "author"):
        column = f"{name}_id"
        used = fact.groupBy(column).agg(F.count("*").alias("n"))
        lost = used.join(getattr(dims, name).select(column), column, "left_anti")
        reports.append(lost.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
        ).select(F.lit(f"dim_{name}").alias("table"), "orphan_rows"))
    return reduce(DataFrame.unionByName, reports)


def fact_counts(fact: DataFrame) -> DataFrame:
    by_author = fact.groupBy("author_id").agg(F.count("*").alias("n"))
    return by_author.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"), F.count("author_id").alias("authors_in_fact")
    )


def _missing_counts(rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Distinct combinations of match keys with their row count and ids."""
    combos = rows.groupBy(*_MATCH).agg(F.count("*").alias("n"))
    return with_dimension_ids(combos, dims)


def _sum_if(condition, name: str):
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)


def _missing_columns() -> list:
    return [
        _sum_if(F.col("country_id").isNull(), "missing_country"),
        _sum_if(F.col("affiliation_id").isNull(), "missing_affiliation"),
        _sum_if(F.col("award_type_id").isNull(), "missing_award_type"),
        _sum_if(F.col("author_id").isNull(), "missing_author"),
    ]


def load_readiness(staging: DataFrame, dims: Dimensions) -> DataFrame:
    """How many staging rows lack a member in each dimension, and how many lack none."""
    found = _missing_counts(with_match_keys(staging, _person()), dims)
    ready = F.lit(True)
    for name in ("country_id", "affiliation_id", "award_type_id", "author_id"):
        ready = ready & F.col(name).isNotNull()
    return found.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_staging_rows"),
        *_missing_columns(),
        _sum_if(ready, "rows_ready_for_fact"),
    )


def unloaded_rows(staging: DataFrame, dims: Dimensions, fact: DataFrame) -> DataFrame:
    """Staging rows without a fact row, with their match keys."""
    found = with_dimension_ids(with_match_keys(staging, _person()), dims)
    return without_loaded(found, fact).select(*staging.columns, *_MATCH)


def unloaded_keys(staging: DataFrame, dims: Dimensions, fact: DataFrame) -> DataFrame:
    return unloaded_rows(staging, dims, fact).select(
        F.col("id").alias("stg_id"), "name", "email", "affiliation", "country",
        "award_certificate_type", "certificate_number",
        F.col("person_key").alias("email_norm"),
        F.col("country_key").alias("country_norm"),
        F.col("affiliation_key").alias("affiliation_norm"),
        F.col("award_key").alias("award_norm"),
    )


def explain_unloaded(unloaded: DataFrame, dims: Dimensions) -> DataFrame:
    """Unloaded rows by the dimension in which they lack a member."""
    return _missing_counts(unloaded, dims).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_missing"), *_missing_columns()
    )


def unmatched_awards(unloaded: DataFrame, dims: Dimensions) -> DataFrame:
    names = unloaded.select(F.col("award_key")).distinct()
    return names.join(dims.award_type.select("award_key"), "award_key", "left_anti").select(
        F.col("award_key").alias("missing_award")
    )


def unmatched_countries(unloaded: DataFrame, dims: Dimensions) -> DataFrame:
    names = unloaded.select("country_key").distinct()
    return names.join(dims.country.select("country_key"), "country_key", "left_anti").select(
        F.col("country_key").alias("missing_country")
    )


def unmatched_affiliations(unloaded: DataFrame, dims: Dimensions) -> DataFrame:
    """Affiliations not known within their country."""
    places = dims.affiliation.join(dims.country, "country_id").select("affiliation_key", "country_key")
    names = unloaded.select("country_key", "affiliation_key").distinct()
    return names.join(places, ["country_key", "affiliation_key"], "left_anti").select(
        F.col("country_key").alias("country_norm"), F.col("affiliation_key").alias("missing_affiliation")
    )
