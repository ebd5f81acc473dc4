"""Award reports over the fact table and its dimensions.

Facts are first added up by ids; names are joined to the sums. A fact row's ids
are known to be in the dimensions (``check_foreign_keys``), so a report joins
only the dimensions it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import ci_key
from tallyloom.operators.lists import join_values, joined_lists, list_values
from tallyloom.operators.warehouse import Dimensions


def _named(rows: DataFrame, dims: Dimensions, *names: str) -> DataFrame:
    """Join the shown columns of some dimensions."""
    shown = {
        "country": ["country_name"],
        "affiliation": ["affiliation_name"],
        "award_type": ["award_name"],
        "author": ["full_name", "email_norm"],
    }
    for name in names:
        rows = rows.join(getattr(dims, name).select(f"{name}_id", *shown[name]), f"{name}_id")
    return rows


def _of_country(fact: DataFrame, dims: Dimensions, country: str) -> DataFrame:
    wanted = dims.country.filter(ci_key(F.col("country_name")) == ci_key(F.lit(country)))
    return fact.join(wanted.select("country_id"), "country_id", "left_semi")


def awardees_by_affiliation(fact: DataFrame, dims: Dimensions, order: str = "country") -> DataFrame:
    """Awardees per country and affiliation, by ``country`` or by ``awardees`` first."""
    people = fact.groupBy("country_id", "affiliation_id", "author_id").agg(F.count("*").alias("n"))
    counts = people.groupBy("country_id", "affiliation_id").agg(F.count("*").alias("awardees"))
    rows = _named(counts, dims, "country", "affiliation")
    count_name = "unique_awardees" if order == "country" else "total_awardees"
    report = rows.select(
        F.col("country_name").alias("country"),
        F.col("affiliation_name").alias("affiliation"),
        F.col("awardees").alias(count_name),
    )
    if order == "country":
        return report.orderBy("country", F.desc(count_name), "affiliation")
    return report.orderBy(F.desc(count_name), "country", "affiliation")


def country_totals(fact: DataFrame, dims: Dimensions) -> DataFrame:
    people = fact.groupBy("country_id", "author_id").agg(F.count("*").alias("n"))
    counts = people.groupBy("country_id").agg(
        F.sum("n").alias("total_awards"), F.count("*").alias("unique_awardees")
    )
    return _named(counts, dims, "country").select(
        F.col("country_name").alias("country"), "total_awards", "unique_awardees"
    ).orderBy(F.desc("total_awards"), "country")


def award_detail(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Every fact row with its names. The row id ends the sort, so equal names split over tasks."""
    return _named(fact, dims, "author", "country", "affiliation", "award_type").select(
        "award_id",
        F.col("full_name").alias("author_name"),
        F.col("email_norm").alias("email"),
        F.col("affiliation_name").alias("affiliation"),
        F.col("country_name").alias("country"),
        F.col("award_name").alias("award_type"),
        F.col("session_topic").alias("research_area"),
        "assembly_number",
        "award_year",
        "presentation_type",
    ).orderBy("country", "award_type", "award_id")


def _counted(fact: DataFrame, *columns: str) -> DataFrame:
    return fact.groupBy(*columns).agg(F.count("*").alias("n"))


def _country_values(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Values of the lists per country. Topics are added up apart from people, or each person would come once per topic."""
    people = _named(_counted(fact, "country_id", "author_id"), dims, "author")
    topics = _counted(fact, "country_id", "session_topic")
    return list_values(people, ["country_id"], {"authors": "full_name", "emails": "email_norm"}, "n").unionByName(
        list_values(topics, ["country_id"], {"research_areas": "session_topic"}, "n")
    )


def country_lists(fact: DataFrame, dims: Dimensions) -> DataFrame:
    names = ["authors", "emails", "research_areas"]
    lists = join_values(_country_values(fact, dims), ["country_id"], names, row_count="total_awards")
    return _named(lists, dims, "country").select(
        F.col("country_name").alias("country"), "total_awards", *names
    ).orderBy(F.desc("total_awards"), "country")


def country_list_values(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """The lists of ``country_lists`` one value per row, for countries of any size."""
    return _named(_country_values(fact, dims), dims, "country").select(
        F.col("country_name").alias("country"), "list", "value", "n"
    )


def affiliation_list_values(fact: DataFrame, dims: Dimensions, country: str) -> DataFrame:
    """The lists of ``affiliation_lists`` one value per row."""
    combos = _counted(
        _of_country(fact, dims, country), "affiliation_id", "author_id", "session_topic", "award_type_id"
    )
    lists = {"authors": "full_name", "emails": "email_norm", "research_areas": "session_topic", "award_names": "award_name"}
    long = list_values(_named(combos, dims, "author", "award_type"), ["affiliation_id"], lists, "n")
    return _named(long, dims, "affiliation").select("affiliation_name", "list", "value", "n")


def author_lists(fact: DataFrame, dims: Dimensions) -> DataFrame:
    keys = ["country_id", "author_id"]
    combos = _counted(fact, *keys, "session_topic").groupBy(*keys, ci_key(F.col("session_topic")).alias("_key")).agg(
        F.min("session_topic").alias("session_topic"), F.sum("n").alias("n")
    )
    per = combos.groupBy(*keys).agg(
        F.expr("listagg(session_topic, ', ') WITHIN GROUP (ORDER BY session_topic)").alias("research_areas"),
        F.sum("n").alias("total_awards"),
    )
    return _named(per, dims, "country", "author").select(
        F.col("country_name").alias("country"),
        F.col("full_name").alias("author_name"),
        F.col("email_norm").alias("email"),
        "research_areas",
        "total_awards",
    ).orderBy("country", F.desc("total_awards"), "author_name", "email")


def country_affiliation_rank(fact: DataFrame, dims: Dimensions, country: str) -> DataFrame:
    """Affiliations of a country by number of awardees."""
    rows = _of_country(fact, dims, country)
    years = rows.groupBy("affiliation_id").agg(
        F.min("award_year").cast("long").alias("first_year"), F.max("award_year").cast("long").alias("last_year")
    )
    combos = _counted(rows, "affiliation_id", "author_id", "session_topic", "award_type_id")
    lists = joined_lists(
        _named(combos, dims, "award_type"),
        ["affiliation_id"],
        {"research_areas": "session_topic", "award_names": "award_name"},
        weight="n",
        row_count="awards",
    )
    people = rows.select("affiliation_id", "author_id").distinct().groupBy("affiliation_id").agg(F.count("*").alias("awardees"))
    return _named(lists.join(people, "affiliation_id").join(years, "affiliation_id"), dims, "affiliation").drop("affiliation_id").orderBy(
        F.desc("awardees"), F.desc("awards"), "affiliation_name"
    )


def _person_rows(rows: DataFrame, dims: Dimensions) -> DataFrame:
    return _named(rows, dims, "author", "affiliation", "award_type").select(
        "award_id",
        "affiliation_name",
        "award_name",
        F.col("session_topic").alias("research_area"),
        F.col("full_name").alias("author_name"),
        F.coalesce("email_norm", F.lit("")).alias("email"),
        "award_year",
        "presentation_type",
    )


def country_award_detail(fact: DataFrame, dims: Dimensions, country: str) -> DataFrame:
    return _person_rows(_of_country(fact, dims, country), dims).orderBy(
        "affiliation_name", "award_name", "author_name", F.desc_nulls_last("award_year"), "award_id"
    ).drop("award_id")


def affiliation_award_detail(fact: DataFrame, dims: Dimensions, country: str, affiliation: str) -> DataFrame:
    wanted = dims.affiliation.filter(ci_key(F.col("affiliation_name")) == ci_key(F.lit(affiliation)))
    rows = _of_country(fact, dims, country).join(wanted.select("affiliation_id"), "affiliation_id", "left_semi")
    return _person_rows(rows, dims).orderBy(
        F.desc_nulls_last("award_year"), "award_name", "author_name", "award_id"
    ).drop("award_id")


def affiliation_lists(fact: DataFrame, dims: Dimensions, country: str, distinct: bool = True) -> DataFrame:
    """Authors, e-mails, areas and awards per affiliation of a country.

    ``total_awards`` counts different award names with ``distinct``, else rows;
    without ``distinct`` the lists repeat a value as often as it occurs.
    """
    combos = _counted(
        _of_country(fact, dims, country), "affiliation_id", "author_id", "session_topic", "award_type_id"
    )
    lists = joined_lists(
        _named(combos, dims, "author", "award_type"),
        ["affiliation_id"],
        {
            "authors": "full_name",
            "emails": "email_norm",
            "research_areas": "session_topic",
            "award_names": "award_name",
        },
        distinct,
        weight="n",
        **({"value_counts": {"total_awards": "award_names"}} if distinct else {"row_count": "total_awards"}),
    )
    return _named(lists, dims, "affiliation").drop("affiliation_id").orderBy(
        F.desc("total_awards"), "affiliation_name"
    )
