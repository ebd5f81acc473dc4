"""Insight tables: pricing, cohorts and best items per country, conference or affiliation.

One builder serves the three grains and both kinds of window. It aggregates the
conversion pairs twice: to one row per group and user (for user counts, money and
the best affiliations or countries) and to one row per group and conference (for
conference counts and the best conferences). All further steps work on those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import conversion_pct, price_tiers
from tallyloom.functions.measures import TOTAL
from tallyloom.operators import funnel
from tallyloom.operators.ranking import count_label, euro_label, top_k_label
from tallyloom.params import DateWindow
from tallyloom.plans.marketing import Inputs
from tallyloom.sources.tables import stage


def _best(stats: DataFrame, keys: list[str], item: str, key: str, plural: str) -> list[DataFrame]:
    """Top-three labels by payers and by revenue; ties go by the item's key."""
    by_paid = [F.desc("item_users"), F.desc("item_revenue"), F.asc(item), F.asc(key)]
    by_revenue = [F.desc("item_revenue"), F.desc("item_users"), F.asc(item), F.asc(key)]
    return [
        top_k_label(stats, keys, item, by_paid, count_label("item_users"), f"top_{plural}_by_paid"),
        top_k_label(stats, keys, item, by_revenue, euro_label("item_revenue"), f"top_{plural}_by_revenue"),
    ]


def _item_stats(users: DataFrame, keys: list[str], item_key: str, *extra) -> DataFrame:
    """Payers and revenue per key and item, from rows that are one per key, item and user."""
    return users.filter("paid_rows > 0").groupBy(*keys, item_key).agg(
        F.count("*").alias("item_users"), F.sum("revenue").cast(TOTAL).alias("item_revenue"), *extra
    )


def _assemble(totals: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    joined = reduce(lambda left, right: left.join(right, keys, "left"), parts, totals)
    tiers = price_tiers("avg_ticket_EUR", "stddev_ticket_EUR", "min_ticket_EUR")
    labels = [c for c in joined.columns if c.startswith("top_")]
    return joined.withColumns(tiers).fillna("", labels)


def _totals(users: DataFrame, keys: list[str], *extra) -> DataFrame:
    """``extra`` columns describe the group and come first."""
    rolled = funnel.roll_up(users, keys, *extra, *funnel.user_counts(), *funnel.cohort_counts())
    shown = [c for c in rolled.columns if c not in ("paid_rows", "revenue", "squares", "lowest", "highest")]
    return rolled.select(
        *shown,
        conversion_pct("paid_users", "submitter_users", on_zero=0).alias("conversion_pct"),
        F.col("paid_rows").alias("paid_registration_rows"),
        *funnel.ticket_stats(),
    )


def _located(inputs: Inputs, window: DateWindow, blank: str | None) -> DataFrame:
    """The pairs with their user's place, stored: every figure of a table is read from them."""
    pairs = funnel.with_returning(inputs.pairs(window), inputs.abstracts, window, inputs.first)
    return stage(pairs.join(inputs.user_dim(blank), "user_id"), "pairs")


def _users(located: DataFrame, attributes: list[str]) -> DataFrame:
    """Pairs added up to one row per user, keeping what depends on the user alone."""
    return funnel.roll_up(located, [*attributes, "returning", "user_id"], F.min("affiliation").alias("affiliation"))


def _conferences(located: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group and conference."""
    return located.groupBy(*keys, "event_id").agg(
        F.count_if(F.col("paid_rows") > 0).alias("item_users"),
        F.sum("revenue").cast(TOTAL).alias("item_revenue"),
    )


def _conference_parts(conferences: DataFrame, keys: list[str], events: DataFrame) -> list[DataFrame]:
    counts = conferences.groupBy(*keys).agg(
        F.count("*").alias("events_submitted"), F.count_if(F.col("item_users") > 0).alias("events_paid")
    )
    named = conferences.filter("item_users > 0").join(funnel.event_names(events), "event_id")
    return [counts, *_best(named, keys, "event_name", "event_id", "events")]


def geo_event(inputs: Inputs, window: DateWindow, blank: str | None = "Unknown") -> DataFrame:
    """Country x conference.

    With ``blank=None`` the best affiliations are taken as typed, leaving out only
    missing and empty ones; otherwise blank ones count as unknown and are left out.
    A conference missing from the conference table keeps its figures but shows
    neither id nor name.
    """
    keys = ["country_name", "event_id"]
    located = _located(inputs, window, blank)
    skip = "" if blank is None else blank.lower()
    site = _item_stats(
        located.filter(F.col("affiliation_key") != skip), keys, "affiliation_key", F.min("affiliation").alias("affiliation")
    )
    table = _assemble(
        _totals(located, keys), _best(site, keys, "affiliation", "affiliation_key", "affiliations"), keys
    )
    return _best_first(_with_conference(table, inputs.events), "country_name", "event_id")


def _best_first(table: DataFrame, *names: str) -> DataFrame:
    return table.orderBy(F.desc("revenue_EUR"), F.desc("conversion_pct"), *names)


def _with_conference(table: DataFrame, events: DataFrame) -> DataFrame:
    """Conference id and name from the conference table; NULL for both if it is not there."""
    known = funnel.event_names(events).withColumn("known_id", F.col("event_id"))
    rest = [c for c in table.columns if c not in ("country_name", "event_id")]
    return table.join(known, "event_id", "left").select(
        "country_name", F.col("known_id").alias("event_id"), "event_name", *rest
    )


def country(inputs: Inputs, window: DateWindow, top_affiliations: bool = False) -> DataFrame:
    """All conferences of a country together."""
    keys = ["country_name"]
    located = _located(inputs, window, "Unknown")
    users = _users(located, ["country_name", "affiliation_key"])
    parts = _conference_parts(_conferences(located, keys), keys, inputs.events)
    if top_affiliations:
        site = _item_stats(
            users.filter("affiliation_key != 'unknown'"), keys, "affiliation_key", F.min("affiliation").alias("affiliation")
        )
        parts += _best(site, keys, "affiliation", "affiliation_key", "affiliations")
    return _best_first(_assemble(_totals(users, keys), parts, keys), "country_name")


def affiliation(inputs: Inputs, window: DateWindow) -> DataFrame:
    """All conferences and countries of an affiliation together."""
    keys = ["affiliation_key"]
    located = _located(inputs, window, "Unknown")
    users = _users(located, ["affiliation_key", "country_name"])
    homes = users.groupBy("affiliation_key", "country_name").agg(
        F.count_if(F.col("paid_rows") > 0).alias("item_users"),
        F.sum("revenue").cast(TOTAL).alias("item_revenue"),
    )
    counts = homes.groupBy("affiliation_key").agg(
        F.count("*").alias("countries_represented"), F.count_if(F.col("item_users") > 0).alias("countries_paid")
    )
    parts = [
        counts,
        *_best(homes.filter("item_users > 0"), keys, "country_name", "country_name", "countries"),
        *_conference_parts(_conferences(located, keys), keys, inputs.events),
    ]
    totals = _totals(users, keys, F.min("affiliation").alias("affiliation"))
    return _best_first(_assemble(totals, parts, keys).drop("affiliation_key"), "affiliation")


def unconverted(inputs: Inputs, window: DateWindow) -> DataFrame:
    """Country x conference: submitters who did not pay, and what that may have cost."""
    keys = ["country_name", "event_id"]
    shown = "(No affiliation)"
    located = stage(inputs.pairs(window).join(inputs.user_dim(shown), "user_id"), "pairs")
    unpaid = F.col("paid_rows") == 0
    cells = funnel.roll_up(
        located, keys, F.count("*").alias("submitter_users"), F.count_if(unpaid).alias("unregistered_users")
    ).withColumns({"avg_ticket_EUR": funnel.ticket_stats()[1]})
    site = located.filter(unpaid).groupBy(*keys, "affiliation_key").agg(
        F.count("*").alias("item_users"), F.min("affiliation").alias("affiliation")
    )
    label = top_k_label(
        site, keys, "affiliation", [F.desc("item_users"), F.asc("affiliation"), F.asc("affiliation_key")],
        count_label("item_users"), "top_unregistered_affiliations",
    )
    table = cells.join(label, keys, "left").select(
        *keys,
        "submitter_users",
        "unregistered_users",
        conversion_pct("unregistered_users", "submitter_users", on_zero=0).alias("dropoff_pct"),
        "avg_ticket_EUR",
        funnel.missed_revenue("unregistered_users", "avg_ticket_EUR").alias("est_missed_revenue_EUR"),
        F.coalesce("top_unregistered_affiliations", F.lit("")).alias("top_unregistered_affiliations"),
    )
    return _with_conference(table, inputs.events).orderBy(
        F.desc("est_missed_revenue_EUR"), F.desc("dropoff_pct"), "country_name", "event_id"
    )
