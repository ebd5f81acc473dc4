"""Conversion reports over users, abstracts, registrations, conferences and countries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import conversion_pct, mean_ticket
from tallyloom.functions.measures import TOTAL
from tallyloom.operators import funnel
from tallyloom.params import DateWindow, Payment
from tallyloom.sources.tables import stage


@dataclass(frozen=True)
class Inputs:
    """The tables the conversion reports read."""

    users: DataFrame
    abstracts: DataFrame
    registrations: DataFrame
    events: DataFrame
    countries: DataFrame
    #: The stored table of first submissions (``funnel.merge_first_activity``), where there is one.
    first: DataFrame | None = None

    def pairs(self, window: DateWindow, payment: Payment = Payment()) -> DataFrame:
        return funnel.conversion_pairs(self.abstracts, self.registrations, window, payment)

    def user_dim(self, blank: str | None = "Unknown") -> DataFrame:
        return funnel.user_dim(self.users, self.countries, blank)


_PCT = "conversion_pct"


def _money() -> list:
    return funnel.ticket_stats()[:2]


def _mean(name: str):
    return F.expr(f"CAST(coalesce({mean_ticket('revenue', 'paid_rows')}, 0) AS {TOTAL}) AS {name}")


def _pct(part: str = "paid_users", whole: str = "submitter_users"):
    return conversion_pct(part, whole)


def submission_rate(inputs: Inputs, window: DateWindow) -> DataFrame:
    """Users created in the window against users who submitted in it.

    Submitters need not be among the users created in the window, so the rate
    may exceed 100.
    """
    created = funnel.window_filter(inputs.users, "created_at", window)
    submitted = funnel.window_filter(inputs.abstracts, "statusdate", window)
    by_user = submitted.groupBy("user_id").count()
    totals = by_user.agg(
        F.count("*").alias("users_who_submitted_in_window"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_abstracts_in_window"),
    )
    counted = totals.withColumn("total_users_in_window", created.agg(F.count("*")).scalar())
    return counted.select(
        "total_users_in_window",
        "users_who_submitted_in_window",
        "total_abstracts_in_window",
        _pct("users_who_submitted_in_window", "total_users_in_window").alias("user_submission_rate_percent"),
    )


def submitter_detail(inputs: Inputs, window: DateWindow) -> DataFrame:
    created = funnel.window_filter(inputs.users, "created_at", window)
    people = created.select(*funnel.person_columns(window.end), "created_at")
    activity = funnel.lifetime_vs_window(inputs.abstracts, window)
    return people.join(activity, "user_id").orderBy(F.desc("last_submission"), "user_id")


def conversion(inputs: Inputs, window: DateWindow) -> DataFrame:
    totals = funnel.per_user(inputs.pairs(window)).agg(
        *funnel.user_counts(), F.coalesce(F.sum("revenue"), F.lit(0)).cast(TOTAL).alias("total_revenue_EUR")
    )
    return totals.select(
        "submitter_users",
        "paid_users",
        _pct().alias("submitter_to_paid_rate_pct"),
        "total_revenue_EUR",
    )


_USER_MONEY = ["paid_rows AS paid_registrations", "revenue AS eur_revenue"]
_IS_PAID = "CAST(if(paid_rows > 0, 1, 0) AS bigint) AS is_paid"


def _user_revenue(pairs: DataFrame) -> DataFrame:
    return funnel.per_user(pairs).selectExpr("user_id", *_USER_MONEY, _IS_PAID)


def paid_unpaid(inputs: Inputs, window: DateWindow) -> DataFrame:
    people = inputs.users.select(*funnel.person_columns(window.end))
    return people.join(_user_revenue(inputs.pairs(window)), "user_id").orderBy(
        F.desc("is_paid"), F.desc("eur_revenue"), "user_id"
    )


def paid_users(inputs: Inputs, window: DateWindow) -> DataFrame:
    paying = _user_revenue(inputs.pairs(window)).filter("is_paid = 1").drop("is_paid")
    people = inputs.users.select(*funnel.person_columns(window.end))
    return people.join(paying, "user_id").orderBy(
        F.desc("eur_revenue"), F.desc("paid_registrations"), "user_id"
    )


def unpaid_invoices(inputs: Inputs, window: DateWindow) -> DataFrame:
    """Submitters' registrations with an invoice asked for and no payment."""
    pending = inputs.registrations.filter("sendinvoice = 1 AND status = 0").join(
        funnel.submitters(inputs.abstracts, window), funnel.PAIR, "left_semi"
    )
    people = inputs.users.select(
        F.col("id").alias("user_id"), F.concat_ws(" ", "first_name", "last_name").alias("name"), "email", "affiliation"
    )
    return pending.join(people, "user_id").select(
        F.col("id").alias("registration_id"), "user_id", "name", "email", "affiliation", "event_id",
        "total_price", "currency_type", "sendinvoice", "status", "created_at", "updated_at",
    ).orderBy(F.desc("created_at"), "registration_id")


def paid_unpaid_events(inputs: Inputs, window: DateWindow) -> DataFrame:
    users = funnel.per_user_with_events(inputs.pairs(window), inputs.events).selectExpr(
        "user_id", *_USER_MONEY, _IS_PAID,
        "submitted_event_ids", "submitted_event_names", "paid_event_ids", "paid_event_names",
    )
    names = inputs.countries.selectExpr("id AS country_id", "name AS country")
    people = inputs.users.select(*funnel.person_columns(window.end), "country_id")
    return people.join(users, "user_id").join(names, "country_id", "left").drop("country_id").orderBy(
        F.desc("is_paid"), F.desc("eur_revenue"), "user_id"
    )


def country_conversion(inputs: Inputs, window: DateWindow) -> DataFrame:
    by_user = funnel.per_user(inputs.pairs(window)).join(inputs.user_dim(), "user_id")
    countries = funnel.roll_up(by_user, ["country_name"], *funnel.user_counts())
    return countries.select(
        "country_name", "submitter_users", "paid_users", _pct().alias(_PCT), *_money()
    ).orderBy(F.desc("revenue_EUR"), F.desc("conversion_pct"), "country_name")


def country_event(inputs: Inputs, window: DateWindow) -> DataFrame:
    events = inputs.events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    located = inputs.pairs(window).join(inputs.user_dim(), "user_id")
    cells = funnel.roll_up(located, ["country_name", "event_id"], *funnel.user_counts())
    return cells.join(events, "event_id").select(
        "country_name", "event_id", "event_name", "submitter_users", "paid_users",
        _pct().alias(_PCT), *_money(),
    ).orderBy(F.desc("revenue_EUR"), "country_name", "event_id")


def _paid_located(inputs: Inputs, window: DateWindow) -> DataFrame:
    """Paid pairs with the user's country and affiliation as typed."""
    paid = inputs.pairs(window).filter("paid_rows > 0")
    return paid.join(inputs.user_dim(blank=None), "user_id")


_SITE = ["affiliation_key", "country_name"]


def _shown():
    """The affiliation as shown: the smallest spelling of the group."""
    return F.min("affiliation").alias("affiliation")


def _sites(located: DataFrame) -> DataFrame:
    """Paid totals per affiliation and country."""
    by_user = funnel.roll_up(located, [*_SITE, "user_id"], _shown())
    return funnel.roll_up(by_user, _SITE, _shown(), F.count("*").alias("paid_users"))


def _site_events(located: DataFrame, events: DataFrame) -> DataFrame:
    """Paid totals per affiliation, country and known conference."""
    known = events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    cells = funnel.roll_up(located, [*_SITE, "event_id"], _shown(), F.count("*").alias("paid_users"))
    return cells.join(known, "event_id")


def affiliation(inputs: Inputs, window: DateWindow) -> DataFrame:
    return _sites(_paid_located(inputs, window)).select(
        "affiliation", "country_name", "paid_users", F.col("revenue").alias("revenue_EUR")
    ).orderBy(F.desc("revenue_EUR"), F.desc("paid_users"), "affiliation", "country_name")


def affiliation_event(inputs: Inputs, window: DateWindow) -> DataFrame:
    return _site_events(_paid_located(inputs, window), inputs.events).select(
        "affiliation", "country_name", "event_id", "event_name", "paid_users", *_money()
    ).orderBy(F.desc("revenue_EUR"), F.desc("paid_users"), "affiliation", "country_name", "event_id")


def _rollup2(located: DataFrame, events: DataFrame) -> DataFrame:
    named = located.filter("affiliation_key IS NOT NULL")
    totals = _sites(named).select(
        *_SITE,
        F.col("paid_users").alias("paid_users_total"),
        F.col("revenue").alias("revenue_total_EUR"),
        _mean("avg_ticket_total_EUR"),
    )
    detail = _site_events(named, events).select(
        *_SITE, "affiliation", "event_id", "event_name", "paid_users", *_money()
    )
    return detail.join(totals, _SITE).drop("affiliation_key")


def affiliation_rollup2(inputs: Inputs, window: DateWindow) -> DataFrame:
    """Affiliation x conference rows, each with the affiliation's total.

    The totals cover conferences missing from the conference table too, and count
    users, so they are not sums of the rows. Rows without an affiliation drop out.
    """
    located = stage(_paid_located(inputs, window), "paid_pairs")
    return _rollup2(located, inputs.events).orderBy(
        F.desc("revenue_total_EUR"), F.desc("paid_users_total"), "affiliation", "country_name", "event_id"
    )


def affiliation_rollup3(inputs: Inputs, window: DateWindow) -> DataFrame:
    """As ``affiliation_rollup2``, with the country's total on each row as well."""
    located = stage(_paid_located(inputs, window), "paid_pairs")
    by_user = funnel.roll_up(located, ["country_name", "user_id"])
    countries = funnel.roll_up(by_user, ["country_name"], F.count("*").alias("paid_users_country")).select(
        "country_name",
        "paid_users_country",
        F.col("revenue").alias("revenue_country_EUR"),
        _mean("avg_ticket_country_EUR"),
    )
    return _rollup2(located, inputs.events).join(countries, "country_name").orderBy(
        F.desc("revenue_country_EUR"), F.desc("revenue_total_EUR"), F.desc("revenue_EUR"),
        "affiliation", "country_name", "event_id",
    )


def grand_total(inputs: Inputs, window: DateWindow) -> DataFrame:
    """One row per country and one for all.

    The total counts submitters without a user row too; the country rows cannot.
    ``rollup`` gives both from one pass, with those users under a NULL country
    that only the total takes in.
    """
    by_user = funnel.per_user(inputs.pairs(window)).join(
        inputs.user_dim().select("user_id", "country_name"), "user_id", "left"
    )
    rolled = by_user.rollup("country_name").agg(
        F.grouping("country_name").alias("is_total"),
        *funnel.user_counts(),
        F.sum("paid_rows").alias("paid_rows"),
        F.sum("revenue").cast(TOTAL).alias("revenue"),
    )
    shown = rolled.filter("is_total = 1 OR country_name IS NOT NULL").withColumn(
        "country_name", F.when(F.col("is_total") == 1, "ALL COUNTRIES").otherwise(F.col("country_name"))
    )
    return shown.select(
        "country_name", "submitter_users", "paid_users", _pct().alias(_PCT), *_money()
    ).orderBy(
        (F.col("country_name") == "ALL COUNTRIES").desc(),
        F.desc("revenue_EUR"), F.desc("conversion_pct"), "country_name",
    )
