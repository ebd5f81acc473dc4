"""Submission -> registration -> payment.

The common grain is the *pair*: one row per user and conference with a
submission in the window, carrying the payments made for it as sums that add up
(rows, revenue, squares, extremes). Submissions and registrations are combined
to that grain before they meet, so a user or conference that owns a large part
of the rows shrinks inside the map tasks; and since a pair is unique, counting
pairs or users needs no distinct aggregate further on.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import age_as_of, blank_to_null, ci_key, mean_ticket, pop_stddev
from tallyloom.functions.measures import MONEY, SQUARES, TOTAL
from tallyloom.params import DateWindow, Payment
from tallyloom.sources import versions

PAIR = ["user_id", "event_id"]


def window_filter(df: DataFrame, column: str, window: DateWindow) -> DataFrame:
    """Rows in ``[start, end)``. The column stays bare so that the scan can use the range."""
    return df.filter((F.col(column) >= F.lit(window.start)) & (F.col(column) < F.lit(window.end)))


def submitters(abstracts: DataFrame, window: DateWindow) -> DataFrame:
    """Distinct user and conference with a submission in the window."""
    return window_filter(abstracts, "statusdate", window).select(*PAIR).distinct()


def is_paid(payment: Payment = Payment()) -> Column:
    return (
        (F.col("status") == payment.paid_status)
        & (F.col("currency_type") == payment.currency)
        & F.col("total_price").isNotNull()
    )


def paid_registrations(registrations: DataFrame, pairs: DataFrame, payment: Payment = Payment()) -> DataFrame:
    """Paid registration rows whose user and conference are among ``pairs``."""
    return registrations.filter(is_paid(payment)).join(pairs.select(*PAIR), PAIR, "left_semi")


def paid_in_window(registrations: DataFrame, window: DateWindow, payment: Payment = Payment()) -> DataFrame:
    """Registrations paid in the window by ``updated_at``; a missing price is kept."""
    paid = registrations.filter(
        (F.col("status") == payment.paid_status) & (F.col("currency_type") == payment.currency)
    )
    return window_filter(paid, "updated_at", window)


def payment_sums(registrations: DataFrame, keys: list[str]) -> DataFrame:
    """Additive ticket statistics per key, of registrations that have a price."""
    priced = registrations.select(*keys, F.col("total_price").cast(MONEY).alias("price"))
    return priced.groupBy(*keys).agg(
        F.count("*").alias("paid_rows"),
        F.sum("price").alias("revenue"),
        F.expr("sum(price * price) AS squares"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
    )


def conversion_pairs(
    abstracts: DataFrame, registrations: DataFrame, window: DateWindow, payment: Payment = Payment()
) -> DataFrame:
    """One row per submitting user and conference with its payments.

    ``paid_rows`` is 0 and ``revenue`` 0.00 where nothing was paid.
    """
    paid = payment_sums(registrations.filter(is_paid(payment)), PAIR)
    return submitters(abstracts, window).join(paid, PAIR, "left").selectExpr(
        *PAIR,
        "coalesce(paid_rows, 0) AS paid_rows",
        f"CAST(coalesce(revenue, 0) AS {TOTAL}) AS revenue",
        f"CAST(coalesce(squares, 0) AS {SQUARES}) AS squares",
        "lowest",
        "highest",
    )


def roll_up(rows: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Add up pair-level sums to ``keys``."""
    return rows.groupBy(*keys).agg(
        F.sum("paid_rows").alias("paid_rows"),
        F.expr(f"CAST(sum(revenue) AS {TOTAL}) AS revenue"),
        F.expr(f"CAST(sum(squares) AS {SQUARES}) AS squares"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        *extra,
    )


def per_user(pairs: DataFrame, *attributes: str) -> DataFrame:
    """Pairs added up to one row per user; ``attributes`` depend on the user alone."""
    return roll_up(pairs, [*attributes, "user_id"])


def user_counts() -> list[Column]:
    """Submitting and paying users, over rows that are one per user."""
    return [
        F.count("*").alias("submitter_users"),
        F.count_if(F.col("paid_rows") > 0).alias("paid_users"),
    ]


def ticket_stats() -> list[Column]:
    """Rounded ticket statistics from summed-up columns (zero where nothing was paid)."""
    shown = {
        "revenue_EUR": "revenue",
        "avg_ticket_EUR": mean_ticket("revenue", "paid_rows"),
        "min_ticket_EUR": "lowest",
        "max_ticket_EUR": "highest",
        "stddev_ticket_EUR": pop_stddev("paid_rows", "revenue", "squares"),
    }
    return [F.expr(f"CAST(coalesce({text}, 0) AS {TOTAL}) AS {name}") for name, text in shown.items()]


def user_dim(users: DataFrame, countries: DataFrame, blank: str | None = "Unknown") -> DataFrame:
    """User with country and affiliation.

    ``blank`` replaces missing and blank affiliations; ``None`` leaves them as
    typed. ``affiliation_key`` is what affiliations are grouped by.
    """
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    shown = F.col("affiliation")
    if blank is not None:
        shown = F.coalesce(blank_to_null(shown), F.lit(blank))
    return users.join(names, "country_id", "left").select(
        F.col("id").alias("user_id"),
        F.coalesce("country_name", F.lit("Unknown")).alias("country_name"),
        shown.alias("affiliation"),
        ci_key(shown).alias("affiliation_key"),
    )


def person_columns(day) -> list[Column]:
    """The user columns every person-level report shows."""
    return [
        F.col("id").alias("user_id"),
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        F.col("email"),
        F.col("affiliation"),
        age_as_of(F.col("date_of_birth"), day).cast("long").alias("age_as_of_end"),
    ]


def earlier_submitters(abstracts: DataFrame, window: DateWindow) -> DataFrame:
    """Users whose first submission lies before the window."""
    before = abstracts.filter(F.col("statusdate") < F.lit(window.start))
    return before.select("user_id").distinct()


def first_activity(abstracts: DataFrame) -> DataFrame:
    """First submission of each user over all time."""
    return abstracts.groupBy("user_id").agg(F.min("statusdate").alias("first_abs_date"))


def merge_first_activity(abstracts: DataFrame, path: str, until: dt.date) -> DataFrame:
    """The stored table of first submissions, brought up to the day before ``until``.

    Only days that no earlier call has read are scanned. They are added up to one row per user and merged with the
    stored rows, and the table changes as a whole together with the day it has come to; a call for a day it has
    reached already changes nothing. A first submission that arrives with a date before that day is merged by
    ``merge_late_activity``.
    """
    spark, date = abstracts.sparkSession, F.col("statusdate")
    stored = versions.latest(spark, path)
    if stored is not None and stored.notes["until"] >= until.isoformat():
        return versions.read(spark, path)
    days = abstracts.filter(date < F.lit(until))
    if stored is not None:
        days = days.filter(date >= F.lit(dt.date.fromisoformat(stored.notes["until"])))
    return _merged_activity(days, path, until.isoformat())


def merge_late_activity(late: DataFrame, path: str) -> DataFrame:
    """Take in submissions of days the table has passed. Repeating it changes nothing: the least date stays."""
    stored = versions.latest(late.sparkSession, path)
    until = stored.notes["until"]
    return _merged_activity(late.filter(F.col("statusdate") < F.lit(dt.date.fromisoformat(until))), path, until)


def _merged_activity(days: DataFrame, path: str, until: str) -> DataFrame:
    fresh = first_activity(days)
    if versions.latest(days.sparkSession, path) is not None:
        both = versions.read(days.sparkSession, path).unionByName(fresh)
        fresh = both.groupBy("user_id").agg(F.min("first_abs_date").alias("first_abs_date"))
    return versions.reload(fresh, path, notes={"until": until})


def with_returning(pairs: DataFrame, abstracts: DataFrame, window: DateWindow, first: DataFrame | None = None) -> DataFrame:
    """Mark pairs of users who had submitted before the window.

    A user in ``pairs`` has a submission in the window, so the first one ever is
    either before it or in it. ``first`` is the stored table of first submissions (``merge_first_activity``); without
    it the rows before the window are read.
    """
    if first is None:
        known = earlier_submitters(abstracts, window)
    else:
        known = first.filter(F.col("first_abs_date") < F.lit(window.start)).select("user_id")
    return pairs.join(known.withColumn("_known", F.lit(True)), "user_id", "left").withColumn(
        "returning", F.coalesce("_known", F.lit(False))
    ).drop("_known")


def cohort_counts() -> list[Column]:
    """Paid rows (not users) of returning and of new submitters."""
    return [
        F.sum(F.when(F.col("returning"), F.col("paid_rows")).otherwise(0)).alias("returning_paid_users"),
        F.sum(F.when(~F.col("returning"), F.col("paid_rows")).otherwise(0)).alias("new_paid_users"),
    ]


def lifetime_vs_window(abstracts: DataFrame, window: DateWindow) -> DataFrame:
    """Submissions per user in the window and over all time, in one aggregate."""
    date = F.col("statusdate")
    inside = (date >= F.lit(window.start)) & (date < F.lit(window.end))
    return abstracts.groupBy("user_id").agg(
        F.count_if(inside).alias("abstracts_in_window"),
        F.count("*").alias("total_abstracts_all_time"),
        F.min(F.when(inside, date)).alias("first_submission"),
        F.max(F.when(inside, date)).alias("last_submission"),
        F.min(date).alias("first_submission_ever"),
        F.max(date).alias("last_submission_ever"),
    ).filter("abstracts_in_window > 0")


def event_name(number: Column, name: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("Event#"), number.cast("string")))


def event_names(events: DataFrame) -> DataFrame:
    return events.select(F.col("id").alias("event_id"), event_name(F.col("id"), F.col("name")).alias("event_name"))


def per_user_with_events(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """``per_user`` with the conferences submitted to and those paid for.

    Ids are in ascending order and names in the order of their smallest id. Names
    of different spelling are one, shown by the least spelling. A conference missing from ``events`` has an id but no name. A
    user's list is as long as the number of conferences at most.
    """
    entry = F.struct("event_id", "event_name", "name_key")
    lists = roll_up(
        pairs.join(event_names(events).withColumn("name_key", ci_key(F.col("event_name"))), "event_id", "left"),
        ["user_id"],
        F.array_sort(F.collect_list(entry)).alias("submitted"),
        F.array_sort(F.collect_list(F.when(F.col("paid_rows") > 0, entry))).alias("paid"),
    )
    texts = []
    for flag in ("submitted", "paid"):
        ids = f"transform({flag}, e -> CAST(e.event_id AS string))"
        keys = f"array_distinct(filter(transform({flag}, e -> e.name_key), k -> k IS NOT NULL))"
        names = f"transform({keys}, k -> array_min(transform(filter({flag}, e -> e.name_key = k), e -> e.event_name)))"
        # NULL rather than an empty text where there is nothing to list.
        texts += [
            f"if(size({entries}) > 0, array_join({entries}, ','), NULL) AS {flag}_event_{what}"
            for what, entries in (("ids", ids), ("names", names))
        ]
    return lists.selectExpr("*", *texts).drop("submitted", "paid")


def dropoff(pairs: DataFrame, paid: DataFrame) -> DataFrame:
    """Pairs without a payment for the same conference."""
    return pairs.join(paid.select(*PAIR), PAIR, "left_anti")


def missed_revenue(unregistered: str, avg_ticket: str) -> Column:
    count = f"CAST(coalesce({unregistered}, 0) AS decimal(15,0))"
    return F.expr(f"CAST(round({count} * coalesce({avg_ticket}, 0), 2) AS {TOTAL})")


def densify(aggregates: list[DataFrame], keys: list[str], fill: dict[str, object]) -> DataFrame:
    """Aggregates side by side over every key that occurs in any of them, gaps filled.

    Each input is unique on ``keys``, so the full outer joins meet one row with one row.
    """
    joined = reduce(lambda left, right: left.join(right, keys, "full_outer"), aggregates)
    return joined.fillna(fill)
