"""Mailings and form answers: who was written to, who answered, who has yet to act.

Mailings arrive as one table, the union of the mailer tables tagged with their
source (``sources.tables.union_sources``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import blank_to_null, ci_key, extract_email, plain_address
from tallyloom.operators.asof import latest_before, running_before
from tallyloom.operators.funnel import window_filter
from tallyloom.operators.latest import latest_per_key
from tallyloom.params import DateWindow

Address = Callable[[Column], Column]


def mail_touches(mailings: DataFrame, address: Address = plain_address) -> DataFrame:
    """Mailings that name a category: address, category and time sent (or else queued).

    ``category_key`` is what categories are compared by; ``award_category`` is one spelling of it.
    """
    return mailings.filter("p4 IS NOT NULL AND p4 != ''").select(
        address(F.col("to_address")).alias("email_norm"),
        ci_key(F.col("p4")).alias("category_key"),
        F.col("p4").alias("award_category"),
        F.coalesce("date_sent", "date_added").alias("sent_at"),
    )


def user_addresses(users: DataFrame, *columns: str) -> DataFrame:
    return users.select(F.col("id").alias("user_id"), plain_address(F.col("email")).alias("email_norm"), *columns)


def touch_counts(touches: DataFrame) -> DataFrame:
    """Mailings with their number per address, category and time, under the category's smallest spelling."""
    counts = touches.groupBy("email_norm", "category_key", "award_category", "sent_at").agg(F.count("*").alias("n"))
    return counts.groupBy("email_norm", "category_key", "sent_at").agg(
        F.min("award_category").alias("award_category"), F.sum("n").alias("mailings")
    )


def last_touch(payments: DataFrame, users: DataFrame, touches: DataFrame, *user_columns: str) -> DataFrame:
    """Payments (summed per user and time) with the category of the payer's latest mailing.

    The payer's address is looked up first and the mailings are matched by
    address, so users who share one do not multiply the mailings; their payments
    at one time are added up. The result is per address, time and ``user_columns``.
    """
    addressed = payments.join(user_addresses(users, *user_columns), "user_id", "left")
    summed = addressed.groupBy("email_norm", *user_columns, "paid_at").agg(
        F.sum("payments").alias("payments"), F.sum("amount").alias("amount")
    )
    named = touches.withColumn("category", F.struct("category_key", "award_category"))
    found = latest_before(summed, named, "email_norm", "paid_at", "sent_at", "category", collapse=False)
    return found.select("*", "category.category_key", "category.award_category").drop("category")


def emails_sent(counts: DataFrame, users: DataFrame) -> DataFrame:
    """Mailings per country and category over all time, from ``touch_counts``.

    Both sides are counted per address before they meet; a mailing counts once
    for every user with the address.
    """
    sent = counts.groupBy("email_norm", "category_key", "award_category").agg(F.sum("mailings").alias("sent"))
    holders = users.groupBy("email_norm", "country_name").agg(F.count("*").alias("holders"))
    return sent.join(holders, "email_norm").groupBy("country_name", "category_key").agg(
        F.min("award_category").alias("award_category"), F.sum(F.col("sent") * F.col("holders")).alias("emails_sent")
    )


def said_yes() -> Column:
    return plain_address(F.col("response")) == "yes"


def yes_responses(form: DataFrame, window: DateWindow) -> DataFrame:
    """The latest yes per address."""
    rows = window_filter(form.filter(said_yes()), "created_at", window)
    return rows.groupBy(extract_email(F.col("email")).alias("email_norm")).agg(
        F.max("created_at").alias("yes_created_at")
    )


def _contact_column(name: str) -> Column:
    raw = name in ("subject", "template_name")
    return (F.col(name) if raw else blank_to_null(F.col(name))).alias(name)


def latest_contact(mailings: DataFrame, columns: list[str]) -> DataFrame:
    """The last mailing's fields per address.

    Of mailings at one time the greatest source name, then the greatest id, wins.
    """
    rows = mailings.select(
        extract_email(F.col("to_address")).alias("email_norm"),
        F.coalesce("date_sent", "date_added").cast("timestamp_ntz").alias("ts"),
        "source",
        "id",
        *[_contact_column(c) for c in columns],
    )
    return latest_per_key(rows, "email_norm", "ts", ["source", "id"]).select("email_norm", *columns)


CONTACT_NAMES = {
    "p1": "name_from_p1",
    "p2": "affiliation_from_p2",
    "p3": "extra_from_p3",
}


def nonresponders(
    form: DataFrame, users: DataFrame, abstracts: DataFrame, mailings: DataFrame, columns: list[str], window: DateWindow
) -> DataFrame:
    """Who said yes and has no abstract in the window, with the last mailing's fields, the newest yes first.

    An address held by several users comes once for each of them without an
    abstract; an address held by no user comes once.
    """
    submitted = window_filter(abstracts, "created_at", window).select("user_id").distinct()
    holders = user_addresses(users).join(submitted.withColumn("wrote", F.lit(True)), "user_id", "left").groupBy(
        "email_norm"
    ).agg(F.count_if(F.col("wrote").isNull()).alias("idle"))
    yes = yes_responses(form, window).join(holders, "email_norm", "left")
    # One row per address until the last step, which spreads the copies.
    listed = repeat_rows(yes.join(latest_contact(mailings, columns), "email_norm", "left"), "coalesce(idle, 1)", "_copy")
    shown = [F.col("email_norm").alias("email"), *[F.col(c).alias(CONTACT_NAMES.get(c, c)) for c in columns], "yes_created_at"]
    # The copies of an address differ in their number, so the sort can part them.
    return listed.select(*shown, "_copy").orderBy(F.desc("yes_created_at"), "email", "_copy").drop("_copy")


_BLOCK = 1000


def repeat_rows(df: DataFrame, times: str, number: str = "_copy") -> DataFrame:
    """Each row as often as the expression says, the copies numbered 0.. in the column ``number``.

    A row is first made into one row per block of ``_BLOCK`` copies. The blocks are dealt out by row and block before
    they are expanded, so a row with very many copies is expanded by all tasks, and no long array is held.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.withColumn("_times", F.expr(times)).filter("_times > 0")
    blocks = counted.selectExpr("*", f"explode(sequence(0L, (_times - 1) div {_BLOCK})) AS _block")
    # With its number given, the shuffle is not merged into a few tasks for being small before the rows are copied.
    dealt = blocks.repartition(n, *[F.col(f"`{c}`") for c in df.columns], "_block")
    inside = f"sequence(0L, least({_BLOCK}L, _times - _block * {_BLOCK}) - 1)"
    return dealt.selectExpr(*[f"`{c}`" for c in df.columns], "_block", f"explode({inside}) AS _inside").selectExpr(
        *[f"`{c}`" for c in df.columns], f"_block * {_BLOCK} + _inside AS `{number}`"
    )


#: Parts that the yes rows of one address are numbered in.
_PARTS = 64


def _yes_times(form: DataFrame, window: DateWindow) -> DataFrame:
    return window_filter(form.filter(said_yes()), "created_at", window).select(
        "id", extract_email(F.col("email")).alias("email_norm"), F.col("created_at").alias("yes_created_at")
    )


def _sent_by(users: DataFrame, abstracts: DataFrame, window: DateWindow) -> DataFrame:
    people = user_addresses(
        users, F.concat_ws(" ", "first_name", "last_name").alias("name"), F.col("email").alias("user_email")
    )
    sent = window_filter(abstracts, "created_at", window).select(
        F.col("id").alias("abstract_id"), "user_id", F.col("created_at").alias("abstract_created_at")
    )
    return sent.join(people, "user_id")


def yes_to_abstract(
    form: DataFrame, users: DataFrame, abstracts: DataFrame, yes_window: DateWindow, abstract_window: DateWindow
) -> DataFrame:
    """Every yes of a user with every abstract the user sent in later (the two windows are separate).

    The result pairs the two by its nature; no join does. The yes rows of an address are numbered in parts, an
    abstract is made into one row per number of each part, and address, part and number meet one to one, so neither
    a person with many answers nor one with many abstracts falls to one task.
    """
    yes = _yes_times(form, yes_window).withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(_PARTS)).cast("int"))
    within = Window.partitionBy("email_norm", "_part").orderBy("yes_created_at", "id")
    numbered = yes.withColumn("_number", F.row_number().over(within)).drop("id")
    sizes = yes.groupBy("email_norm", "_part").agg(F.count("*").alias("_times"))
    parts = _sent_by(users, abstracts, abstract_window).join(sizes, "email_norm")
    wanted = repeat_rows(parts, "_times", "_copy").withColumn("_number", (F.col("_copy") + 1).cast("int"))
    return wanted.join(numbered, ["email_norm", "_part", "_number"]).select(
        "user_id", "name", "user_email", "yes_created_at", "abstract_id", "abstract_created_at"
    ).orderBy(F.desc("abstract_created_at"), "abstract_id", "yes_created_at")


def yes_before_abstract(
    form: DataFrame, users: DataFrame, abstracts: DataFrame, yes_window: DateWindow, abstract_window: DateWindow
) -> DataFrame:
    """The abstracts of users who had said yes by then: how often, and the first and the last time before it.

    The compact form of ``yes_to_abstract``, one row per abstract. The answers of an address lie on one time line with
    the days of its abstracts, and what had happened by a day is a running count, so nothing is paired.
    """
    yes = _yes_times(form, yes_window).groupBy("email_norm", F.col("yes_created_at").cast("timestamp_ntz").alias("at")).agg(
        F.count("*").alias("n")
    )
    sent = _sent_by(users, abstracts, abstract_window)
    so_far = running_before(sent, yes, "email_norm", "abstract_created_at", "at", "n")
    return so_far.filter("times > 0").select(
        "user_id", "abstract_id", "abstract_created_at", F.col("times").alias("yes_count"),
        F.col("first_at").alias("first_yes_at"), F.col("last_at").alias("last_yes_at"),
    ).orderBy(F.desc("abstract_created_at"), "abstract_id", "user_id")


def yes_pull(form: DataFrame, window: DateWindow) -> DataFrame:
    """Form rows that say yes and carry a name."""
    named = form.filter(said_yes() & blank_to_null(F.col("full_name")).isNotNull())
    return window_filter(named, "created_at", window)


def response_histogram(form: DataFrame, window: DateWindow) -> DataFrame:
    since = form.filter(F.col("created_at") >= F.lit(window.start))
    return since.groupBy(plain_address(F.col("response")).alias("resp_norm")).agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "resp_norm"
    )


def name_completeness(form: DataFrame, window: DateWindow) -> DataFrame:
    """Yes rows, and how many of them have or lack a name (a NULL name is neither)."""
    since = form.filter(said_yes() & (F.col("created_at") >= F.lit(window.start)))
    has_text = F.col("full_name").rlike(r"\S")
    return since.agg(
        F.count("*").alias("yes_total"),
        F.count_if(has_text).alias("yes_with_name"),
        F.count_if(~has_text).alias("yes_missing_name"),
    )
