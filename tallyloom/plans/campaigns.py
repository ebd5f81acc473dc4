"""Campaign reports: which mailings led to payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import conversion_pct, plain_address
from tallyloom.functions.measures import TOTAL
from tallyloom.operators import campaign, funnel
from tallyloom.params import DateWindow
from tallyloom.sources.tables import stage


def _payments(registrations: DataFrame, window: DateWindow) -> DataFrame:
    """Payments added up per user and time of payment: all a mailing can tell apart."""
    paid = funnel.paid_in_window(registrations, window)
    return paid.groupBy("user_id", F.col("updated_at").alias("paid_at")).agg(
        F.count("*").alias("payments"), F.sum("total_price").alias("amount")
    )


def _revenue(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("award_category").alias("award_category"),
        F.sum("payments").alias("paid_registrations"), F.sum("amount").cast(TOTAL).alias("eur_revenue")
    )


def _or_unknown(rows: DataFrame) -> DataFrame:
    """Payments without a mailing form a category of their own, apart from one that is called so."""
    return rows.withColumns({
        "category_key": F.coalesce("category_key", F.lit("UNKNOWN")),
        "award_category": F.coalesce("award_category", F.lit("UNKNOWN")),
    })


def last_touch_revenue(
    users: DataFrame,
    registrations: DataFrame,
    mailings: DataFrame,
    window: DateWindow,
    address: campaign.Address = plain_address,
) -> DataFrame:
    """Paid registrations and revenue by the category that led to them."""
    touches = campaign.mail_touches(mailings, address)
    credited = campaign.last_touch(_payments(registrations, window), users, touches)
    return _revenue(_or_unknown(credited), "category_key").drop("category_key").orderBy(
        F.desc("eur_revenue"), F.desc("paid_registrations"), "award_category"
    )


def award_country_funnel(
    users: DataFrame,
    countries: DataFrame,
    registrations: DataFrame,
    mailings: DataFrame,
    window: DateWindow,
    address: campaign.Address = plain_address,
) -> DataFrame:
    """Mailings of all time against payments in the window, per country and category.

    A payment without a mailing, or whose payer has no country, counts under
    ``UNKNOWN``. Mailings to users without a country stay a row of their own
    (no country) and meet no payments.
    """
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    located = users.join(names, "country_id", "left")
    touches = stage(campaign.touch_counts(campaign.mail_touches(mailings, address)), "touches")
    sent = campaign.emails_sent(touches, campaign.user_addresses(located, "country_name"))
    credited = campaign.last_touch(_payments(registrations, window), located, touches, "country_name")
    paid = _revenue(
        _or_unknown(
            credited.withColumn("country_name", F.expr("coalesce(if(award_category IS NULL, NULL, country_name), 'UNKNOWN')"))
        ),
        "country_name",
        "category_key",
    )
    both = sent.alias("s").join(paid.alias("p"), ["country_name", "category_key"], "full_outer")
    return both.select(
        "country_name",
        F.least("s.award_category", "p.award_category").alias("award_category"),
        F.coalesce("emails_sent", F.lit(0)).alias("emails_sent_lifetime"),
        F.coalesce("paid_registrations", F.lit(0)).alias("paid_registrations_window"),
        F.coalesce(F.col("eur_revenue"), F.lit(0)).cast(TOTAL).alias("eur_revenue_window"),
        conversion_pct("coalesce(paid_registrations, 0)", "emails_sent")
        .alias("conversion_pct_window_over_lifetime"),
    ).orderBy(
        F.asc_nulls_first("country_name"), F.desc("eur_revenue_window"), F.desc("paid_registrations_window"),
        "award_category",
    )
