"""One small query per basic operator that the reports do not show on its own.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import (
    age_as_of,
    blank_to_null,
    ci_key,
    code_from_hash,
    code_from_id,
    conversion_pct,
    extract_email,
    norm_key,
    not_blank,
    plain_address,
    price_tiers,
    thousands,
)
from tallyloom.operators import campaign, funnel
from tallyloom.operators import warehouse as w
from tallyloom.operators.asof import latest_before
from tallyloom.operators.lists import joined_lists
from tallyloom.operators.ranking import count_label, top_k, top_k_label
from tallyloom.params import DateWindow
from tallyloom.plans import marketing
from tallyloom.sources import tables
from tallyloom.sources.testdata import MAILERS, TestTables

WINDOW = DateWindow.between("1999-07-01", "2000-10-01")
YEAR = DateWindow.last_12_months("2000-09-30")
SINCE = DateWindow.since("1999-05-15", "1999-06-05")
LOAD_TS = "2000-09-30 12:00:00"


def _inputs(t: TestTables) -> marketing.Inputs:
    return marketing.Inputs(t.users(), t.abstracts(), t.registrations(), t.conferences(), t.countries())


def _located(t: TestTables) -> DataFrame:
    """Conversion pairs with the user's country and affiliation."""
    return _inputs(t).pairs(WINDOW).join(_inputs(t).user_dim(), "user_id")


# Scans, sources and sinks


def union_mailers(t: TestTables) -> DataFrame:
    """The mailer tables as one; the view they are cut from is made once."""
    every = tables.stage(t.mailings().select("id", "mailer_no"), "mailings")
    mailings = tables.union_sources({name: every.filter(f"mailer_no = {number}") for name, number in MAILERS.items()})
    return mailings.groupBy("source").agg(F.count("*").alias("mailings"), F.max("id").alias("last_id"))


def create_table_as(t: TestTables) -> DataFrame:
    path = tables.work_folder(t.spark, "country_event")
    return tables.create_table(marketing.country_event(_inputs(t), WINDOW), path)


def temp_view(t: TestTables) -> DataFrame:
    t.users().createOrReplaceTempView("tallyloom_users")
    return t.spark.sql(
        "SELECT country_id, count(*) AS users FROM tallyloom_users WHERE created_at >= DATE'1999-07-01' GROUP BY country_id"
    )


def insert_select(t: TestTables) -> DataFrame:
    """The rows of two windows, loaded one after the other."""
    path = tables.work_folder(t.spark, "loaded")
    earlier = DateWindow(YEAR.start.replace(year=1998), YEAR.start)
    tables.create_table(funnel.submitters(t.abstracts(), earlier), path)
    year = funnel.submitters(t.abstracts(), YEAR)
    tables.append_rows(year, path, f"until {YEAR.end}")
    # The same load again, as after a failure, adds nothing.
    loaded = tables.append_rows(year, path, f"until {YEAR.end}")
    return loaded.groupBy("event_id").agg(F.count("*").alias("rows"))


def _members(t: TestTables) -> DataFrame:
    """One affiliation per name as typed in the staging table, with a country."""
    return t.staging().filter(not_blank(F.col("affiliation"))).select(
        norm_key(F.col("affiliation")).alias("member"), norm_key(F.col("country")).alias("place")
    )


def insert_ignore(t: TestTables) -> DataFrame:
    """Members of submitters' rows first, then those of all rows that are not there yet."""
    path = tables.work_folder(t.spark, "members")
    seed = _members(t).filter("place < 'nation_2'")
    tables.create_table(tables.first_per_key(seed, ["member"]), path)
    return tables.insert_ignore(_members(t), path, ["member"])


def truncate_and_reload(t: TestTables) -> DataFrame:
    path = tables.work_folder(t.spark, "reloaded")
    tables.create_table(funnel.submitters(t.abstracts(), WINDOW), path)
    return tables.reload_table(funnel.submitters(t.abstracts(), YEAR), path)


def create_if_not_exists(t: TestTables) -> DataFrame:
    """The second create leaves the table as it is."""
    path = tables.work_folder(t.spark, "kept")
    tables.create_table(t.users().select("id", "email"), path, "ignore")
    return tables.create_table(t.users().select("id", "email").filter("id IS NULL"), path, "ignore")


def update_join(t: TestTables) -> DataFrame:
    """Users' affiliation overwritten by the last mailing's, where it names one."""
    latest = campaign.latest_contact(t.mailed(*MAILERS), ["p2"])
    return campaign.user_addresses(t.users(), "affiliation").join(latest, "email_norm", "left").select(
        "user_id", F.coalesce("p2", "affiliation").alias("affiliation")
    )


def column_defaults(t: TestTables) -> DataFrame:
    return tables.with_load_columns(t.users().select("id", "email"), LOAD_TS, email_is_pseudo=0)


# Projections, filters, predicates


def projection(t: TestTables) -> DataFrame:
    return t.raw("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") < 0, "owes").when(F.col("s_acctbal") < 1000, "low").otherwise("fine").alias("state"),
        F.lit("PENDING").alias("code"),
        F.lit(WINDOW.start).alias("start_date"),
    )


def like_patterns(t: TestTables) -> DataFrame:
    email = F.col("email")
    return t.staging().select(
        email.contains("@").alias("has_at"), (~email.contains("@")).alias("lacks_at"),
        email.endswith("@ex.org").alias("ends"), email.isNull().alias("missing"),
    ).groupBy("has_at", "lacks_at", "ends", "missing").agg(F.count("*").alias("rows"))


def having(t: TestTables) -> DataFrame:
    return t.registrations().groupBy("user_id").agg(F.count("*").alias("rows")).filter("rows > 14")


def having_on_alias(t: TestTables) -> DataFrame:
    """The condition is on the group's own value, so it runs before the aggregate."""
    named = t.users().select(F.coalesce("affiliation", F.lit("")).alias("affiliation")).filter("affiliation != ''")
    return named.groupBy("affiliation").agg(F.count("*").alias("users"))


# Joins


def composite_key_join(t: TestTables) -> DataFrame:
    same = t.registrations().join(funnel.submitters(t.abstracts(), WINDOW), funnel.PAIR)
    return same.select("id", *funnel.PAIR)


def normalised_join(t: TestTables) -> DataFrame:
    """Staging rows per country, matched by name whatever its case and padding."""
    rows = t.staging().groupBy(norm_key(F.col("country")).alias("name_key")).agg(F.count("*").alias("rows"))
    return t.countries().withColumn("name_key", norm_key(F.col("name"))).join(rows, "name_key").select("id", "name", "rows")


def left_chain(t: TestTables) -> DataFrame:
    names = t.countries().select(F.col("id").alias("country_id"), F.col("name").alias("country"))
    first = funnel.first_activity(t.abstracts())
    return t.users().select(F.col("id").alias("user_id"), "country_id").join(names, "country_id", "left").join(
        first, "user_id", "left"
    ).select("user_id", "country", F.col("first_abs_date").alias("first_submission"))


def anti_join(t: TestTables) -> DataFrame:
    sent = t.abstracts().select(F.col("user_id").alias("id"))
    return t.users().select("id", "email").join(sent, "id", "left_anti")


def semi_join(t: TestTables) -> DataFrame:
    return t.registrations().join(funnel.submitters(t.abstracts(), WINDOW), funnel.PAIR, "left_semi").select(
        "id", "total_price"
    )


def totals_side_by_side(t: TestTables) -> DataFrame:
    """Single-row aggregates of three tables in one row."""
    return t.users().agg(F.count("*").alias("users")).withColumns({
        "abstracts": t.abstracts().agg(F.count("*")).scalar(),
        "revenue": t.registrations().filter(funnel.is_paid()).agg(F.sum("total_price")).scalar(),
    })


def latest_touch(t: TestTables) -> DataFrame:
    """Every form answer with the category of the address's last mailing up to it."""
    answers = t.yes_no_form().select(
        "id", extract_email(F.col("email")).alias("email_norm"), F.col("created_at").alias("answered_at")
    )
    touches = campaign.mail_touches(t.mailed(*MAILERS), extract_email)
    return latest_before(answers, touches, "email_norm", "answered_at", "sent_at", "award_category")


def densified(t: TestTables) -> DataFrame:
    submitted = funnel.submitters(t.abstracts(), WINDOW).groupBy("event_id").agg(F.count("*").alias("submitted"))
    invoiced = t.registrations().filter("sendinvoice = 1").groupBy("event_id").agg(
        F.count("*").alias("invoices")
    )
    known = t.conferences().select(F.col("id").alias("event_id"), F.lit(1).alias("is_known"))
    return funnel.densify(
        [submitted, invoiced, known], ["event_id"], {"submitted": 0, "invoices": 0, "is_known": 0}
    )


# Aggregates


def plain_aggregates(t: TestTables) -> DataFrame:
    rows = t.registrations().groupBy("event_id").agg(
        F.count("*").alias("rows"),
        F.count("total_price").alias("priced"),
        F.count_distinct("user_id").alias("users"),
        F.round(F.sum("total_price"), 2).alias("total"),
        F.min("total_price").alias("lowest"),
        F.max("total_price").alias("highest"),
        F.min("created_at").alias("first_day"),
        F.max("currency_type").alias("last_currency"),
    )
    return rows


def ticket_statistics(t: TestTables) -> DataFrame:
    paid = t.registrations().filter(funnel.is_paid())
    sums = funnel.payment_sums(paid, ["event_id"])
    return sums.select("event_id", "paid_rows", *funnel.ticket_stats())


def several_distincts(t: TestTables) -> DataFrame:
    """Two distinct counts per conference over one pre-aggregate."""
    combos = t.registrations().groupBy("event_id", "user_id", "currency_type").agg(F.count("*").alias("n"))
    return combos.groupBy("event_id").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("currency_type").alias("currencies"),
        F.count_distinct(F.when(F.col("currency_type") == "EUR", F.col("user_id"))).alias("euro_users"),
        F.sum("n").alias("rows"),
    )


def conditional_counts(t: TestTables) -> DataFrame:
    return t.registrations().groupBy("event_id").agg(
        F.sum(F.when(F.col("currency_type") == "EUR", 1).otherwise(0)).alias("euro_rows"),
        F.count_if(F.col("total_price").isNull()).alias("unpriced"),
        F.bool_or(F.col("status") == 1).alias("any_paid"),
        F.max(F.when(F.col("status") == 0, F.col("user_id"))).alias("last_unpaid_user"),
    )


def distinct_list(t: TestTables) -> DataFrame:
    return joined_lists(t.registrations(), ["event_id"], {"currencies": "currency_type"}, row_count="rows")


def list_with_repeats(t: TestTables) -> DataFrame:
    return joined_lists(t.registrations(), ["user_id"], {"currencies": "currency_type"}, distinct=False)


def group_by_expression(t: TestTables) -> DataFrame:
    return t.abstracts().groupBy(F.year("statusdate").alias("year"), (F.col("event_id") % 3).alias("series")).agg(
        F.count("*").alias("rows")
    )


def latest_date_per_key(t: TestTables) -> DataFrame:
    return campaign.yes_responses(t.yes_no_form(), SINCE)


# Ranks, sorts, set operations


def _affiliations(t: TestTables) -> DataFrame:
    return _located(t).filter("paid_rows > 0").groupBy("country_name", "affiliation").agg(
        F.count_distinct("user_id").alias("payers"), F.sum("revenue").alias("total")
    )


def rank_by_count(t: TestTables) -> DataFrame:
    order = [F.desc("payers"), F.desc("total"), F.asc("affiliation")]
    return top_k(_affiliations(t), ["country_name"], order, 3)


def rank_by_revenue(t: TestTables) -> DataFrame:
    order = [F.desc("total"), F.desc("payers"), F.asc("affiliation")]
    return top_k(_affiliations(t), ["country_name"], order, 3)


def rank_label(t: TestTables) -> DataFrame:
    order = [F.desc("payers"), F.asc("affiliation")]
    return top_k_label(_affiliations(t), ["country_name"], "affiliation", order, count_label("payers"), "best")


def sorted_layout(t: TestTables) -> DataFrame:
    """A sort inside a table write is a matter of file layout, not of the result."""
    path = tables.work_folder(t.spark, "sorted")
    rows = t.registrations().repartition("event_id").sortWithinPartitions("event_id", "user_id", "id")
    return tables.create_table(rows, path).select("id", "event_id", "user_id")


def union_of_keys(t: TestTables) -> DataFrame:
    return t.abstracts().select(*funnel.PAIR).union(t.registrations().select(*funnel.PAIR)).distinct()


# Scalar functions


def text_functions(t: TestTables) -> DataFrame:
    name, affiliation = F.col("name"), F.col("affiliation")
    return t.staging().select(
        "id",
        F.trim("country").alias("trimmed"),
        F.lower(name).alias("lowered"),
        F.replace(name, F.lit("#"), F.lit(" no ")).alias("replaced"),
        F.concat(name, F.lit("/"), affiliation).alias("joined_or_null"),
        F.concat_ws("/", name, affiliation).alias("joined"),
        F.substring("name", 1, 5).alias("start"),
        code_from_id("AWD", F.col("id")).alias("code"),
        code_from_hash("AWD_", name).alias("hash_code"),
        F.regexp_replace("country", r"\s+", "_").alias("squeezed"),
        blank_to_null(affiliation).alias("no_blank"),
        plain_address(F.col("email")).alias("address"),
    )


def address_functions(t: TestTables) -> DataFrame:
    return t.mailings().select(
        "id",
        extract_email(F.col("to_address")).alias("address"),
        extract_email(F.col("p1")).alias("no_address"),
        F.col("p3").rlike("[5-9]").alias("matches"),
    )


def norm_key_of_text(t: TestTables) -> DataFrame:
    """Names with a no-break space, a tab and an accent come out equal."""
    dirty = F.concat(F.lit("\u00a0 \u00c9\t"), F.col("c_mktsegment"), F.lit("\u00a0\u00a0Lab "))
    return t.raw("customer").select("c_custkey", norm_key(dirty).alias("key"), ci_key(dirty).alias("raw_key"))


def date_functions(t: TestTables) -> DataFrame:
    born = F.col("date_of_birth")
    return t.users().select(
        "id",
        age_as_of(born, WINDOW.end).alias("age"),
        age_as_of(born, DateWindow.between("2001-02-28", "2001-03-01").start).alias("age_end_of_february"),
        born.cast("timestamp_ntz").alias("born_at"),
        F.to_date(F.lit("1999-07-01")).alias("start_date"),
        F.lit(YEAR.start).alias("year_start"),
        F.lit(YEAR.end).alias("year_end"),
    )


def number_functions(t: TestTables) -> DataFrame:
    sums = funnel.payment_sums(
        t.registrations().filter("total_price IS NOT NULL"), ["event_id", "status"]
    ).select("event_id", "status", "paid_rows", *funnel.ticket_stats())
    return sums.select(
        "event_id",
        "status",
        conversion_pct("status * paid_rows", "paid_rows + status").alias("pct"),
        conversion_pct("paid_rows", "status").alias("pct_or_null"),
        conversion_pct("paid_rows", "status", on_zero=0).alias("pct_or_zero"),
        thousands(F.col("revenue_EUR")).alias("shown"),
        funnel.event_name(F.col("event_id"), F.nullif(F.lit(""), F.lit(""))).alias("event_name"),
        *[c.alias(n) for n, c in price_tiers("avg_ticket_EUR", "stddev_ticket_EUR", "min_ticket_EUR").items()],
    )


# Operators of the funnel and of campaigns


def paid_rows(t: TestTables) -> DataFrame:
    pairs = funnel.submitters(t.abstracts(), WINDOW)
    return funnel.paid_registrations(t.registrations(), pairs).select("id", *funnel.PAIR, "total_price")


def cohorts(t: TestTables) -> DataFrame:
    marked = funnel.with_returning(_inputs(t).pairs(WINDOW), t.abstracts(), WINDOW)
    return marked.groupBy("event_id").agg(*funnel.cohort_counts())


def pairs_without_payment(t: TestTables) -> DataFrame:
    pairs = funnel.submitters(t.abstracts(), WINDOW)
    return funnel.dropoff(pairs, t.registrations().filter(funnel.is_paid()))


def mailings_by_country(t: TestTables) -> DataFrame:
    touches = campaign.mail_touches(t.mailed("emails2", "emails2_"), extract_email)
    names = t.countries().select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    owners = campaign.user_addresses(t.users().join(names, "country_id", "left"), "country_name")
    return campaign.emails_sent(campaign.touch_counts(touches), owners).drop("category_key")


def last_contact(t: TestTables) -> DataFrame:
    return campaign.latest_contact(t.mailed(*MAILERS), ["p1", "p2", "subject", "template_name"])


def primitives() -> dict[str, Callable[[TestTables], DataFrame]]:
    return {
        "io01_scan": lambda t: t.users(),
        "io02_union_sources": union_mailers,
        "io03_create_table_as": create_table_as,
        "io04_temp_view": temp_view,
        "io05_insert_select": insert_select,
        "io06_insert_ignore": insert_ignore,
        "io07_truncate_reload": truncate_and_reload,
        "io08_create_if_not_exists": create_if_not_exists,
        "io09_delete_where": lambda t: tables.delete_where(t.users().select("id", "country_id"), F.col("country_id") > 12),
        "io12_update_join": update_join,
        "io14_column_defaults": column_defaults,
        "p01_projection": projection,
        "p03_half_open_window": lambda t: funnel.window_filter(t.abstracts(), "statusdate", WINDOW),
        "p04_rolling_year": lambda t: funnel.window_filter(t.abstracts(), "statusdate", YEAR).select("id", "user_id"),
        "p07_paid_in_window": lambda t: funnel.paid_in_window(t.registrations(), WINDOW),
        "p09_not_blank": lambda t: t.staging().filter(not_blank(F.col("affiliation"))).select("id", "affiliation"),
        "p10_like_patterns": like_patterns,
        "p14_having": having,
        "p15_having_on_alias": having_on_alias,
        "j02_composite_key": composite_key_join,
        "j03_normalised_join": normalised_join,
        "j05_left_chain": left_chain,
        "j07_anti_join": anti_join,
        "j09_semi_join": semi_join,
        "j11_totals_side_by_side": totals_side_by_side,
        "j13_latest_touch": latest_touch,
        "j18_densify": densified,
        "g01_g09_aggregates": plain_aggregates,
        "g08_g10_ticket_stats": ticket_statistics,
        "g05_several_distincts": several_distincts,
        "g11_g14_conditional": conditional_counts,
        "g15_distinct_list": distinct_list,
        "g16_list_with_repeats": list_with_repeats,
        "g19_group_by_expression": group_by_expression,
        "g26_latest_date_per_key": latest_date_per_key,
        "w01_rank_by_count": rank_by_count,
        "w02_rank_by_revenue": rank_by_revenue,
        "w03_rank_label": rank_label,
        "t07_sorted_layout": sorted_layout,
        "u01_union_of_keys": union_of_keys,
        "s01_s12_text": text_functions,
        "s10_s11_address": address_functions,
        "s16_s21_dates": date_functions,
        "s22_norm_key": norm_key_of_text,
        "s23_s28_numbers": number_functions,
        "f03_paid_registrations": paid_rows,
        "f04_user_dim": lambda t: _inputs(t).user_dim(),
        "f08_first_activity": lambda t: funnel.first_activity(t.abstracts()),
        "f09_cohorts": cohorts,
        "f13_lifetime_vs_window": lambda t: funnel.lifetime_vs_window(t.abstracts(), WINDOW),
        "f16_dropoff": pairs_without_payment,
        "c01_mail_touches": lambda t: campaign.mail_touches(t.mailings(), extract_email).drop("category_key"),
        "c03_emails_sent": mailings_by_country,
        "c06_latest_contact": last_contact,
        "d06_members_within_country": lambda t: w.build_dimension(
            t.staging().withColumn("country_key", norm_key(F.col("country"))), "affiliation", "affiliation", ["country_key"]
        ),
    }
