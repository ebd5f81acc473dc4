"""The registered queries: every report and operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import extract_email, plain_address
from tallyloom.operators import campaign, funnel, quality
from tallyloom.operators import warehouse as w
from tallyloom.params import DateWindow
from tallyloom.plans import campaigns, insights, marketing, reports
from tallyloom.plans.warehouse import Warehouse, load_warehouse
from tallyloom.sources.tables import append_rows, create_table, stage, work_folder
from tallyloom.sources.testdata import TestTables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters for the test tables (their dates run from 1995 to 2001).
ABSTRACTS = DateWindow.between("1999-07-01", "2000-10-01")
INVOICES = DateWindow.between("2000-01-01", "2000-10-01")
LAST_12M = DateWindow.last_12_months("2000-09-30")
YES = DateWindow.between("1999-05-01", "2000-01-01")
YES_SINCE = DateWindow.since("1999-05-15", "1999-06-05")
YES_OPEN = DateWindow.since("1999-05-15", "2000-09-30")
LATER_ABSTRACTS = DateWindow.since("1999-09-09", "2000-09-30")
ASSEMBLY_YEARS = {"A3 AMC": 2023, "A5 AMC": 2025}
COUNTRY, AFFILIATION = "NATION_1", "AUTOMOBILE Lab 6"


def plain_types(df: DataFrame) -> DataFrame:
    """The result as a checker in another engine sees it: doubles, longs and ISO text for dates."""
    def plain(field: T.StructField) -> str:
        column, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, T.DecimalType):
            return f"CAST({column} AS double) AS {column}"
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return f"CAST({column} AS bigint) AS {column}"
        if isinstance(kind, T.DateType):
            return f"CAST({column} AS string) AS {column}"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {column}"
        return column

    return df.selectExpr(*[plain(f) for f in df.schema.fields])


def inputs(t: TestTables) -> marketing.Inputs:
    return marketing.Inputs(t.users(), t.abstracts(), t.registrations(), t.conferences(), t.countries())


_first: dict[tuple[str, str], DataFrame] = {}


def first_submissions(t: TestTables) -> DataFrame:
    """The table of first submissions of a folder, merged in two steps, once per Spark application."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _first:
        path = work_folder(t.spark, "first_submissions")
        funnel.merge_first_activity(t.abstracts(), path, ABSTRACTS.start)
        _first[key] = funnel.merge_first_activity(t.abstracts(), path, LAST_12M.end)
    return _first[key]


def staging(t: TestTables) -> DataFrame:
    return w.with_year_overrides(t.staging(), ASSEMBLY_YEARS)


_loaded: dict[tuple[str, str], Warehouse] = {}


def loaded(t: TestTables) -> Warehouse:
    """The warehouse of a folder, loaded once per Spark application.

    The staging rows are derived from the test tables, so they are stored first,
    as a staging table would be.
    """
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _loaded:
        rows = stage(staging(t), "stg_awards")
        _loaded[key] = load_warehouse(t.spark, rows, work_folder(t.spark, "warehouse"))
    return _loaded[key]


def _marketing() -> dict[str, Callable[[TestTables], DataFrame]]:
    def over(report, window=ABSTRACTS, **options):
        return lambda t: report(inputs(t), window, **options)

    def insight(report, window=ABSTRACTS, **options):
        return lambda t: report(replace(inputs(t), first=first_submissions(t)), window, **options)

    return {
        "mkt_submission_rate": over(marketing.submission_rate),
        "mkt_submitter_detail": over(marketing.submitter_detail),
        "mkt_conversion": over(marketing.conversion),
        "mkt_paid_unpaid": over(marketing.paid_unpaid),
        "mkt_paid_users": over(marketing.paid_users),
        "mkt_unpaid_invoices": over(marketing.unpaid_invoices, INVOICES),
        "mkt_paid_unpaid_events": over(marketing.paid_unpaid_events),
        "mkt_country_conversion": over(marketing.country_conversion),
        "mkt_country_event": over(marketing.country_event),
        "mkt_affiliation": over(marketing.affiliation),
        "mkt_affiliation_event": over(marketing.affiliation_event),
        "mkt_affiliation_rollup2": over(marketing.affiliation_rollup2),
        "mkt_rollup3": over(marketing.affiliation_rollup3),
        "mkt_grand_total": over(marketing.grand_total),
        "ins_geo_event": insight(insights.geo_event),
        "ins_country": insight(insights.country),
        "ins_affiliation": insight(insights.affiliation),
        "ins_geo_event_12m": insight(insights.geo_event, LAST_12M, blank=None),
        "ins_country_12m": insight(insights.country, LAST_12M, top_affiliations=True),
        "ins_affiliation_12m": insight(insights.affiliation, LAST_12M),
        "ins_unconverted_12m": over(insights.unconverted, LAST_12M),
    }


def _warehouse() -> dict[str, Callable[[TestTables], DataFrame]]:
    def award_type_missing(t: TestTables) -> DataFrame:
        # The dimension after a seed that let a single member in.
        seeded = w.dim_award_type(staging(t)).filter("award_type_id = 1")
        return w.missing_award_types(staging(t), seeded)

    def author_upsert(t: TestTables) -> DataFrame:
        stored = loaded(t)
        return w.upsert_dimension(
            w.split_email_columns(stored.author_by_person), stored.people, "email_norm", "author_id"
        )

    def fact_incremental(t: TestTables) -> DataFrame:
        stored = loaded(t)
        # Both loads share the look-up.
        texts = w.person_texts(stored.staging)
        rows = stage(w.located_once(stored.staging, texts, stored.dims, stored.dims_by_email, "by_email"), "located")
        return w.later_facts(rows, stored.dims, w.first_facts(rows))

    def fact_reloaded(t: TestTables) -> DataFrame:
        return w.load_fact_by_person(loaded(t).staging, loaded(t).dims_by_person)

    return {
        "dwh_dim_country": lambda t: w.dim_country(staging(t)),
        "dwh_dim_affiliation": lambda t: w.dim_affiliation(staging(t), w.dim_country(staging(t))),
        "dwh_dim_author": lambda t: w.dim_author(staging(t)),
        "dwh_dim_award_type": lambda t: w.dim_award_type(staging(t)),
        "dwh_award_type_missing": award_type_missing,
        "dwh_people_strict": lambda t: w.people_strict(staging(t)),
        "dwh_people": lambda t: w.build_people(staging(t)),
        "dwh_author_with_people": lambda t: w.add_people(w.dim_author(staging(t)), staging(t)),
        "dwh_author_backfill": lambda t: w.split_email_columns(loaded(t).author_by_person),
        "dwh_author_upsert": author_upsert,
        "dwh_fact_v1": lambda t: w.load_fact_by_email(loaded(t).staging, loaded(t).dims_by_email),
        "dwh_fact_v2": fact_reloaded,
        "dwh_fact_incremental": fact_incremental,
        "dwh_year_overrides": lambda t: staging(t).select("id", "assembly_number", "award_year"),
    }


def _quality() -> dict[str, Callable[[TestTables], DataFrame]]:
    def over(check, *parts: str):
        def run(t: TestTables) -> DataFrame:
            stored = loaded(t)
            return check(*[getattr(stored, part) for part in parts])
        return run

    def unloaded(t: TestTables) -> DataFrame:
        return quality.unloaded_rows(loaded(t).staging, loaded(t).dims, loaded(t).fact)

    return {
        "qa_row_parity": over(quality.check_row_parity, "staging", "fact"),
        "qa_award_parity": lambda t: quality.check_member_parity(loaded(t).fact, loaded(t).dims.award_type),
        "qa_pseudo": over(quality.count_pseudo, "author_by_person"),
        "qa_authors": over(quality.count_authors, "staging", "author_by_person"),
        "qa_identity_profile": over(quality.identity_profile, "staging"),
        "qa_top_identities": over(quality.top_repeated_identities, "staging"),
        "qa_constraints": over(quality.check_constraints, "dims", "fact"),
        "qa_foreign_keys": over(quality.check_foreign_keys, "fact", "dims"),
        "qa_fact_counts": over(quality.fact_counts, "fact"),
        "qa_load_readiness": over(quality.load_readiness, "staging", "dims"),
        "qa_unloaded": lambda t: unloaded(t).select(*loaded(t).staging.columns),
        "qa_unloaded_keys": over(quality.unloaded_keys, "staging", "dims", "fact"),
        "qa_unloaded_reasons": lambda t: quality.explain_unloaded(unloaded(t), loaded(t).dims),
        "qa_unmatched_award": lambda t: quality.unmatched_awards(unloaded(t), loaded(t).dims),
        "qa_unmatched_country": lambda t: quality.unmatched_countries(unloaded(t), loaded(t).dims),
        "qa_unmatched_affiliation": lambda t: quality.unmatched_affiliations(unloaded(t), loaded(t).dims),
    }


def _reports() -> dict[str, Callable[[TestTables], DataFrame]]:
    def over(report, *args, **options):
        return lambda t: report(loaded(t).fact, loaded(t).dims, *args, **options)

    return {
        "rpt_awardees_country_affiliation": over(reports.awardees_by_affiliation),
        "rpt_awardees_country_affiliation_by_count": over(reports.awardees_by_affiliation, order="awardees"),
        "rpt_country_totals": over(reports.country_totals),
        "rpt_award_detail": over(reports.award_detail),
        "rpt_country_lists": over(reports.country_lists),
        "rpt_country_list_values": over(reports.country_list_values),
        "rpt_affiliation_list_values": over(reports.affiliation_list_values, COUNTRY),
        "rpt_author_lists": over(reports.author_lists),
        "rpt_country_affiliation_rank": over(reports.country_affiliation_rank, COUNTRY),
        "rpt_country_award_detail": over(reports.country_award_detail, COUNTRY),
        "rpt_affiliation_award_detail": over(reports.affiliation_award_detail, COUNTRY, AFFILIATION),
        "rpt_affiliation_lists_distinct": over(reports.affiliation_lists, COUNTRY),
        "rpt_affiliation_lists_all": over(reports.affiliation_lists, COUNTRY, distinct=False),
    }


# Mailer tables and fields of each variant of the follow-up list.
FOLLOW_UPS = {
    "cmp_nonresponders_two_mailers": (["emails2", "emails2_"], ["p1"]),
    "cmp_nonresponders_reminders": (["reminders"], ["p1"]),
    "cmp_nonresponders_reminders_aml": (["reminders", "campaign_aml"], ["p1"]),
    "cmp_nonresponders_emails3": (["emails3"], ["p1"]),
    "cmp_nonresponders_emails3_affiliation": (["emails3"], ["p1", "p2"]),
    "cmp_nonresponders_four_mailers": (["emails3", "reminders", "campaign_aml", "campaign_amf"], ["p1", "p2", "p3"]),
    "cmp_nonresponders_six_mailers": (
        ["emails3", "reminders", "campaign_aml", "campaign_amf", "emails2", "emails2_"], ["p1", "p2", "p3"],
    ),
}
EXTENDED_FIELDS = ["p1", "p2", "p3", "subject", "p4", "p5", "template_name"]
ALL_MAILERS = FOLLOW_UPS["cmp_nonresponders_six_mailers"][0]


def follow_up(t: TestTables, mailers: list[str], fields: list[str]) -> DataFrame:
    mailings = t.mailed(*mailers)
    return campaign.nonresponders(t.yes_no_form(), t.users(), t.abstracts(), mailings, fields, YES)


def _campaigns() -> dict[str, Callable[[TestTables], DataFrame]]:
    def award_mailings(t: TestTables) -> DataFrame:
        return t.mailed("emails2", "emails2_")

    def last_touch(address):
        return lambda t: campaigns.last_touch_revenue(
            t.users(), t.registrations(), award_mailings(t), ABSTRACTS, address
        )

    def country_funnel(address):
        return lambda t: campaigns.award_country_funnel(
            t.users(), t.countries(), t.registrations(), award_mailings(t), ABSTRACTS, address
        )

    def reminder_load(t: TestTables) -> DataFrame:
        path = work_folder(t.spark, "yes_no_reminder")
        rows = follow_up(t, ALL_MAILERS, EXTENDED_FIELDS)
        create_table(t.spark.createDataFrame([], rows.schema), path, "ignore")
        load = f"follow-up {YES.start} to {YES.end}"
        append_rows(rows, path, load)
        # The load is in the table by its id, so running it again adds nothing.
        return append_rows(rows, path, load)

    queries = {
        # Test addresses carry a display name, so they are extracted; the plain form matches none.
        "cmp_last_touch_revenue": last_touch(extract_email),
        "cmp_last_touch_revenue_plain": last_touch(plain_address),
        "cmp_award_country_funnel": country_funnel(extract_email),
        "cmp_yes_pull": lambda t: campaign.yes_pull(t.yes_no_form(), YES_SINCE),
        "cmp_response_hist": lambda t: campaign.response_histogram(t.yes_no_form(), YES_SINCE),
        "cmp_name_completeness": lambda t: campaign.name_completeness(t.yes_no_form(), YES_SINCE),
        "cmp_yes_to_abstract": lambda t: campaign.yes_to_abstract(
            t.yes_no_form(), t.users(), t.abstracts(), YES_OPEN, LATER_ABSTRACTS
        ),
        "cmp_yes_before_abstract": lambda t: campaign.yes_before_abstract(
            t.yes_no_form(), t.users(), t.abstracts(), YES_OPEN, LATER_ABSTRACTS
        ),
        "cmp_reminder_load": reminder_load,
    }
    for name, (mailers, fields) in FOLLOW_UPS.items():
        queries[name] = lambda t, m=mailers, f=fields: follow_up(t, m, f)
    return queries


def queries() -> dict[str, Query]:
    from tallyloom.plans.primitives import primitives

    every = {**_marketing(), **_warehouse(), **_quality(), **_reports(), **_campaigns(), **primitives()}
    return {
        name: (lambda spark, folder, q=query: plain_types(q(TestTables(spark, folder))))
        for name, query in every.items()
    }
