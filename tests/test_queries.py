"""Every registered query of the library against its DuckDB statement at the smallest scale.

No query may pair all rows of two tables or leave the JVM, and a report that is
sorted comes out in its order.
"""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tallyloom.oracle.statements import statements
from tallyloom.plans import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = registry.queries(), statements()

#: The order each sorted report has: column and direction (``-`` descending), as the statement would put it.
ORDERS = {
    "rpt_country_totals": ["-total_awards", "country"],
    "rpt_country_lists": ["-total_awards", "country"],
    "rpt_awardees_country_affiliation": ["country", "-unique_awardees", "affiliation"],
    "rpt_awardees_country_affiliation_by_count": ["-total_awardees", "country", "affiliation"],
    "rpt_award_detail": ["country", "award_type", "award_id"],
    "rpt_country_affiliation_rank": ["-awardees", "-awards", "affiliation_name"],
    "mkt_country_event": ["-revenue_EUR", "country_name", "event_id"],
    "mkt_affiliation_event": ["-revenue_EUR", "-paid_users", "affiliation", "country_name", "event_id"],
    "mkt_paid_unpaid": ["-is_paid", "-eur_revenue", "user_id"],
    "mkt_paid_unpaid_events": ["-is_paid", "-eur_revenue", "user_id"],
    "mkt_country_conversion": ["-revenue_EUR", "-conversion_pct", "country_name"],
    "cmp_yes_before_abstract": ["-abstract_created_at", "abstract_id", "user_id"],
    "cmp_yes_to_abstract": ["-abstract_created_at", "abstract_id", "yes_created_at"],
    **{f"ins_{grain}{span}": ["-revenue_EUR", "-conversion_pct", *keys] for span in ("", "_12m") for grain, keys in (
        ("geo_event", ["country_name", "event_id"]), ("country", ["country_name"]), ("affiliation", ["affiliation"]))},
    "ins_unconverted_12m": ["-est_missed_revenue_EUR", "-dropoff_pct", "country_name", "event_id"],
    "cmp_award_country_funnel": ["country_name", "-eur_revenue_window", "-paid_registrations_window", "award_category"],
    "cmp_last_touch_revenue": ["-eur_revenue", "-paid_registrations", "award_category"],
    "cmp_response_hist": ["-cnt", "resp_norm"],
    "cmp_nonresponders_two_mailers": ["-yes_created_at", "email"],
    "cmp_nonresponders_reminders": ["-yes_created_at", "email"],
    "cmp_nonresponders_reminders_aml": ["-yes_created_at", "email"],
    "cmp_nonresponders_emails3": ["-yes_created_at", "email"],
    "cmp_nonresponders_emails3_affiliation": ["-yes_created_at", "email"],
    "cmp_nonresponders_four_mailers": ["-yes_created_at", "email"],
    "cmp_nonresponders_six_mailers": ["-yes_created_at", "email"],
}


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as connection:
        yield connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().toString()
    assert not re.findall("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|MapInPandas", plan)
    assert differences(result, duck, STATEMENTS[name]) is None


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, duck, name):
    """The sort columns come out as the statement's do when it sorts by them."""
    order = ORDERS[name]
    columns = [c.lstrip("-") for c in order]
    by = ", ".join(f'"{c.lstrip("-")}" {"DESC" if c[0] == "-" else "ASC"} NULLS {"LAST" if c[0] == "-" else "FIRST"}' for c in order)
    shown = ", ".join(f'"{c}"' for c in columns)
    wanted = duck.execute(f"SELECT {shown} FROM ({STATEMENTS[name]}) ORDER BY {by}").fetchall()
    found = [tuple(row[c] for c in columns) for row in QUERIES[name](spark, FOLDER).collect()]
    assert len(found) > 1
    assert found == wanted


def test_total_row_comes_first(spark, duck):
    columns = ["country_name", "revenue_EUR", "conversion_pct"]
    wanted = duck.execute(f"""SELECT country_name, "revenue_EUR", conversion_pct FROM ({STATEMENTS["mkt_grand_total"]})
ORDER BY country_name = 'ALL COUNTRIES' DESC, 2 DESC NULLS LAST, 3 DESC NULLS LAST, 1 NULLS FIRST""").fetchall()
    found = [tuple(row[c] for c in columns) for row in QUERIES["mkt_grand_total"](spark, FOLDER).collect()]
    assert found[0][0] == "ALL COUNTRIES" and found == wanted


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(STATEMENTS) <= set(entry.oracle_sql())
