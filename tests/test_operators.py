import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import campaign, funnel, quality
from tallyloom.operators import warehouse as w
from tallyloom.operators.asof import latest_before
from tallyloom.operators.keys import assign_surrogate_keys
from tallyloom.operators.lists import joined_lists, list_values
from tallyloom.operators.ranking import count_label, top_k_label
from tallyloom.params import DateWindow
from tallyloom.plans import campaigns, insights, marketing
from tallyloom.plans.warehouse import load_warehouse
from tallyloom.sources import tables

WINDOW = DateWindow.between("2024-07-01", "2025-10-01")


def latest_before_by_pairs(
    rows, touches, key, row_id, row_ts, touch_ts, value
):
    """The plain form of ``latest_before``: pair each row with its earlier touches, keep the last.
    """
    seen = touches.select(key, F.col(touch_ts).alias("_sent"), value)
    at = F.col("_sent") <= F.col(row_ts)
    paired = rows.alias("r").join(seen.alias("t"), (F.col(f"r.{key}") == F.col(f"t.{key}")) & at, "left").select(
        "r.*", "_sent", value
    )
    order = Window.partitionBy(row_id).orderBy(F.desc_nulls_last("_sent"), F.desc_nulls_last(value))
    return paired.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_sent")


def day(text):
    return dt.date.fromisoformat(text)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Surrogate keys


def test_surrogate_keys_are_dense_and_independent_of_layout(rows):
    members = rows([(f"m{i}", i) for i in range(1500)], "name string, v int")
    ids = {r.name: r.id for r in assign_surrogate_keys(members, ["name"], "id").collect()}
    again = {r.name: r.id for r in assign_surrogate_keys(members.repartition(7, "v"), ["name"], "id").collect()}
    assert sorted(ids.values()) == list(range(1, 1501))
    assert ids == again


def test_surrogate_keys_keep_known_ids(rows):
    first = tables.stage(assign_surrogate_keys(rows([("a",), ("b",)], "name string"), ["name"], "id"), "first")
    both = assign_surrogate_keys(rows([("a",), ("b",), ("c",), ("d",)], "name string"), ["name"], "id", first)
    known = {r.name: r.id for r in first.collect()}
    ids = {r.name: r.id for r in both.collect()}
    assert {n: ids[n] for n in known} == known
    assert sorted(ids.values()) == [1, 2, 3, 4]


def test_surrogate_keys_start_at_one_over_an_empty_dimension(rows):
    empty = rows([], "id long, name string")
    assert tuples(assign_surrogate_keys(rows([("a",)], "name string"), ["name"], "id", empty)) == [(1, "a")]


# As-of join


@pytest.mark.parametrize("seed", range(3))
def test_latest_before_agrees_with_the_pairing_form(rows, seed):
    rng = random.Random(seed)
    start = dt.datetime(2025, 1, 1)

    def moment():
        return start + dt.timedelta(minutes=rng.choice([0, 1, 5]) + 720 * rng.randrange(12))

    # One key holds a third of all rows; some rows have no key.
    keys = ["hot"] * 5 + [f"k{i}" for i in range(9)] + [None]
    asked = rows([(i, rng.choice(keys), moment()) for i in range(200)], "id int, k string, at timestamp_ntz")
    touches = rows(
        [(rng.choice(keys), moment() if rng.random() > 0.1 else None, rng.choice("abc")) for _ in range(300)],
        "k string, sent timestamp_ntz, v string",
    )
    wanted = tuples(latest_before_by_pairs(asked, touches, "k", "id", "at", "sent", "v").select("id", "v"))
    for collapse in (True, False):
        found = latest_before(asked, touches, "k", "at", "sent", "v", collapse)
        assert found.columns == ["k", "id", "at", "v"]
        assert tuples(found.select("id", "v")) == wanted


def test_latest_before_ties_and_order(rows):
    at = [dt.datetime(2025, 1, 1, h) for h in range(6)]
    touches = rows([("x", at[1], "a"), ("x", at[1], "b"), ("x", at[3], "c")], "k string, sent timestamp_ntz, v string")
    asked = rows([(i, "x", at[i]) for i in range(5)] + [(9, "y", at[5])], "id int, k string, at timestamp_ntz")
    found = dict(latest_before(asked, touches, "k", "at", "sent", "v").select("id", "v").collect())
    assert found == {0: None, 1: "b", 2: "b", 3: "c", 4: "c", 9: None}


# Lists and labels


def test_joined_lists(rows):
    data = rows([(1, "b", 1), (1, "a", 2), (1, None, 5), (2, None, 1)], "k int, v string, n int")
    distinct = joined_lists(data, ["k"], {"vs": "v"}, weight="n", row_count="rows", value_counts={"values": "vs"})
    assert tuples(distinct) == [(1, "a, b", 8, 2), (2, None, 1, 0)]
    assert tuples(list_values(data, ["k"], {"vs": "v"}, "n")) == [
        (1, "vs", "a", 2), (1, "vs", "b", 1), (1, "vs", None, 5), (2, "vs", None, 1),
    ]
    repeated = joined_lists(data, ["k"], {"vs": "v"}, distinct=False, weight="n", separator="|")
    assert tuples(repeated) == [(1, "a|a|b"), (2, None)]


def test_top_k_label_over_a_hot_key(rows):
    data = [("hot", f"i{n:04d}", n) for n in range(2000)] + [(f"k{n}", "only", 1) for n in range(1000)]
    label = top_k_label(
        rows(data, "k string, item string, n int"), ["k"], "item", [F.desc("n"), F.asc("item")], count_label("n"), "best"
    )
    found = dict(label.collect())
    assert found["hot"] == "i1999 (1999) | i1998 (1998) | i1997 (1997)"
    assert len(found) == 1001 and found["k7"] == "only (1)"


# Funnel


@pytest.fixture
def inputs(rows):
    users = rows(
        [
            (1, "Ann", "Lee", "a@x.org", "MIT", day("2000-02-29"), 1, day("2024-08-01")),
            (2, None, "Ray", "b@x.org", "  ", None, None, day("2024-08-01")),
            (3, "Cy", None, "c@x.org", "mit", day("1990-01-01"), 1, day("2020-01-01")),
        ],
        "id long, first_name string, last_name string, email string, affiliation string, date_of_birth date, "
        "country_id long, created_at date",
    )
    abstracts = rows(
        [
            (1, 1, 10, day("2024-07-01")), (2, 1, 10, day("2025-09-30")), (3, 1, 11, day("2025-10-01")),
            (4, 2, 12, day("2024-09-01")), (5, 3, 10, day("2023-01-01")), (6, 3, 10, day("2024-09-01")),
            (7, 3, 99, day("2024-09-01")), (8, 8, 10, day("2024-09-01")),
        ],
        "id long, user_id long, event_id long, statusdate date",
    ).withColumn("created_at", F.col("statusdate"))
    registrations = rows(
        [
            (1, 1, 10, D("100.00"), "EUR", 1), (2, 1, 10, D("100.01"), "EUR", 1), (3, 1, 10, D("5.00"), "USD", 1),
            (4, 1, 11, D("7.00"), "EUR", 1), (5, 2, 12, None, "EUR", 1), (6, 3, 99, D("50.00"), "EUR", 1),
            (7, 8, 10, D("30.00"), "EUR", 1), (8, 3, 10, D("9.00"), "EUR", 0),
        ],
        "id long, user_id long, event_id long, total_price decimal(12,2), currency_type string, status int",
    )
    events = rows([(10, "Expo"), (11, "Later"), (12, None)], "id long, name string")
    countries = rows([(1, "France"), (2, "Peru")], "id long, name string")
    return marketing.Inputs(users, abstracts, registrations, events, countries)


def test_pairs_take_the_half_open_window_and_paid_euro_rows(inputs):
    pairs = inputs.pairs(WINDOW).select("user_id", "event_id", "paid_rows", "revenue")
    assert tuples(pairs) == [
        (1, 10, 2, D("200.01")), (2, 12, 0, D("0.00")), (3, 10, 0, D("0.00")), (3, 99, 1, D("50.00")),
        (8, 10, 1, D("30.00")),
    ]


def test_conversion(inputs):
    assert tuples(marketing.conversion(inputs, WINDOW)) == [(4, 3, D("75.00"), D("280.01"))]


def test_conversion_of_nobody(inputs):
    empty = DateWindow.between("1900-01-01", "1900-02-01")
    assert tuples(marketing.conversion(inputs, empty)) == [(0, 0, None, D("0.00"))]


def test_grand_total_counts_submitters_without_a_user_row(inputs):
    found = {r.country_name: (r.submitter_users, r.paid_users, r.revenue_EUR) for r in marketing.grand_total(inputs, WINDOW).collect()}
    assert found == {
        "ALL COUNTRIES": (4, 3, D("280.01")), "France": (2, 2, D("250.01")), "Unknown": (1, 0, D("0.00")),
    }


def test_affiliations_are_grouped_without_regard_to_case(inputs):
    found = tuples(marketing.affiliation(inputs, WINDOW))
    assert found == [("MIT", "France", 2, D("250.01"))]


def test_event_lists_name_missing_and_nameless_conferences(inputs):
    found = {r.user_id: r for r in marketing.paid_unpaid_events(inputs, WINDOW).collect()}
    assert found[2].submitted_event_names == "Event#12" and found[2].paid_event_ids is None
    assert (found[3].submitted_event_ids, found[3].submitted_event_names) == ("10,99", "Expo")
    assert (found[3].paid_event_ids, found[3].paid_event_names) == ("99", None)


def test_insights_keep_figures_of_a_missing_conference(inputs):
    found = {(r.country_name, r.event_id): r for r in insights.geo_event(inputs, WINDOW).collect()}
    lost = found["France", None]
    assert (lost.event_name, lost.paid_users, lost.revenue_EUR) == (None, 1, D("50.00"))
    expo = found["France", 10]
    assert (expo.submitter_users, expo.paid_registration_rows) == (2, 2)
    # Both paid rows of user 1 count as new: the first submission lies in the window.
    assert (expo.new_paid_users, expo.returning_paid_users, lost.returning_paid_users) == (2, 0, 1)
    assert expo.top_affiliations_by_revenue == "MIT (€200)"


def test_unconverted_conferences(inputs):
    found = {(r.country_name, r.event_id): r for r in insights.unconverted(inputs, WINDOW).collect()}
    row = found["France", 10]
    assert (row.unregistered_users, row.dropoff_pct, row.est_missed_revenue_EUR) == (1, D("50.00"), D("100.01"))
    assert found["Unknown", 12].top_unregistered_affiliations == "(No affiliation) (1)"


def test_paid_never_exceeds_submitters_and_revenue_adds_up(inputs):
    table = insights.country(inputs, WINDOW).collect()
    assert all(r.paid_users <= r.submitter_users for r in table)
    detail = insights.geo_event(inputs, WINDOW).collect()
    assert sum(r.revenue_EUR for r in table) == sum(r.revenue_EUR for r in detail)


def test_densify_fills_gaps(rows):
    left, right = rows([(1, 5)], "k int, a int"), rows([(2, 7)], "k int, b int")
    assert tuples(funnel.densify([left, right], ["k"], {"a": 0, "b": 0})) == [(1, 5, 0), (2, 0, 7)]


# Warehouse

STAGING = (
    "id long, assembly_number string, award_year int, name string, email string, affiliation string, country string, "
    "award_certificate_type string, certificate_number string, session string, session_topic string, "
    "presentation_type string"
)


def staged(rows, *people):
    """(id, name, email, affiliation, country, award, certificate)"""
    return rows(
        [(i, "57th AMC", 2020, n, e, a, c, t, cert, " s ", " ", None) for i, n, e, a, c, t, cert in people], STAGING
    )


@pytest.fixture
def staging(rows):
    return staged(
        rows,
        (1, "Ann", " A@b.org ", "MIT", "France", "Gold", "C1"),
        (2, "Ann", "a@B.org", " mit ", " FRANCE", " gold ", "C2"),
        (3, "Bob", "n/a", "MIT", "Peru", "Silver", ""),
        (4, "Bob", None, "MIT", "Peru", "Silver", None),
        (5, "Cy", None, None, "Peru", "Gold", "C5"),
        (6, "Di", "", "ETH", "Schweiz", None, "C6"),
    )


def test_warehouse_load(spark, staging):
    loaded = load_warehouse(spark, staging, tables.work_folder(spark, "w"))
    assert sorted(r.country_name for r in loaded.dims.country.collect()) == ["FRANCE", "Peru", "Schweiz"]
    assert loaded.dims.affiliation.count() == 3
    assert sorted(r.award_code for r in loaded.dims.award_type.collect()) == ["AWD001", "AWD002"]
    assert sorted(r.award_id for r in loaded.fact.collect()) == [1, 2, 3, 4]
    readiness = quality.load_readiness(loaded.staging, loaded.dims).first()
    assert (readiness.total_staging_rows, readiness.missing_affiliation, readiness.missing_award_type) == (6, 1, 1)
    assert readiness.rows_ready_for_fact == 4
    assert [r.orphan_rows for r in quality.check_foreign_keys(loaded.fact, loaded.dims).collect()] == [0] * 4
    assert all(r.blank_keys == r.repeated_keys == 0 for r in quality.check_constraints(loaded.dims, loaded.fact).collect())


def test_second_incremental_load_adds_nothing(spark, staging):
    loaded = load_warehouse(spark, staging, tables.work_folder(spark, "w"))
    assert w.load_fact_incremental(loaded.staging, loaded.dims, loaded.fact).count() == 0


def test_incremental_load_takes_new_certificates_and_keeps_batch_repeats(spark, rows, staging):
    loaded = load_warehouse(spark, staging, tables.work_folder(spark, "w"))
    batch = staged(
        rows,
        (7, "Ann", "a@b.org", "MIT", "France", "Gold", "C9"),
        (8, "Ann", "a@b.org", "MIT", "France", "Gold", "C9"),
        (9, "Ann", "a@b.org", "MIT", "France", "Gold", "C1"),
        (10, "Bob", None, "MIT", "Peru", "Silver", "  "),
    )
    added = w.load_fact_incremental(batch, loaded.dims, loaded.fact)
    assert sorted(r.award_id for r in added.collect()) == [w.LOAD_STEP + 7, w.LOAD_STEP + 8]


def test_upsert_overwrites_known_members_and_keeps_old_values_for_missing_new_ones(rows):
    dim = rows([(1, "a", "Old", "raw"), (2, "b", "Bo", None)], "id long, k string, name string, raw string")
    new = rows([("a", "New", None), ("c", "Cy", "r")], "k string, name string, raw string")
    found = tuples(w.upsert_dimension(dim, new, "k", "id"))
    assert found == [(1, "a", "New", "raw"), (2, "b", "Bo", None), (3, "c", "Cy", "r")]


def test_strict_people_need_every_part(staging):
    assert w.people_strict(staging).filter("email LIKE 'cy|%'").count() == 0
    assert w.build_people(staging).filter("email_norm LIKE 'cy|%'").count() == 1


def test_year_overrides(rows):
    data = rows([("57th amc", 2020), ("64th AMC", None), ("other", 2019)], "assembly_number string, award_year int")
    assert tuples(w.with_year_overrides(data)) == [("57th amc", 2023), ("64th AMC", 2025), ("other", 2019)]


def test_check_key_finds_blank_and_repeated_keys(rows):
    found = quality.check_key(rows([("a",), ("a",), (" ",), (None,)], "k string"), "k").first()
    assert tuple(found) == (4, 2, 1)


def test_missing_award_types_get_a_code_from_their_name(staging):
    dim = w.dim_award_type(staging).filter("award_key = 'gold'")
    found = w.missing_award_types(staging, dim).collect()
    assert [(r.award_name, r.award_code[:4], len(r.award_code)) for r in found] == [("Silver", "AWD_", 12)]


# Campaigns


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def mailings(rows):
    return rows(
        [
            (1, "m1", "Dr <A@x.org>", "Ann", "gold", at("2025-01-01T10:00"), at("2025-01-01T09:00")),
            (2, "m1", "a@x.org", " ", "silver", None, at("2025-02-01T09:00")),
            (3, "m2", "b@x.org", "Bo", "", at("2025-01-05T10:00"), at("2025-01-05T09:00")),
            (4, "m2", "z@x.org", "Zed", "gold", at("2025-01-05T10:00"), at("2025-01-05T09:00")),
        ],
        "id long, source string, to_address string, p1 string, p4 string, date_sent timestamp_ntz, date_added timestamp_ntz",
    )


@pytest.fixture
def sharing_users(rows):
    return rows(
        [(1, "a@x.org", 1), (2, " A@X.org", 2), (3, "b@x.org", None)], "id long, email string, country_id long"
    )


def test_last_touch_revenue_and_shared_addresses(rows, mailings, sharing_users):
    registrations = rows(
        [
            (1, 1, D("10.00"), "EUR", 1, day("2025-01-01")), (2, 1, D("20.00"), "EUR", 1, day("2025-01-02")),
            (3, 2, D("40.00"), "EUR", 1, day("2025-03-01")), (4, 3, D("5.00"), "EUR", 1, day("2025-03-01")),
            (5, 77, None, "EUR", 1, day("2025-03-01")), (6, 1, D("1.00"), "EUR", 1, day("2025-10-01")),
        ],
        "id long, user_id long, total_price decimal(12,2), currency_type string, status int, updated_at date",
    )
    from tallyloom.functions import extract_email

    revenue = campaigns.last_touch_revenue(sharing_users, registrations, mailings, WINDOW, extract_email)
    assert tuples(revenue) == [
        ("UNKNOWN", 3, D("15.00")), ("gold", 1, D("20.00")), ("silver", 1, D("40.00")),
    ]
    countries = rows([(1, "France"), (2, "Peru")], "id long, name string")
    funnel_rows = campaigns.award_country_funnel(sharing_users, countries, registrations, mailings, WINDOW, extract_email)
    assert tuples(funnel_rows) == sorted([
        ("France", "gold", 1, 1, D("20.00"), D("100.00")), ("France", "silver", 1, 0, D("0.00"), D("0.00")),
        ("Peru", "gold", 1, 0, D("0.00"), D("0.00")), ("Peru", "silver", 1, 1, D("40.00"), D("100.00")),
        ("UNKNOWN", "UNKNOWN", 0, 3, D("15.00"), None),
    ], key=str)


def test_nonresponders(rows, mailings, sharing_users):
    form = rows(
        [
            ("<a@x.org>", " YES", at("2025-01-01T00:00")), ("a@x.org", "yes", at("2025-01-03T00:00")),
            ("b@x.org", "yes", at("2025-01-03T00:00")), ("z@x.org", "yes", at("2025-01-04T00:00")),
            ("q@x.org", "no", at("2025-01-04T00:00")),
        ],
        "email string, response string, created_at timestamp_ntz",
    )
    abstracts = rows([(3, day("2025-01-09"))], "user_id long, created_at date")
    found = campaign.nonresponders(form, sharing_users, abstracts, mailings, ["p1"], WINDOW)
    # Two users share a@x.org, neither wrote; user 3 did; nobody has z@x.org. The last mailing to a@x.org has no name.
    assert tuples(found) == [
        ("a@x.org", None, at("2025-01-03T00:00")), ("a@x.org", None, at("2025-01-03T00:00")),
        ("z@x.org", "Zed", at("2025-01-04T00:00")),
    ]


def test_repeat_rows_in_blocks(rows):
    found = campaign.repeat_rows(rows([("a", 2500), ("b", 0), ("c", 1000), ("d", 1)], "k string, n long"), "n")
    assert tuples(found.groupBy("k").count()) == [("a", 2500), ("c", 1000), ("d", 1)]


def test_latest_contact_breaks_ties_by_source_then_id(rows):
    data = rows(
        [(5, "m1", "a@x.org", "one"), (2, "m2", "a@x.org", "two"), (3, "m2", "a@x.org", "three")],
        "id long, source string, to_address string, p1 string",
    ).withColumns({"date_sent": F.lit("2025-01-01").cast("timestamp_ntz"), "date_added": F.lit(None).cast("timestamp_ntz")})
    assert tuples(campaign.latest_contact(data, ["p1"])) == [("a@x.org", "three")]


def test_name_completeness_counts_a_null_name_in_neither(rows):
    form = rows(
        [("yes", "A", at("2025-01-01T00:00")), ("YES ", " ", at("2025-01-01T00:00")), ("yes", None, at("2025-01-01T00:00"))],
        "response string, full_name string, created_at timestamp_ntz",
    )
    assert tuples(campaign.name_completeness(form, WINDOW)) == [(3, 1, 1)]


# Tables


def test_insert_ignore_keeps_one_row_per_key(spark, rows):
    path = tables.work_folder(spark, "t")
    tables.create_table(rows([("a", 1)], "k string, v int"), path)
    tables.insert_ignore(rows([("a", 9), ("b", 3), ("b", 2)], "k string, v int"), path, ["k"])
    assert tuples(tables.read_table(spark, path)) == [("a", 1), ("b", 2)]


def test_delete_where_keeps_rows_for_which_the_condition_is_unknown(rows):
    data = rows([(1,), (None,), (5,)], "v int")
    assert tuples(tables.delete_where(data, F.col("v") > 3)) == [(1,), (None,)]


def test_create_table_refuses_to_replace(spark, rows):
    path = tables.work_folder(spark, "t")
    tables.create_table(rows([(1,)], "v int"), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.create_table(rows([(2,)], "v int"), path)


def test_work_folder_lies_in_the_shared_folder(spark):
    assert tables.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_lists_count_values_beyond_any_cell_and_fold_spellings(rows):
    data = rows([("a", "Anna", 3_000_000_000), ("a", "ANNA", 1), ("a", "Änna", 1), ("a", "Bo", 2)], "k string, v string, n long")
    assert tuples(list_values(data, ["k"], {"vs": "v"}, "n")) == [("a", "vs", "ANNA", 3_000_000_002), ("a", "vs", "Bo", 2)]
    assert joined_lists(data, ["k"], {"vs": "v"}, weight="n").first().vs == "ANNA, Bo"
    with pytest.raises(Exception, match="use list_values"):
        joined_lists(data, ["k"], {"vs": "v"}, distinct=False, weight="n").collect()


def test_categories_of_different_spelling_are_one(rows):
    mailings = rows(
        [(1, "a@b.org", c, f"2025-01-0{i} 00:00:00") for i, c in enumerate(["Gold", "GOLD", "gold", "Silver"], 1)],
        "id long, to_address string, p4 string, sent string",
    ).selectExpr("id", "to_address", "p4", "CAST(sent AS timestamp_ntz) AS date_sent", "CAST(NULL AS timestamp_ntz) AS date_added")
    users = rows([(1, "a@b.org")], "id long, email string").withColumn("country_name", F.lit("FR"))
    counts = campaign.touch_counts(campaign.mail_touches(mailings))
    sent = campaign.emails_sent(counts, campaign.user_addresses(users, "country_name"))
    assert sorted((r.award_category, r.emails_sent) for r in sent.collect()) == [("GOLD", 3), ("Silver", 1)]
