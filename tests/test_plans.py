"""What the planner makes of the queries: pushed filters, single scans, split hot keys."""

import contextlib
import io
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import asof, funnel, quality
from tallyloom.operators import warehouse as w
from tallyloom.operators.ranking import top_k
from tallyloom.params import DateWindow
from tallyloom.plans import insights, marketing, registry, reports
from tallyloom.sources import tables
from tallyloom.sources.testdata import TestTables

FOLDER = "/root/testdata/sf0.001"
WINDOW = DateWindow.between("1999-07-01", "2000-10-01")


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.sub(r"#\d+L?", "", text)


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def test_date_window_reaches_the_scan(spark):
    text = plan(funnel.submitters(TestTables(spark, FOLDER).abstracts(), WINDOW))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1999-07-01" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_top_k_is_cut_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    text = plan(top_k(rows, ["k"], [F.desc("v")], 3))
    assert "WindowGroupLimit" in text and "row_number(), 3, Partial" in text


def test_an_insight_table_scans_each_input_once(spark):
    t = TestTables(spark, FOLDER)
    text = final_plan(insights.country(registry.inputs(t), WINDOW, top_affiliations=True))
    assert "customer.parquet" not in text and "orders.parquet" not in text


@pytest.mark.parametrize("name", [
    "ins_geo_event", "mkt_rollup3", "mkt_grand_total", "dwh_dim_affiliation", "dwh_fact_incremental", "qa_unloaded",
    "rpt_country_lists", "cmp_award_country_funnel", "cmp_nonresponders_six_mailers", "j13_latest_touch",
])
def test_same_result_without_broadcasts(spark, name):
    query = registry.queries()[name]
    wanted = sorted(map(str, query(spark, FOLDER).collect()))
    with settings(spark, **NO_BROADCAST):
        result = query(spark, FOLDER)
        # The table of bucket sizes is the one forced broadcast: at most 4,096 rows.
        assert final_plan(result).count("BroadcastHashJoin") <= (name == "dwh_dim_affiliation")
        assert sorted(map(str, result.collect())) == wanted


HOT = {
    **NO_BROADCAST,
    "spark__sql__shuffle__partitions": "16",
    # Equal rows compress well, so in bytes the hot partition stands out less than in rows.
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


def hot_staging(spark, n):
    """A third of the rows is one person without an address, at one affiliation, with one award."""
    hot = "id % 3 = 0"
    return spark.range(0, n, 1, 8).selectExpr(
        "id", "'57th AMC' AS assembly_number", "2020 AS award_year",
        f"if({hot}, 'Unknown', concat('Person ', id % 4001)) AS name",
        f"if({hot}, NULL, concat('p', id % 4001, '@x.org')) AS email",
        f"if({hot}, 'Hot Lab', concat('Lab ', id % 997)) AS affiliation",
        f"if({hot}, 'Hotland', concat('Land ', id % 97)) AS country",
        f"if({hot}, 'Prize', concat('Award ', id % 31)) AS award_certificate_type",
        "concat('C', id) AS certificate_number", "'s' AS session", "repeat('topic', 5) AS session_topic",
        "NULL AS presentation_type",
    )


def test_fact_load_splits_a_hot_person(spark):
    staging = tables.stage(hot_staging(spark, 120_000), "hot")
    dims = registry.load_warehouse(spark, staging, tables.work_folder(spark, "hot")).dims
    with settings(spark, **HOT):
        fact = w.with_authors(w.located(staging, dims), dims, "lenient")
        text = final_plan(fact)
        assert "SortMergeJoin(skew=true)" in text
        assert "BroadcastHashJoin" not in text
        assert fact.count() == 120_000
        assert quality.load_readiness(staging, dims).first().rows_ready_for_fact == 120_000


def longest_method(spark, df_of):
    """Bytes of the longest method Spark generates; the JVM does not compile one of more than 8,000."""
    out = io.StringIO()
    with settings(spark, spark__sql__adaptive__enabled="false", **NO_BROADCAST), contextlib.redirect_stdout(out):
        df_of().explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))


def test_look_ups_are_short_enough_to_be_compiled(spark):
    stored = registry.loaded(TestTables(spark, FOLDER))
    assert longest_method(spark, lambda: w.located(stored.staging, stored.dims)) < 8000
    texts = tables.stage(w.person_texts(stored.staging), "texts")
    assert longest_method(spark, lambda: w.identified(texts, stored.dims, stored.dims_by_person, "strict")) < 8000


def test_people_of_a_country_are_not_listed_once_per_topic(spark, rows):
    fact = rows([(i, i % 2, 1, f"topic {i % 50}") for i in range(200)], "award_id long, author_id long, country_id long, session_topic string")
    country = rows([(1, "Peru")], "country_id long, country_name string")
    author = rows([(0, "Ann", "a@x.org"), (1, "Bo", "b@x.org")], "author_id long, full_name string, email_norm string")
    dims = w.Dimensions(country, None, None, author)
    lists = reports.country_lists(fact, dims)
    row = lists.first()
    assert (row.total_awards, row.authors, row.emails, len(row.research_areas.split(", "))) == (200, "Ann, Bo", "a@x.org, b@x.org", 50)
    text = lists._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[country_id#\d+L?, author_id#\d+L?, session_topic", text)


@pytest.mark.parametrize("identity", ["strict", "by_email"])
def test_the_shared_look_up_gives_the_rows_of_two_loads(spark, identity):
    """Blank parts, repeated rows, and junk e-mails of one name, which share an identity without context."""
    data = [
        (1, "Ann", "n/a", "MIT", "Peru", "Gold", "C1"), (2, "Ann", "none", "MIT", "Peru", "Gold", "C2"),
        (3, "Ann", None, "unknown_affiliation", "unknown_country", "Gold", None), (3, "Bo", "b@x.org", " mit", "PERU", "gold ", "C3"),
        (3, "Bo", "b@x.org", " mit", "PERU", "gold ", "C3"), (4, " ", None, "MIT", "Peru", "Gold", " "),
        (5, None, None, "MIT", "Peru", "Silver", "C5"), (6, "Cy", None, None, "Peru", "Gold", "C6"), (7, "Cy", "", "MIT", "Peru", None, "C7"),
        (8, "Cy", "C@X.org ", "MIT", "Pérú", "Gold", "C8"), (9, None, None, None, None, None, None),
    ]
    staging = spark.createDataFrame(
        [(i, "A1", 2020, *rest, "s", "t", "p") for i, *rest in data],
        "id long, assembly_number string, award_year int, name string, email string, affiliation string, country string, "
        "award_certificate_type string, certificate_number string, session string, session_topic string, presentation_type string",
    )
    stored = registry.load_warehouse(spark, staging, tables.work_folder(spark, "odd"))
    before = {"strict": stored.dims_by_person, "by_email": stored.dims_by_email}[identity]
    plain = w.located(staging, stored.dims)
    first = w.with_authors(plain, before, identity)
    later = w.add_to_fact(plain, stored.dims, first)
    rows = w.located_once(staging, w.person_texts(staging), stored.dims, before, identity)
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(w.first_facts(rows)) == as_text(first) and as_text(w.later_facts(rows, stored.dims, w.first_facts(rows))) == as_text(later)
    assert first.count() > 3 and later.count() > 0
    if identity == "strict":
        assert as_text(stored.fact) == sorted(as_text(first) + as_text(later))
        # Only what the first load took otherwise or not at all goes on to the second; 3 shares its identity with the junk e-mails.
        assert {r.id for r in rows.filter("_lenient IS NOT NULL").collect()} == {3, 4, 5}


def every_person():
    """Each combination of missing, blank, junk and usable texts."""
    n = 0
    for name in (None, " ", "Ann", "ann "):
        for email in (None, "", "n/a", "a@x.org", " A@X.org "):
            for affiliation in (None, " ", "MIT", " mit"):
                for country in (None, "", "Peru", "PERU "):
                    n += 1
                    yield n, "A1", 2020, name, email, affiliation, country, "Gold", f"C{n % 7}" if n % 5 else None, "s", "t", "p"


@pytest.mark.parametrize("identity", ["strict", "by_email", "lenient"])
def test_the_shared_look_up_takes_every_kind_of_person(spark, identity):
    staging = spark.createDataFrame(
        list(every_person()),
        "id long, assembly_number string, award_year int, name string, email string, affiliation string, country string, "
        "award_certificate_type string, certificate_number string, session string, session_topic string, presentation_type string",
    )
    stored = registry.load_warehouse(spark, staging, tables.work_folder(spark, "every"))
    people = stored.people.selectExpr("abs(hash(email_norm)) AS author_id", "email_norm")
    before = {"strict": stored.dims_by_person, "by_email": stored.dims_by_email, "lenient": stored.dims.with_author(people, "email_norm")}[identity]
    plain = w.located(staging, stored.dims)
    first = w.with_authors(plain, before, identity)
    rows = w.located_once(staging, w.person_texts(staging), stored.dims, before, identity)
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(w.first_facts(rows)) == as_text(first) and first.count() > 20
    assert as_text(w.later_facts(rows, stored.dims, first)) == as_text(w.add_to_fact(plain, stored.dims, first))
    if identity == "strict":
        later = w.add_to_fact(plain, stored.dims, first)
        assert as_text(stored.fact) == sorted(as_text(first) + as_text(later))


def test_rows_are_dealt_out_by_one_identity_without_its_texts(spark):
    stored = registry.loaded(TestTables(spark, FOLDER))
    texts = tables.stage(w.person_texts(stored.staging), "texts")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        rows = w.located_once(stored.staging, texts, stored.dims, stored.dims_by_person, "strict")
        text = rows._jdf.queryExecution().optimizedPlan().toString()
        assert longest_method(spark, lambda: rows) < 8000
    assert re.search(r"Join Inner, .*_identity#\d+ = _identity#\d+", text)
    # The join by texts takes rows and texts with a blank part only; the other rows leave them out.
    assert len(re.findall(r"Join Inner, .*name#\d+.* <=> ", text)) == 1
    assert len(re.findall(r"Filter .*trim\(name#\d+, None\) = ", text)) >= 3, text


def test_a_small_batch_moves_none_of_the_fact_table(spark, rows):
    fact = tables.stage(spark.range(200_000).selectExpr(
        "id AS author_id", "id AS affiliation_id", "id AS country_id", "id AS award_type_id", "concat('C', id) AS certificate_number"
    ), "fact")
    batch = tables.stage(fact.limit(5).unionByName(fact.limit(1).withColumn("certificate_number", F.lit("new"))), "batch")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="200k", spark__sql__adaptive__autoBroadcastJoinThreshold="200k"):
        left = w.without_loaded(batch, fact)
        assert [r.certificate_number for r in left.collect()] == ["new"]
        text = left._jdf.queryExecution().sparkPlan().toString()
        assert re.search(r"BroadcastHashJoin \[.*LeftSemi, BuildRight", text)


def test_conversion_with_a_hot_user_and_conference(spark):
    """A third of all registrations belongs to one user and conference; the rows meet as one pair."""
    n = 90_000
    abstracts = spark.range(n).selectExpr(
        "id", "if(id % 3 = 0, 0, id % 5003) AS user_id", "if(id % 3 = 0, 0, id % 11) AS event_id",
        "DATE'2000-01-01' AS statusdate",
    )
    registrations = abstracts.selectExpr(
        "id", "user_id", "event_id", "CAST(id % 500 + 1 AS decimal(12,2)) AS total_price", "'EUR' AS currency_type",
        "1 AS status",
    )
    with settings(spark, **HOT):
        pairs = funnel.conversion_pairs(abstracts, registrations, WINDOW)
        text = final_plan(pairs)
        for side in ("partial_count(1)", "functions=[], output=[user_id"):
            assert side in text
        hot = pairs.filter("user_id = 0 AND event_id = 0").collect()
        total = pairs.agg(F.sum("paid_rows")).first()[0]
    assert len(hot) == 1 and hot[0].paid_rows >= n // 3 and total == n


def test_time_line_of_a_hot_key_spreads_over_slices(spark):
    n = 30_000
    base = spark.range(n).selectExpr(
        "id", "if(id % 3 = 0, 'hot', concat('k', id % 700)) AS k",
        "TIMESTAMP_NTZ'2025-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id % 40000 AS int)) AS at",
    )
    touches = base.selectExpr("k", "at AS sent", "concat('v', id) AS v")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", **NO_BROADCAST):
        found = asof.latest_before(base, touches, "k", "at", "sent", "v", slice_hours=1)
        plan = found._jdf.queryExecution().toString()
        assert "hashpartitioning(_key" in plan and "rangepartitioning" not in plan
        # Each row's own touch is the latest at its instant.
        assert found.filter("v = concat('v', id)").count() == n
        # One window per key and slice: the hot key's line is cut by the hour.
        assert re.search(r"windowspecdefinition\(_key#\d+, _slice#\d+", plan)


def test_marketing_totals_survive_many_partitions(spark):
    t = TestTables(spark, FOLDER)
    wanted = marketing.conversion(registry.inputs(t), WINDOW).collect()
    with settings(spark, spark__sql__shuffle__partitions="64", spark__sql__adaptive__enabled="false"):
        assert marketing.conversion(registry.inputs(t), WINDOW).collect() == wanted


def sorts_before_a_shuffle(df):
    """Sorting nodes of the plan with no exchange anywhere below them."""
    text = re.split(r"== Physical Plan ==", df._jdf.queryExecution().toString())[1]
    found, open_nodes = [], []
    for line in text.splitlines():
        node = re.search(r"[A-Za-z]", line)
        if not node:
            continue
        depth, name = node.start(), line[node.start():]
        while open_nodes and open_nodes[-1][0] >= depth:
            if not open_nodes[-1][2]:
                found.append(open_nodes[-1][1])
            open_nodes.pop()
        name = re.sub(r"^\*\(\d+\) ", "", name)
        if "Exchange" in name:
            open_nodes = [(d, n, True) for d, n, _ in open_nodes]
        if name.startswith("Sort"):
            open_nodes.append((depth, name[:60], False))
    return found + [n for _, n, below in open_nodes if not below]


@pytest.mark.parametrize("name", ["c06_latest_contact", "io12_update_join", *registry.FOLLOW_UPS])
def test_latest_rows_are_not_sorted_before_the_shuffle(spark, name):
    with settings(spark, **NO_BROADCAST):
        assert sorts_before_a_shuffle(registry.queries()[name](spark, FOLDER)) == []


def test_first_row_per_key_is_no_sort_aggregate(spark):
    rows = spark.range(100).selectExpr("concat('k', id % 7) AS k", "concat('v', id) AS v")
    text = plan(tables.first_per_key(rows, ["k"]))
    assert "SortAggregate" not in text and sorts_before_a_shuffle(tables.first_per_key(rows, ["k"])) == []
    # A sort before the shuffle is what the helper finds.
    assert sorts_before_a_shuffle(rows.groupBy("k").agg(F.min(F.struct("v", "k"))))


def test_insights_scan_submissions_once(spark):
    t = TestTables(spark, FOLDER)
    located = insights._located(registry.replace(registry.inputs(t), first=registry.first_submissions(t)), WINDOW, "Unknown")
    assert "orders" not in located._jdf.queryExecution().toString()


def test_copies_of_one_row_are_made_by_several_tasks(spark):
    from tallyloom.operators import campaign

    one = spark.range(1).selectExpr("'a@x.org' AS email", "1000000L AS holders")
    copies = campaign.repeat_rows(one, "holders", "copy")
    sizes = [r["count"] for r in copies.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) > 4 and max(sizes) < 400_000
    assert copies.agg(F.count_distinct("copy"), F.max("copy")).first()[:] == (1_000_000, 999_999)


def test_yes_and_abstracts_of_one_person_are_not_paired_in_a_join(spark):
    from tallyloom.operators import campaign

    form = spark.range(3000).selectExpr("id", "'a@x.org' AS email", "'yes' AS response", "TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS created_at")
    users = spark.range(1).selectExpr("id", "'A' AS first_name", "'B' AS last_name", "'a@x.org' AS email")
    abstracts = spark.range(40).selectExpr("id", "0L AS user_id", "DATE'2000-02-01' AS created_at")
    args = (form, users, abstracts, WINDOW, WINDOW)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", **NO_BROADCAST):
        full = campaign.yes_to_abstract(*args)
        assert full.count() == 3000 * 40 and full.select("yes_created_at", "abstract_id").distinct().count() == 3000 * 40
        text = plan(full)
        # Each of the many rows of an abstract meets one row by its number; other joins have one row per key on a side.
        assert re.search(r"Join Inner, \(\(\(email_norm#\d+ = email_norm#\d+\) AND \(_part#\d+ = _part#\d+\)\) AND \(_number#\d+ = _number#\d+\)\)", text), re.findall(r".*Join.*", text)
    compact = campaign.yes_before_abstract(*args).collect()
    assert [(r.yes_count, str(r.first_yes_at), str(r.last_yes_at)) for r in compact] == [(3000, "2000-01-01 00:00:00", "2000-01-01 00:49:59")] * 40
