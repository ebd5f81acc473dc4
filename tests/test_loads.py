"""Stored tables: loads that are atomic and repeatable, incremental tables, and what is left behind."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import funnel
from tallyloom.operators import warehouse as w
from tallyloom.plans import registry
from tallyloom.sources import tables, versions

FOLDER = "/root/testdata/sf0.001"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, rows):
    """A stored table of two rows."""
    path = tables.work_folder(spark, "t")
    tables.create_table(rows([(1, "a"), (2, "b")], "k long, v string"), path)
    return path


def failing(rows):
    """Rows of which the last partition cannot be made."""
    good = rows([(i, "new") for i in range(50)], "k long, v string").repartition(4)
    return good.withColumn("v", F.when(F.col("k") == 37, F.raise_error(F.lit("lost half-way")).cast("string")).otherwise(F.col("v")))


def test_a_reload_that_fails_half_way_leaves_the_old_rows(spark, rows, table):
    with pytest.raises(Exception, match="lost half-way"):
        tables.reload_table(failing(rows), table)
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="lost half-way"):
        tables.append_rows(failing(rows), table, "load 1")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b")]
    # The load has not been taken for done.
    tables.append_rows(rows([(3, "c")], "k long, v string"), table, "load 1")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_reader_goes_on_with_the_rows_it_began_with(spark, rows, table):
    old = tables.read_table(spark, table)
    new = tables.reload_table(rows([(9, "z")], "k long, v string"), table)
    assert tuples(new) == [(9, "z")] and tuples(old) == [(1, "a"), (2, "b")]
    assert tuples(versions.read(spark, table, 0)) == [(1, "a"), (2, "b")]


def test_a_table_may_be_reloaded_from_itself(spark, table):
    own = tables.read_table(spark, table)
    assert tuples(tables.reload_table(own.withColumn("v", F.upper("v")), table)) == [(1, "A"), (2, "B")]


def test_a_load_with_an_id_is_taken_once(spark, rows, table):
    more = rows([(3, "c")], "k long, v string")
    for _ in range(2):
        tables.append_rows(more, table, "load 1")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b"), (3, "c")]
    tables.append_rows(more, table, "load 2")
    tables.append_rows(more, table)
    assert tables.read_table(spark, table).count() == 5
    assert versions.latest(spark, table).loads == ("load 1", "load 2")
    # A load that is there already is not even worked out.
    tables.append_rows(failing(rows), table, "load 2")


def test_a_reload_forgets_the_loads_whose_rows_are_gone(spark, rows, table):
    tables.append_rows(rows([(3, "c")], "k long, v string"), table, "load 1")
    tables.reload_table(rows([(4, "d")], "k long, v string"), table, "reload 1")
    tables.reload_table(failing(rows), table, "reload 1")
    tables.append_rows(rows([(3, "c")], "k long, v string"), table, "load 1")
    assert tuples(tables.read_table(spark, table)) == [(3, "c"), (4, "d")]


def test_two_writers_of_one_table(spark, rows, table, monkeypatch):
    """Another writer gets in between reading the newest version and publishing the next."""
    plain, others = versions.Store.publish, iter(["load 1", "load x"])

    def beaten(self, name, text):
        other = next(others, None)
        if other:
            monkeypatch.setattr(versions.Store, "publish", plain)
            tables.append_rows(rows([(7, other)], "k long, v string"), table, other)
            monkeypatch.setattr(versions.Store, "publish", beaten)
        return plain(self, name, text)

    monkeypatch.setattr(versions.Store, "publish", beaten)
    # The other one does the very same load: it is there once.
    tables.append_rows(rows([(7, "load 1")], "k long, v string"), table, "load 1")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b"), (7, "load 1")]
    # Another load of the other one: both are there.
    tables.append_rows(rows([(8, "mine")], "k long, v string"), table, "load 2")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b"), (7, "load 1"), (7, "load x"), (8, "mine")]


def test_columns_of_an_append_are_matched_by_name(spark, rows, table):
    tables.append_rows(rows([("c", 3)], "v string, k int"), table)
    assert (3, "c") in tuples(tables.read_table(spark, table))
    with pytest.raises(ValueError, match="do not fit"):
        tables.append_rows(rows([(1,)], "k long"), table)


def test_create_if_there_is_none(spark, rows, table):
    assert tuples(tables.create_table(failing(rows), table, "ignore")) == [(1, "a"), (2, "b")]
    with pytest.raises(FileExistsError):
        tables.create_table(rows([], "k long, v string"), table)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, table + "-no")
    empty = tables.create_table(rows([], "k long, v string"), table, "overwrite")
    assert empty.collect() == [] and empty.columns == ["k", "v"]


def test_paths_with_a_scheme_and_plain_folders(spark, rows, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.create_table(rows([(1,)], "v int"), path)
    tables.append_rows(rows([(2,)], "v int"), path, "load 1")
    assert tuples(tables.read_table(spark, path)) == tuples(tables.read_table(spark, f"{tmp_path}/t/")) == [(1,), (2,)]
    rows([(3,)], "v int").write.parquet(f"{tmp_path}/plain")
    assert tuples(tables.read_table(spark, f"{tmp_path}/plain")) == [(3,)]


def test_clean_deletes_what_no_kept_version_holds(spark, rows, table):
    with pytest.raises(Exception, match="lost half-way"):
        tables.reload_table(failing(rows), table)
    tables.append_rows(rows([(3, "c")], "k long, v string"), table, "load 1")
    tables.reload_table(rows([(4, "d")], "k long, v string"), table)
    gone = versions.clean(spark, table, keep=1)
    assert len(gone) == 3 and tuples(tables.read_table(spark, table)) == [(4, "d")]
    assert [f for f in os.listdir(table) if f.startswith("rows-")] == list(versions.latest(spark, table).folders)
    tables.append_rows(rows([(5, "e")], "k long, v string"), table)
    assert tuples(tables.read_table(spark, table)) == [(4, "d"), (5, "e")]


def test_insert_ignore_may_be_repeated(spark, rows, table):
    more = rows([(2, "no"), (3, "c"), (3, "d")], "k long, v string")
    for _ in range(2):
        tables.insert_ignore(more, table, ["k"], "load 1")
    assert tuples(tables.read_table(spark, table)) == [(1, "a"), (2, "b"), (3, "c")]


def test_reminder_load_twice_with_one_id_adds_its_rows_once(spark):
    query = registry.queries()
    load, listed = query["cmp_reminder_load"](spark, FOLDER), query["cmp_nonresponders_six_mailers"](spark, FOLDER)
    # The query itself loads twice.
    assert load.count() == listed.count() > 0


# Work folders


def test_scratch_deletes_what_is_staged_meanwhile(spark, rows):
    with tables.scratch(spark):
        inside = tables.work_folder(spark, "x")
        staged = tables.stage(rows([(1,)], "v int"), "y")
        with tables.scratch(spark):
            tables.stage(rows([(2,)], "v int"), "z")
        assert staged.count() == 1
        folder = os.path.dirname(os.path.dirname(inside))
        assert len(os.listdir(folder)) == 2
    assert not os.path.exists(folder) and not tables.work_folder(spark, "x").startswith(folder)


def test_scratch_deletes_after_a_failure(spark, rows):
    with pytest.raises(ZeroDivisionError), tables.scratch(spark):
        tables.stage(rows([(1,)], "v int"), "y")
        folder = os.path.dirname(os.path.dirname(tables.work_folder(spark, "x")))
        raise ZeroDivisionError
    assert not os.path.exists(folder)


def test_a_warehouse_load_leaves_its_tables_only(spark):
    t = registry.TestTables(spark, FOLDER)
    folder = tables.work_folder(spark, "warehouse")
    before = set(os.listdir(tables._application_folder(spark)))
    stored = registry.load_warehouse(spark, registry.staging(t), folder)
    after = set(os.listdir(tables._application_folder(spark))) - before
    assert after <= {os.path.basename(os.path.dirname(folder))}
    assert stored.fact.count() > 0 and "located" not in os.listdir(folder)


def test_a_failed_warehouse_load_keeps_the_tables_before_it(spark):
    t = registry.TestTables(spark, FOLDER)
    folder = tables.work_folder(spark, "warehouse")
    wanted = tuples(registry.load_warehouse(spark, registry.staging(t), folder).fact)
    # Staging ids from 2^40 on would be those of another load.
    odd = registry.staging(t).withColumn("id", F.col("id") + (1 << 40))
    with pytest.raises(Exception, match="staging ids must lie below"):
        registry.load_warehouse(spark, odd, folder)
    assert tuples(tables.read_table(spark, f"{folder}/fact_award")) == wanted


# Incremental and single-pass steps


def submissions(rows, *data):
    return rows([(u, dt.date.fromisoformat(d)) for u, d in data], "user_id long, statusdate date")


def test_first_submissions_are_merged_day_by_day(spark, rows):
    path = tables.work_folder(spark, "first")
    every = submissions(rows, (1, "2024-01-05"), (1, "2024-02-01"), (2, "2024-02-10"), (2, "2024-03-01"), (3, "2024-03-05"))
    day = dt.date.fromisoformat
    first = funnel.merge_first_activity(every, path, day("2024-02-01"))
    assert tuples(first) == [(1, day("2024-01-05"))]
    first = funnel.merge_first_activity(every, path, day("2024-03-05"))
    assert tuples(first) == [(1, day("2024-01-05")), (2, day("2024-02-10"))]
    # Days already read are not read again.
    broken = every.withColumn("user_id", F.when(F.col("statusdate") < "2024-03-05", F.raise_error(F.lit("read again")).cast("long")).otherwise(F.col("user_id")))
    assert funnel.merge_first_activity(broken, path, day("2024-03-06")).count() == 3
    version = versions.latest(spark, path).number
    assert funnel.merge_first_activity(broken, path, day("2024-03-06")).count() == 3
    assert versions.latest(spark, path).number == version
    late = submissions(rows, (2, "2024-01-02"), (4, "2024-09-09"))
    for _ in range(2):
        first = funnel.merge_late_activity(late, path)
        assert tuples(first)[1] == (2, day("2024-01-02")) and first.count() == 3


def test_returning_submitters_from_the_stored_table(spark):
    t = registry.TestTables(spark, FOLDER)
    pairs = registry.inputs(t).pairs(registry.ABSTRACTS)
    plain = funnel.with_returning(pairs, t.abstracts(), registry.ABSTRACTS)
    stored = funnel.with_returning(pairs, t.abstracts(), registry.ABSTRACTS, registry.first_submissions(t))
    assert tuples(plain) == tuples(stored) and True in {r.returning for r in plain.collect()}
    text = stored._jdf.queryExecution().optimizedPlan().toString()
    # Submissions once, registrations once: both are views over one file here, told apart by a column of the latter.
    scans = [line for line in text.splitlines() if "Relation" in line and "o_orderkey" in line]
    assert len(scans) == 2


def test_upsert_reads_each_side_once(rows):
    dim = rows([("k1", 4, "a"), ("k2", 7, "b")], "key string, id long, v string").repartition(2)
    new = rows([("k2", "B"), ("k3", "c"), ("k4", None), ("k1", None)], "key string, v string").repartition(2)
    merged = w.merged_members(dim, new, "key", "id")
    text = merged._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("FullOuter") == 1 and len([x for x in text.splitlines() if "LogicalRDD" in x or "LocalRelation" in x]) == 2
    got = tuples(w.upsert_dimension(dim, new, "key", "id"))
    known, fresh = [r for r in got if r[1] <= 7], [r for r in got if r[1] > 7]
    assert known == [("k1", 4, "a"), ("k2", 7, "B")]
    assert sorted(r[1] for r in fresh) == [8, 9] and {(r[0], r[2]) for r in fresh} == {("k3", "c"), ("k4", None)}
