import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyloom import functions as fn
from tallyloom.functions import text
from tallyloom.functions.measures import mean_ticket, pop_stddev
from tallyloom.params import DateWindow


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def key(spark, *parts, null_as="unknown"):
    return one(spark, fn.person_key(*[F.lit(p).cast("string") for p in parts], null_as=null_as))


def test_norm_key_evens_out_whitespace_case_and_accents(spark):
    for text in ("café lab", "  CAFÉ \tLab ", "Café Lab"):
        assert one(spark, fn.norm_key(F.lit(text))) == "cafe lab"
    assert one(spark, fn.norm_key(F.lit("  "))) == ""


def test_norm_key_of_plain_and_odd_text_follows_one_rule(spark):
    texts = [" A  b ", "a b", "  Ab", "a\u00a0B", "a\tb\n", "\u00a0", "\u0130x", "Stra\u00dfe \u00c9", "a\x00b", "\u212a", "a b  ", "", None]
    data = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.translate(F.lower(F.trim(F.regexp_replace("t", r"[\s\u00A0]+", " "))), text._ACCENTED, text._BASE)
    for wanted, found, folded, low in data.select(whole, fn.norm_key(F.col("t")), fn.ci_key(F.col("t")), F.translate(F.lower("t"), text._ACCENTED, text._BASE)).collect():
        assert (found, folded) == (wanted, low)


def test_ci_key_keeps_spaces_and_letters_without_a_base(spark):
    assert one(spark, fn.ci_key(F.lit(" Âß "))) == " aß "


def test_blank_tests(spark):
    assert one(spark, fn.blank_to_null(F.lit("  "))) is None
    assert one(spark, fn.blank_to_null(F.lit(" a "))) == "a"
    assert one(spark, fn.not_blank(F.lit(None).cast("string"))) is None


def test_extract_email(spark):
    assert one(spark, fn.extract_email(F.lit(" Dr <A.b@X.org> "))) == "a.b@x.org"
    assert one(spark, fn.extract_email(F.lit(" No-Address "))) == "no-address"
    assert one(spark, fn.extract_email(F.lit(None).cast("string"))) is None


def test_code_from_id_is_not_cut(spark):
    assert [one(spark, fn.code_from_id("AWD", F.lit(n))) for n in (7, 999, 12345)] == ["AWD007", "AWD999", "AWD12345"]


def test_person_key_uses_a_real_address(spark):
    assert key(spark, " A@B.org ", None, None, None) == "a@b.org"
    assert key(spark, " A@B.org ", None, None, None, null_as=None) == "a@b.org"


def test_person_key_without_address(spark):
    import hashlib

    for email in (None, "", "  ", "n/a"):
        digest = hashlib.md5(b"ann lee|mit|france").hexdigest()[:10]
        assert key(spark, email, " Ann Lee ", "MIT ", "France") == f"annlee|{digest}@pseudo"


def test_person_key_with_missing_parts(spark):
    import hashlib

    digest = hashlib.md5(b"ann|unknown|unknown").hexdigest()[:10]
    assert key(spark, None, "Ann", None, "  ") == f"ann|{digest}@pseudo"
    assert key(spark, None, "Ann", None, "FR", null_as=None) is None


def test_has_address_is_never_null(spark):
    assert one(spark, fn.has_address(F.lit(None).cast("string"))) is False


def test_conversion_pct_rounds_half_up_and_handles_zero(spark):
    df = spark.createDataFrame([(1, 800, 0)], "a long, b long, z long")
    row = df.select(
        fn.conversion_pct("a", "b").alias("half"),
        fn.conversion_pct("a", "z").alias("none"),
        fn.conversion_pct("a", "z", on_zero=0).alias("zero"),
    ).first()
    assert (row.half, row.none, row.zero) == (D("0.13"), None, D("0.00"))


def stats(spark, prices):
    df = spark.createDataFrame([(D(p),) for p in prices], "p decimal(12,2)").selectExpr(
        "count(*) AS n", "sum(p) AS s", "sum(p * p) AS q"
    )
    return df.selectExpr(f"{mean_ticket('s', 'n')} AS mean", f"{pop_stddev('n', 's', 'q')} AS sd").first()


def test_ticket_statistics_are_exact(spark):
    assert tuple(stats(spark, ["100.00", "100.01"])) == (D("100.01"), D("0.01"))
    assert tuple(stats(spark, ["9999999999.99"])) == (D("9999999999.99"), D("0.00"))
    assert tuple(stats(spark, ["1.00", "2.00", "3.00", "4.00"])) == (D("2.50"), D("1.12"))


@pytest.mark.parametrize("factor", [1, 10**6, 10**9])
def test_stddev_of_large_totals_by_the_same_formula(spark, factor):
    # Prices 9,999,999,999.98 and .99 many times over: totals to 2e19, deviation half a cent.
    prices = [D("9999999999.98"), D("9999999999.99")]
    n, s, q = 2 * factor, sum(prices) * factor, sum(p * p for p in prices) * factor
    df = spark.createDataFrame([(n, s, q)], "n long, s decimal(22,2), q decimal(38,4)")
    assert df.selectExpr(f"{pop_stddev('n', 's', 'q')} AS sd").first().sd == D("0.01")
    empty = spark.createDataFrame([(0, None, None)], "n long, s decimal(22,2), q decimal(38,4)")
    assert empty.selectExpr(f"{pop_stddev('n', 's', 'q')} AS sd").first().sd is None


def test_accents_fold_in_every_script(spark):
    for raw, key in {"Ά": "α", "Й": "и", "Ệ": "e", "ĞÜL": "gul", "ё": "е", "한": "한", "e\u0301": "e"}.items():
        assert one(spark, fn.ci_key(F.lit(raw))) == key


def test_price_tiers(spark):
    df = spark.createDataFrame([(D("10.00"), D("3.33"), D("9.50"))], "a decimal(22,2), d decimal(22,2), l decimal(22,2)")
    tiers = fn.price_tiers("a", "d", "l")
    row = df.select(*[c.alias(n) for n, c in tiers.items()]).first()
    assert list(row) == [D("9.50"), D("10.00"), D("12.50")]


def test_age_counts_completed_years(spark):
    born = F.lit("2000-02-29").cast("date")
    assert one(spark, fn.age_as_of(born, dt.date(2025, 2, 28))) == 24
    assert one(spark, fn.age_as_of(born, dt.date(2025, 3, 1))) == 25
    assert one(spark, fn.age_as_of(F.lit(None).cast("date"), dt.date(2025, 3, 1))) is None


def test_thousands_rounds_half_away(spark):
    assert one(spark, fn.thousands(F.lit("1234.50").cast("decimal(12,2)"))) == "1,235"
    assert one(spark, fn.thousands(F.lit("2.50").cast("decimal(12,2)"))) == "3"


def test_last_12_months_clips_leap_day():
    assert DateWindow.last_12_months("2024-02-29") == DateWindow(dt.date(2023, 2, 28), dt.date(2024, 3, 1))
    assert DateWindow.last_12_months("2023-12-31") == DateWindow(dt.date(2022, 12, 31), dt.date(2024, 1, 1))
