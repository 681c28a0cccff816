"""One value at a time through every rule."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimsieve.functions import ages, rules


def apply(spark, rule, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row.out for row in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_blank_to_null_keeps_other_values(spark):
    assert apply(spark, rules.blank_to_null, "", "   ", " a ", "\t", "NaN", None) == [None, None, " a ", "\t", "NaN", None]


def test_blank_to_null_keeps_the_type(spark):
    numbers = spark.createDataFrame([(1,), (None,)], "v bigint")
    cleaned = numbers.select(rules.blank_to_null(F.col("v")).alias("v"))
    assert cleaned.dtypes == [("v", "bigint")]
    assert {row.v for row in cleaned.collect()} == {1, None}


def test_null_tokens(spark):
    out = apply(spark, lambda c: rules.blank_to_null(c, ("NaN",)), "NaN", " NaN ", "nan", "x")
    assert out == [None, None, "nan", "x"]


def test_load_nulls_are_exact(spark):
    assert apply(spark, rules.load_nulls, "NULL", "null", "", "Null", " ", "x") == [None, None, None, "Null", " ", "x"]


def test_trim_leaves_tabs(spark):
    assert apply(spark, rules.trimmed, "  a b ", "\ta", None) == ["a b", "\ta", None]


def test_initcap_breaks_words_at_blanks_only(spark):
    out = apply(spark, rules.titled, " new DELHI ", "Mira-Bhayandar", "NaN", "o'neil x", None)
    assert out == ["New Delhi", "Mira-bhayandar", "Nan", "O'neil X", None]


def test_upper(spark):
    assert apply(spark, rules.uppered, " s101 ", None) == ["S101", None]


def test_whole_number(spark):
    values = ["12", " 12 ", "-3", "1956.0", "7.9", "12.", "1e3", "abc", "1.2.3", "99999999999", "", "5\n6", None]
    assert apply(spark, rules.whole_number, *values) == [
        12, 12, -3, 1956, 7, 12, None, None, None, None, None, None, None,
    ]


def test_ids_may_need_more_than_32_bits(spark):
    assert apply(spark, rules.number_id, "99999999999", "0", "x") == [99_999_999_999, 0, None]


def test_safe_decimal(spark):
    values = ["1,234.567", "13667", "-1.005", "NaN", "", "1,2,3", "1234567890123.00", " 5 ", "abc", None]
    assert apply(spark, rules.safe_decimal, *values) == [
        Decimal("1234.57"), Decimal("13667.00"), Decimal("-1.01"), None, None, Decimal("123.00"), None,
        Decimal("5.00"), None, None,
    ]


def test_strict_date(spark):
    values = ["1924-06-30", "1924-13-40", "2000-1-2", "2000-02-30", " 2000-01-01", "2000-01-01T", "", None]
    assert apply(spark, rules.strict_date, *values) == [datetime.date(1924, 6, 30)] + [None] * 7


def test_strict_date_equals_the_formatter(spark):
    texts = [f"{y}-{m}-{d}" for y in ("1900", "2000", "0001", "99") for m in ("02", "13", "1") for d in ("28", "29", "30")]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    both = rows.select(rules.strict_date(F.col("v")).alias("a"), F.try_to_date("v", "yyyy-MM-dd").alias("b")).collect()
    assert all(row.a == row.b for row in both)


@pytest.mark.parametrize(
    ("rule", "values", "labels"),
    [
        (rules.gender, ["m", " Male ", "F", "feMALE", "Others", None], ["Male", "Male", "Female", "Female", "NA", "NA"]),
        (rules.claim_status, [" y", "N", "NaN", None], ["Rejected", "Not Rejected", "Unknown", "Unknown"]),
        (rules.group_type, ["govt", "Govt.", "private ", "trust", None], ["Government"] * 2 + ["Private", "NA", "NA"]),
    ],
)
def test_decoders(spark, rule, values, labels):
    assert apply(spark, rule, *values) == labels


def test_contains_ignores_case_and_null(spark):
    out = apply(spark, lambda c: rules.contains_ignoring_case(c, "cancer"), "Lung Cancer", "Melanoma", None)
    assert out == [True, False, None]


def test_ages_count_new_years(spark):
    new_year = datetime.date(2001, 1, 1)
    births = [datetime.date(2000, 12, 31), datetime.date(2001, 6, 1), datetime.date(1983, 1, 1), None]
    rows = spark.createDataFrame([(b,) for b in births], "b date")
    assert [r.a for r in rows.select(ages.calendar_age(F.col("b"), new_year).alias("a")).collect()] == [1, 0, 18, None]


@pytest.mark.parametrize("years", [0, 1, 18, 40])
def test_age_ranges_equal_age_comparisons(spark, years):
    as_of = datetime.date(2000, 2, 29)
    days = spark.sql("SELECT explode(sequence(DATE'1955-01-01', DATE'2003-01-01', INTERVAL 13 DAYS)) AS b")
    age = ages.calendar_age(F.col("b"), as_of)
    wrong = days.filter(
        (ages.younger_than(F.col("b"), years, as_of) != (age < years))
        | (ages.older_than(F.col("b"), years, as_of) != (age > years))
    )
    assert wrong.count() == 0


def test_the_day_of_a_run_is_fixed_once(spark):
    assert ages.fixed_day(spark, datetime.date(2001, 2, 3)) == datetime.date(2001, 2, 3)
    assert abs(ages.fixed_day(spark) - datetime.datetime.now(datetime.UTC).date()) <= datetime.timedelta(days=1)


def test_past_year_holds_both_ends(spark):
    as_of = datetime.date(2001, 11, 4)
    days = [datetime.date(2000, 11, 3), datetime.date(2000, 11, 4), as_of, datetime.date(2001, 11, 5)]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.x for r in rows.select(ages.within_past_year(F.col("d"), as_of).alias("x")).collect()] == [
        False, True, True, False,
    ]
