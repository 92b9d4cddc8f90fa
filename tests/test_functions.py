from decimal import Decimal

from conftest import day, rows_of
from pyspark.sql import functions as F

from retailmart.functions.dates import calendar, calendar_parts, date_key, parse_date
from retailmart.functions.numbers import mart_mean, mean_money, ratio
from retailmart.functions.text import blank_to_null, clean, email, full_name, not_blank, or_unknown


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def results(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_email(spark):
    df = column(spark, [" A@B.c ", "a@b.C", "", "  ", None])
    assert results(df, email("x")) == ["a@b.c", "a@b.c", "", "", None]
    assert [r.x for r in df.where(not_blank("x")).collect()] == [" A@B.c ", "a@b.C"]


def test_blank_and_null_rules(spark):
    df = column(spark, ["red", " red", "", " ", None])
    assert results(df, clean("x")) == ["red", "red", "", "", None]
    assert results(df, blank_to_null("x")) == ["red", "red", None, None, None]
    assert results(df, or_unknown("x")) == ["red", "red", "", "", "Unknown"]


def test_trim_keeps_tabs(spark):
    assert results(column(spark, ["\ta "]), clean("x")) == ["\ta"]


def test_full_name_needs_both_parts(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    assert results(df, full_name("f", "l")) == ["A B", None, None]


def test_parse_date(spark):
    df = column(spark, ["1/5/2021", "01/05/2021", "13/45/2021", "", "2/29/2021", "2/29/2020", None])
    same = day(2021, 1, 5)
    assert results(df, parse_date("x")) == [same, same, None, None, None, day(2020, 2, 29), None]
    assert results(df, date_key(parse_date("x")))[:3] == [20210105, 20210105, None]


def test_calendar_parts_start_the_week_on_monday(spark):
    df = column(spark, [day(2021, 1, 3), day(2021, 1, 4)], "date")
    parts = [tuple(r) for r in df.select(*calendar_parts("x")).collect()]
    assert parts == [
        (3, 1, 2021, 1, 7, "Sunday", "January", True),
        (4, 1, 2021, 1, 1, "Monday", "January", False),
    ]


def test_calendar_covers_its_span_once(spark):
    df = calendar(spark)
    assert df.count() == 7670
    assert df.agg(F.min("full_date"), F.max("full_date")).first() == (day(2010, 1, 1), day(2030, 12, 31))
    assert df.select("date_key").distinct().count() == 7670


def test_averages_round_half_up_once(spark):
    df = spark.createDataFrame([(Decimal("2.01"), 2), (Decimal("10.00"), 3), (Decimal("1.00"), 0)], "t decimal(20,2), n bigint")
    total, count = F.col("t"), F.col("n")
    assert results(df, mart_mean(total, count)) == [Decimal("1.01"), Decimal("3.33"), None]
    assert results(df, mean_money(total, count)) == [Decimal("1.005000"), Decimal("3.333333"), None]
    assert results(df.limit(1), ratio(-total, count, 2, 18)) == [Decimal("-1.01")]


def test_sums_beyond_the_mart_type_fit(spark):
    df = spark.createDataFrame([(Decimal("99999999999999999999.99"), 10**13)], "t decimal(28,2), n bigint")
    assert rows_of(df.select(mean_money(F.col("t"), F.col("n")))) == [(Decimal("10000000.000000"),)]
