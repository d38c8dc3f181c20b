import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from policy_mart.functions import dates, numbers, text


def value(spark, column, **row):
    return spark.createDataFrame([row]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("  o'higgins san-juan\t", "O'Higgins San-Juan"),
        ("JOSE  de  LA.cruz", "Jose  De  La.Cruz"),
        ("ñandú 3ra b2b", "Ñandú 3ra B2b"),
        ("", ""),
        ("  x\n", "X"),
    ],
)
def test_clean_name(spark, raw, clean):
    assert value(spark, text.clean_name("s"), s=raw) == clean


@pytest.mark.parametrize(
    "raw, number",
    [("1.234,56", 1234.56), (" -0,5", -0.5), ("12", 12.0), ("1.000.000", 1e6), ("n/a", None), ("", None)],
)
def test_decimal_comma(spark, raw, number):
    assert value(spark, text.decimal_comma("s"), s=raw) == number


def test_lenient_date(spark):
    assert value(spark, text.lenient_date("s"), s="2025-1-3") == dt.date(2025, 1, 3)
    assert value(spark, text.lenient_date("s", "d/M/yyyy"), s="31/02/2025") is None
    assert value(spark, text.lenient_date("s"), s="none") is None


@pytest.mark.parametrize("parts, date", [((2025, 1, 3), dt.date(2025, 1, 3)), ((0, 0, 0), None), ((2025, 2, 31), None)])
def test_date_from_parts(spark, parts, date):
    y, m, d = parts
    assert value(spark, dates.date_from_parts("y", "m", "d"), y=y, m=m, d=d) == date


def test_null_year_one(spark):
    assert value(spark, dates.null_year_one("d"), d=dt.date(1, 1, 1)) is None
    assert value(spark, dates.null_year_one("d"), d=dt.date(2, 1, 1)) == dt.date(2, 1, 1)


def test_in_month_is_pushed_as_a_range(spark, tmp_path):
    days = [dt.date(2024, 11, 30), dt.date(2024, 12, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
    path = str(tmp_path / "d")
    spark.createDataFrame([(d,) for d in days], "d date").write.parquet(path)
    found = spark.read.parquet(path).filter(dates.in_month("d", 2024, 12))
    assert sorted(r.d for r in found.collect()) == days[1:3]
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2024-12-01), LessThan(d,2025-01-01)]" in plan


def test_from_month_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    months = [(2023, 12), (2024, 10), (2024, 11), (2024, 12), (2025, 1)]
    spark.createDataFrame(months, "y int, m int").write.parquet(path)
    found = spark.read.parquet(path).filter(dates.from_month("y", "m", dt.date(2024, 11, 20)))
    assert sorted(map(tuple, found.collect())) == months[2:]
    assert "PushedFilters: [Or(GreaterThan(y,2024),And(EqualTo(y,2024),GreaterThanOrEqual(m,11)))]" in found._jdf.queryExecution().toString()


def test_month_index_is_consecutive(spark):
    rows = spark.createDataFrame([(202412,), (202501,), (202502,)], "m int")
    got = [r.i for r in rows.select(dates.month_index("m").alias("i")).collect()]
    assert [b - a for a, b in zip(got, got[1:])] == [1, 1]


def test_days_back_includes_both_ends(spark):
    days = [dt.date(2025, 1, d) for d in (9, 10, 15, 20, 21)]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows.filter(dates.days_back("d", dt.date(2025, 1, 20), 10)).count() == 3


@pytest.mark.parametrize("x, even", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-0.5, 0.0), (2.6, 3.0)])
def test_half_even(spark, x, even):
    assert value(spark, numbers.half_even("x"), x=x) == even


@pytest.mark.parametrize("x, whole", [(1.9, 1), (-1.9, -1), (0.0, 0)])
def test_truncated(spark, x, whole):
    assert value(spark, numbers.truncated("x"), x=x) == whole


def test_percent_of_zero_is_null(spark):
    assert value(spark, numbers.percent("a", "b"), a=5.0, b=0.0) is None
    assert value(spark, numbers.percent("a", "b"), a=5.0, b=20.0) == 25.0


def test_money_sum_does_not_depend_on_order(spark):
    rows = spark.createDataFrame([(0.1,)] * 10 + [(1e9,), (-1e9,)], "x double")
    assert rows.agg(numbers.money_sum("x").alias("s")).first()["s"] == 1.0


@pytest.mark.parametrize("values", [[-0.0001, -5.25], [1e11, 1e11, -0.01], [-1e13, 1e13, 3.5], [None, 2.0]])
def test_money_sum_of_signs_and_sizes(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    exact = float(sum(Decimal(str(v)) for v in values if v is not None))
    assert rows.agg(numbers.money_sum("x").alias("s")).first()["s"] == exact


def test_money_sum_beyond_one_whole_number(spark):
    """Far above what a single 64-bit sum of ten-thousandths could hold."""
    rows = spark.range(0, 1_000_000).select(F.lit(4e13).alias("x"))
    assert rows.agg(numbers.money_sum("x").alias("s")).first()["s"] == 4e19


def test_money_sum_of_tiny_amounts(spark):
    rows = spark.range(0, 1_000_000).select(F.lit(0.00004).alias("x"), F.lit(1 / 3).alias("y"), (F.col("id") * 1e-9).alias("z"))
    got = rows.agg(*[numbers.money_sum(c).alias(c) for c in "xyz"]).first()
    assert got["x"] == 40.0 and got["y"] == pytest.approx(1e6 / 3, rel=1e-9) and got["z"] == pytest.approx(499.9995, rel=1e-9)


def test_money_sum_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(None,)], "x double")
    assert rows.agg(numbers.money_sum("x").alias("s")).first()["s"] is None


def test_net_of_discount(spark):
    assert value(spark, numbers.net_of_discount("a", "p"), a=200.0, p=25.0) == 150.0
    assert value(spark, numbers.net_of_discount("a", "p", "as_loaded"), a=200.0, p=25.0) == 200 * (100 - 0.25)
    with pytest.raises(ValueError):
        numbers.net_of_discount("a", "p", "other")


def test_leading_number(spark):
    assert value(spark, text.leading_number("s", 7), s="123456789") == 1234567
    assert value(spark, text.leading_number("s", 7), s="s/n 12") is None


def test_label_of_a_missing_name_is_null(spark):
    df = spark.createDataFrame([(7, "Ana"), (8, None)], "c int, n string")
    assert [r.l for r in df.select(text.labelled("c", "n").alias("l")).collect()] == ["7 - Ana", None]


def test_strip_leaves_inner_space(spark):
    assert value(spark, text.strip(F.col("s")), s="\t a  b \r\n") == "a  b"
