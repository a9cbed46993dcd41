import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from closebook.functions import calendar, columns as C


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_ratio4_rounds_half_away_from_zero(spark):
    assert _one(spark, C.ratio4(F.lit(1), F.lit(3))) == 0.3333
    assert _one(spark, C.ratio4(F.lit(2), F.lit(3))) == 0.6667
    assert _one(spark, C.ratio4(F.lit(-2), F.lit(3))) == -0.6667
    assert _one(spark, C.ratio4(F.lit(1), F.lit(8))) == 0.125
    assert _one(spark, C.ratio4(F.lit(1), F.lit(0))) is None
    assert _one(spark, C.ratio4(F.lit(None).cast("int"), F.lit(2))) is None


def test_half_up_ties(spark):
    assert _one(spark, C.half_up(F.lit(0.125), 2)) == 0.13
    assert _one(spark, C.half_up(F.lit(-0.125), 2)) == -0.13


def test_money_rounds_decimal(spark):
    x = F.lit(Decimal("2.345")).cast("decimal(10,3)")
    assert _one(spark, C.money(x)) == Decimal("2.35")


def test_day_of_week_zero_is_sunday(spark):
    # 2024-03-03 is a Sunday, 2024-03-09 a Saturday.
    assert _one(spark, C.day_of_week(F.lit(dt.date(2024, 3, 3)))) == 0
    assert _one(spark, C.day_of_week(F.lit(dt.date(2024, 3, 9)))) == 6
    assert _one(spark, C.day_name(F.lit(dt.date(2024, 3, 4)))) == "Monday"
    assert _one(spark, C.is_weekday(F.lit(dt.date(2024, 3, 9)))) is False


def test_iso_week(spark):
    assert _one(spark, C.week_of_year(F.lit(dt.date(2021, 1, 1)))) == 53


def test_title_case_and_make_date(spark):
    assert _one(spark, C.title_case(F.lit("  mARIA  jose-luis "))) == "Maria  Jose-luis"
    assert _one(spark, C.make_date(F.lit(2024), F.lit(2))) == dt.date(2024, 2, 1)


def test_cents_to_dollars(spark):
    assert _one(spark, C.cents_to_dollars(F.lit(12345))) == Decimal("123.45")
    assert _one(spark, C.cents_to_dollars(F.lit(12350), 0)) == Decimal("124")


def test_surrogate_key_matches_md5_of_joined_parts(spark):
    import hashlib
    got = _one(spark, C.surrogate_key(F.lit("a"), F.lit(None).cast("string")))
    want = hashlib.md5(b"a-" + C.SURROGATE_NULL.encode()).hexdigest()
    assert got == want


def test_date_spine_is_half_open(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 2, 27), dt.date(2024, 3, 2))],
                                   "start_date date, end_date date")
    rows = calendar.date_spine(bounds).orderBy("date").collect()
    assert [r["date"] for r in rows] == [dt.date(2024, 2, 27), dt.date(2024, 2, 28),
                                         dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert rows[-1]["month"] == dt.date(2024, 3, 1)
    assert rows[0]["quarter"] == dt.date(2024, 1, 1)
    months = calendar.date_spine(
        spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 4, 1))],
                              "start_date date, end_date date"), datepart="month")
    assert [r["date"] for r in months.orderBy("date").collect()] == [
        dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
