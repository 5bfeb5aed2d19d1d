import math
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from shelfcast.functions import calendar as fc
from shelfcast.operators import calendar as oc

FIRST, N = date(2011, 1, 29), 1969


def features(spark, first=FIRST, n=N):
    bounds = spark.createDataFrame([(first, first + timedelta(days=n - 1))], "lo date, hi date")
    return oc.calendar_features(oc.calendar_between(bounds), F.lit(first)).toPandas().sort_values("d").reset_index(drop=True)


def moon(day):
    cycles = Decimal("0.20439731") + Decimal((day - date(2001, 1, 1)).days) * Decimal("0.03386319269")
    return math.floor(cycles % 1 * 8 + Decimal("0.5")) % 8


def test_features_against_plain_loops(spark):
    cal = features(spark)
    assert list(cal.d) == list(range(1, N + 1))
    week, serial = 1, []
    for i in range(N):
        week += i % 7 == 0
        serial.append(week)
    assert list(cal.w_serial) == serial
    days = [FIRST + timedelta(days=i) for i in range(N)]
    assert list(cal.moon) == [moon(x) for x in days]
    assert list(cal.is_weekend) == [int(x.weekday() >= 5) for x in days]
    assert list(cal.wday) == [(x.weekday() + 2) % 7 + 1 for x in days]
    by_month = cal.groupby([cal.year, cal.month]).w_serial.transform("min")
    by_year = cal.groupby(cal.year).w_serial.transform("min")
    assert (cal.week_of_month == cal.w_serial - by_month + 1).all()
    assert (cal.week_of_year == cal.w_serial - by_year + 1).all()
    assert set(cal[cal.olympic_president_elec_year == 1].year) == {2012, 2016}


def test_moon_before_its_epoch(spark):
    cal = features(spark, date(1995, 1, 2), 2500)
    assert list(cal.moon) == [moon(date(1995, 1, 2) + timedelta(days=i)) for i in range(2500)]


def test_events(spark):
    cal = features(spark).set_index("d")
    assert cal.NBA_finals.sum() == 13 + 10 + 15 + 11 + 13 + 18
    assert cal.Ramadan_Starts.sum() == 5 * 30 + 13
    assert (cal.loc[[100, 99], "Mothers_day"] == [1, 2]).all()
    assert (cal.loc[[436, 435, 434], "Easter"] == [1, 2, 0]).all()
    assert (cal.loc[[443, 442], "OrthodoxEaster"] == [1, 2]).all()
    assert list(cal.loc[range(516, 528), "IndependenceDay"]) == [0, *range(1, 11), 0]


def test_labels(spark):
    df = spark.createDataFrame(
        [("CA", "HOBBIES", "Sporting"), ("WI", "FOODS", "Religious"), ("TX", "HOUSEHOLD", "Cultural"), ("TX", "FOODS", None)],
        "s string, c string, t string",
    )
    label = fc.composite_label(F.col("s"), F.col("c"), F.col("t"))
    assert [x[0] for x in df.select(label).collect()] == [1, 36, 14, 0]
    code = fc.coded(F.col("c"), {"FOODS": 7})
    assert [x[0] for x in df.select(code).collect()] == [None, 7, None, 7]


def test_holidays_and_weeks(spark):
    d1, d2 = date(2016, 7, 4), date(2016, 7, 5)
    fact = spark.createDataFrame([("CA", d1), ("TX", d1), ("CA", d2)], "state_id string, date date")
    listed = spark.createDataFrame([("CA", d1), ("CA", d1), ("TX", d2)], "state_id string, date date")
    got = {(x.state_id, x.date): x.national_holiday for x in oc.flag_holidays(fact, listed).collect()}
    assert got == {("CA", d1): 1, ("TX", d1): 0, ("CA", d2): 0}
    cal = spark.createDataFrame(
        [(1, date(2016, 1, 30), 1, 2016), (1, date(2016, 2, 1), 2, 2016), (2, date(2016, 2, 6), 2, 2016)],
        "wm_yr_wk int, date date, month int, year int",
    )
    assert sorted(map(tuple, oc.weeks_of(cal).collect())) == [(1, 1, 2016), (2, 2, 2016)]
