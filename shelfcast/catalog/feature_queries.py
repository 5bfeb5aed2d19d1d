"""Queries on reshaping, calendar, price, target, lag and encoding operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import retail as r
from shelfcast.catalog.registry import query
from shelfcast.functions import calendar as fc
from shelfcast.functions import price as fp
from shelfcast.operators import calendar as oc
from shelfcast.operators import lags as ol
from shelfcast.operators import price as op
from shelfcast.operators import reshape as orr
from shelfcast.operators import target as ot
from shelfcast.operators.encode import PARTS, encode, encoding_name, join_encodings, term_cutoffs
from shelfcast.operators.hierarchy import node_label
from shelfcast.plans.manifests import encoding_columns, lag_manifest
from shelfcast.schema import ENCODED_LEVELS, KEYS
from shelfcast.session import table_path
from shelfcast.sources import scan, store

FIRST_DATE = "DATE '1995-01-02'"


# ---------------------------------------------------------------- reshaping

WEEKDAYS = [f"d_{i}" for i in range(1, 8)]


def weekday_matrix(spark, sf):
    """Units per supplier and weekday, wide: d_1 is Sunday."""
    lines = table_lines(spark, sf)
    return (
        lines.groupBy("l_suppkey")
        .pivot("wd", list(range(1, 8)))
        .agg(F.sum("sales"))
        .withColumnsRenamed({str(i): f"d_{i}" for i in range(1, 8)})
    )


def table_lines(spark, sf):
    return r.lines(spark, sf).withColumn("wd", F.dayofweek(r.date_of(F.col("d"))))


@query(
    "melt_wide",
    f"""WITH {r.SQL_LINES},
    sums AS (SELECT l_suppkey, 1 + dayofweek(DATE '{r.EPOCH}' + CAST(d AS INTEGER)) AS wd, sum(sales) AS sales FROM lines GROUP BY ALL)
    SELECT k.l_suppkey, k.d, s.sales FROM (
      SELECT l_suppkey, CAST(unnest(range(1, 10)) AS INTEGER) AS d FROM (SELECT DISTINCT l_suppkey FROM lines)) k
    LEFT JOIN sums s ON s.l_suppkey = k.l_suppkey AND s.wd = k.d""",
)
def melt_wide(spark, sf):
    """Weekday columns to rows, with two empty future days."""
    return orr.melt_days(weekday_matrix(spark, sf), ["l_suppkey"], WEEKDAYS, horizon=2)


@query(
    "transpose_weekdays",
    f"""WITH {r.SQL_LINES},
    b AS (SELECT p_type AS cat_id, 1 + dayofweek(DATE '{r.EPOCH}' + CAST(d AS INTEGER)) AS wd, sales
          FROM lines JOIN part ON l_partkey = p_partkey)
    SELECT CAST(wd AS INTEGER) AS d, """
    + ", ".join(f"sum(CASE WHEN cat_id = '{c}' THEN sales END) AS cat_{c}" for c in r.CATS)
    + " FROM b GROUP BY 1",
)
def transpose_weekdays(spark, sf):
    """Category x weekday matrix turned into weekday x category."""
    cats = table_lines(spark, sf).join(r.items(spark, sf), F.col("l_partkey") == F.col("p_partkey"))
    wide = orr.pivot_sum(cats, ["cat_id"], "wd", "sales", range(1, 8), "d_")
    return orr.pivot_sum(orr.melt_days(wide, ["cat_id"], WEEKDAYS), ["d"], "cat_id", "sales", r.CATS, "cat_")


def dense(spark, sf, horizon=0):
    daily = r.supplier_daily(spark, sf)
    bounds = r.lines(spark, sf).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return orr.dense_days(
        daily, bounds.select("lo").scalar(), bounds.select("hi").scalar(), horizon, keep=["store_id", "state_id"]
    )


@query(
    "dense_spine",
    f"""WITH {r.SQL_DENSE}
    SELECT id, store_id, state_id, CAST(d AS INTEGER) AS d, sales FROM dense
    UNION ALL
    SELECT id, store_id, state_id, CAST(hi + h AS INTEGER) AS d, NULL AS sales
    FROM (SELECT DISTINCT id, store_id, state_id FROM daily), bounds, (SELECT unnest(range(1, 29)) AS h)""",
)
def dense_spine(spark, sf):
    """R2: gap-free days per supplier and 28 empty future days."""
    return dense(spark, sf, horizon=28)


@query(
    "serial_key",
    f"""WITH {r.SQL_LEAF}
    SELECT id, row_number() OVER (ORDER BY id) - 1 AS id_serial FROM (SELECT DISTINCT id FROM leaf)""",
)
def serial_key(spark, sf):
    """Consecutive series numbers in id order."""
    return orr.with_serial(r.leaf_series(spark, sf), ["id"], buckets=16).select("id", "id_serial")


@query(
    "narrow_types",
    """WITH s AS (
      SELECT 'l_quantity' AS "column", min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
      UNION ALL SELECT 'l_linenumber', min(l_linenumber), max(l_linenumber) FROM lineitem
      UNION ALL SELECT 'l_suppkey', min(l_suppkey), max(l_suppkey) FROM lineitem
      UNION ALL SELECT 'l_partkey', min(l_partkey), max(l_partkey) FROM lineitem
      UNION ALL SELECT 'l_orderkey', min(l_orderkey), max(l_orderkey) FROM lineitem
      UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem),
    t AS (UNPIVOT (SELECT sum(l_quantity)::BIGINT AS l_quantity, sum(l_linenumber)::BIGINT AS l_linenumber, sum(l_suppkey)::BIGINT AS l_suppkey,
      sum(l_partkey)::BIGINT AS l_partkey, sum(l_orderkey)::BIGINT AS l_orderkey, sum(floor(l_extendedprice::FLOAT))::BIGINT AS l_extendedprice FROM lineitem)
      ON COLUMNS(*) INTO NAME "column" VALUE total)
    SELECT "column", CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, total,
      CASE WHEN "column" IN ('l_quantity', 'l_extendedprice') THEN 'float' WHEN lo > -128 AND hi < 127 THEN 'tinyint'
           WHEN lo > -32768 AND hi < 32767 THEN 'smallint' WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS narrow
    FROM s JOIN t USING ("column")""",
)
def narrow_types(spark, sf):
    """The columns cast to the narrowest types that hold them; types and totals are read off the cast frame."""
    columns = ["l_quantity", "l_linenumber", "l_suppkey", "l_partkey", "l_orderkey", "l_extendedprice"]
    lines = r.table(spark, sf, "lineitem").select(*columns)
    cast = orr.narrow_types(lines)
    exact = {c: F.floor(c) if c == "l_extendedprice" else F.col(c) for c in columns}
    totals = cast.agg(*[F.sum(v.cast("long")).alias(c) for c, v in exact.items()])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("narrow"), F.col(c).alias("total")) for c, t in cast.dtypes]
    return orr.column_ranges(lines, columns).join(totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*"), "column")


@query(
    "last_28_days",
    f"""WITH {r.SQL_LINES} SELECT l_suppkey, sum(sales) AS sales, count(*) AS n FROM lines
    WHERE d > (SELECT max(d) FROM lines) - 28 GROUP BY ALL""",
)
def last_28_days(spark, sf):
    """Trailing days of the table."""
    recent = orr.last_days(r.lines(spark, sf).drop("l_partkey", "cents"), 28)
    return recent.groupBy("l_suppkey").agg(F.sum("sales").alias("sales"), F.count("*").alias("n"))


@query(
    "first_row_per_week",
    f"""WITH {r.SQL_LINES}, days AS (SELECT DISTINCT d, (d - 1) // 7 AS w FROM lines)
    SELECT CAST(w AS INTEGER) AS wm_yr_wk, CAST(min(d) AS INTEGER) AS d,
           CAST(month(DATE '{r.EPOCH}' + CAST(min(d) AS INTEGER)) AS INTEGER) AS month FROM days GROUP BY w""",
)
def first_row_per_week(spark, sf):
    """First calendar row of each sales week."""
    days = r.lines(spark, sf).select("d").distinct()
    rows = days.withColumns(
        {"wm_yr_wk": F.floor((F.col("d") - 1) / 7).cast("int"), "month": F.month(r.date_of(F.col("d")))}
    )
    return orr.first_by(rows, ["wm_yr_wk"], "d", ["d", "month"])


@query(
    "one_hot_status",
    """SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS n_A,
       CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_N,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_R FROM lineitem GROUP BY 1""",
)
def one_hot_status(spark, sf):
    """0/1 columns of a label, counted per order."""
    flags = orr.one_hot(r.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), "l_returnflag", ["A", "N", "R"])
    return flags.groupBy("l_orderkey").agg(*[F.sum(f"l_returnflag_{x}").alias(f"n_{x}") for x in "ANR"])


@query(
    "masked_update",
    """SELECT user_id, count(CASE WHEN event_type <> 'error' THEN value END) AS n_kept,
       round(avg(CASE WHEN event_type <> 'error' THEN value END), 6) AS mean_value FROM events GROUP BY 1""",
)
def masked_update(spark, sf):
    """R15 and the NaN rule: blank out values under a mask, then average what is left."""
    ev = r.table(spark, sf, "events").select("user_id", "event_type", "value")
    masked = ev.withColumn("value", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    return orr.nan_to_null(masked).groupBy("user_id").agg(
        F.count("value").alias("n_kept"), F.round(F.avg("value"), 6).alias("mean_value")
    )


# ---------------------------------------------------------------- calendar


def calendar(spark, sf, horizon=0):
    bounds = r.lines(spark, sf).agg(
        r.date_of(F.lit(1)).alias("lo"), r.date_of(F.max("d") + horizon).alias("hi")
    )
    return oc.calendar_features(oc.calendar_between(bounds), F.lit("1995-01-02").cast("date"))


def daily_units(spark, sf):
    return r.lines(spark, sf).groupBy("d").agg(F.sum("sales").alias("units"))


def with_units(spark, sf, *columns):
    cal = calendar(spark, sf).select("d", *columns)
    return oc.join_calendar(daily_units(spark, sf), cal)


SQL_CAL = f"""{r.SQL_LINES},
units AS (SELECT CAST(d AS INTEGER) AS d, sum(sales) AS units FROM lines GROUP BY ALL),
cal AS (SELECT d, units, DATE '{r.EPOCH}' + d AS date, CAST((d - 1) // 7 + 2 AS INTEGER) AS w_serial FROM units)"""

SQL_FULL_CAL = f"""{r.SQL_LINES},
units AS (SELECT CAST(d AS INTEGER) AS d, sum(sales) AS units FROM lines GROUP BY ALL),
full_cal AS (SELECT d, DATE '{r.EPOCH}' + d AS date, CAST((d - 1) // 7 + 2 AS INTEGER) AS w_serial
  FROM (SELECT CAST(unnest(range(1, (SELECT max(d) FROM units) + 1)) AS INTEGER) AS d))"""


@query(
    "week_serial",
    f"WITH {SQL_CAL} SELECT d, units, w_serial FROM cal",
)
def week_serial(spark, sf):
    """Week numbers in blocks of seven rows."""
    return with_units(spark, sf, "w_serial")


@query(
    "week_of_month_year",
    f"""WITH {SQL_FULL_CAL}
    SELECT d, units, CAST(wm AS INTEGER) AS week_of_month, CAST(wy AS INTEGER) AS week_of_year FROM (
      SELECT d, w_serial - min(w_serial) OVER (PARTITION BY year(date), month(date)) + 1 AS wm,
             w_serial - min(w_serial) OVER (PARTITION BY year(date)) + 1 AS wy FROM full_cal) JOIN units USING (d)""",
)
def week_of_month_year(spark, sf):
    """Week inside month and year."""
    return with_units(spark, sf, "week_of_month", "week_of_year")


@query(
    "moon_phase",
    f"""WITH {SQL_CAL}, phase AS (
      SELECT d, units, (CAST('0.20439731' AS DECIMAL(20,11)) + datediff('day', DATE '2001-01-01', date) * CAST('0.03386319269' AS DECIMAL(20,11))) % 1 AS f FROM cal)
    SELECT d, units, CAST((CAST(floor(f * 8 + CAST('0.5' AS DECIMAL(2,1))) AS INTEGER) % 8 + 8) % 8 AS INTEGER) AS moon FROM phase""",
)
def moon_phase(spark, sf):
    """moon phase 0..7."""
    return with_units(spark, sf, "moon")


@query(
    "weekend_flag",
    f"""WITH {SQL_CAL} SELECT d, units, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday FROM cal""",
)
def weekend_flag(spark, sf):
    """weekend flag and weekday number (Saturday is 1)."""
    return with_units(spark, sf, "is_weekend", "wday")


@query(
    "date_parts",
    f"""WITH {SQL_CAL} SELECT d, units, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
    CAST(year(date) AS INTEGER) AS year, CASE WHEN year(date) IN (1996, 2000) THEN 1 ELSE 0 END AS flagged_year FROM cal""",
)
def date_parts(spark, sf):
    """Date parts and year flag."""
    return with_units(spark, sf, "date", "day", "month", "year").withColumn(
        "flagged_year", fc.year_flag(F.col("date"), [1996, 2000])
    ).drop("date")


# Dates of the events, from a calendar: the check does not share the day numbers of the operator. Day 1 is 2011-01-29.
FINALS = "2011-05-31 2011-06-12 2012-06-12 2012-06-21 2013-06-06 2013-06-20 2014-06-05 2014-06-15 2015-06-04 2015-06-16 2016-06-02 2016-06-19"
FASTING = "2011-08-01 2011-08-30 2012-07-20 2012-08-18 2013-07-09 2013-08-07 2014-06-29 2014-07-28 2015-06-18 2015-07-17 2016-06-07 2016-06-19"
MOTHERS = "2011-05-08 2012-05-13 2013-05-12 2014-05-11 2015-05-10 2016-05-08"
ORTHODOX = "2011-04-24 2012-04-15 2013-05-05 2014-04-20 2015-04-12 2016-05-01"
WESTERN = "2011-04-24 2012-04-08 2013-03-31 2014-04-20 2015-04-05 2016-03-27"


def _sql_spans(dates):
    pairs = dates.split()
    spans = " OR ".join(f"on_day BETWEEN DATE '{a}' AND DATE '{z}'" for a, z in zip(pairs[::2], pairs[1::2]))
    return f"CASE WHEN {spans} THEN 1 ELSE 0 END"


def _sql_eve(dates):
    listed = ", ".join(f"DATE '{x}'" for x in dates.split())
    return f"CASE WHEN on_day IN ({listed}) THEN 1 WHEN on_day + 1 IN ({listed}) THEN 2 ELSE 0 END"


@query(
    "event_flags",
    f"""WITH {SQL_CAL}, a AS (SELECT d, units, DATE '2011-01-28' + CAST(d AS INTEGER) AS on_day FROM cal)
    SELECT d, units, {_sql_spans(FINALS)} AS NBA_finals, {_sql_spans(FASTING)} AS Ramadan_Starts,
    {_sql_eve(MOTHERS)} AS Mothers_day, {_sql_eve(ORTHODOX)} AS OrthodoxEaster, {_sql_eve(WESTERN)} AS Easter FROM a""",
)
def event_flags(spark, sf):
    """day-number event flags."""
    return with_units(spark, sf, "NBA_finals", "Ramadan_Starts", "Mothers_day", "OrthodoxEaster", "Easter")


@query(
    "event_countdown",
    f"""WITH {SQL_CAL} SELECT c.d, c.units, coalesce(c.d - s.start + 1, 0) AS IndependenceDay FROM cal c
    LEFT JOIN (SELECT unnest([151, 517, 882, 1247, 1612]) AS start) s ON c.d BETWEEN s.start AND s.start + 9""",
)
def event_countdown(spark, sf):
    """countdown code 1..10."""
    return with_units(spark, sf, "IndependenceDay")


# A calendar with event types and per-state flags, derived from the day number.
EVENT_TYPES = fc.LABEL_EVENT_TYPES


def typed_calendar(spark, sf, horizon=0):
    d = F.col("d")
    kind = F.when(d % 11 == 0, "Sporting").when(d % 13 == 0, "Cultural").when(d % 17 == 0, "National").when(d % 19 == 0, "Religious")
    names = F.when(d % 11 == 0, "Easter").when(d % 13 == 0, "OrthodoxEaster").when(d % 17 == 0, "Parade")
    return calendar(spark, sf, horizon).select(
        "d",
        "date",
        "wday",
        "day",
        kind.alias("event_type_1"),
        names.alias("event_name_2"),
        *[(F.col("day") <= 5 * (i + 1)).cast("int").alias(f"snap_{i}") for i in range(len(r.STATES))],
    )


SQL_TYPED = f"""{r.SQL_LEAF},
typed AS (SELECT *, CASE WHEN d % 11 = 0 THEN 'Sporting' WHEN d % 13 = 0 THEN 'Cultural'
  WHEN d % 17 = 0 THEN 'National' WHEN d % 19 = 0 THEN 'Religious' END AS event_type_1,
  CASE WHEN d % 11 = 0 THEN 'Easter' WHEN d % 13 = 0 THEN 'OrthodoxEaster' WHEN d % 17 = 0 THEN 'Parade' END AS event_name_2,
  DATE '{r.EPOCH}' + CAST(d AS INTEGER) AS date FROM leaf)"""


def _sql_case(column, values, start=0):
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i + start}" for i, v in enumerate(values)) + " END"


@query(
    "composite_event_label",
    f"""WITH {SQL_TYPED}, coded AS (SELECT sales, {_sql_case('event_type_1', EVENT_TYPES)} AS t,
      {_sql_case('state_id', r.STATES)} AS s, {_sql_case('cat_id', r.CATS)} AS c FROM typed)
    SELECT coalesce(t * 30 + s * 6 + c + 1, 0) AS event_label, count(*) AS n, sum(sales) AS units FROM coded GROUP BY 1""",
)
def composite_event_label(spark, sf):
    """One code per event type, state and category."""
    fact = oc.join_calendar(r.leaf_sales(spark, sf), typed_calendar(spark, sf))
    label = fc.composite_label(F.col("state_id"), F.col("cat_id"), F.col("event_type_1"), r.STATES, r.CATS)
    return fact.groupBy(label.alias("event_label")).agg(F.count("*").alias("n"), F.sum("sales").alias("units"))


@query(
    "event_codes",
    f"""WITH {SQL_TYPED} SELECT CASE event_name_2 WHEN 'Easter' THEN 1 WHEN 'OrthodoxEaster' THEN 3 END AS event_code,
    CASE event_type_1 WHEN 'Cultural' THEN 0 WHEN 'Religious' THEN 1 END AS type_code,
    count(*) AS n, sum(sales) AS units FROM typed GROUP BY 1, 2""",
)
def event_codes(spark, sf):
    """Dictionary codes of event names and types; unlisted names are NULL."""
    fact = r.leaf_sales(spark, sf).join(F.broadcast(typed_calendar(spark, sf)), "d")
    return fact.groupBy(
        fc.coded(F.col("event_name_2"), fc.EVENT_NAME_2_CODES).alias("event_code"),
        fc.coded(F.col("event_type_1"), fc.EVENT_TYPE_2_CODES).alias("type_code"),
    ).agg(F.count("*").alias("n"), F.sum("sales").alias("units"))


@query(
    "state_pick",
    f"""WITH {SQL_TYPED}, picked AS (SELECT state_id, sales,
      CASE WHEN day(date) <= 5 * ({_sql_case('state_id', r.STATES, 1)}) THEN 1 ELSE 0 END AS snap_total FROM typed
      WHERE state_id <> 'ASIA' UNION ALL SELECT state_id, sales, 0 FROM typed WHERE state_id = 'ASIA')
    SELECT state_id, snap_total, count(*) AS n, sum(sales) AS units FROM picked GROUP BY 1, 2""",
)
def state_pick(spark, sf):
    """each state reads its own flag column; a state without one gets 0."""
    fact = oc.join_calendar(r.leaf_sales(spark, sf), typed_calendar(spark, sf))
    columns = {s: F.col(f"snap_{i}") for i, s in enumerate(r.STATES) if s != "ASIA"}
    return fact.groupBy("state_id", fc.state_pick(F.col("state_id"), columns).alias("snap_total")).agg(
        F.count("*").alias("n"), F.sum("sales").alias("units")
    )


def holidays(spark, sf, horizon=0):
    md = F.date_format("date", "MM-dd")
    state = F.explode(F.array(*[F.lit(s) for s in r.STATES])).alias("state_id")
    days = calendar(spark, sf, horizon).select("date", state)
    return days.where(
        md.isin("12-25", "01-01")
        | ((F.col("state_id") == "EUROPE") & (md == "05-01"))
        | ((F.col("state_id") == "AMERICA") & (md == "07-04"))
    )


@query(
    "holiday_flag",
    f"""WITH {SQL_TYPED}, flagged AS (SELECT state_id, sales,
      CASE WHEN (month(date) = 12 AND day(date) = 25) OR (month(date) = 1 AND day(date) = 1)
             OR (state_id = 'EUROPE' AND month(date) = 5 AND day(date) = 1)
             OR (state_id = 'AMERICA' AND month(date) = 7 AND day(date) = 4) THEN 1 ELSE 0 END AS national_holiday FROM typed)
    SELECT state_id, national_holiday, count(*) AS n, sum(sales) AS units FROM flagged GROUP BY 1, 2""",
)
def holiday_flag(spark, sf):
    """(state, date) pairs listed in a holiday table."""
    fact = r.leaf_sales(spark, sf).withColumn("date", r.date_of(F.col("d")))
    return oc.flag_holidays(fact, holidays(spark, sf)).groupBy("state_id", "national_holiday").agg(
        F.count("*").alias("n"), F.sum("sales").alias("units")
    )


@query(
    "calendar_join",
    f"""WITH {r.SQL_LEAF}, c AS (SELECT *, DATE '{r.EPOCH}' + CAST(d AS INTEGER) AS date FROM leaf)
    SELECT store_id, cat_id, CAST(year(date) AS INTEGER) AS year, CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday,
           sum(sales) AS units FROM c GROUP BY ALL""",
)
def calendar_join(spark, sf):
    """Fact joined to the broadcast calendar."""
    fact = oc.join_calendar(r.leaf_sales(spark, sf), calendar(spark, sf).select("d", "year", "wday"))
    return fact.groupBy("store_id", "cat_id", "year", "wday").agg(F.sum("sales").alias("units"))


# ---------------------------------------------------------------- keys and text


@query(
    "key_parts",
    """SELECT p_partkey, substr(p_brand, 1, 2) AS prefix, left(p_type || '_' || p_brand, length(p_type || '_' || p_brand) - 2) AS stem,
    CAST(substr('d_' || p_size, 3) AS INTEGER) AS d, p_type || '_' || p_brand || '_0.005_evaluation' AS long_id,
    replace(p_type || '_evaluation', 'evaluation', 'validation') AS other_id FROM part""",
)
def key_parts(spark, sf):
    """Prefixes, suffixes, day text, joined keys, quantile suffix, replaced suffix."""
    dept = F.concat_ws("_", "p_type", "p_brand")
    return r.table(spark, sf, "part").select(
        "p_partkey",
        fp.state_of(F.col("p_brand")).alias("prefix"),
        fp.without_suffix(dept, 2).alias("stem"),
        fc.day_serial(F.concat(F.lit("d_"), F.col("p_size").cast("string"))).alias("d"),
        F.concat_ws("_", dept, F.format_string("%.3f", F.lit(0.005)), F.lit("evaluation")).alias("long_id"),
        F.regexp_replace(F.concat(F.col("p_type"), F.lit("_evaluation")), "evaluation", "validation").alias("other_id"),
    )


# ---------------------------------------------------------------- prices


def weeks(spark, sf):
    bounds = r.lines(spark, sf).agg(F.max("d").alias("hi"))
    week = F.explode(F.sequence(F.lit(0), F.floor(F.col("hi") / 7).cast("int"))).alias("wm_yr_wk")
    first = r.date_of(F.col("wm_yr_wk") * 7 + 1)
    return bounds.select(week).select("wm_yr_wk", F.month(first).alias("month"), F.year(first).alias("year"))


def featured_prices(spark, sf):
    return op.price_features(r.weekly_prices(spark, sf), weeks(spark, sf))


@query(
    "price_nunique",
    f"""WITH {r.SQL_PRICES}, s AS (SELECT state_id, item_id, count(DISTINCT sell_price) AS n_state FROM prices GROUP BY ALL),
    t AS (SELECT store_id, item_id, count(DISTINCT sell_price) AS n_store FROM prices GROUP BY ALL)
    SELECT p.store_id, p.item_id, p.wm_yr_wk, CAST(n_state AS BIGINT) AS price_unique_item_state,
           CAST(n_store AS BIGINT) AS price_unique_item_store
    FROM prices p JOIN s USING (state_id, item_id) JOIN t USING (store_id, item_id)""",
)
def price_nunique(spark, sf):
    """Number of distinct prices per (state, item) and (store, item), on every row."""
    return featured_prices(spark, sf).select(
        "store_id", "item_id", "wm_yr_wk", "price_unique_item_state",
        F.col("price_unique_item_store").cast("long").alias("price_unique_item_store"),
    )


def _momentum_sql(unit):
    short = unit[0]
    return f"""WITH {r.SQL_PRICES}, p AS (SELECT prices.*, weeks.{unit} FROM prices LEFT JOIN weeks USING (wm_yr_wk))
    SELECT store_id, item_id, wm_yr_wk,
      round(sell_price / avg(sell_price) OVER (PARTITION BY state_id, item_id, {unit}), 6) AS price_momentum_{short}_item_state,
      round(sell_price / avg(sell_price) OVER (PARTITION BY store_id, item_id, {unit}), 6) AS price_momentum_{short}_item_store
    FROM p"""


def _momentum(spark, sf, short):
    names = [f"price_momentum_{short}_item_state", f"price_momentum_{short}_item_store"]
    return featured_prices(spark, sf).select("store_id", "item_id", "wm_yr_wk", *[F.round(n, 6).alias(n) for n in names])


@query("price_momentum_month", _momentum_sql("month"))
def price_momentum_month(spark, sf):
    """Price over the mean price of the month."""
    return _momentum(spark, sf, "m")


@query("price_momentum_year", _momentum_sql("year"))
def price_momentum_year(spark, sf):
    """Price over the mean price of the year."""
    return _momentum(spark, sf, "y")


@query(
    "weeks_on_sale",
    f"""WITH {r.SQL_PRICES}, n AS (SELECT store_id, item_id, wm_yr_wk,
      row_number() OVER (PARTITION BY store_id, item_id ORDER BY wm_yr_wk) AS k FROM prices)
    SELECT store_id, item_id, wm_yr_wk, CAST(k AS INTEGER) AS sell_start, round(ln(k), 6) AS sell_start_log FROM n""",
)
def weeks_on_sale(spark, sf):
    """Running count of weeks with a price, and its logarithm."""
    return featured_prices(spark, sf).select(
        "store_id", "item_id", "wm_yr_wk", "sell_start", F.round("sell_start_log", 6).alias("sell_start_log")
    )


@query(
    "price_minor_digits",
    f"""WITH {r.SQL_PRICES}, d AS (
      SELECT item_id, CAST(CAST(round(sell_price * 100) AS BIGINT) % 100 AS INTEGER) AS c FROM prices
      UNION ALL SELECT 'P' || p_partkey, NULL FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem))
    SELECT coalesce(c, 9999) AS minor_digits, coalesce(CASE WHEN c % 10 = 0 THEN c // 10 ELSE c END, 9999) AS minor_text,
           count(*) AS n FROM d GROUP BY 1, 2""",
)
def price_minor_digits(spark, sf):
    """digits after the point, 9999 for items without a price."""
    price = r.items(spark, sf).select("item_id").join(r.weekly_prices(spark, sf), "item_id", "left")
    return price.groupBy(
        fp.minor_digits(F.col("sell_price")).alias("minor_digits"),
        fp.minor_digits(F.col("sell_price"), as_text=True).alias("minor_text"),
    ).agg(F.count("*").alias("n"))


@query(
    "price_join",
    f"""WITH {r.SQL_PRICES}, f AS (SELECT *, CAST(floor((d - 1) / 7) AS INTEGER) AS w FROM leaf)
    SELECT f.store_id, f.cat_id, count(*) AS n, count(sell_price) AS n_priced, sum(sales * sell_price * 100)::BIGINT AS cents
    FROM f LEFT JOIN prices p ON p.store_id = f.store_id AND p.item_id = f.item_id AND p.wm_yr_wk = f.w + 1
    GROUP BY ALL""",
)
def price_join(spark, sf):
    """Revenue at the next week's price, where there is one."""
    fact = r.leaf_sales(spark, sf).withColumn("wm_yr_wk", F.floor((F.col("d") - 1) / 7).cast("int") + 1)
    priced = op.join_prices(fact, r.weekly_prices(spark, sf).select("store_id", "item_id", "wm_yr_wk", "sell_price"))
    cents = F.when(fp.has_price(F.col("sell_price")), fp.revenue(F.col("sales"), F.col("sell_price")) * 100)
    return priced.groupBy("store_id", "cat_id").agg(
        F.count("*").alias("n"), F.count("sell_price").alias("n_priced"), F.round(F.sum(cents)).cast("long").alias("cents")
    )


# ---------------------------------------------------------------- target


def target(spark, sf, horizon=0):
    return ot.add_residual(ot.add_baseline(dense(spark, sf, horizon)))


@query(
    "baseline_365",
    f"WITH {r.SQL_TARGET} SELECT id, CAST(d AS INTEGER) AS d, round(baseline, 6) AS baseline FROM target",
)
def baseline_365(spark, sf):
    """365-day mean that ends 28 days before."""
    return ot.add_baseline(dense(spark, sf)).select("id", "d", F.round("baseline", 6).alias("baseline"))


@query(
    "residual_target",
    f"WITH {r.SQL_TARGET} SELECT id, CAST(d AS INTEGER) AS d, sales, round(residual, 6) AS residual FROM target",
)
def residual_target(spark, sf):
    """Sales minus baseline."""
    return target(spark, sf).select("id", "d", "sales", F.round("residual", 6).alias("residual"))


@query(
    "baseline_on_days",
    f"""WITH {r.SQL_LEAF}, hi AS (SELECT max(d) AS hi FROM leaf),
    asked AS (SELECT id, unnest(range(hi - 27, hi + 1)) AS d FROM (SELECT DISTINCT id FROM leaf), hi)
    SELECT a.id, CAST(a.d AS INTEGER) AS d, round(coalesce(sum(l.sales), 0) / 365, 6) AS baseline
    FROM asked a LEFT JOIN leaf l ON l.id = a.id AND l.d BETWEEN a.d - 392 AND a.d - 28 GROUP BY a.id, a.d""",
)
def baseline_on_days(spark, sf):
    """W10 on the last 28 days of every sparse store x item series."""
    hi = r.last_day(spark, sf)
    rows = ot.baseline_on(r.leaf_sales(spark, sf), hi - 27, hi)
    return rows.select("id", "d", F.round("baseline", 6).alias("baseline"))


@query(
    "last_positive_day",
    f"""WITH {r.SQL_LEAF} SELECT id, CAST(coalesce(max(CASE WHEN sales > 0 AND d <= 1913 THEN d END), 0) AS INTEGER) AS last_sales
    FROM leaf GROUP BY 1""",
)
def last_positive_day(spark, sf):
    """Last day with sales up to a cut-off."""
    return ot.last_positive_day(r.leaf_sales(spark, sf), 1913)


@query(
    "first_positive_day",
    f"""WITH {r.SQL_LEAF} SELECT store_id, dept_id, CAST(coalesce(min(CASE WHEN sales > 0 THEN d END), 9999) AS INTEGER) AS first_day
    FROM leaf GROUP BY 1, 2""",
)
def first_positive_day(spark, sf):
    """First day with sales per node."""
    return ot.first_positive_day(r.leaf_sales(spark, sf), ["store_id", "dept_id"])


# ---------------------------------------------------------------- lags


def rolled(spark, sf, rolls, digits=4):
    rows = ol.add_rolls(target(spark, sf), rolls)
    return rows.select("id", "d", *[r.rounded(x.name, digits).alias(x.name) for x in rolls])


def _sql_roll(roll, value="residual", rounding=r.sql_rounded):
    """Window expression over the shifted column, as the definition has it: shift first, then roll."""
    shifted_value = f"lag({value}, {roll.shift}) OVER (PARTITION BY id ORDER BY d)"
    if roll.fn == "lag":
        return None, f"{rounding(shifted_value)} AS {roll.name}"
    col = f"s{roll.shift}"
    fn = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min", "median": "median", "skew": "skewness", "kurt": "kurtosis"}[roll.fn]
    over = (
        f"OVER (PARTITION BY id, d % {roll.stride} ORDER BY d ROWS BETWEEN {roll.window - 1} PRECEDING AND CURRENT ROW)"
    )
    expr = f"CASE WHEN count({col}) {over} = {roll.window} THEN {rounding(f'{fn}({col}) {over}')} END AS {roll.name}"
    return (f"{shifted_value} AS {col}", expr)


def _sql_rolls(rolls, rounding=r.sql_rounded):
    shifts, exprs = [], []
    for roll in rolls:
        s, e = _sql_roll(roll, rounding=rounding)
        if s and s not in shifts:
            shifts.append(s)
        exprs.append(e)
    inner = "target" if not shifts else f"(SELECT *, {', '.join(shifts)} FROM target)"
    return f"SELECT id, CAST(d AS INTEGER) AS d, {', '.join(exprs)} FROM {inner}"


def _register_rolls(name, rolls, doc):
    def run(spark, sf):
        return rolled(spark, sf, rolls)

    run.__doc__ = doc
    run.__name__ = name
    query(name, f"WITH {r.SQL_TARGET} {_sql_rolls(rolls)}")(run)


_register_rolls("lag_features", [ol.lag(s) for s in (1, 7, 14, 28, 41, 56)], "W1: plain lags.")
_register_rolls("roll_mean_stride7", ol.shifted(ol.WEEKLY_MEANS, [7]), "W2, W4: same-weekday means.")
_register_rolls("roll_max_min_stride7", ol.shifted(ol.WEEKLY_EXTREMES, [14]), "W5: same-weekday extremes.")
_register_rolls("roll_mean_stride235", ol.shifted(ol.STRIDED_MEANS, [3]), "W2, W3: every second, third and fifth day.")
_register_rolls(
    "roll_stats_daily",
    ol.shifted([x for x in ol.DAILY_MEANS + ol.DAILY_SPREADS if x.fn != "median"], [8]),
    "W6, W7, W8: daily mean, deviation and extremes.",
)
_register_rolls("roll_median_daily", ol.shifted([x for x in ol.DAILY_SPREADS if x.fn == "median"], [1]), "W9: rolling median.")
_register_rolls(
    "roll_skew_kurt", [ol.Roll(1, 14, "skew", 7), ol.Roll(1, 30, "kurt", 7), ol.Roll(1, 14, "std", 7), ol.Roll(1, 14, "max", 7)],
    "W16, W17, W18: plain shifted rolls with skewness and kurtosis.",
)


def _lag_frame_sql(h):
    rolls = lag_manifest(h)
    sums = ", ".join(f"round(sum({x.name}), 3) AS {x.name}, count({x.name}) AS n_{x.name}" for x in rolls)
    return f"WITH {r.SQL_TARGET} SELECT id, {sums} FROM ({_sql_rolls(rolls, str)}) GROUP BY id"


def _lag_frame(h):
    def run(spark, sf):
        rolls = lag_manifest(h)
        return ol.column_sums(ol.add_rolls(target(spark, sf), rolls), [x.name for x in rolls])

    run.__doc__ = f"R22, R5, F28: every lag column of horizon {h}, summed per series."
    return run


query("lag_frame_h7", _lag_frame_sql(7))(_lag_frame(7))
query("lag_frame_h9", _lag_frame_sql(9))(_lag_frame(9))


# ---------------------------------------------------------------- encodings


def encoding_fact(spark, sf):
    """Sparse sales with weekday and day of month; the value to encode is the sales."""
    cal = calendar(spark, sf).select("d", "wday", "day")
    return oc.join_calendar(r.leaf_sales(spark, sf), cal)


def encodings(spark, sf, part, terms=None):
    cutoffs = term_cutoffs(r.last_day(spark, sf))
    if terms is not None:
        cutoffs = {t: cutoffs[t] for t in terms}
    return encode(encoding_fact(spark, sf), cutoffs, value="sales", price=None, parts={part: PARTS[part]}, by_item=True)


SQL_ENC = f"""{r.SQL_LEAF},
enc AS (SELECT *, CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday, CAST(day(date) AS INTEGER) AS day FROM (
  SELECT *, DATE '{r.EPOCH}' + CAST(d AS INTEGER) AS date, (SELECT max(d) FROM leaf) AS hi FROM leaf))"""


def _enc_sql(part, cut=0, levels=ENCODED_LEVELS):
    col = {"all": None, "wday": "wday", "dom": "day"}[part]
    y = f"CASE WHEN d < hi + 1 - {cut * 28} THEN sales END"
    extra = (
        f"CAST({col or 'NULL'} AS INTEGER) AS part_value, count({y}) AS n, round(avg({y}), 4) AS mean, "
        f"round(stddev_samp({y}), 4) AS std"
    )
    return r.sql_nodes("enc", extra, col or "", levels)


def _round_enc(df):
    return df.select(
        "term", "level", "node", "part_value", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


def _register_encoding(name, part, doc):
    def run(spark, sf):
        return _round_enc(encodings(spark, sf, part, ["private"]))

    run.__doc__ = doc
    query(name, f"WITH {SQL_ENC} SELECT 'private' AS term, * FROM ({_enc_sql(part)})")(run)


_register_encoding("encode_level", "all", "A4, A5: mean and deviation per level.")
_register_encoding("encode_level_wday", "wday", "A4, A5: mean and deviation per level and weekday.")
_register_encoding("encode_level_dom", "dom", "A4, A5: mean and deviation per level and day of month.")


@query(
    "encode_cutoffs",
    f"WITH {SQL_ENC} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS term, * FROM ({_enc_sql('all', i)})" for i, t in enumerate(["private", "public", "validation", "semival"])
    ),
)
def encode_cutoffs(spark, sf):
    """The same encodings under four cut-offs, from one scan."""
    return _round_enc(encodings(spark, sf, "all"))


def type_target(spark, sf):
    """Dense days of every store and part type with residual, weekly price, weekday and day of the month."""
    leaf = r.type_sales(spark, sf)
    rows = orr.dense_days(leaf.select("id", *KEYS, "d", "sales"), 1, r.last_day(spark, sf), keep=KEYS)
    rows = ot.add_residual(ot.add_baseline(rows))
    prices = r.weekly_prices(spark, sf, leaf).select("store_id", "item_id", "wm_yr_wk", "sell_price")
    rows = op.join_prices(rows.withColumn("wm_yr_wk", F.floor((F.col("d") - 1) / 7).cast("int")), prices)
    return oc.join_calendar(rows, calendar(spark, sf).select("d", "wday", "day"))


SQL_TYPES = f"""{r.SQL_LEAF},
types AS (SELECT cat_id || '_' || store_id AS id, state_id, store_id, cat_id, cat_id AS dept_id, cat_id AS item_id, d,
  sum(sales) AS sales, sum(cents) AS cents FROM leaf GROUP BY ALL),
tdense AS (SELECT s.*, d, coalesce(sales, 0) AS sales FROM (SELECT DISTINCT id, state_id, store_id, cat_id, dept_id, item_id FROM types) s
  CROSS JOIN (SELECT unnest(range(1, (SELECT max(d) FROM types) + 1)) AS d) LEFT JOIN (SELECT id, d, sales FROM types) x USING (id, d)),
tprice AS (SELECT store_id, item_id, CAST(floor((d - 1) / 7) AS INTEGER) AS w, (sum(cents) // CAST(sum(sales) AS BIGINT)) / 100 AS sell_price FROM types GROUP BY ALL),
tbase AS (SELECT *, CASE WHEN count(sales) OVER b = 365 THEN sum(sales) OVER b / 365 END AS baseline FROM tdense
  WINDOW b AS (PARTITION BY id ORDER BY d ROWS BETWEEN 392 PRECEDING AND 28 PRECEDING)),
tfact AS (SELECT t.*, sales - baseline AS residual, sell_price, (SELECT max(d) FROM types) AS hi,
  CAST((dayofweek(DATE '{r.EPOCH}' + CAST(t.d AS INTEGER)) + 1) % 7 + 1 AS INTEGER) AS wday, CAST(day(DATE '{r.EPOCH}' + CAST(t.d AS INTEGER)) AS INTEGER) AS day
  FROM tbase t LEFT JOIN tprice p ON p.store_id = t.store_id AND p.item_id = t.item_id AND p.w = CAST(floor((t.d - 1) / 7) AS INTEGER))"""


def _encode_join_sql():
    joins, sums = [], []
    for part, extra in (("all", ""), ("wday", "wday"), ("dom", "day")):
        for level, keys in ENCODED_LEVELS.items():
            name, by = f"e_{part}_{level}", [*keys, *([extra] if extra else [])]
            on = " AND ".join(f"{name}.{k} = y.{k}" for k in by)
            joins.append(f"LEFT JOIN (SELECT {', '.join(by)}, avg(y) AS mean, stddev_samp(y) AS std FROM y GROUP BY ALL) {name} ON {on}")
            sums += [f"round(sum({name}.{fn}), 3) AS {encoding_name(part, level, fn)}" for fn in ("mean", "std")]
    return f"""WITH {SQL_TYPES}, y AS (SELECT *, CASE WHEN sell_price >= 0 AND d < hi - 27 THEN residual END AS y FROM tfact)
    SELECT y.id, count(*) AS n_days, {', '.join(sums)} FROM y {' '.join(joins)} GROUP BY y.id"""


@query("encode_join", _encode_join_sql())
def encode_join(spark, sf):
    """All 66 encodings of the residual of one term, masked by price, looked up for every day and summed per series."""
    path = table_path(spark, "type-target")
    fact = store.write_table(type_target(spark, sf), path)
    cutoffs = {"public": term_cutoffs(r.last_day(spark, sf))["public"]}
    rows = join_encodings(fact, fact.select("id", *KEYS).distinct(), encode(fact, cutoffs), "public")
    names = encoding_columns()
    return rows.groupBy("id").agg(F.count("*").alias("n_days"), *[F.round(F.sum(n), 3).alias(n) for n in names])


# ---------------------------------------------------------------- ingest


WIDE_DAYS = 420


def wide_lines(spark, sf):
    """The daily sales of the store and part-type series as lines of a wide CSV file, every 97th cell damaged."""
    leaf = r.type_sales(spark, sf).where(F.col("d") <= WIDE_DAYS)
    dense = orr.dense_days(leaf.select("id", *KEYS, "d", "sales"), 1, WIDE_DAYS, keep=KEYS)
    cell = F.when(F.pmod(F.crc32("id") + 13 * F.col("d"), F.lit(97)) == 0, F.concat(F.lit("?"), F.col("sales").cast("int")))
    text = dense.select("id", *KEYS, "d", F.coalesce(cell, F.col("sales").cast("int").cast("string")).alias("text"))
    return orr.pivot_first(text, ["id", *KEYS], "d", "text", range(1, WIDE_DAYS + 1), "d_")


def crc32_sql(x):
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)))"
    )


@query(
    "ingest_wide",
    f"""WITH {SQL_TYPES}, c AS (SELECT id, {crc32_sql("id")} AS h FROM (SELECT DISTINCT id FROM types WHERE d <= {WIDE_DAYS})),
    cell AS (SELECT c.id, g.d, coalesce(x.sales, 0) AS sales, (c.h + 13 * g.d) % 97 = 0 AS bad FROM c
      CROSS JOIN (SELECT unnest(range(1, {WIDE_DAYS + 1})) AS d) g LEFT JOIN types x ON x.id = c.id AND x.d = g.d)
    SELECT id, count(*) AS n_days, sum(CASE WHEN NOT bad THEN sales END)::BIGINT AS sales, count(CASE WHEN bad THEN 1 END) AS n_rejected,
      coalesce(string_agg(CASE WHEN bad THEN 'd_' || d || '=?' || CAST(sales AS INTEGER) END, ' ' ORDER BY d), '') AS rejected FROM cell GROUP BY id""",
)
def ingest_wide(spark, sf):
    """A wide matrix is written, scanned by its header and melted; cells that are no numbers go to a table of rejects."""
    path = table_path(spark, "wide")
    wide_lines(spark, sf).write.option("header", True).csv(path)
    good, rejects = scan.read_sales_wide_checked(spark, path)
    rejects = store.write_table(rejects, table_path(spark, "rejects"))
    days = scan.day_columns(good)
    facts = orr.melt_days(good, ["id"], days).groupBy("id").agg(F.count("*").alias("n_days"), F.sum("sales").cast("long").alias("sales"))
    texts = F.array_sort(F.collect_list(F.struct(F.substring("column", 3, 9).cast("int").alias("d"), "column", "text")))
    said = F.array_join(F.transform(texts, lambda x: F.concat(x["column"], F.lit("="), x["text"])), " ")
    per_id = rejects.groupBy("id").agg(F.count("*").alias("n_rejected"), said.alias("rejected"))
    return facts.join(per_id, "id", "left").na.fill({"n_rejected": 0, "rejected": ""})
