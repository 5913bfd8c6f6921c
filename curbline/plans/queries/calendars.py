"""Calendar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.functions import dates
from curbline.operators import calendar, joins
from curbline.plans import lookups, standins
from curbline.plans.queries.registry import oracle, query, values

# Rules of every kind, among them some that name no day.
RULES = [
    "1",
    "29",
    "31",
    "first_sunday",
    "second_monday",
    "third tuesday",
    "Fourth_Wednesday",
    "last_thursday",
    "last_friday",
    " first_saturday ",
    "fifth_monday",
    "first_noday",
    "",
]

_MONTHS = """SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders"""
_DAYS = """SELECT y, m, day, day(day) AS dom, lower(dayname(day)) AS weekday,
        row_number() OVER (PARTITION BY y, m, dayname(day) ORDER BY day) AS nth,
        row_number() OVER (PARTITION BY y, m, dayname(day) ORDER BY day DESC) AS nth_last
    FROM (SELECT y, m, unnest(generate_series(make_date(y, m, 1)::TIMESTAMP,
        last_day(make_date(y, m, 1))::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM months)"""


@query(
    oracle(
        """SELECT CAST(months.y AS INTEGER) AS year, CAST(months.m AS INTEGER) AS month, rule,
            CAST(min(d.day) AS DATE) AS holiday_date
        FROM months CROSS JOIN rules LEFT JOIN days d ON d.y = months.y AND d.m = months.m AND (
            CAST(d.dom AS VARCHAR) = word
            OR (d.nth = 1 AND word = 'first_' || weekday) OR (d.nth = 2 AND word = 'second_' || weekday)
            OR (d.nth = 3 AND word = 'third_' || weekday) OR (d.nth = 4 AND word = 'fourth_' || weekday)
            OR (d.nth_last = 1 AND word = 'last_' || weekday))
        GROUP BY 1, 2, 3""",
        months=_MONTHS,
        days=_DAYS,
        rules="SELECT rule, replace(lower(trim(rule)), ' ', '_') AS word FROM ("
        + values([(r,) for r in RULES], ["rule"])
        + ")",
    )
)
def nth_weekday(spark, sf):
    months = (
        standins.table(spark, sf, "orders")
        .select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .distinct()
    )
    rules = F.explode(F.array(*[F.lit(r) for r in RULES]))
    return months.withColumn("rule", rules).withColumn(
        "holiday_date", dates.nth_weekday(F.col("year"), F.col("month"), F.col("rule"))
    )


@query(
    oracle(
        """SELECT holiday_name, CAST(month AS INTEGER) AS month, day_or_rule, CAST(year AS INTEGER) AS year
        FROM holiday_rules CROSS JOIN (SELECT unnest(generate_series(
            min(year(pickup_datetime)), max(year(pickup_datetime)))) AS year FROM fact)""",
        "fact",
        "holiday_rules",
    )
)
def cross_years(spark, sf):
    rules = lookups.holidays(spark).select("holiday_name", "month", "day_or_rule")
    return calendar.cross_years(rules, calendar.year_span(standins.fact(spark, sf)))


@query(oracle("SELECT holiday_date, holiday_name FROM holidays", "holidays"))
def holiday_calendar(spark, sf):
    return _holidays(spark, standins.fact(spark, sf))


def _holidays(spark, fact):
    return calendar.holiday_calendar(lookups.holidays(spark), calendar.year_span(fact))


@query(
    oracle(
        """SELECT f.*, holiday_name FROM fact f
        LEFT JOIN day_names ON CAST(pickup_datetime AS DATE) = holiday_date""",
        "fact",
        "day_names",
    )
)
def calendar_join(spark, sf):
    fact = standins.fact(spark, sf)
    return joins.calendar_join(fact, _holidays(spark, fact))


TIME = """SELECT pickup_datetime, CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(day(pickup_datetime) AS INTEGER) AS day,
        CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
        dayname(pickup_datetime) AS day_name, CAST(quarter(pickup_datetime) AS INTEGER) AS quarter,
        dayofweek(pickup_datetime) IN (0, 6) AS is_weekend, holiday_name IS NOT NULL AS holiday_flag
    FROM fact LEFT JOIN day_names ON CAST(pickup_datetime AS DATE) = holiday_date"""


@query(oracle(TIME, "fact", "day_names"))
def time_dimension(spark, sf):
    fact = standins.fact(spark, sf)
    return calendar.time_dimension(fact, _holidays(spark, fact))


@query(
    """SELECT CAST(o_orderdate AS DATE) AS day, dayofweek(o_orderdate) IN (0, 6) AS is_weekend,
        count(*) AS n FROM orders GROUP BY 1, 2"""
)
def weekend_flag(spark, sf):
    day = F.to_date("o_orderdate")
    return (
        standins.table(spark, sf, "orders")
        .groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("is_weekend", dates.weekend_flag(F.col("day")))
    )
