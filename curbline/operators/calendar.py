"""Holiday rules and the time dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import dates
from curbline.operators import joins


def year_span(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """One row: first and last year."""
    return df.agg(
        F.year(F.min(ts_col)).alias("start_year"), F.year(F.max(ts_col)).alias("end_year")
    )


def cross_years(rules: DataFrame, span: DataFrame) -> DataFrame:
    """Every rule once per year of the span.

    The span's two numbers are scalar subqueries and the years are generated
    next to each rule, so nothing is joined.
    """
    start, end = span.select("start_year").scalar(), span.select("end_year").scalar()
    return rules.withColumn("year", F.explode(F.sequence(start, end)))


def holiday_calendar(rules: DataFrame, span: DataFrame) -> DataFrame:
    """``holiday_date, holiday_name`` for every rule and year; unresolvable rules go."""
    day = dates.nth_weekday(F.col("year"), F.col("month"), F.col("day_or_rule"))
    return (
        cross_years(rules, span)
        .select(day.alias("holiday_date"), "holiday_name")
        .where(F.col("holiday_date").isNotNull())
    )


def time_dimension(
    fact: DataFrame, holidays: DataFrame, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """Calendar attributes of every trip, one row per trip."""
    ts = F.col(ts_col)
    return calendar_attributes(
        joins.calendar_join(fact.select(ts_col), holidays, ts_col).withColumn(
            "holiday_flag", F.col("holiday_name").isNotNull()
        ),
        ts_col,
    ).select(
        ts,
        "year",
        "month",
        "day",
        "day_of_week",
        "day_name",
        "quarter",
        "is_weekend",
        "holiday_flag",
    )


def calendar_attributes(df: DataFrame, ts_col: str) -> DataFrame:
    """Add year to weekend flag; weekdays count from 1 = Sunday."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.day(ts),
            "day_of_week": F.dayofweek(ts),
            # Looking a name up costs far less than formatting a date.
            "day_name": F.element_at(F.lit(list(fixed.DAY_NAMES)), F.dayofweek(ts)),
            "quarter": F.quarter(ts),
            "is_weekend": dates.weekend_flag(ts),
        }
    )
