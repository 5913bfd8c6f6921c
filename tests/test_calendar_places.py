from __future__ import annotations

import calendar as pycalendar
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.functions import dates, geo
from curbline.operators import calendar, places
from curbline.plans import lookups

ORDINALS = ["first", "second", "third", "fourth"]
WEEKDAYS = [d.lower() for d in pycalendar.day_name]


def brute(year, month, rule):
    word = rule.strip().lower().replace(" ", "_")
    last = pycalendar.monthrange(year, month)[1]
    if word.isdigit():
        return date(year, month, int(word)) if 1 <= int(word) <= last else None
    ordinal, _, weekday = word.partition("_")
    if weekday not in WEEKDAYS:
        return None
    hits = [
        date(year, month, 1) + timedelta(days=i)
        for i in range(last)
        if (date(year, month, 1) + timedelta(days=i)).weekday() == WEEKDAYS.index(weekday)
    ]
    if ordinal == "last":
        return hits[-1]
    return hits[ORDINALS.index(ordinal)] if ordinal in ORDINALS else None


def test_every_rule_of_eight_years(frame):
    rules = [f"{o}_{w}" for o in [*ORDINALS, "last"] for w in WEEKDAYS]
    rules += ["1", "29", "30", "31", "32", "0", "fifth_monday", "", "monday", "third monday", " Last_Friday "]
    cases = [(y, m, r) for y in range(2019, 2027) for m in range(1, 13) for r in rules]
    df = frame("year int, month int, rule string", *cases)
    found = df.select(
        "year", "month", "rule", dates.nth_weekday(F.col("year"), F.col("month"), F.col("rule")).alias("day")
    ).collect()
    wrong = [r for r in found if r.day != brute(r.year, r.month, r.rule)]
    assert not wrong, wrong[:5]


def test_rule_without_month_or_text(frame):
    df = frame("year int, month int, rule string", (2024, None, "1"), (2024, 13, "first_monday"), (2024, 1, None))
    day = dates.nth_weekday(F.col("year"), F.col("month"), F.col("rule"))
    assert [r.day for r in df.select(day.alias("day")).collect()] == [None, None, None]


def test_holidays_of_2024(spark, frame):
    span = frame("start_year int, end_year int", (2024, 2024))
    found = {r.holiday_name: r.holiday_date for r in calendar.holiday_calendar(lookups.holidays(spark), span).collect()}
    assert len(found) == 12
    assert found["Thanksgiving Day"] == date(2024, 11, 28)
    assert found["Memorial Day"] == date(2024, 5, 27)
    assert found["Presidents' Day"] == date(2024, 2, 19)


def test_years_are_generated_not_joined(spark, frame):
    span = calendar.year_span(frame("pickup_datetime timestamp_ntz", (datetime(2020, 5, 1),), (datetime(2023, 5, 1),)))
    crossed = calendar.cross_years(lookups.holidays(spark), span)
    assert crossed.count() == 12 * 4
    text = crossed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text


def test_one_row_per_trip(spark, frame):
    trips = frame(
        "pickup_datetime timestamp_ntz",
        (datetime(2024, 12, 25, 23, 59, 59, 500000),),
        (datetime(2024, 12, 25, 23, 59, 59, 500000),),
        (datetime(2024, 2, 29),),
        (datetime(2024, 12, 28),),
        (datetime(2024, 12, 29),),
    )
    holidays = calendar.holiday_calendar(lookups.holidays(spark), calendar.year_span(trips))
    found = sorted(map(tuple, calendar.time_dimension(trips, holidays).collect()))
    assert len(found) == 5
    assert found[0][1:] == (2024, 2, 29, 5, "Thursday", 1, False, False)
    assert found[1][1:] == (2024, 12, 25, 4, "Wednesday", 4, False, True)
    assert [f[7] for f in found[3:]] == [True, True]


def test_month_tokens():
    assert dates.parse_month("2023_10") == (2023, 10)
    assert dates.month_after(2023, 12) == datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        dates.parse_month("2023_13")


def test_haversine(frame):
    df = frame("lat double, lon double", (40.7128, -74.0060), (34.0522, -118.2437), (None, 1.0))
    away = [r.d for r in df.select(geo.haversine_miles(F.col("lat"), F.col("lon"), (40.7128, -74.0060)).alias("d")).collect()]
    assert away[0] == pytest.approx(0, abs=1e-6)
    assert away[1] == pytest.approx(2445.6, abs=1)
    assert away[2] is None


def test_composite_zones_average_their_nearest_places(frame):
    zones = frame(
        "location_id int, borough string, zone string",
        (1, "Q", "Alpha/Beta"), (2, "Q", "Gamma"), (3, "Q", "Alpha & Nowhere"), (4, "X", "Alpha"), (5, None, None),
    )
    candidates = frame(
        "place string, borough string, lat double, lon double",
        ("Alpha", "Q", 40.0, -74.0), ("Alpha", "Q", 10.0, 10.0), ("Beta", "Q", 41.0, -73.0), ("Alpha", "Q", None, None),
    )
    found = {r.location_id: (r.latitude, r.longitude) for r in places.resolve_zone_points(zones, candidates).collect()}
    assert found == {1: (40.5, -73.5), 2: (None, None), 3: (40.0, -74.0), 4: (None, None), 5: (None, None)}


def test_overrides_fill_gaps_only(frame):
    zones = frame(
        "location_id int, latitude double, longitude double, geolocation string",
        (1, 1.0, 2.0, "(1.0, 2.0)"), (2, None, None, ""), (3, None, None, None), (4, None, 5.0, None),
    )
    fixes = frame("location_id int, lat double, lon double", (1, 9.0, 9.0), (2, 3.5, 4.5), (4, 6.0, 7.0))
    found = {r.location_id: tuple(r)[1:] for r in places.override_points(zones, fixes).collect()}
    assert found[1] == (1.0, 2.0, "(1.0, 2.0)")
    assert found[2] == (3.5, 4.5, "(3.5, 4.5)")
    assert found[3][:2] == (None, None)
    assert found[4][:2] == (6.0, 5.0)
    assert {r.location_id for r in places.missing_points(places.override_points(zones, fixes)).collect()} == {3}


def test_point_needs_both_coordinates(frame):
    df = frame("lat double, lon double", (1.0, 2.0), (None, 2.0))
    assert [r.p and tuple(r.p) for r in df.select(geo.point(F.col("lon"), F.col("lat")).alias("p")).collect()] == [(2.0, 1.0), None]
