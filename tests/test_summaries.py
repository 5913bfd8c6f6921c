from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from curbline.functions import money
from curbline.operators import summaries
from curbline.plans import lookups

FACT = (
    "dwid string, cab_type string, fare_amount float, total_amount float, trip_distance float,"
    " ratecode_id int, vendor_id int, pu_location_id int, do_location_id int,"
    " pickup_datetime timestamp_ntz, payment_type int"
)
NOON = datetime(2024, 7, 4, 12)
ZONES = "location_id int, borough string, zone string, latitude double, longitude double, geolocation string"


@pytest.fixture
def fact(frame):
    return frame(
        FACT,
        ("a", "yellow", 10.0, 12.0, 1.0, 1, 1, 1, 2, NOON, 1),
        ("b", "yellow", 10.01, 12.0, 2.0, 1, 2, 1, 9, NOON, 2),
        ("c", "green", 5.0, 6.0, 3.0, None, None, 2, 1, NOON, 9),
        ("d", "fhv", None, None, None, None, None, None, 1, NOON, 5),
        ("e", "green", 7.5, 8.0, 3.0, 99, 1, 9, 9, NOON, 0),
        ("f", "yellow", 7.5, 8.0, 3.0, 2, 1, 1, 1, NOON, None),
    )


@pytest.fixture
def zones(frame):
    return frame(ZONES, (1, "North", "One", 1.0, 2.0, "(1.0, 2.0)"), (2, "South", "Two", None, None, "N/A"))


def test_payment_summary_keeps_the_unmatched_group(spark, fact):
    found = [tuple(r) for r in summaries.payment_summary(fact, lookups.payment_types(spark)).collect()]
    assert found[0] == (None, 2, 12.5, 6.25, 3.0, 7.0, 0, 2)
    assert ("Unknown", 1, None, None, None, None, 0, 0) in found
    assert sum(r[1] for r in found) == 5


def test_rate_codes_unknown_together(spark, fact):
    found = {r.rate_code_description: r for r in summaries.rate_code_summary(fact, lookups.rate_codes(spark)).collect()}
    assert found["Unknown"].total_trips == 2 and found["Unknown"].green_cab_trips == 2
    assert found["Standard Rate"].avg_fare == 10.01  # 20.01 / 2 is a tie
    assert set(found) == {"Unknown", "Standard Rate", "JFK"}


def test_zone_summary_defaults_averages_to_zero(fact, zones):
    found = {r.pu_location_id: r for r in summaries.pickup_zone_summary(fact, zones).collect()}
    assert found[None].avg_fare == 0.0 and found[None].total_trips == 1
    assert found[9].borough_pickup is None
    assert found[1].total_trips == 3 and found[1].zone_pickup == "One"


def test_flow_needs_both_boroughs(fact, zones):
    found = {(r.borough_pickup, r.borough_dropoff): r.total_trips for r in summaries.flow_matrix(fact, zones).collect()}
    assert found == {("North", "South"): 1, ("South", "North"): 1, ("North", "North"): 1}
    wide = {r.borough_pickup: r.asDict() for r in summaries.flow_pivot(fact, zones).collect()}
    assert wide["South"] == {"borough_pickup": "South", "North": 1, "South": 0}


def test_summaries_from_partials_agree(spark, fact, zones, rows):
    codes, pairs = summaries.code_partials(fact), summaries.zone_partials(fact)
    for direct, indirect in [
        (summaries.payment_summary(fact, lookups.payment_types(spark)), summaries.payment_summary_from(codes, lookups.payment_types(spark))),
        (summaries.rate_code_summary(fact, lookups.rate_codes(spark)), summaries.rate_code_summary_from(codes, lookups.rate_codes(spark))),
        (summaries.vendor_summary(fact, lookups.vendors(spark)), summaries.vendor_summary_from(codes, lookups.vendors(spark))),
        (summaries.monthly_service_counts(fact), summaries.monthly_service_counts_from(codes)),
        (summaries.pickup_zone_summary(fact, zones), summaries.pickup_zone_summary_from(pairs, zones)),
        (summaries.dropoff_zone_summary(fact, zones), summaries.dropoff_zone_summary_from(pairs, zones)),
        (summaries.flow_matrix(fact, zones), summaries.flow_matrix_from(pairs, zones)),
    ]:
        assert rows(direct) == rows(indirect)


def test_summaries_of_nothing(spark, fact, zones):
    none = fact.where("dwid = 'z'")
    assert summaries.payment_summary(none, lookups.payment_types(spark)).count() == 0
    assert summaries.flow_matrix(none, zones).count() == 0
    assert summaries.key_uniqueness(none, "dwid").first().is_unique


def test_counts_are_grouped_before_the_lookup_join(fact, zones):
    text = summaries.flow_matrix(fact, zones)._jdf.queryExecution().optimizedPlan().toString()
    join, first_aggregate = text.index("Join"), text.rindex("Aggregate [pu_location_id")
    assert join < first_aggregate  # the aggregate lies below the join


def test_sums_are_exact_in_any_order(frame):
    values = [0.1, 0.2, 0.3, 99999.99, 1e-6, -5.005, 12345678.9, 0.005] * 400
    df = frame("v double", *[(v,) for v in values])
    exact = sum(Decimal(repr(v)) for v in values)
    cents = Decimal("0.01")
    for parts in (1, 7):
        total = df.repartition(parts).agg(*money.sum_parts("v", "x"), F.count("v").alias("n"))
        row = total.select(
            money.total_money(money.joined_sum("x")).alias("t"),
            money.mean_money(money.joined_sum("x"), F.col("n")).alias("m"),
        ).first()
        assert row.t == float(exact.quantize(cents, ROUND_HALF_UP))
        assert row.m == float((exact / len(values)).quantize(cents, ROUND_HALF_UP))


def test_negative_ties_round_away_from_zero(frame):
    row = frame("v double", (-0.005,), (-0.01,)).agg(*money.sum_parts("v", "x"), F.count("v").alias("n")).select(
        money.total_money(money.joined_sum("x")).alias("t"), money.mean_money(money.joined_sum("x"), F.col("n")).alias("m")
    ).first()
    assert (row.t, row.m) == (-0.02, -0.01)


def test_amounts_that_are_no_number_raise(frame):
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        frame("v double", (float("nan"),)).agg(*money.sum_parts("v", "x")).collect()


def test_round_money_half_away(frame):
    df = frame("v decimal(10,4)", (Decimal("1.0050"),), (Decimal("-1.0050"),), (Decimal("2.6750"),))
    assert [r.r for r in df.select(money.round_money(F.col("v")).alias("r")).collect()] == [1.01, -1.01, 2.68]
