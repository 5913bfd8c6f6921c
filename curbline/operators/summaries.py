"""Summary tables of the fact table.

Each groups the fact by its own small keys first and joins the lookup to the
few groups that are left, so the wide fact is never shuffled for a lookup and a
hot key arrives as one partial row per task. The ``*_from`` forms start from
partial groups instead, so that one scan of the fact can serve several summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import dates, geo, money
from curbline.operators import clean, joins, sets

_MEASURES = {"fare": "fare_amount", "distance": "trip_distance", "total": "total_amount"}


def _service(name: str) -> Column:
    return F.col("cab_type") == name


def _group_partials(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """Trip counts plus an exact sum and a count per measure."""
    aggs = [F.count("dwid").alias("trips"), F.count(F.lit(1)).alias("rows")]
    for name in measures:
        column = _MEASURES[name]
        aggs += [*money.sum_parts(column, name), F.count(column).alias(f"{name}_count")]
    for service in fixed.METERED_SERVICES:
        aggs.append(money.filtered_count("dwid", _service(service)).alias(f"{service}_trips"))
    return df.groupBy(*keys).agg(*aggs)


def _combine_partials(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up partial groups that share a label."""
    names = ["trips", "rows", *[f"{s}_trips" for s in fixed.METERED_SERVICES]]
    for name in measures:
        names += [f"{name}_high", f"{name}_low", f"{name}_count"]
    return df.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def _total(name: str) -> Column:
    return money.total_money(money.joined_sum(name))


def _mean(name: str) -> Column:
    return money.mean_money(money.joined_sum(name), F.col(f"{name}_count"))


def _service_counts() -> list[Column]:
    return [F.col(f"{s}_trips").alias(f"{s}_cab_trips") for s in fixed.METERED_SERVICES]


def code_partials(fact: DataFrame) -> DataFrame:
    """Partial groups by day, service and codes: enough for every summary without zones."""
    return _group_partials(
        fact,
        [
            F.to_date("pickup_datetime").alias("pickup_date"),
            "cab_type",
            "payment_type",
            "ratecode_id",
            "vendor_id",
        ],
        list(_MEASURES),
    )


def zone_partials(fact: DataFrame) -> DataFrame:
    """Partial groups by zone pair: enough for every summary by zone."""
    return _group_partials(fact, ["pu_location_id", "do_location_id"], ["fare", "distance"])


def zone_partials_by_month(fact: DataFrame) -> DataFrame:
    """Partial groups by month and zone pair, to be stored and added up over any months."""
    month = F.trunc(F.to_date("pickup_datetime"), "month").alias("pickup_month")
    return _group_partials(fact, [month, "pu_location_id", "do_location_id"], ["fare", "distance"])


def payment_summary(fact: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Trips and amounts by payment description, busiest first."""
    partials = _group_partials(
        fact.where(F.col("payment_type").isNotNull()), ["payment_type"], list(_MEASURES)
    )
    return payment_summary_from(partials, payment_types)


def payment_summary_from(partials: DataFrame, payment_types: DataFrame) -> DataFrame:
    labelled = joins.lookup_join(
        partials.where(F.col("payment_type").isNotNull()),
        payment_types,
        "payment_type",
        "payment_type_id",
    )
    return (
        _combine_partials(labelled, ["payment_type_description"], list(_MEASURES))
        .select(
            "payment_type_description",
            F.col("trips").alias("total_trips"),
            _total("fare").alias("total_fare"),
            _mean("fare").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
            _mean("total").alias("avg_total_amount"),
            *_service_counts(),
        )
        .orderBy(F.col("total_trips").desc(), "payment_type_description")
    )


def rate_code_summary(fact: DataFrame, rate_codes: DataFrame) -> DataFrame:
    """Metered trips and averages by rate code, unknown codes together."""
    metered = clean.in_domain(fact, "cab_type", fixed.METERED_SERVICES)
    partials = _group_partials(metered, ["cab_type", "ratecode_id"], list(_MEASURES))
    return rate_code_summary_from(partials, rate_codes)


def rate_code_summary_from(partials: DataFrame, rate_codes: DataFrame) -> DataFrame:
    labelled = joins.lookup_join(
        clean.in_domain(partials, "cab_type", fixed.METERED_SERVICES),
        rate_codes,
        "ratecode_id",
        "ratecode_id",
    ).withColumn("rate_code_description", F.coalesce("rate_code_description", F.lit("Unknown")))
    return (
        _combine_partials(labelled, ["rate_code_description"], list(_MEASURES))
        .select(
            "rate_code_description",
            F.col("trips").alias("total_trips"),
            _mean("fare").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
            _mean("total").alias("avg_total_amount"),
            *_service_counts(),
        )
        .orderBy(F.col("total_trips").desc(), "rate_code_description")
    )


def vendor_summary(fact: DataFrame, vendors: DataFrame) -> DataFrame:
    """Metered trips and amounts by vendor and service."""
    metered = clean.in_domain(fact, "cab_type", fixed.METERED_SERVICES)
    partials = _group_partials(metered, ["cab_type", "vendor_id"], list(_MEASURES))
    return vendor_summary_from(partials, vendors)


def vendor_summary_from(partials: DataFrame, vendors: DataFrame) -> DataFrame:
    labelled = joins.lookup_join(
        clean.in_domain(partials, "cab_type", fixed.METERED_SERVICES),
        vendors,
        "vendor_id",
        "vendor_id",
    )
    return (
        _combine_partials(labelled, ["vendor_name", "cab_type"], list(_MEASURES))
        .select(
            "vendor_name",
            "cab_type",
            F.col("trips").alias("total_trips"),
            _total("fare").alias("total_fare"),
            _mean("fare").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
            _mean("total").alias("avg_total_amount"),
            *_service_counts(),
        )
        .orderBy(F.col("total_trips").desc(), "vendor_name", "cab_type")
    )


def monthly_service_counts(fact: DataFrame) -> DataFrame:
    """Trips by year, month and service."""
    months = [F.trunc(F.to_date("pickup_datetime"), "month").alias("pickup_date"), "cab_type"]
    return monthly_service_counts_from(
        fact.groupBy(*months).agg(F.count(F.lit(1)).alias("rows"))
    )


def monthly_service_counts_from(partials: DataFrame) -> DataFrame:
    counts = partials.groupBy(
        F.year("pickup_date").alias("year"), F.month("pickup_date").alias("month"), "cab_type"
    ).agg(F.sum("rows").alias("total_trips"))
    return sets.order_summary(counts, ["year", "month", "cab_type"])


def daily_summary(fact: DataFrame, holidays: DataFrame) -> DataFrame:
    """Trips and amounts by day, with weekday, weekend and holiday."""
    day = F.to_date("pickup_datetime").alias("pickup_date")
    return _daily(_group_partials(fact, [day], list(_MEASURES)), holidays)


def daily_summary_from(partials: DataFrame, holidays: DataFrame) -> DataFrame:
    return _daily(_combine_partials(partials, ["pickup_date"], list(_MEASURES)), holidays)


def _daily(days: DataFrame, holidays: DataFrame) -> DataFrame:
    when = F.col("pickup_date")
    return joins.calendar_join(days, holidays, "pickup_date").select(
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        F.day(when).alias("day"),
        F.dayofweek(when).alias("day_of_week"),
        dates.weekend_flag(when).alias("is_weekend"),
        F.coalesce("holiday_name", F.lit("None")).alias("holiday_name"),
        F.col("holiday_name").isNotNull().alias("holiday_flag"),
        F.col("rows").alias("total_trips"),
        _total("fare").alias("total_fare"),
        _mean("fare").alias("avg_fare"),
        _total("distance").alias("total_distance"),
        _mean("distance").alias("avg_distance"),
        _total("total").alias("total_amount"),
        _mean("total").alias("avg_total_amount"),
    )


def pickup_zone_summary(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and averages by pickup zone."""
    partials = _group_partials(fact, ["pu_location_id"], ["fare", "distance"])
    return _zone_summary(partials, zones, "pu_location_id", "pickup")


def dropoff_zone_summary(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and averages by dropoff zone."""
    partials = _group_partials(fact, ["do_location_id"], ["fare", "distance"])
    return _zone_summary(partials, zones, "do_location_id", "dropoff")


def pickup_zone_summary_from(partials: DataFrame, zones: DataFrame) -> DataFrame:
    per_zone = _combine_partials(partials, ["pu_location_id"], ["fare", "distance"])
    return _zone_summary(per_zone, zones, "pu_location_id", "pickup")


def dropoff_zone_summary_from(partials: DataFrame, zones: DataFrame) -> DataFrame:
    per_zone = _combine_partials(partials, ["do_location_id"], ["fare", "distance"])
    return _zone_summary(per_zone, zones, "do_location_id", "dropoff")


def _zone_summary(per_zone: DataFrame, zones: DataFrame, fk: str, suffix: str) -> DataFrame:
    attributes = ["borough", "zone", "latitude", "longitude", "geolocation"]
    labelled = joins.role_join(per_zone, zones, "location_id", {suffix: fk}, attributes)
    return labelled.select(
        fk,
        *[f"{a}_{suffix}" for a in attributes],
        F.col("trips").alias("total_trips"),
        F.coalesce(_mean("fare"), F.lit(0.0)).alias("avg_fare"),
        F.coalesce(_mean("distance"), F.lit(0.0)).alias("avg_distance"),
    )


def with_point(summary: DataFrame, suffix: str) -> DataFrame:
    """A zone summary with ``point_<suffix>`` in place of its two coordinates, NULL where one is missing."""
    lon, lat = f"longitude_{suffix}", f"latitude_{suffix}"
    return summary.withColumn(f"point_{suffix}", geo.point(F.col(lon), F.col(lat))).drop(lon, lat)


def flow_matrix(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips by pickup and dropoff borough, both known."""
    pairs = fact.groupBy("pu_location_id", "do_location_id").agg(F.count(F.lit(1)).alias("rows"))
    return flow_matrix_from(pairs, zones)


def flow_matrix_from(partials: DataFrame, zones: DataFrame) -> DataFrame:
    named = joins.role_join(
        partials,
        zones,
        "location_id",
        {"pickup": "pu_location_id", "dropoff": "do_location_id"},
        ["borough"],
    )
    return (
        named.where(F.col("borough_pickup").isNotNull() & F.col("borough_dropoff").isNotNull())
        .groupBy("borough_pickup", "borough_dropoff")
        .agg(F.sum("rows").alias("total_trips"))
    )


#: A wide matrix has at most so many columns; a lookup with more boroughs is an error.
MOST_BOROUGHS = 500


def flow_pivot(
    fact: DataFrame, zones: DataFrame, boroughs: Sequence[str] | None = None
) -> DataFrame:
    """The flow matrix with one column per dropoff borough, absent pairs 0.

    Column names must be known to plan a pivot; unless given they are the
    boroughs of the lookup, ``MOST_BOROUGHS`` at most.
    """
    pairs = fact.groupBy("pu_location_id", "do_location_id").agg(F.count(F.lit(1)).alias("rows"))
    return flow_pivot_from(pairs, zones, boroughs)


def flow_pivot_from(
    partials: DataFrame, zones: DataFrame, boroughs: Sequence[str] | None = None
) -> DataFrame:
    if boroughs is None:
        names = zones.select("borough").where(F.col("borough").isNotNull()).distinct()
        boroughs = sorted(row.borough for row in names.limit(MOST_BOROUGHS + 1).collect())
    if len(boroughs) > MOST_BOROUGHS:
        raise ValueError(f"more than {MOST_BOROUGHS} boroughs don't make a matrix")
    return (
        flow_matrix_from(partials, zones)
        .groupBy("borough_pickup")
        .pivot("borough_dropoff", list(boroughs))
        .agg(F.sum("total_trips"))
        .na.fill(0)
    )


def time_bounds(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """First and last time and year, in one pass."""
    return df.agg(F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts")).select(
        "min_ts", "max_ts", F.year("min_ts").alias("min_year"), F.year("max_ts").alias("max_year")
    )


def count_by_lookup(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str, label: str, k: int
) -> DataFrame:
    """The ``k`` most frequent descriptions of a code."""
    partial = fact.groupBy(fk).agg(F.count("dwid").alias("n"))
    labelled = joins.lookup_join(partial, dim, fk, pk, [label])
    counts = labelled.groupBy(label).agg(F.sum("n").alias("total_trips"))
    return sets.top_k(counts, "total_trips", k, [label])


def avg_fare_by_zone(fact: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` pickup zones with the highest average fare."""
    partial = _group_partials(
        fact.where(F.col("fare_amount").isNotNull()), ["pu_location_id"], ["fare"]
    )
    labelled = joins.lookup_join(
        partial, zones, "pu_location_id", "location_id", ["zone", "borough"]
    )
    averages = _combine_partials(labelled, ["zone", "borough"], ["fare"]).select(
        "zone", "borough", _mean("fare").alias("average_fare")
    )
    return sets.top_k(averages, "average_fare", k, ["zone", "borough"])


def zone_counts(
    fact: DataFrame,
    zones: DataFrame,
    k: int,
    borough: str | None = None,
    fk: str = "pu_location_id",
    known_only: bool = False,
) -> DataFrame:
    """The ``k`` busiest zones, of one borough if given."""
    partial = fact.groupBy(fk).agg(F.count("dwid").alias("n"))
    labelled = joins.lookup_join(partial, zones, fk, "location_id", ["zone", "borough"])
    if borough is not None:
        labelled = labelled.where(F.col("borough") == borough)
    if known_only:
        labelled = labelled.where(F.col("zone").isNotNull())
    counts = labelled.groupBy("zone", "borough").agg(F.sum("n").alias("total_trips"))
    return sets.top_k(counts, "total_trips", k, ["borough", "zone"])


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys against rows."""
    return df.agg(
        F.count_distinct(key).alias("distinct_keys"), F.count(F.lit(1)).alias("total_rows")
    ).withColumn("is_unique", F.col("distinct_keys") == F.col("total_rows"))
