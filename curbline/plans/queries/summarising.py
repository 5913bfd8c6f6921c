"""Summary tables and zone coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.functions import money
from curbline.operators import calendar, places, summaries
from curbline.plans import lookups, standins
from curbline.plans.queries.registry import money_avg, money_sum, oracle, query

_AVERAGES = f"""{money_avg('fare_amount')} AS avg_fare,
    {money_avg('trip_distance')} AS avg_distance, {money_avg('total_amount')} AS avg_total_amount"""
_SERVICES = """count(dwid) FILTER (WHERE cab_type = 'yellow') AS yellow_cab_trips,
    count(dwid) FILTER (WHERE cab_type = 'green') AS green_cab_trips"""

PAYMENT = f"""SELECT payment_type_description, count(dwid) AS total_trips,
    {money_sum('fare_amount')} AS total_fare, {_AVERAGES}, {_SERVICES}
    FROM fact LEFT JOIN payment_types ON payment_type = payment_type_id
    WHERE payment_type IS NOT NULL GROUP BY 1 ORDER BY total_trips DESC"""

RATE_CODE = f"""SELECT coalesce(rate_code_description, 'Unknown') AS rate_code_description,
    count(dwid) AS total_trips, {_AVERAGES}, {_SERVICES}
    FROM fact LEFT JOIN rate_codes USING (ratecode_id)
    WHERE cab_type IN ('yellow', 'green') GROUP BY 1 ORDER BY total_trips DESC"""

VENDOR = f"""SELECT vendor_name, cab_type, count(dwid) AS total_trips,
    {money_sum('fare_amount')} AS total_fare, {_AVERAGES}, {_SERVICES}
    FROM fact LEFT JOIN vendors USING (vendor_id)
    WHERE cab_type IN ('yellow', 'green') GROUP BY 1, 2 ORDER BY total_trips DESC"""

MONTHLY = """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month, cab_type, count(*) AS total_trips
    FROM fact GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""

DAILY = f"""SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    dayofweek(d) IN (0, 6) AS is_weekend, coalesce(holiday_name, 'None') AS holiday_name,
    holiday_name IS NOT NULL AS holiday_flag, count(*) AS total_trips,
    {money_sum('fare_amount')} AS total_fare, {money_avg('fare_amount')} AS avg_fare,
    {money_sum('trip_distance')} AS total_distance, {money_avg('trip_distance')} AS avg_distance,
    {money_sum('total_amount')} AS total_amount, {money_avg('total_amount')} AS avg_total_amount
    FROM (SELECT *, CAST(pickup_datetime AS DATE) AS d FROM fact) LEFT JOIN day_names ON d = holiday_date
    GROUP BY d, holiday_name"""


def zone_summary(fk: str, suffix: str) -> str:
    attributes = ["borough", "zone", "latitude", "longitude", "geolocation"]
    return f"""SELECT {fk}, {', '.join(f'{a} AS {a}_{suffix}' for a in attributes)},
        count(dwid) AS total_trips, coalesce({money_avg('fare_amount')}, 0) AS avg_fare,
        coalesce({money_avg('trip_distance')}, 0) AS avg_distance
        FROM fact LEFT JOIN zones ON {fk} = location_id
        GROUP BY {fk}, {', '.join(attributes)}"""


FLOW = """SELECT p.borough AS borough_pickup, d.borough AS borough_dropoff, count(*) AS total_trips
    FROM {fact} f JOIN zones p ON f.pu_location_id = p.location_id
    JOIN zones d ON f.do_location_id = d.location_id GROUP BY 1, 2"""


def _holidays(spark, sf, fact):
    return calendar.holiday_calendar(lookups.holidays(spark), calendar.year_span(fact))


@query(oracle(PAYMENT, "fact", "payment_types"))
def payment_summary(spark, sf):
    return summaries.payment_summary(standins.fact(spark, sf), lookups.payment_types(spark))


@query(oracle(RATE_CODE, "fact", "rate_codes"))
def rate_code_summary(spark, sf):
    return summaries.rate_code_summary(standins.fact(spark, sf), lookups.rate_codes(spark))


@query(oracle(VENDOR, "fact", "vendors"))
def vendor_summary(spark, sf):
    return summaries.vendor_summary(standins.fact(spark, sf), lookups.vendors(spark))


@query(oracle(MONTHLY, "fact"))
def monthly_service_counts(spark, sf):
    return summaries.monthly_service_counts(standins.fact(spark, sf))


@query(oracle(DAILY, "fact", "day_names"))
def daily_summary(spark, sf):
    fact = standins.fact(spark, sf)
    return summaries.daily_summary(fact, _holidays(spark, sf, fact))


@query(oracle(zone_summary("pu_location_id", "pickup"), "fact", "zones"))
def pickup_zone_summary(spark, sf):
    return summaries.pickup_zone_summary(standins.fact(spark, sf), standins.zones(spark, sf))


@query(oracle(zone_summary("do_location_id", "dropoff"), "fact", "zones"))
def dropoff_zone_summary(spark, sf):
    return summaries.dropoff_zone_summary(standins.fact(spark, sf), standins.zones(spark, sf))


_POINTS = "SELECT * EXCLUDE (longitude_{0}, latitude_{0}), CASE WHEN latitude_{0} IS NOT NULL THEN longitude_{0} END AS lon, CASE WHEN longitude_{0} IS NOT NULL THEN latitude_{0} END AS lat FROM ({1})"


@query(oracle(_POINTS.format("pickup", zone_summary("pu_location_id", "pickup")), "fact", "zones"))
def pickup_zone_points(spark, sf):
    """The pickup summary with a point for its zones."""
    found = summaries.with_point(summaries.pickup_zone_summary(standins.fact(spark, sf), standins.zones(spark, sf)), "pickup")
    return found.select("*", "point_pickup.lon", "point_pickup.lat").drop("point_pickup")


@query(oracle(_POINTS.format("dropoff", zone_summary("do_location_id", "dropoff")), "fact", "zones"))
def dropoff_zone_points(spark, sf):
    found = summaries.with_point(summaries.dropoff_zone_summary(standins.fact(spark, sf), standins.zones(spark, sf)), "dropoff")
    return found.select("*", "point_dropoff.lon", "point_dropoff.lat").drop("point_dropoff")


@query(oracle(FLOW.format(fact="yellow"), "yellow", "zones"))
def flow_matrix(spark, sf):
    return summaries.flow_matrix(standins.trips(spark, sf, "yellow"), standins.zones(spark, sf))


@query(oracle(FLOW.format(fact="fact"), "fact", "zones"))
def flow_matrix_all_services(spark, sf):
    return summaries.flow_matrix(standins.fact(spark, sf), standins.zones(spark, sf))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


PIVOT = (
    "SELECT borough_pickup, "
    + ", ".join(
        f"CAST(coalesce(sum(total_trips) FILTER (WHERE borough_dropoff = '{r}'), 0) AS BIGINT)" f' AS "{r}"'
        for r in REGIONS
    )
    + f" FROM ({FLOW.format(fact='fact')}) GROUP BY 1"
)


@query(oracle(PIVOT, "fact", "zones"))
def flow_pivot(spark, sf):
    return summaries.flow_pivot(standins.fact(spark, sf), standins.zones(spark, sf))


@query(
    oracle(
        """SELECT min(pickup_datetime) AS min_ts, max(pickup_datetime) AS max_ts,
            CAST(min(year(pickup_datetime)) AS INTEGER) AS min_year,
            CAST(max(year(pickup_datetime)) AS INTEGER) AS max_year FROM fact""",
        "fact",
    )
)
def time_bounds(spark, sf):
    return summaries.time_bounds(standins.fact(spark, sf))


_BY_LOOKUP = """SELECT {label}, count(dwid) AS total_trips FROM fact LEFT JOIN {dim} ON fact.{fk} = {dim}.{pk}
    GROUP BY 1 ORDER BY total_trips DESC, {label} NULLS FIRST LIMIT 10"""


@query(
    oracle(
        _BY_LOOKUP.format(
            label="payment_type_description", dim="payment_types", fk="payment_type", pk="payment_type_id"
        ),
        "fact",
        "payment_types",
    )
)
def count_by_payment_type(spark, sf):
    return summaries.count_by_lookup(
        standins.fact(spark, sf),
        lookups.payment_types(spark),
        "payment_type",
        "payment_type_id",
        "payment_type_description",
        10,
    )


@query(
    oracle(
        _BY_LOOKUP.format(
            label="rate_code_description", dim="rate_codes", fk="ratecode_id", pk="ratecode_id"
        ),
        "fact",
        "rate_codes",
    )
)
def count_by_rate_code(spark, sf):
    return summaries.count_by_lookup(
        standins.fact(spark, sf),
        lookups.rate_codes(spark),
        "ratecode_id",
        "ratecode_id",
        "rate_code_description",
        10,
    )


@query(
    oracle(
        _BY_LOOKUP.format(label="vendor_name", dim="vendors", fk="vendor_id", pk="vendor_id"),
        "fact",
        "vendors",
    )
)
def count_by_vendor(spark, sf):
    return summaries.count_by_lookup(
        standins.fact(spark, sf), lookups.vendors(spark), "vendor_id", "vendor_id", "vendor_name", 10
    )


@query(
    oracle(
        f"""SELECT zone, borough, {money_avg('fare_amount')} AS average_fare
        FROM fact LEFT JOIN zones ON pu_location_id = location_id WHERE fare_amount IS NOT NULL
        GROUP BY 1, 2 ORDER BY average_fare DESC, zone NULLS FIRST, borough NULLS FIRST LIMIT 10""",
        "fact",
        "zones",
    )
)
def avg_fare_by_zone(spark, sf):
    return summaries.avg_fare_by_zone(standins.fact(spark, sf), standins.zones(spark, sf))


_ZONE_COUNTS = """SELECT zone, borough, count(dwid) AS total_trips
    FROM fact LEFT JOIN zones ON {fk} = location_id WHERE {where} GROUP BY 1, 2
    ORDER BY total_trips DESC, borough NULLS FIRST, zone NULLS FIRST LIMIT {k}"""


@query(
    oracle(
        _ZONE_COUNTS.format(fk="pu_location_id", where="zone IS NOT NULL", k=20), "fact", "zones"
    )
)
def zone_counts(spark, sf):
    return summaries.zone_counts(
        standins.fact(spark, sf), standins.zones(spark, sf), 20, known_only=True
    )


@query(
    oracle(
        _ZONE_COUNTS.format(fk="pu_location_id", where="borough = 'ASIA'", k=10), "fact", "zones"
    )
)
def zone_counts_of_borough(spark, sf):
    return summaries.zone_counts(
        standins.fact(spark, sf), standins.zones(spark, sf), 10, borough="ASIA"
    )


@query(oracle(_ZONE_COUNTS.format(fk="do_location_id", where="true", k=5), "fact", "zones"))
def zone_counts_by_dropoff(spark, sf):
    return summaries.zone_counts(
        standins.fact(spark, sf), standins.zones(spark, sf), 5, fk="do_location_id"
    )


@query(
    oracle(
        """SELECT cab_type, count(dwid) FILTER (WHERE payment_type = 1) AS card_trips,
            count(fare_amount) FILTER (WHERE trip_distance > 10) AS long_trips FROM fact GROUP BY 1""",
        "fact",
    )
)
def filtered_count(spark, sf):
    return (
        standins.fact(spark, sf)
        .groupBy("cab_type")
        .agg(
            money.filtered_count("dwid", F.col("payment_type") == 1).alias("card_trips"),
            money.filtered_count("fare_amount", F.col("trip_distance") > 10).alias("long_trips"),
        )
    )


_PRICE = """CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
    * (1 + CAST(l_tax AS DECIMAL(4,2)))"""


@query(
    f"""SELECT l_orderkey, l_linenumber,
        CAST((CAST({_PRICE} * 1000000 AS HUGEINT) + 5000) // 10000 AS DOUBLE) / 100 AS price
    FROM lineitem"""
)
def round_money(spark, sf):
    return standins.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", money.round_money(F.expr(_PRICE)).alias("price")
    )


def _candidates_sql() -> str:
    return """SELECT n_name AS place, r_name AS borough, 40 + c_acctbal / 10000 AS lat,
        -74 + (c_custkey % 100) / 100.0::DOUBLE AS lon
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _candidates(spark, sf):
    home = standins.zones(spark, sf).select("location_id", "zone", "borough")
    return (
        standins.table(spark, sf, "customer")
        .join(home, F.col("c_nationkey") == F.col("location_id"))
        .selectExpr(
            "zone AS place",
            "borough",
            "40 + c_acctbal / 10000 AS lat",
            "-74 + CAST(c_custkey % 100 AS DOUBLE) / 100 AS lon",
        )
    )


_COMPOSITE = """SELECT location_id, borough, zone || ' / NATION_' || ((location_id + 5) % 25) AS zone,
    zone AS part1, 'NATION_' || ((location_id + 5) % 25) AS part2 FROM zones"""
_AWAY = """2 * 3958.7613 * asin(sqrt(pow(sin(radians(lat - 40.7128) / 2), 2)
    + cos(radians(lat)) * cos(radians(40.7128)) * pow(sin(radians(lon + 74.0060) / 2), 2)))"""


@query(
    oracle(
        """SELECT c.location_id, c.borough, c.zone, avg(n.lat) AS latitude, avg(n.lon) AS longitude
        FROM composite c LEFT JOIN nearest n ON n.borough = c.borough AND n.place IN (c.part1, c.part2)
        GROUP BY 1, 2, 3""",
        "zones",
        composite=_COMPOSITE,
        nearest=f"""SELECT place, borough, lat, lon FROM ({_candidates_sql()})
            QUALIFY row_number() OVER (PARTITION BY place, borough ORDER BY {_AWAY}, lat, lon) = 1""",
    )
)
def resolve_zone_points(spark, sf):
    composite = standins.zones(spark, sf).withColumn(
        "zone",
        F.concat("zone", F.lit(" / NATION_"), (F.col("location_id") + 5) % 25),
    )
    return places.resolve_zone_points(composite, _candidates(spark, sf))


@query(
    oracle(
        """SELECT z.* REPLACE (coalesce(latitude, lat) AS latitude, coalesce(longitude, lon) AS longitude,
            coalesce(nullif(geolocation, ''), '(' || lat || ', ' || lon || ')') AS geolocation)
        FROM zones z LEFT JOIN (
            SELECT CAST(c_nationkey AS INTEGER) AS location_id, CAST(count(*) AS DOUBLE) AS lat,
                -CAST(max(c_custkey) AS DOUBLE) AS lon
            FROM customer GROUP BY 1) USING (location_id)""",
        "zones",
    )
)
def override_points(spark, sf):
    overrides = (
        standins.table(spark, sf, "customer")
        .groupBy(F.col("c_nationkey").alias("location_id"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("lat"),
            (-F.max("c_custkey").cast("double")).alias("lon"),
        )
    )
    return places.override_points(standins.zones(spark, sf), overrides)


@query(oracle("SELECT * FROM zones WHERE latitude IS NULL OR longitude IS NULL", "zones"))
def missing_points(spark, sf):
    return places.missing_points(standins.zones(spark, sf))
