"""Registration, and the SQL building blocks the oracles share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from curbline import fixed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its oracle if there is one."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def _row_key(cols: Sequence[str] = tuple(fixed.TRIP_KEY)) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"substr(sha256(concat_ws('_', {parts})), 1, 16)"


def values(rows: Sequence[tuple], names: Sequence[str]) -> str:
    """An inline table."""

    def literal(value: object) -> str:
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return str(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(names)})"


YELLOW_COLUMNS = [fixed.YELLOW_RENAMES.get(c, c) for c, _ in fixed.YELLOW_FILE_COLUMNS]
GREEN_COLUMNS = [fixed.GREEN_RENAMES.get(c, c) for c, _ in fixed.GREEN_FILE_COLUMNS]
FHV_COLUMNS = [fixed.FHV_RENAMES.get(c, c) for c, _ in fixed.FHV_FILE_COLUMNS]
FACT_COLUMNS = [c for c, _ in fixed.FACT_COLUMNS]

_ORDERS = "orders JOIN customer ON o_custkey = c_custkey"
_COLUMN_CTES = {"yellow": YELLOW_COLUMNS, "green": GREEN_COLUMNS, "fhv": FHV_COLUMNS}


def _fact_arm(service: str) -> str:
    have = {"dwid": "dwid", "cab_type": f"'{service}'"}
    have.update({c: c for c in _COLUMN_CTES[service]})
    types = {"float": "FLOAT", "int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP"}
    items = [
        f"CAST({have.get(c, 'NULL')} AS {types[kind]}) AS {c}" for c, kind in fixed.FACT_COLUMNS
    ]
    known = " AND ".join(f"{c} IS NOT NULL" for c in fixed.TRIP_KEY)
    return f"SELECT {', '.join(items)} FROM {service}_keyed WHERE {known}"


# name -> (names it builds on, body)
CTES: dict[str, tuple[list[str], str]] = {
    "yellow": (
        [],
        f"""SELECT CAST(l_suppkey % 3 AS INTEGER) AS vendor_id,
            o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
            CAST(l_linenumber AS INTEGER) AS passenger_count,
            CAST(l_quantity AS FLOAT) AS trip_distance,
            CAST(l_linenumber AS INTEGER) AS ratecode_id,
            l_returnflag || l_linestatus AS store_and_fwd_flag,
            CAST(c_nationkey AS INTEGER) AS pu_location_id,
            CAST(s_nationkey AS INTEGER) AS do_location_id,
            CAST(l_linenumber % 7 AS INTEGER) AS payment_type,
            CAST(l_extendedprice AS FLOAT) AS fare_amount,
            CAST(l_discount AS FLOAT) AS extra, CAST(l_tax AS FLOAT) AS mta_tax,
            CAST(l_tax AS FLOAT) AS tip_amount, CAST(l_discount AS FLOAT) AS tolls_amount,
            CAST(l_tax AS FLOAT) AS improvement_surcharge,
            CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS FLOAT) AS total_amount,
            CAST(NULL AS FLOAT) AS congestion_surcharge,
            CAST(l_linenumber AS FLOAT) AS airport_fee
        FROM lineitem JOIN ({_ORDERS}) ON l_orderkey = o_orderkey
            JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "green": (
        [],
        f"""SELECT CAST(o_orderkey % 3 AS INTEGER) AS vendor_id,
            o_orderdate AS pickup_datetime,
            o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS dropoff_datetime,
            CAST(o_orderkey % 6 AS INTEGER) AS passenger_count,
            CAST(o_orderkey % 60 AS FLOAT) AS trip_distance,
            CAST(o_orderkey % 8 AS INTEGER) AS ratecode_id,
            o_orderstatus || 'X' AS store_and_fwd_flag,
            CAST(c_nationkey AS INTEGER) AS pu_location_id,
            CAST(o_orderkey % 25 AS INTEGER) AS do_location_id,
            CAST(o_orderkey % 7 AS INTEGER) AS payment_type,
            CAST(o_totalprice AS FLOAT) AS fare_amount,
            CAST(o_orderkey % 3 AS FLOAT) AS extra, CAST(o_orderkey % 2 AS FLOAT) AS mta_tax,
            CAST(o_orderkey % 5 AS FLOAT) AS tip_amount,
            CAST(o_orderkey % 4 AS FLOAT) AS tolls_amount,
            CAST(o_orderkey % 2 AS FLOAT) AS improvement_surcharge,
            CAST(o_totalprice AS FLOAT) AS total_amount,
            CAST(o_orderkey % 2 + 1 AS INTEGER) AS trip_type,
            CAST(NULL AS FLOAT) AS congestion_surcharge
        FROM {_ORDERS}""",
    ),
    "fhv": (
        [],
        """SELECT event_type AS dispatching_base_num, ts AS pickup_datetime,
            ts + to_hours(CAST(event_id % 4 AS INTEGER)) AS dropoff_datetime,
            CAST(nullif(user_id % 30, 29) AS INTEGER) AS pu_location_id,
            CAST(event_id % 25 AS INTEGER) AS do_location_id,
            CAST(nullif(event_id % 5, 4) AS INTEGER) AS sr_flag,
            CASE WHEN event_id % 7 = 0 THEN ' ' WHEN event_id % 11 = 0 THEN NULL
                ELSE event_type END AS affiliated_base_number
        FROM events""",
    ),
    "yellow_keyed": (["yellow"], f"SELECT {_row_key()} AS dwid, * FROM yellow"),
    "green_keyed": (["green"], f"SELECT {_row_key()} AS dwid, * FROM green"),
    "fhv_keyed": (["fhv"], f"SELECT {_row_key()} AS dwid, * FROM fhv"),
    "fact": (
        ["yellow_keyed", "green_keyed", "fhv_keyed"],
        " UNION ALL ".join(_fact_arm(s) for s in fixed.SERVICES),
    ),
    "zones": (
        [],
        """SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
            CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone,
            CASE WHEN n_nationkey < 23 THEN CAST(40 + n_nationkey AS DOUBLE) END AS latitude,
            CASE WHEN n_nationkey < 23 THEN CAST(-74 - n_nationkey AS DOUBLE) END AS longitude,
            CASE WHEN n_nationkey < 23 THEN '(' || CAST(CAST(40 + n_nationkey AS DECIMAL(8,2)) AS VARCHAR)
                || ', ' || CAST(CAST(-74 - n_nationkey AS DECIMAL(8,2)) AS VARCHAR) || ')'
                ELSE '' END AS geolocation
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "vendors": ([], values(fixed.VENDORS, ["vendor_id", "vendor_name"])),
    "payment_types": (
        [],
        values(fixed.PAYMENT_TYPES, ["payment_type_id", "payment_type_description"]),
    ),
    "rate_codes": ([], values(fixed.RATE_CODE_NAMES, ["ratecode_id", "rate_code_description"])),
    "holiday_rules": (
        [],
        values(
            fixed.HOLIDAYS,
            [
                "holiday_id",
                "holiday_name",
                "month",
                "day_or_rule",
                "holiday_type",
                "nyc_observance",
            ],
        ),
    ),
    # Holidays found by numbering the weekdays of every month, not by date arithmetic.
    "holidays": (
        ["fact", "holiday_rules"],
        """SELECT CAST(d.day AS DATE) AS holiday_date, h.holiday_name
        FROM (
            SELECT day, month(day) AS m, lower(dayname(day)) AS weekday, day(day) AS dom,
                row_number() OVER (PARTITION BY year(day), month(day), dayname(day) ORDER BY day) AS nth,
                row_number() OVER (PARTITION BY year(day), month(day), dayname(day) ORDER BY day DESC) AS nth_last
            FROM (
                SELECT unnest(generate_series(
                    make_date(min(year(pickup_datetime)), 1, 1)::TIMESTAMP,
                    make_date(max(year(pickup_datetime)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS day
                FROM fact)) d
        JOIN holiday_rules h ON h.month = d.m AND (
            CAST(d.dom AS VARCHAR) = h.day_or_rule
            OR (d.nth = 1 AND h.day_or_rule = 'first_' || d.weekday)
            OR (d.nth = 2 AND h.day_or_rule = 'second_' || d.weekday)
            OR (d.nth = 3 AND h.day_or_rule = 'third_' || d.weekday)
            OR (d.nth = 4 AND h.day_or_rule = 'fourth_' || d.weekday)
            OR (d.nth_last = 1 AND h.day_or_rule = 'last_' || d.weekday))""",
    ),
    "day_names": (
        ["holidays"],
        "SELECT holiday_date, min(holiday_name) AS holiday_name FROM holidays GROUP BY holiday_date",
    ),
}


def oracle(body: str, *names: str, **extra: str) -> str:
    """A statement with the named building blocks, and extra ones, before the body.

    Extra blocks may build on the named ones and on the extras before them.
    """
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in CTES[name][0]:
                add(needed)
            order.append(name)

    for name in names:
        add(name)
    # Each block is worked out once, whatever reads it.
    parts = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def first_rows(source: str, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> str:
    """One row per key by a total order over the remaining columns, NULLs first."""
    rest = [*order, *[c for c in columns if c not in set(keys)]]
    by = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return (
        f"SELECT {', '.join(columns)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {by}) = 1"
    )


def micros(value: str) -> str:
    """An amount in whole millionths, rounded half up."""
    return f"CAST(floor(CAST({value} AS DOUBLE) * 1000000 + 0.5) AS HUGEINT)"


def money_sum(value: str) -> str:
    """Exact sum to two decimals (amounts are not negative)."""
    return f"CAST((sum({micros(value)}) + 5000) // 10000 AS DOUBLE) / 100"


def money_avg(value: str) -> str:
    """Exact average to two decimals (amounts are not negative)."""
    return (
        f"CAST((2 * sum({micros(value)}) + 10000 * count({value})) "
        f"// nullif(20000 * count({value}), 0) AS DOUBLE) / 100"
    )
