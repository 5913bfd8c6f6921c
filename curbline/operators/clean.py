"""Filters and value cleaning. Filters on plain columns reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import fixed
from curbline.functions import dates, text


def in_range(df: DataFrame, ts_col: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= ts < end``; a plain range, so row groups are skipped."""
    return df.where((F.col(ts_col) >= dates.ntz(start)) & (F.col(ts_col) < dates.ntz(end)))


def in_month(df: DataFrame, ts_col: str, year: int, month: int) -> DataFrame:
    """Rows of one calendar month."""
    return in_range(df, ts_col, dates.month_start(year, month), dates.month_after(year, month))


def in_months(df: DataFrame, ts_col: str, first: str, last: str) -> DataFrame:
    """Rows from one ``yyyy_MM`` month to another, both included."""
    return in_range(
        df,
        ts_col,
        dates.month_start(*dates.parse_month(first)),
        dates.month_after(*dates.parse_month(last)),
    )


def in_day(df: DataFrame, ts_col: str, day: date) -> DataFrame:
    """Rows of one day, up to but not including the next midnight."""
    start = datetime(day.year, day.month, day.day)
    return in_range(df, ts_col, start, start + timedelta(days=1))


def delete_month(df: DataFrame, ts_col: str, year_month: str) -> DataFrame:
    """Rows outside one ``yyyy_MM`` month; rows without a time stay."""
    year, month = dates.parse_month(year_month)
    ts = F.col(ts_col)
    return df.where(
        ts.isNull()
        | (ts < dates.ntz(dates.month_start(year, month)))
        | (ts >= dates.ntz(dates.month_after(year, month)))
    )


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.dropna(subset=list(cols))


def drop_any_null(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows with a value in every column except the excluded ones."""
    checked = [c for c in df.columns if c not in set(exclude)]
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in checked])) if checked else df


def in_bounds(
    df: DataFrame, col: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows with ``low < col <= high``; NULL is out of bounds."""
    value = F.col(col)
    if low is not None:
        df = df.where(value > low)
    if high is not None:
        df = df.where(value <= high)
    return df


def valid_interval(df: DataFrame, start: str, end: str, mode: str = "differs") -> DataFrame:
    """Rows whose two times differ, or (``ordered``) whose end follows the start."""
    if mode not in ("differs", "ordered"):
        raise ValueError(f"unknown mode: {mode}")
    ok = F.col(end) > F.col(start) if mode == "ordered" else F.col(start) != F.col(end)
    return df.where(ok)


def in_domain(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is in a fixed list."""
    return df.where(F.col(col).isin(list(values)))


def fill_defaults(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Defaults for NULL, per column; columns that do not exist are ignored."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
            for name, value in mapping.items()
            if name in types
        }
    )


def coerce_int(df: DataFrame, cols: Sequence[str], default: int = 0, kind: str = "bigint") -> DataFrame:
    """Columns as whole numbers, the default where no number can be read."""
    return df.withColumns({c: text.lenient_int(F.col(c), default, kind) for c in cols})


def invalidate_codes(df: DataFrame, col: str, allowed: Sequence[int]) -> DataFrame:
    """Codes outside the list become NULL."""
    return df.withColumn(col, text.known_code(F.col(col), allowed))


def blank_to_default(df: DataFrame, col: str, default: object) -> DataFrame:
    """NULL and blank text become the default."""
    return df.withColumn(col, text.blank_to(F.col(col), default))


def truncate_text(df: DataFrame, col: str, n: int) -> DataFrame:
    """First ``n`` characters."""
    return df.withColumn(col, F.substring(F.col(col), 1, n))


#: Ranges of hash values that are counted to find where a sample ends.
_HASH_RANGES = 4096


def sample_to(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` rows without replacement, all if there are fewer; everything when ``n`` is not positive."""
    return sample_each(df, n, F.lit(0), seed)


def sample_each(df: DataFrame, n: int, group: Column, seed: int | None = None) -> DataFrame:
    """``n`` rows of each group without replacement, all if it has fewer; everything when ``n`` is not positive.

    A sample is the rows with the least seeded hash, so it is the same each time it is drawn, wherever the
    rows lie. Counting the rows of each range of hashes tells in which range a group's sample ends;
    ranges before that are taken whole, and only the rows of that one are ordered. The groups are few,
    such as months: one row for each goes through the driver.
    """
    if n <= 0:
        return df
    value = F.xxhash64(F.lit(seed or 0), *df.columns)
    # Hashes are spread evenly over all 64-bit numbers.
    place = F.shiftrightunsigned(value, 64 - _HASH_RANGES.bit_length() + 1)
    counts = df.groupBy(group.alias("group"), place.alias("place")).agg(F.count(F.lit(1)).alias("rows"))
    so_far = F.sum("rows").over(W.partitionBy("group").orderBy("place"))
    ends = (
        counts.withColumn("before", so_far - F.col("rows"))
        .where((F.col("before") < n) & (F.col("before") + F.col("rows") >= n))
        .collect()
    )
    last, left = F.lit(_HASH_RANGES), F.lit(0).cast("long")
    for row in ends:
        here = group.eqNullSafe(F.lit(row["group"]))
        last, left = F.when(here, F.lit(row["place"])).otherwise(last), F.when(here, F.lit(n - row["before"])).otherwise(left)
    marks = {"__place": place, "__last": last, "__left": left, "__hash": value, "__group": group}
    taken = df.select("*", *[c.alias(name) for name, c in marks.items()]).where("__place <= __last")
    # Rows that are taken whatever their rank need no company.
    alone = F.when(F.col("__place") < F.col("__last"), F.monotonically_increasing_id())
    ordered = W.partitionBy("__group", "__place", "__alone").orderBy("__hash", *df.columns)
    ranked = taken.withColumn("__alone", alone).withColumn("__rank", F.row_number().over(ordered))
    return ranked.where("__place < __last OR __rank <= __left").select(*df.columns)


def since_high_watermark(df: DataFrame, target: DataFrame, ts_col: str) -> DataFrame:
    """Rows newer than the newest row of the target; all rows with a time if it has none.

    The target's maximum is a scalar subquery. Spark runs it first and hands its
    value to the Parquet scan like any other bound.
    """
    newest = F.coalesce(F.max(ts_col), dates.ntz(datetime(1, 1, 1)))
    return df.where(F.col(ts_col) > target.select(newest.alias("newest")).scalar())


def to_timestamps(df: DataFrame, *cols: str) -> DataFrame:
    """Columns as timestamps without zone; unreadable text becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(T.TimestampNTZType()) for c in cols})


def metered_rules() -> dict[str, Column]:
    """What a kept yellow or green trip satisfies, by rule name."""
    return {
        "pickup_zone_known": F.col("pu_location_id").isNotNull(),
        "dropoff_zone_known": F.col("do_location_id").isNotNull(),
        "distance_in_bounds": (F.col("trip_distance") > 0)
        & (F.col("trip_distance") <= fixed.MAX_TRIP_DISTANCE),
        "fare_in_bounds": (F.col("fare_amount") > 0)
        & (F.col("fare_amount") <= fixed.MAX_FARE_AMOUNT),
        "has_passengers": F.col("passenger_count") > 0,
        "times_differ": F.col("pickup_datetime") != F.col("dropoff_datetime"),
    }


def fhv_rules() -> dict[str, Column]:
    """What a kept for-hire trip satisfies, by rule name."""
    return {
        "pickup_zone_known": F.col("pu_location_id").isNotNull(),
        "dropoff_zone_known": F.col("do_location_id").isNotNull(),
        "dropoff_after_pickup": F.col("dropoff_datetime") > F.col("pickup_datetime"),
        "flag_in_domain": F.col("sr_flag").isin(fixed.SR_FLAGS),
    }


def service_rules(service: str) -> dict[str, Column]:
    return fhv_rules() if service == "fhv" else metered_rules()


def prepare_trips(df: DataFrame, service: str) -> DataFrame:
    """What a service's rules are applied to: defaults filled, times read."""
    if service != "fhv":
        return df
    return df.transform(fill_defaults, {"sr_flag": 0}).transform(
        to_timestamps, "pickup_datetime", "dropoff_datetime"
    )


def valid_trips(df: DataFrame, service: str) -> DataFrame:
    """Rows that satisfy all rules of the service."""
    return df.where(reduce(and_, service_rules(service).values()))


def unique_trips(df: DataFrame, service: str) -> DataFrame:
    """Exact duplicates removed, then the flag shortened: rows that differ only in the rest of it stay."""
    return shortened(df.dropDuplicates(), service)


def shortened(df: DataFrame, service: str) -> DataFrame:
    """The columns of cleaned trips, the flag shortened."""
    if service != "fhv":
        df = truncate_text(df, "store_and_fwd_flag", 1)
    return df.drop("year", "month")


def clean_trips(df: DataFrame, service: str) -> DataFrame:
    """The rule set of one service.

    Row filters commute with removing exact duplicates, so they come first and
    only kept rows are shuffled.
    """
    return df.transform(prepare_trips, service).transform(valid_trips, service).transform(unique_trips, service)
