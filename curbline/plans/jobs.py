"""Jobs: operators composed from landed files to summary tables.

Every job takes a month range and handles all its months in one Spark plan. A
new table image is written once, beside the table, checked on its way there, and
renamed into place month by month from a journal. So a table is never read and
replaced by the same plan, a failed check leaves it as it was, and a run that is
lost half way is finished by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import fixed, schemas
from curbline.functions import dates
from curbline.operators import (
    calendar,
    clean,
    keys,
    merge,
    quality,
    sets,
    shape,
    summaries,
)
from curbline.plans import lookups
from curbline.session import remove_path, scratch_path
from curbline.sinks import partitions, tables
from curbline.sources import files


@dataclass(frozen=True)
class Lake:
    """Where the zones of each service lie."""

    root: str

    def zone(self, name: str, service: str) -> str:
        return f"{self.root}/{service}/{name}"


def keyed_schema(service: str) -> T.StructType:
    """A service's table schema with the row key first."""
    return T.StructType(
        [T.StructField("dwid", T.StringType()), *schemas.SERVICES[service].table_schema.fields]
    )


_MONTHS = ("year", "month")


def _existing_months(
    spark: SparkSession, path: str, schema: T.StructType, first: str, last: str
) -> DataFrame:
    """Stored rows in a schema that is pinned: a column that only later months have is read from those.

    What a lost run left half done is put right first.
    """
    partitions.recover(spark, path)
    months = {"year": T.IntegerType(), "month": T.IntegerType()}
    pinned = T.StructType(
        [f for f in schema.fields if f.name not in months] + [T.StructField(n, k) for n, k in months.items()]
    )
    if not partitions.Store(spark, path).partitions(_MONTHS):
        return shape.empty_frame(spark, schema)
    return shape.align_schema(files.read_months(spark, path, first, last, pinned), schema)


def _stored_schema(spark: SparkSession, path: str, first: str, last: str) -> T.StructType:
    """All columns that the months of a range have, from their footers; their types must agree."""
    parts = partitions.in_range(partitions.Store(spark, path).partitions(_MONTHS), first, last)
    if not parts:
        return T.StructType()
    groups = files.schema_groups(spark, [f"{path.rstrip('/')}/{p}" for p in parts])
    if len(groups) > 1:
        raise quality.QualityError(f"months of {path} store a column with different types")
    return T.StructType([f for f in groups[0][0].fields if f.name not in _MONTHS])


def _upserted(rows: DataFrame, path: str, first: str, last: str, key: Sequence[str]) -> DataFrame:
    """The new image of the months, with every column that either side has.

    Matched rows take the batch's columns and keep what it lacks; a column with two types stops the job.
    """
    spark = rows.sparkSession
    if not partitions.in_range(partitions.Store(spark, path).partitions(_MONTHS), first, last):
        # Nothing to merge with. A batch that was brought together by this key is not shuffled again.
        return keys.distinct_on(rows, key)
    stored = _stored_schema(spark, path, first, last)
    known = {f.name: f.dataType for f in rows.schema.fields}
    if clash := [f.name for f in stored.fields if known.get(f.name, f.dataType) != f.dataType]:
        raise quality.QualityError(f"{path} stores {clash} with other types than the batch has")
    more = [f for f in stored.fields if f.name not in known]
    both = T.StructType([*rows.schema.fields, *more])
    existing = _existing_months(spark, path, both, first, last)
    batch = shape.align_schema(rows, both)
    if more:
        return merge.upsert_columns(existing, batch, key, [c for c in rows.columns if c not in set(key)])
    return merge.merge_by_key(existing, batch, key)


def publish(
    rows: DataFrame,
    path: str,
    first: str,
    last: str,
    overwrite: bool,
    key: Sequence[str] = tuple(fixed.PRIMARY_KEY),
    check: Callable[[DataFrame], None] | None = None,
    rules: Mapping[str, Column] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Replace or upsert the months of a table; returns those months as stored.

    The new image is written once, beside the table, and its months are then renamed into place from
    a journal. ``rules`` are counted during that write; ``check`` sees the written image. If either
    finds a fault, the table stays as it was. A replacement replaces the whole range: a stored
    month for which it brings no rows is removed. ``dealt`` says that the rows of a month are together
    already, in one task or a few, and need no shuffle of their own.
    """
    return _put(rows, path, first, last, overwrite, key, check, rules, shape.add_year_month, _MONTHS, dealt)


def _put(rows, path, first, last, overwrite, key, check, rules, add_columns, columns, dealt=False) -> DataFrame:
    spark = rows.sparkSession
    partitions.recover(spark, path)
    if not overwrite:
        rows = _upserted(rows, path, first, last, key)
    observed = quality.Observed(rules or {})
    pending = partitions.pending_path(path)
    image = tables.write_image(add_columns(observed.watch(rows)), f"{pending}/image", columns, dealt=dealt)
    try:
        observed.require_none(path)
        if check is not None:
            check(image)
    except Exception:
        remove_path(spark, pending)
        raise
    stale = partitions.in_range(partitions.Store(spark, path).partitions(columns), first, last) if overwrite else []
    partitions.put_in_place(spark, path, pending, columns, stale)
    read = files.read_months if columns == _MONTHS else files.read_days
    return read(spark, path, first, last, schema=image.schema)


def ingest_dev(
    spark: SparkSession,
    paths: str | Sequence[str],
    service: str,
    first: str,
    last: str,
    lake: Lake,
    sample: int = 0,
    seed: int | None = None,
    most_rejected: float = 1.0,
) -> DataFrame:
    """Landed files to the cleaned development zone.

    Rows that break a cleaning rule are counted as they pass; when all of them, or more than the share
    ``most_rejected``, break one, the zone stays as it was.
    """
    profile = schemas.SERVICES[service]
    pickup = next(
        (old for old, new in profile.renames.items() if new == "pickup_datetime"),
        "pickup_datetime",
    )
    conformed = (
        files.read_drifting_files(spark, paths, profile.file_schema)
        .transform(clean.in_months, pickup, first, last)
        .transform(clean.sample_each, sample, F.date_format(pickup, "yyyy_MM"), seed)
        .transform(shape.cast_to_schema, profile.file_schema)
        .transform(shape.drop_columns, *profile.drops)
        .transform(shape.rename_columns, profile.renames)
    )
    problems = quality.schema_problems(conformed, profile.table_schema)
    if problems:
        raise quality.QualityError(f"{service} files: {problems}")
    arriving, kept = quality.Observed(clean.service_rules(service)), quality.Observed({})
    prepared = clean.prepare_trips(conformed, service)
    valid = kept.watch(clean.valid_trips(arriving.watch(prepared), service))
    return publish(
        clean.unique_trips(valid, service),
        lake.zone("dev", service),
        first,
        last,
        overwrite=True,
        check=lambda _: arriving.require_kept(kept.rows, most_rejected, f"{service} dev"),
    )


def load_stage(
    spark: SparkSession, service: str, first: str, last: str, lake: Lake, overwrite: bool = False
) -> DataFrame:
    """Development zone to keyed, unique rows in the stage zone."""
    # The trips of one key are one group of the primary key, which thus is unique. Choosing one of them
    # leaves no exact duplicates, so these need no shuffle of their own.
    rows = (
        _existing_months(spark, lake.zone("dev", service), schemas.SERVICES[service].table_schema, first, last)
        .transform(clean.prepare_trips, service)
        .transform(clean.valid_trips, service)
        .transform(clean.shortened, service)
        .transform(keys.add_row_key)
        .transform(keys.dedup_by_key, fixed.PRIMARY_KEY)
    )
    return publish(rows, lake.zone("stage", service), first, last, overwrite)


def publish_lakehouse(
    spark: SparkSession, service: str, first: str, last: str, lake: Lake
) -> DataFrame:
    """Stage zone to day files; days of the range that have no trips any more are removed."""
    rows = _existing_months(spark, lake.zone("stage", service), keyed_schema(service), first, last)
    add_day = lambda df: df.withColumn("partition_date", F.to_date("pickup_datetime"))
    return _put(rows, lake.zone("days", service), first, last, True, (), None, None, add_day, ("partition_date",))


def publish_production(
    spark: SparkSession,
    service: str,
    first: str,
    last: str,
    lake: Lake,
    level: str,
    may_be_null: Sequence[str] = (),
    overwrite: bool = False,
) -> DataFrame:
    """Day files reconciled with the stage zone to the production zone."""
    schema = keyed_schema(service)
    stored = T.StructType([*schema.fields, T.StructField("partition_date", T.DateType())])
    partitions.recover(spark, lake.zone("days", service))
    truth = files.read_days(spark, lake.zone("days", service), first, last, schema=stored).drop("partition_date")
    other = _existing_months(spark, lake.zone("stage", service), schema, first, last)
    quality.require_loss_below_limit(merge.reconcile_loss_by_month(truth, other, level, fixed.PRIMARY_KEY))
    rows = (
        merge.reconcile(truth, other)
        .transform(keys.dedup_by_key, fixed.PRIMARY_KEY)
        .transform(clean.drop_any_null, may_be_null)
    )
    return publish(rows, lake.zone("production", service), first, last, overwrite)


def fact_rows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Keyed trips per service as unique fact rows with cleaned codes.

    Unusable rows are dropped before the unique rows are chosen, so one shuffle
    serves all services. It deals them by time, as the months of the table need them.
    """
    parts = []
    for service, frame in frames.items():
        part = frame.transform(clean.drop_null_keys, fixed.TRIP_KEY).transform(
            shape.conform_to_fact, service
        )
        if service in fixed.METERED_SERVICES:
            part = part.transform(
                clean.invalidate_codes, "ratecode_id", fixed.RATE_CODES
            ).transform(clean.invalidate_codes, "vendor_id", fixed.VENDOR_CODES)
        else:
            part = part.transform(
                clean.blank_to_default, "dispatching_base_num", fixed.UNKNOWN_BASE
            ).transform(clean.blank_to_default, "affiliated_base_number", fixed.UNKNOWN_BASE)
        parts.append(part)
    together = sets.union_services(parts).transform(
        clean.fill_defaults, {"payment_type": fixed.UNKNOWN_PAYMENT_TYPE}
    )
    return keys.distinct_in_time(together, fixed.PRIMARY_KEY, "pickup_datetime", ["cab_type"])


def build_fact(
    spark: SparkSession,
    first: str,
    last: str,
    lake: Lake,
    services: Sequence[str] = tuple(fixed.SERVICES),
) -> DataFrame:
    """Production zones of the enabled services to the fact table's months."""
    frames = sets.select_sources(
        {
            name: _existing_months(
                spark, lake.zone("production", name), keyed_schema(name), first, last
            )
            for name in fixed.SERVICES
        },
        services,
    )
    return publish(
        fact_rows(frames),
        lake.zone("fact", "all"),
        first,
        last,
        overwrite=True,
        rules={f"{c} known": F.col(c).isNotNull() for c in ("dwid", "cab_type", "payment_type")},
        dealt=True,
    )


_BY_CODE = ("payment_summary", "rate_code_summary", "vendor_summary", "monthly_service_counts", "daily_summary")
_BY_ZONE = ("pickup_zone_summary", "dropoff_zone_summary", "flow_matrix", "flow_pivot")
SUMMARIES = (*_BY_CODE, *_BY_ZONE, "time_dimension")
_ALL = ("0001_01", "9999_12")
#: The columns of the fact that the summaries are made of.
_SUMMARISED = [
    *("dwid", "cab_type", "fare_amount", "total_amount", "trip_distance", "ratecode_id", "vendor_id"),
    *("pu_location_id", "do_location_id", "pickup_datetime", "payment_type"),
]


def _partials(fact: DataFrame, groups: DataFrame, path: str, date_col: str, months: tuple[str, str]) -> DataFrame:
    """Stored partial groups of all months, those of a range worked out anew."""
    add = lambda df: shape.add_year_month(df, date_col)
    _put(groups, path, *months, True, (), None, None, add, _MONTHS)
    stored = T.StructType([*groups.schema.fields, *[T.StructField(n, T.IntegerType()) for n in _MONTHS]])
    return _existing_months(fact.sparkSession, path, stored, *_ALL).drop(*_MONTHS)


def build_summaries(
    fact: DataFrame,
    zones: DataFrame,
    out: str,
    which: Sequence[str] | None = None,
    csv: bool = False,
    months: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Write the chosen summaries, and CSV exports of them if wanted.

    Two small tables of partial groups, by month, are kept under ``out``; a summary adds them up. With
    ``months``, the first and the last one that changed, only those months of the fact are read
    again. The time dimension has a row for each trip and is stored by month, too. Only what the
    chosen summaries need is worked out.
    """
    wanted = tuple(which or SUMMARIES)
    if unknown := set(wanted) - set(SUMMARIES):
        raise ValueError(f"unknown summaries: {sorted(unknown)}")
    spark, touched = fact.sparkSession, months or _ALL
    changed, kept = fact, None
    if months is not None:
        # Finding the changed months' rows may take reading all of the fact, so that is done once.
        found = clean.in_months(fact, "pickup_datetime", *months).select(*[c for c in fact.columns if c in _SUMMARISED])
        kept = scratch_path(spark, "changed")
        changed = tables.write_table(found, kept)
    frames: dict[str, DataFrame] = {}
    if set(wanted) & {*_BY_CODE, "time_dimension"}:
        codes = _partials(fact, summaries.code_partials(changed), f"{out}/partials/codes", "pickup_date", touched)
        years = [F.year(f("pickup_date")).alias(n) for f, n in ((F.min, "start_year"), (F.max, "end_year"))]
        holidays = calendar.holiday_calendar(lookups.holidays(spark), codes.agg(*years))
        frames |= {
            "payment_summary": summaries.payment_summary_from(codes, lookups.payment_types(spark)),
            "rate_code_summary": summaries.rate_code_summary_from(codes, lookups.rate_codes(spark)),
            "vendor_summary": summaries.vendor_summary_from(codes, lookups.vendors(spark)),
            "monthly_service_counts": summaries.monthly_service_counts_from(codes),
            "daily_summary": summaries.daily_summary_from(codes, holidays),
        }
    if set(wanted) & set(_BY_ZONE):
        groups = summaries.zone_partials_by_month(changed)
        pairs = _partials(fact, groups, f"{out}/partials/zones", "pickup_month", touched)
        frames |= {
            "pickup_zone_summary": summaries.pickup_zone_summary_from(pairs, zones),
            "dropoff_zone_summary": summaries.dropoff_zone_summary_from(pairs, zones),
            "flow_matrix": summaries.flow_matrix_from(pairs, zones),
        }
        if "flow_pivot" in wanted:
            frames["flow_pivot"] = summaries.flow_pivot_from(pairs, zones)
    stored = {}
    for name in wanted:
        path = f"{out}/{name}"
        if name == "time_dimension":
            trips = calendar.time_dimension(changed, holidays)
            _put(trips, path, *touched, True, (), None, None, lambda df: df, _MONTHS)
            stored[name] = _existing_months(spark, path, trips.schema, *_ALL)
        else:
            frames[name].write.mode("overwrite").parquet(path)
            stored[name] = spark.read.schema(frames[name].schema).parquet(path)
        if csv:
            tables.export_csv(stored[name], f"{out}/csv/{name}")
    if kept is not None:
        remove_path(spark, kept)
    return stored


def month_tokens(first: str, last: str) -> list[str]:
    """Every month of a range, both ends included."""
    (y0, m0), (y1, m1) = dates.parse_month(first), dates.parse_month(last)
    if (y1, m1) < (y0, m0):
        raise ValueError(f"{last} lies before {first}")
    numbers = range(y0 * 12 + m0 - 1, y1 * 12 + m1)
    return [f"{n // 12:04d}_{n % 12 + 1:02d}" for n in numbers]


def backfill(job: Callable[..., DataFrame], first: str, last: str, **arguments) -> DataFrame:
    """Run a job over a range of months as one Spark plan, not one run per month."""
    months = month_tokens(first, last)
    return job(first=months[0], last=months[-1], **arguments)


def reconcile_legacy(
    spark: SparkSession, stage: DataFrame, production: str, year_month: str
) -> DataFrame:
    """Replace one production month by the unique rows of the stage month."""
    year, month = dates.parse_month(year_month)
    view = tables.month_view(stage, f"stage_{year_month}_{uuid.uuid4().hex}", year, month)
    rows = keys.distinct_on(view, fixed.PRIMARY_KEY)
    return publish(rows, production, year_month, year_month, overwrite=True)


def direct_load(
    spark: SparkSession,
    paths: str | Sequence[str],
    service: str,
    first: str,
    last: str,
    table: str,
    csv_path: str,
) -> DataFrame:
    """Files to a keyed table by way of a CSV export, without a schema cast."""
    profile = schemas.SERVICES[service]
    rows = (
        files.read_drifting_files(spark, paths)
        .transform(shape.drop_columns, *profile.drops)
        .transform(shape.rename_columns, profile.renames)
        .transform(clean.in_months, "pickup_datetime", first, last)
        .transform(clean.clean_trips, service)
        .transform(keys.add_row_key)
    )
    tables.export_csv(rows, csv_path)
    return publish(files.load_csv(spark, csv_path, rows.schema), table, first, last, overwrite=True)


def merge_from_object_store(
    spark: SparkSession,
    root: str,
    first: str,
    last: str,
    file_schema: T.StructType,
    service: str,
    table: str,
    column: str = "partitioned_date",
) -> DataFrame:
    """Object-store days of a range of months, merged by row key into a stored table.

    Columns are taken by position, NULL numbers become 0. Rows of the table that the days do not
    bring stay; returns its months as stored.
    """
    names = schemas.SERVICES[service].table_schema.names
    patterns = [files.month_glob(column, *dates.parse_month(m)) for m in month_tokens(first, last)]
    found = files.read_partition_glob(spark, root, "{" + ",".join(patterns) + "}", file_schema)
    rows = shape.rename_positional(found.select(*file_schema.names), names)
    numbers = {f.name: 0 for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)}
    batch = rows.transform(clean.fill_defaults, numbers).transform(keys.add_row_key)
    return publish(batch, table, first, last, overwrite=False, key=["dwid"])
