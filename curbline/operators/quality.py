"""Quality checks. Each returns a small report frame; ``gate`` turns it into an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import joins, keys as row_keys, merge
from curbline.sinks import partitions


class QualityError(ValueError):
    """A check found violations."""


def _one_pass(df: DataFrame, counts: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """Several aggregates of one scan, one row each."""
    wide = df.agg(*[c.alias(label) for label, c in counts.items()])
    return wide.unpivot([], [F.col(f"`{label}`") for label in counts], name, value)


def check_not_null(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """NULLs per column, among the rows the condition selects."""
    rows = df if where is None else df.where(where)
    return _one_pass(
        rows, {c: F.count_if(F.col(c).isNull()) for c in cols}, "column", "violations"
    )


def check_unique(df: DataFrame, key: Sequence[str], where: Column | None = None) -> DataFrame:
    """How many keys occur more than once."""
    rows = df if where is None else df.where(where)
    return row_keys.duplicate_report(rows, key).agg(F.count(F.lit(1)).alias("violations"))


def check_accepted(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Values outside the accepted set, with counts; NULL is not a value."""
    return (
        df.where(~F.col(col).isin(list(values)))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def check_relationship(
    df: DataFrame, col: str, dim: DataFrame, key: str, where: Column | None = None
) -> DataFrame:
    """How many rows, and distinct values, have no parent."""
    rows = (df if where is None else df.where(where)).groupBy(col).agg(
        F.count(F.lit(1)).alias("n")
    )
    return joins.orphans(rows, dim, col, key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
        F.count(F.lit(1)).alias("orphan_values"),
    )


def schema_problems(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str, str]]:
    """``(column, problem, expected type, actual type)`` for every difference."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    found = []
    for name, kind in wanted.items():
        if name not in actual:
            found.append((name, "missing", kind.simpleString(), None))
        elif actual[name] != kind:
            found.append((name, "type", kind.simpleString(), actual[name].simpleString()))
    found += [
        (name, "extra", None, kind.simpleString())
        for name, kind in actual.items()
        if name not in wanted
    ]
    return found


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The schema differences as a frame."""
    return df.sparkSession.createDataFrame(
        schema_problems(df, expected),
        "column string, problem string, expected string, actual string",
    )


def check_ranges(df: DataFrame, rules: Mapping[str, Column], duplicates: bool = False) -> DataFrame:
    """Rows that break each rule, all rules in one scan; NULL breaks a rule.

    With ``duplicates`` the report also counts surplus copies of whole rows.
    """
    report = _one_pass(
        df,
        {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()},
        "rule",
        "violations",
    )
    if not duplicates:
        return report
    surplus = (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    )
    return report.unionByName(surplus.select(F.lit("no_duplicates").alias("rule"), "violations"))


def check_not_empty(df: DataFrame) -> DataFrame:
    """Row and column counts, and whether both are positive."""
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(width).alias("column_count"),
        ((F.col("row_count") > 0) & F.lit(width > 0)).alias("passed"),
    )


def check_partitions(
    spark: SparkSession, base: str, cols: Sequence[str] = ("year", "month")
) -> DataFrame:
    """Rows per partition of a written table; see ``check_months`` for those that are not there."""
    return spark.read.parquet(base).groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))


def check_months(spark: SparkSession, base: str, months: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """``year_month, state, row_count, violations`` for each expected month and any besides.

    A month that is missing, is an empty directory, or holds files without rows is a violation.
    """
    found = partitions.rows_by_month(spark, base, months, schema)
    bad = F.col("state").isin("missing", "unexpected") | (F.col("row_count") == 0)
    return found.withColumn("violations", bad.cast("int"))


def check_loss(df: DataFrame, ts_col: str, level: str) -> DataFrame:
    """The loss report; raises when the limit is reached."""
    report = merge.loss_report(df, ts_col, level)
    require_loss_below_limit(report)
    return report


def require_loss_below_limit(report: DataFrame) -> None:
    """Raise when any row of a loss report is breached; the worst one is named."""
    row = report.where("breached").orderBy(F.desc("loss_percent"), *report.columns).first()
    if row is not None:
        where = f"{row.year_month}: " if "year_month" in report.columns else ""
        raise QualityError(
            f"{where}{row.loss_percent:.2f} % of {row.total_rows} rows lost, limit {row.limit_percent} %"
        )


def column_profile(df: DataFrame) -> DataFrame:
    """Values that are not NULL, per column."""
    return _one_pass(df, {c: F.count(c) for c in df.columns}, "column", "non_null")


class Observed:
    """Rules counted while rows pass by on their way to a write: no second scan.

    ``watch`` a frame, write what comes of it, then ask for ``rows`` and ``broken``.
    """

    def __init__(self, rules: Mapping[str, Column]) -> None:
        self.rules = dict(rules)
        self._metrics = Observation()
        self._counts: dict[str, int] = {}

    def watch(self, df: DataFrame) -> DataFrame:
        self._frame = df
        return df.observe(self._metrics, *self._columns())

    def _columns(self) -> list[Column]:
        broken = [F.count_if(~F.coalesce(rule, F.lit(False))) for rule in self.rules.values()]
        return [F.count(F.lit(1)).alias("rows"), *[c.alias(f"rule {k}") for k, c in enumerate(broken)]]

    def _found(self) -> dict[str, int]:
        if not self._counts:
            try:
                self._counts = self._metrics.get
            except Py4JJavaError as error:
                if "AssertionError" not in str(error.java_exception):
                    raise
                # Where nothing is left to write, Spark drops the plan and what observes it: count then.
                self._counts = self._frame.agg(*self._columns()).first().asDict()
        return self._counts

    @property
    def rows(self) -> int:
        return self._found().get("rows") or 0

    @property
    def broken(self) -> dict[str, int]:
        """How many rows break each rule; a NULL breaks it."""
        found = self._found()
        return {name: found.get(f"rule {k}") or 0 for k, name in enumerate(self.rules)}

    def require_none(self, what: str) -> None:
        """Raise when any row broke a rule."""
        if bad := {name: n for name, n in self.broken.items() if n}:
            raise QualityError(f"{what}: {len(bad)} checks failed, {sum(bad.values())} violations; {bad} of {self.rows} rows")

    def require_kept(self, kept: int, most_rejected: float, what: str) -> None:
        """Raise when more than a share of the rows, or every one of them, was rejected."""
        lost = self.rows - kept
        if self.rows and (kept == 0 or lost > most_rejected * self.rows):
            raise QualityError(f"{what}: {lost} of {self.rows} rows rejected; by rule {self.broken}")


def gate(report: DataFrame, what: str) -> None:
    """Raise when a report counts violations; reports have one row per check."""
    broken = report.where("violations > 0")
    found = broken.agg(F.count(F.lit(1)).alias("rows"), F.sum("violations").alias("violations")).first()
    if found["rows"]:
        some = [row.asDict() for row in broken.limit(20).collect()]
        raise QualityError(
            f"{what}: {found['rows']} checks failed, {found['violations']} violations; for example {some}"
        )
