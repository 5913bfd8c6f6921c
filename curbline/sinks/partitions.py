"""Partition directories: what is there, and putting a whole new image in place.

An image is written once, inside the table but out of sight of readers, and its partitions are then
renamed into place one by one. Before the first rename a journal says which ones; a run that is lost in
between is finished from it by the next, and one lost before it leaves nothing but a hidden
folder, which the next run removes. A table has one writer at a time. On stores whose rename copies,
the same holds, but a rename takes as long as the copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import dates
from curbline.session import remove_path

_PENDING, _JOURNAL = "_pending-", "journal.json"
#: Rows without a time lie in a partition of this name, in no month.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Store:
    """The few calls on directories that a table's partitions need, on whatever store it lies."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        """Directories directly below one; none if that is missing."""
        where = self._path(f"{self.base}/{below}".rstrip("/"))
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where) if s.isDirectory())

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.base}/{name}"))

    def holds_files(self, name: str) -> bool:
        """Whether a directory holds a data file of some length."""
        found = self._fs.listStatus(self._path(f"{self.base}/{name}"))
        return any(s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", ".")) for s in found)

    def move(self, source: str, target: str) -> None:
        to = self._path(f"{self.base}/{target}")
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(f"{self.base}/{source}"), to):
            raise OSError(f"cannot move {source} to {target} in {self.base}")

    def remove(self, name: str) -> None:
        remove_path(self.spark, f"{self.base}/{name}")

    def write(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        fresh = f"{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(f"{self.base}/{fresh}"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(fresh, name)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.base}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def partitions(self, columns: Sequence[str], below: str = "") -> list[str]:
        """``a=1/b=2`` for every directory of that form."""
        found = [""]
        for column in columns:
            found = [f"{p}/{n}".lstrip("/") for p in found for n in self.names(f"{below}/{p}".strip("/")) if n.startswith(f"{column}=")]
        return found


def values_of(part: str) -> dict[str, str]:
    """Column values of a partition directory."""
    return dict(piece.split("=", 1) for piece in part.split("/"))


def month_of(part: str) -> str:
    """``yyyy_MM`` of a month or day partition; of one without a value its name."""
    values = values_of(part)
    if _NO_VALUE in values.values():
        return part
    if "month" in values:
        return f"{int(values['year']):04d}_{int(values['month']):02d}"
    return next(iter(values.values()))[:7].replace("-", "_")


def in_range(parts: Iterable[str], first: str, last: str) -> list[str]:
    """Partitions from one ``yyyy_MM`` month to another."""
    low, high = dates.parse_month(first), dates.parse_month(last)
    return [p for p in parts if _NO_VALUE not in p and low <= dates.parse_month(month_of(p)) <= high]


def pending_path(base: str) -> str:
    """A new hidden folder of a table; the image goes to ``/image`` in it."""
    return f"{base.rstrip('/')}/{_PENDING}{uuid.uuid4().hex}"


def put_in_place(spark: SparkSession, base: str, pending: str, columns: Sequence[str], stale: Sequence[str]) -> None:
    """Rename an image's partitions into the table and the stale ones out of it."""
    store, folder = Store(spark, base), pending.rstrip("/").rsplit("/", 1)[-1]
    parts = store.partitions(columns, f"{folder}/image")
    store.write(f"{folder}/{_JOURNAL}", json.dumps({"parts": parts, "stale": [p for p in stale if p not in set(parts)]}))
    _finish(store, folder)


def recover(spark: SparkSession, base: str) -> None:
    """Finish what a lost run began to put in place, and remove images that it had not finished."""
    store = Store(spark, base)
    for folder in store.names():
        if folder.startswith(_PENDING):
            if store.exists(f"{folder}/{_JOURNAL}"):
                _finish(store, folder)
            else:
                store.remove(folder)


def _finish(store: Store, folder: str) -> None:
    journal: Mapping[str, list[str]] = json.loads(store.read(f"{folder}/{_JOURNAL}"))
    for part in journal["parts"]:
        # An image that is gone is in place already.
        if store.exists(f"{folder}/image/{part}"):
            if store.exists(part):
                store.move(part, f"{folder}/replaced/{part}")
            store.move(f"{folder}/image/{part}", part)
    for part in journal["stale"]:
        if store.exists(part):
            store.move(part, f"{folder}/replaced/{part}")
    store.remove(f"{folder}/{_JOURNAL}")
    store.remove(folder)


def inventory(spark: SparkSession, base: str, months: Sequence[str], columns: Sequence[str] = ("year", "month")) -> DataFrame:
    """``year_month, state`` of every expected month and every one that is there besides.

    ``state`` is ``filled`` (has data files), ``empty`` (a directory without any), ``missing``
    or ``unexpected``. It comes from the listing alone, so it also sees what a read does not.
    """
    store = Store(spark, base)
    found: dict[str, bool] = {}
    for part in store.partitions(columns):
        month = month_of(part)
        found[month] = found.get(month, False) or store.holds_files(part)
    rows = [(m, ("filled" if found[m] else "empty") if m in found else "missing") for m in months]
    rows += [(m, "unexpected") for m in sorted(set(found) - set(months))]
    return spark.createDataFrame(rows, "year_month string, state string")


def rows_by_month(spark: SparkSession, base: str, months: Sequence[str], schema=None) -> DataFrame:
    """The inventory of a table with the rows of each month: 0 where there are none."""
    states = inventory(spark, base, months)
    if not any(Store(spark, base).partitions(("year", "month"))):
        return states.withColumn("row_count", F.lit(0).cast("long"))
    reader = spark.read if schema is None else spark.read.schema(schema)
    month = F.format_string("%04d_%02d", F.col("year").cast("int"), F.col("month").cast("int"))
    counts = reader.parquet(base).groupBy(month.alias("year_month")).agg(F.count(F.lit(1)).alias("row_count"))
    return states.join(counts, "year_month", "left").select("year_month", "state", F.coalesce("row_count", F.lit(0)).alias("row_count"))
