"""Merges, upserts and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline import fixed
from curbline.operators import merge
from curbline.plans import standins
from curbline.plans.queries.joining import UNIQUE_SIDES, unique_sides
from curbline.plans.queries.registry import FACT_COLUMNS, first_rows, oracle, query

# Cash trips come again with another fare, and green trips are new.
_BATCH = """SELECT * REPLACE (CAST(fare_amount + 1 AS FLOAT) AS fare_amount,
        CAST(NULL AS INTEGER) AS vendor_id) FROM fact WHERE cab_type = 'yellow' AND payment_type = 2
    UNION ALL SELECT * FROM fact WHERE cab_type = 'green'"""
_TARGET = "SELECT * FROM fact WHERE cab_type = 'yellow'"
_IN_MONTH = "strftime(pickup_datetime, '%Y_%m') = '1997_12'"
_SAME = " AND ".join(f"t.{k} = u.{k}" for k in fixed.PRIMARY_KEY)


def _replaced(target: str, batch: str, keys) -> str:
    """Target rows whose key the batch lacks, and the batch, by one equality join."""
    names = ", ".join(keys)
    return f"""SELECT t.* FROM {target} t LEFT JOIN (SELECT DISTINCT {names}, true AS hit FROM {batch}) h
            USING ({names}) WHERE h.hit IS NULL
        UNION ALL BY NAME SELECT * FROM {batch}"""


def _target(spark, sf):
    return standins.fact_part(spark, sf, "yellow")


def _batch(spark, sf):
    changed = (
        standins.fact_part(spark, sf, "yellow")
        .where(F.col("payment_type") == 2)
        .withColumns(
            {
                "fare_amount": (F.col("fare_amount") + 1).cast("float"),
                "vendor_id": F.lit(None).cast("int"),
            }
        )
    )
    return changed.unionByName(standins.fact_part(spark, sf, "green"))


@query(
    oracle(
        _replaced("target", "updates", fixed.PRIMARY_KEY),
        "fact",
        target=f"{_TARGET} AND {_IN_MONTH}",
        batch=f"SELECT * FROM ({_BATCH}) WHERE {_IN_MONTH}",
        updates=first_rows("batch", fixed.PRIMARY_KEY, FACT_COLUMNS),
    )
)
def upsert_month(spark, sf):
    return merge.upsert_month(_target(spark, sf), _batch(spark, sf), 1997, 12)


_SOME = ["fare_amount", "total_amount"]


@query(
    oracle(
        "SELECT "
        + ", ".join(
            f"CASE WHEN u.dwid IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}"
            if c in _SOME
            else f"t.{c}"
            for c in FACT_COLUMNS
        )
        + f""" FROM target t LEFT JOIN updates u ON {_SAME}
        UNION ALL SELECT * FROM updates u WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {_SAME})""",
        "fact",
        target=_TARGET,
        batch=_BATCH,
        updates=first_rows("batch", fixed.PRIMARY_KEY, FACT_COLUMNS),
    )
)
def upsert_columns(spark, sf):
    return merge.upsert_columns(_target(spark, sf), _batch(spark, sf), fixed.PRIMARY_KEY, _SOME)


@query(
    oracle(
        _replaced("target", "updates", ["dwid"]),
        "fact",
        target=_TARGET,
        batch=_BATCH,
        updates=first_rows("batch", ["dwid"], FACT_COLUMNS),
    )
)
def merge_by_key(spark, sf):
    return merge.merge_by_key(_target(spark, sf), _batch(spark, sf), ["dwid"])


@query(
    oracle(
        _replaced("target", "batch", ["dwid"]),
        "fact",
        target=_TARGET,
        batch=_BATCH,
    )
)
def replace_by_key(spark, sf):
    return merge.replace_by_key(_target(spark, sf), _batch(spark, sf), ["dwid"])


@query(
    oracle(
        """SELECT * FROM (SELECT t.* FROM truth t FULL JOIN other o ON t.dwid = o.dwid)
        WHERE pickup_datetime IS NOT NULL""",
        "fact",
        **UNIQUE_SIDES,
    )
)
def reconcile(spark, sf):
    return merge.reconcile(*unique_sides(spark, sf))


@query(
    oracle(
        """SELECT * FROM (SELECT coalesce(t.dwid, o.dwid) AS dwid,
            coalesce(t.pickup_datetime, o.pickup_datetime) AS pickup_datetime,
            coalesce(t.fare_amount, o.fare_amount) AS fare_amount,
            coalesce(t.total_amount, o.total_amount) AS total_amount
            FROM truth t FULL JOIN other o ON t.dwid = o.dwid)
        WHERE pickup_datetime IS NOT NULL""",
        "fact",
        **UNIQUE_SIDES,
    )
)
def reconcile_coalesce(spark, sf):
    return merge.reconcile(*unique_sides(spark, sf), mode="coalesce")


_LOSS = """SELECT count(*) AS total_rows, count(*) FILTER (WHERE pickup_datetime IS NULL) AS lost_rows,
    CAST(count(*) FILTER (WHERE pickup_datetime IS NULL) AS DOUBLE) / count(*) * 100 AS loss_percent,
    CAST({limit} AS DOUBLE) AS limit_percent,
    CAST(count(*) FILTER (WHERE pickup_datetime IS NULL) AS DOUBLE) / count(*) * 100 >= {limit} AS breached
    FROM {rows}"""


@query(
    oracle(
        _LOSS.format(
            limit=10.0,
            rows="(SELECT t.pickup_datetime FROM truth t FULL JOIN other o ON t.dwid = o.dwid)",
        ),
        "fact",
        **UNIQUE_SIDES,
    )
)
def reconcile_loss(spark, sf):
    return merge.reconcile_loss(*unique_sides(spark, sf), level="moderate")


@query(
    oracle(
        """SELECT *, lost_rows > 0 AND loss_percent >= 10 AS breached FROM (
            SELECT year_month, count(*) AS total_rows, sum(lost)::BIGINT AS lost_rows,
                CAST(sum(lost) AS DOUBLE) / count(*) * 100 AS loss_percent, CAST(10 AS DOUBLE) AS limit_percent
            FROM (SELECT strftime(pickup_datetime, '%Y_%m') AS year_month,
                    CASE WHEN pickup_datetime IS NULL THEN 1 ELSE 0 END AS lost FROM truth
                UNION ALL SELECT strftime(pickup_datetime, '%Y_%m'), 1 FROM other
                WHERE dwid NOT IN (SELECT dwid FROM truth)) GROUP BY year_month)""",
        "fact",
        **UNIQUE_SIDES,
    )
)
def reconcile_loss_by_month(spark, sf):
    return merge.reconcile_loss_by_month(*unique_sides(spark, sf), level="moderate")


@query(oracle(_LOSS.format(limit=5.0, rows="truth"), "fact", **UNIQUE_SIDES))
def loss_report(spark, sf):
    return merge.loss_report(unique_sides(spark, sf)[0], "pickup_datetime", "strict")


@query(
    oracle(
        f"""SELECT * FROM fact WHERE cab_type = 'yellow' AND NOT ({_IN_MONTH})
        UNION ALL SELECT * FROM fact WHERE cab_type = 'green' AND {_IN_MONTH}""",
        "fact",
    )
)
def reload_month(spark, sf):
    return merge.reload_month(
        _target(spark, sf), standins.fact_part(spark, sf, "green"), "1997_12"
    )
