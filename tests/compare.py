"""Compare a Spark result with its SQL oracle, ignoring row order."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _kind(text: str) -> str:
    text = text.lower()
    return {"int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}.get(text, text)


def difference(spark_frame, con, sql: str) -> str | None:
    """What differs, or None."""
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}").fetchall()
    described = con.execute("DESCRIBE theirs").fetchall()
    their_types = {row[0]: _kind(row[1]) for row in described}
    names = sorted(spark_frame.columns)
    if names != sorted(their_types):
        return f"columns {names} against {sorted(their_types)}"
    ours_types = {f.name: _kind(f.dataType.simpleString()) for f in spark_frame.schema.fields}
    if ours_types != their_types:
        odd = {n: (ours_types[n], their_types[n]) for n in names if ours_types[n] != their_types[n]}
        return f"types {odd}"
    con.register("ours", spark_frame.select(*[f"`{n}`" for n in names]).toArrow())
    quoted = ", ".join(f'"{n}"' for n in names)
    counts = con.execute(
        f"""SELECT (SELECT count(*) FROM ours), (SELECT count(*) FROM theirs),
        (SELECT count(*) FROM (SELECT {quoted} FROM ours EXCEPT ALL SELECT {quoted} FROM theirs)),
        (SELECT count(*) FROM (SELECT {quoted} FROM theirs EXCEPT ALL SELECT {quoted} FROM ours))"""
    ).fetchall()[0]
    if counts[0] != counts[1] or counts[2] or counts[3]:
        left = con.execute(
            f"SELECT {quoted} FROM ours EXCEPT ALL SELECT {quoted} FROM theirs ORDER BY ALL LIMIT 2"
        ).fetchall()
        right = con.execute(
            f"SELECT {quoted} FROM theirs EXCEPT ALL SELECT {quoted} FROM ours ORDER BY ALL LIMIT 2"
        ).fetchall()
        return f"rows {counts}\n   ours {left}\n   sql  {right}"
    return None


def main(sf_dir: str, *only: str) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as contract
    from curbline.session import build_session

    spark = build_session("compare", 8)
    oracles, failed = contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if only and name not in only:
            continue
        con = connect(sf_dir)
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            found = (
                difference(frame, con, oracles[name])
                if name in oracles
                else f"no oracle, {frame.count()} rows"
            )
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        spent = time.time() - start
        print(f"{'ok  ' if found is None else 'DIFF'} {spent:6.2f}s {name}", flush=True)
        if found:
            failed += 1
            print(f"   {found}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    main(*sys.argv[1:])
