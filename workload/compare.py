"""Run a query in Spark and its SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from workload.registry import ORACLES, QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def compare(spark, con, sf: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, sf)
    got_columns = sorted(df.columns)
    rows = df.select(*got_columns).collect()
    if name not in ORACLES:
        return f"no SQL to compare {len(rows)} rows with"
    relation = con.sql(ORACLES[name])
    want_columns = sorted(relation.columns)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    simple = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    off = {c: (types[c], kinds[c]) for c in got_columns if simple.get(kinds[c], kinds[c]) != types[c]}
    if off:
        return f"types {off}"
    want = con.sql(f"SELECT {', '.join(want_columns)} FROM ({ORACLES[name]})").fetchall()
    a = Counter(tuple(_plain(v) for v in r) for r in rows)
    b = Counter(tuple(_plain(v) for v in r) for r in want)
    if a != b:
        return f"{len(rows)} vs {len(want)} rows; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}"
    return None if rows else "no rows on both sides"


if __name__ == "__main__":
    import workload.all_queries  # noqa: F401
    from hexmart.session import local_session

    scale, wanted = sys.argv[1], sys.argv[2:]
    folder = f"/root/testdata/{scale}"
    session, connection = local_session(8), connect(folder)
    for key in wanted or QUERIES:
        start = time.time()
        try:
            verdict = compare(session, connection, folder, key)
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:1200]}"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {key} {time.time() - start:.1f}s {verdict or ''}", flush=True)
