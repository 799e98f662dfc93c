"""Compare a query with its SQL on DuckDB: columns, row count and every value."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(r[i] for i in order) for r in records]
    return sorted(out, key=repr)


def difference(df, con, sql) -> str | None:
    """What differs, or None."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    want_names, want = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} against {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = _norm(got_names, got), _norm(want_names, want)
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{sorted(got_names)}: {a} against {b}"
    return None
