"""Cell-by-cell comparison of a query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def sql_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def _cell(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, sql: str, sf_dir: str) -> str:
    """Empty if equal, else a short description."""
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = canonical(*sql_rows(sql, sf_dir))
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""
