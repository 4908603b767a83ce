"""Rows of a query against rows of its oracle SQL."""

from __future__ import annotations

from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value != value:
        return None
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path / '*.parquet' if path.is_dir() else path}')")
    return con


def same(spark, con, query, sql: str, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = rows_of(names, [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in cur.fetchall()])
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(x == y or (isinstance(x, float) and isinstance(y, (int, float)) and abs(x - y) < 2e-4) for x, y in zip(a, b, strict=True)), (a, b)
