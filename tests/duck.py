"""Queries against their SQL."""

from pathlib import Path


def compare(spark, sf, query, sql):
    """Rows of a query and of its SQL in DuckDB, as sorted lists of rounded values under sorted column names."""
    import decimal

    import duckdb

    def plain(v):
        if isinstance(v, decimal.Decimal):
            v = float(v)
        return round(v, 6) if isinstance(v, float) else v

    df = query(spark, sf)
    cols = sorted(df.columns)
    left = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    out = c.execute(sql)
    names = [d[0] for d in out.description]
    assert sorted(names) == cols
    right = sorted((tuple(plain(dict(zip(names, r, strict=True))[k]) for k in cols) for r in out.fetchall()), key=str)
    return left, right
