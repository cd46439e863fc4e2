"""Runs a query and its DuckDB SQL over the same tables."""

from pathlib import Path

import duckdb


def both(spark, query, sql, sf="/root/testdata/sf0.001"):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = query(spark, sf)
    cols = sorted(got.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()]
    return sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str), sorted(want, key=str)
