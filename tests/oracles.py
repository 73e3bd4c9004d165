"""Comparison of queries with their SQL on the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connected(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order)) for r in found)


def same(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = con.execute(sql)
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(got.fetchall(), columns)
