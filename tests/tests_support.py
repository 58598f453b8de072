"""Comparing a query with its SQL on the smallest tables."""

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compare(spark, name, query, sql, sf_dir="/root/testdata/sf0.001"):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(sql)
    got = query(spark, sf_dir)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns), name
    order = [want.columns.index(c) for c in columns]
    a = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    b = sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
    assert a == b, name
