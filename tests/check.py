"""Compare a Spark result with DuckDB on the same tables: names, types and all rows."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return sorted(map(repr, zip(*[table[c].to_pylist() for c in names]))), names


def types(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def assert_same(df, con, sql):
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    assert types(got) == types(want)
    got_rows, got_names = rows(got)
    want_rows, want_names = rows(want)
    assert got_names == want_names
    assert len(got_rows) == len(want_rows)
    assert got_rows == want_rows
