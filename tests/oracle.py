"""Run a query and its SQL side by side, as the driver does: same columns, same rows in any order."""

import os

import duckdb


def plain(rows):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = plain(tuple(r) for r in df.select(*columns).collect())
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    names = ", ".join(f'"{c}"' for c in columns)
    want = plain(con.sql(f"select {names} from ({sql})").fetchall())
    assert got == want
