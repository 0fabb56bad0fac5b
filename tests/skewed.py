"""Copies of the tables in which one key of each kind holds about a third of the rows."""

import duckdb

HOT_COLUMNS = {
    "customer": "c_nationkey",
    "supplier": "s_nationkey",
    "orders": "o_custkey",
    "lineitem": "l_orderkey, l_suppkey",
    "events": "user_id",
}
OTHERS = "region nation part documents embeddings pages benchmark labels conversations".split()


def skewed_tables(folder: str, target: str) -> str:
    con = duckdb.connect()
    for name, columns in HOT_COLUMNS.items():
        source = f"'{folder}/{name}.parquet'"
        hot = ", ".join(
            f"CASE WHEN hash(rowid_) % 3 = 0 THEN (SELECT min({c}) FROM {source}) ELSE {c} END::"
            f"{'INTEGER' if c.endswith('nationkey') else 'BIGINT'} AS {c}"
            for c in columns.split(", ")
        )
        con.execute(
            f"COPY (SELECT * EXCLUDE (rowid_) REPLACE ({hot}) FROM (SELECT *, row_number() OVER () AS rowid_ "
            f"FROM {source})) TO '{target}/{name}.parquet' (FORMAT parquet)"
        )
    for name in OTHERS:
        con.execute(f"COPY (SELECT * FROM '{folder}/{name}.parquet') TO '{target}/{name}.parquet' (FORMAT parquet)")
    return target
