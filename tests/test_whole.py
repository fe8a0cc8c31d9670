"""Queries that once joined a part of a table, on tables where that part is not enough."""

import duckdb

from spectrail.plans import queries

TABLES = {
    "customer": "SELECT i::BIGINT AS c_custkey, (i * 10 + 5)::DOUBLE AS c_acctbal FROM range(0, 40) g(i)",
    "supplier": "SELECT i::BIGINT AS s_suppkey, 1.0::DOUBLE AS s_acctbal FROM range(0, 3) g(i)",
    # the last order's customer is none, and its user has no events
    "orders": "SELECT i::BIGINT AS o_orderkey, (CASE WHEN i = 40 THEN 90 ELSE i END)::BIGINT AS o_custkey, 'O' AS o_orderstatus FROM range(0, 41) g(i)",
    "events": "SELECT i::BIGINT AS event_id, (i % 4)::BIGINT AS user_id, (i * 0.02)::DOUBLE AS value FROM range(0, 400) g(i)",
}


def found(spark, folder, name):
    """Rows of a query, after a look at its SQL's, by order."""
    con = duckdb.connect()
    for t, sql in TABLES.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    got = sorted(tuple(r) for r in queries.queries()[name](spark, str(folder)).collect())
    assert got == sorted(con.execute(queries.oracle_sql()[name]).fetchall())
    return got


def test_scored_rows(spark, tmp_path):
    got = found(spark, tmp_path, "scored_rows")
    assert [r[0] for r in got if r[1] > 0] == list(range(40)) and got[40] == (40, 0.0, 0.0)


def test_observed_times(spark, tmp_path):
    assert found(spark, tmp_path, "observed_times") == [*((i, i * 10 + 5.0) for i in range(40)), (40, 0.0)]


def test_predicted_rows(spark, tmp_path):
    assert found(spark, tmp_path, "predicted_rows") == [(i, i % 2, i * 10 + 5.0) for i in range(40)]


def test_fill_and_insert(spark, tmp_path):
    assert found(spark, tmp_path, "fill_and_insert") == [*((i, i, i * 10 + 5.0, "O") for i in range(40)), (40, 90, 0.0, "O")]
