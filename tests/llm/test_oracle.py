"""Queries with SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from strata.llm.queries import ORACLE, QUERIES
from strata.sources.tables import TABLES


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    res = con.execute(ORACLE[name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(
        [d[0] for d in res.description], res.fetchall())


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_license_scans"])
def test_odd_rows_match_sql(odd_docs, name):
    from strata.llm import license_scan, quality_rules

    got = (quality_rules.judge if name.startswith("op2") else license_scan.scan)(odd_docs)
    con = duckdb.connect()
    con.register("documents", odd_docs.select("doc_id", "text").toPandas())
    con.execute("CREATE TABLE d2 AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM documents")
    res = con.execute(ORACLE[name].replace("FROM documents", "FROM d2"))
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(
        [d[0] for d in res.description], res.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
