"""Every operator query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from quillwave.llm import queries

DATA = "/root/testdata/sf0.001"


def rows(frame, columns):
    whole = lambda v: int(v) if isinstance(v, float) and v == int(v) else v
    return sorted(repr(tuple(whole(v) for v in r)) for r in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) > 0
    assert rows(got, columns) == rows(want, columns)
