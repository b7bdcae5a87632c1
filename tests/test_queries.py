"""Every query with an oracle against DuckDB on the smallest tables."""

import math
import os
import shutil

import duckdb
import pytest

from quillwave.plans import catalogue, media  # noqa: F401  media adds its queries to the catalogue
from quillwave.sources import listing

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rows(frame, columns):
    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else v

    return sorted(repr(tuple(plain(v) for v in r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_oracle(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
    assert len(got) > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize(("opens", "named"), [(True, "{}"), (True, "file://{}/"), (False, "{}"), (False, "file://{}/")])
def test_table_files_in_parts(spark, duck, tmp_path, monkeypatch, opens, named):
    """Tables that are folders of parts, as larger copies are, or of partitions, beside tables of one file."""
    for i, t in enumerate(TABLES):
        for place in ([""], ["/part-0000.parquet", "/part-0001.parquet"], ["/part-0000.parquet", "/k=1/part-0000.parquet"])[i % 3]:
            (tmp_path / f"{t}.parquet{place}").parent.mkdir(exist_ok=True)
            shutil.copy(f"{DATA}/{t}.parquet", tmp_path / f"{t}.parquet{place}")
    if not opens:
        monkeypatch.setattr(listing, "_opens", lambda path: False)  # a store that only Spark reads
    got = catalogue.QUERIES["table_files"](spark, named.format(tmp_path)).toPandas()
    want = duck.execute(catalogue.ORACLE_SQL["table_files"]).df()
    assert rows(got, ["name", "place"]) == rows(want, ["name", "place"])
