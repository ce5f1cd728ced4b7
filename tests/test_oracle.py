"""Every registered query against its DuckDB statement on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["embeddings", "documents"]

#: queries that SQL cannot express; their own tests hold them against brute force
NO_SQL = {"knn_index_topk", "knn_index_recall"}
#: the optional training-data operators are tested beside them
OWN = sorted(n for n in E.oracle_sql() if not (n.startswith("op") and n[2:3].isdigit()) and n != "pipeline")


def _norm(v):
    if v is None or v is pd.NA:
        return "nan"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_an_oracle():
    ours = {n for n in E.queries() if not (n.startswith("op") and n[2:3].isdigit()) and n != "pipeline"}
    assert ours == set(OWN) | NO_SQL
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


_SAME = {("string", "VARCHAR"), ("bigint", "BIGINT"), ("double", "DOUBLE"), ("int", "INTEGER"),
         ("boolean", "BOOLEAN")}


@pytest.mark.parametrize("name", OWN)
def test_query_types_match_oracle(spark, con, name):
    stypes = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert set(stypes) == set(dtypes)
    assert all((stypes[c], dtypes[c]) in _SAME for c in stypes), {c: (stypes[c], dtypes[c]) for c in stypes}
