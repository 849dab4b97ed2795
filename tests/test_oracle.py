"""Every registered query against its DuckDB oracle, exact multiset equality."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        if isinstance(v, float):
            return ("nan",) if math.isnan(v) else v + 0.0
        return v.item() if hasattr(v, "item") else v
    rows = [tuple(norm(r[c]) for c in cols) for _, r in pdf.iterrows()]
    return cols, sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "label", "x_sum", "score", "prediction", "error"]


def test_every_core_query_has_an_oracle():
    from marginflow.plans.catalog import QUERIES
    assert set(QUERIES) <= set(oracle_sql())
