"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from actionlens.plans import catalog, catalog_model, catalog_store  # noqa: F401
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = catalog.ORACLE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert missing <= {"gbt_scores", "gbt_weighted_scores", "rf_scores", "logloss", "logloss_rounds", "backtest", "model_submission", "weighted_submission", "forest_submission"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    want = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(dcols) == cols
    assert _rows(got, cols) == _rows(want, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
