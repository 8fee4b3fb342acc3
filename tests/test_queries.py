"""Linkage queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from kinlink.plans import corpus

DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracles.oracle_sql()


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple("-" if x is None or isinstance(x, float) and math.isnan(x) else f"{x:.5f}" if isinstance(x, float) else str(x) for x in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    assert rows(corpus.queries()[name](spark, DIR).toPandas()) == rows(db.execute(ORACLES[name]).df())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(entry.queries())


def test_trained_scores_tell_matches_apart(spark):
    """The trees have no SQL: their scores of the validation split are held within fixed ranges."""
    out = corpus.gbt_scores(spark, "/root/testdata/sf0.01").toPandas()
    assert out.match_probability.between(0, 1).all() and set(out.predicted_match) <= {0, 1}
    assert (out.predicted_match == (out.match_probability >= 0.5)).all()
    mean = out.groupby("label").match_probability.mean()
    assert mean[1] - mean[0] > 0.2 and (out.predicted_match == out.label).mean() > 0.9
