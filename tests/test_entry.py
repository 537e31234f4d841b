import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from riskloom.plans.catalog import load_all

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()
# Queries that train or stream take long; the operators behind them have tests of their own.
SLOW = ("model_registry", "retrained_scores", "stream_retrain_gate", "stream_retrained_scores", "holdout_auc",
        "model_save_load", "feature_screen_corr", "scored_with_keys", "model_balance", "holdout_metrics",
        "scored_new_rows", "train_log_odds", "stream_score", "ledger_versions", "stream_retrain_rebuilt", "stream_score_current",
        "registry_metrics", "sparse_code_rates", "train_contrasts")


@pytest.fixture(scope="module")
def duck(tables):
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return con


def rows(frame):
    def plain(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else v

    ordered = frame[sorted(frame.columns)]
    return sorted(repr(tuple(map(plain, r))) for r in ordered.astype(object).itertuples(index=False))


def test_registration():
    queries, sql = load_all()
    assert set(queries) <= set(entry_point.queries()) and set(sql) <= set(entry_point.oracle_sql())
    assert set(SLOW) <= set(sql) <= set(queries)
    assert set(queries) - set(sql) == {"train_coefficients", "scored_lines", "scored_embeddings", "embedding_auc"}


@pytest.mark.parametrize("name", [n for n in load_all()[1] if n not in SLOW])
def test_query_equals_its_sql(spark, tables, duck, name):
    ours, expected = entry_point.queries()[name](spark, tables).toPandas(), duck.sql(entry_point.oracle_sql()[name]).df()
    assert set(ours.columns) == set(expected.columns)
    assert rows(ours) == rows(expected)


def test_entry(spark):
    scored = entry_point.entry(spark)
    assert scored.columns == ["l_orderkey", "l_linenumber", "p_positive", "p_negative", "prediction"]
    assert scored.count() == 6000
