"""A representative slice of the registered queries against their DuckDB statements (sf0.001)."""

import duckdb
import pytest

from conftest import SF_SMALL
from oracle_check import TABLES, canon

NAMES = ["silver_features", "gold_feature_store", "cleaning_funnel_meta", "monthly_rate", "readiness_gaps",
         "stratified_split", "median_impute", "monthly_auc", "psi_report", "kde_charges", "factorize_codes",
         "classification_report", "onehot"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF_SMALL)
    res = con.execute(oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, res.fetchall())
