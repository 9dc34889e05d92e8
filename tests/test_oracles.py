"""Registered queries against their DuckDB oracles at sf0.001 (fast subset; the full set runs in tools/)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
FAST = ["normalize_missing", "price_digits", "parse_list_text", "parse_list_text_single", "days_since_review",
        "round_int_like", "dedup_first", "missing_table", "categorical_describe", "mode_by_group", "median_by_group",
        "group_split", "stratified_folds", "top_vocabulary", "multi_hot", "price_impute", "nearest_group_fallback",
        "feature_target_corr", "histogram", "roc_auc_ovr", "roc_points", "threshold_tune", "spearman", "read_listings"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows, 6) == rows_of(d_cols, d_rows, 6)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert {"occupancy_level", "room_type", "n_rows"} <= set(out.columns)
