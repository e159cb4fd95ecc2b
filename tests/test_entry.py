"""The driver's contract: every query runs, and agrees with its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

FAST = ["quality_score", "reject_reason", "validate_errors", "fresh_by_type_summary", "url_item_norm", "link_extract_top10", "resolve_product_ctx", "merge_cluster", "claim_state", "pagination_stop"]


def plain(df):
    rows = df[sorted(df.columns)].astype(object).itertuples(index=False)
    return sorted(tuple("" if v is None or v is pd.NA or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
