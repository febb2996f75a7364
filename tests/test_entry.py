"""The driver contract, on the smallest sample."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from check import VIEWS, compare  # noqa: E402

# Covers every layer; the checker script runs the complete list.
CHOSEN = [
    "bronze_click_sessions",
    "silver_olist_customers",
    "silver_olist_products",
    "silver_olist_order_reviews",
    "silver_click_customers",
    "silver_click_events",
    "dim_customer",
    "dim_date",
    "fact_orders",
    "fact_clickstream_events",
    "q03_revenue_by_region",
    "q05_review_analysis",
    "q06_funnel_analysis",
    "q07_session_analytics",
    "dq_silver",
    "template_schema",
    "surrogate_key_assignment",
    "cdc_latest_with_before",
    "constraint_report",
    "topic_folder_read",
    "topic_ledger",
    "stream_replay_after_kill",
    "gate_verdicts",
    "quality_log_rows",
    "dq_unreadable",
    "poison_amounts",
    "surrogate_key_dense",
    "csv_seed_in_load_order",
]


@pytest.fixture(scope="module")
def database(sample):
    connection = duckdb.connect()
    for view in VIEWS:
        connection.execute(f"create view {view} as select * from read_parquet('{sample}/{view}.parquet')")
    return connection


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_its_check(spark, database, sample, name):
    assert compare(spark, database, contract.queries()[name], contract.oracle_sql()[name], sample).startswith("ok")


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["region", "state"] and df.count() > 0


def test_every_query_has_a_check():
    """The operators over documents are tested beside themselves; some of them SQL cannot express."""
    assert set(contract.queries()) - set(contract.LLM) == set(contract.oracle_sql()) - set(contract.LLM_SQL)
    assert set(contract.LLM_SQL) <= set(contract.LLM)
    assert len(contract.queries()) > 100


def test_library_uses_no_udf_and_no_local_checkpoint():
    banned = re.compile(r"\budf\(|pandas_udf|localCheckpoint|\.rdd\b|crossJoin|applyInPandas|toPandas")
    everywhere = re.compile(r"localCheckpoint|crossJoin")
    for path in (ROOT / "weirstone").rglob("*.py"):
        assert not everywhere.search(path.read_text()), path
        if "llm" in path.relative_to(ROOT / "weirstone").parts:
            continue
        assert not banned.search(path.read_text()), path
