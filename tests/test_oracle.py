"""Every query against its SQL twin."""

import pytest

from chatlog.operators import events, scan
from __spark_entry__ import entry, oracle_sql, queries
from check import compare


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, sf_dir, name):
    equal, note = compare(spark, duck, sf_dir, name)
    assert equal is not False, note


@pytest.mark.parametrize("name", [
    "concurrency_peaks", "request_health", "replay_savings", "logs_deep_page", "logs_page_crowded", "history_chain_hash", "session_continuity",
    "session_rollover", "session_history", "account_state_history", "event_chunks", "assembled_responses",
    "chunk_reasoning", "chunk_tool_buffer", "early_cut", "transcript_rendered", "tool_catalog",
])
def test_query_in_small_blocks(spark, duck, sf_dir, name, monkeypatch):
    """The same results when every key counts as large and blocks hold few rows."""
    monkeypatch.setattr(scan, "HOT_ROWS", 2)
    monkeypatch.setattr(scan, "BLOCK_ROWS", 20)
    monkeypatch.setattr(events, "BLOCK_ROWS", 5)
    equal, note = compare(spark, duck, sf_dir, name)
    assert equal, note


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
