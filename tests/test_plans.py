"""Plans: what reaches the scan, what is broadcast, and that text work stays in the JVM."""

import re

import pytest

from __spark_entry__ import queries


def plan(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf_dir):
    from chatlog.operators import transcript
    from chatlog.plans import inputs

    conv = inputs.open_inputs(spark, sf_dir)("conversations")
    text = transcript.last_n_messages(conv)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(role,system)" in text and "Not(EqualTo(role,system))" in text


def test_groups_are_limited_before_the_shuffle(spark, sf_dir):
    assert "row_number(), 20, Partial" in plan(spark, sf_dir, "transcript_rendered")


def test_page_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "logs_page")


def test_model_dimension_is_broadcast(spark, sf_dir):
    assert plan(spark, sf_dir, "resolved_models").count("BroadcastHashJoin") == 2


def test_usage_reads_few_columns_and_joins_sums(spark, sf_dir):
    text = plan(spark, sf_dir, "usage_by_account")
    assert "partial_sum(prompt_tokens" in text


@pytest.mark.parametrize("name", [
    "transcript_rendered", "reasoning_split", "reasoning_stripped", "tool_marker_split", "tool_calls_json",
    "tool_calls_markup", "tool_calls_tag", "tool_usage_report", "chat_export", "flattened_messages",
    "request_parameters_openai", "tool_catalog", "redacted_text", "event_chunks", "assembled_responses",
    "chunk_reasoning", "chunk_tool_buffer",
])
def test_no_python_node(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "Python" not in text and "InPandas" not in text and "CartesianProduct" not in text


def test_only_local_text_work_is_narrow(spark, sf_dir):
    for name in ("reasoning_split", "tool_calls_json", "redacted_text", "flattened_messages"):
        assert "Exchange" not in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["assembled_responses", "chunk_reasoning", "chunk_tool_buffer", "early_cut"])
def test_blocks_of_a_hot_response_stay_apart(spark, sf_dir, name, tmp_path):
    """The texts are dealt out by response and block, and the chunks read twice at most."""
    from chatlog.operators import events
    from chatlog.plans import inputs

    inputs.derived(spark, sf_dir, "chunks").write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = {
            "assembled_responses": events.assemble_responses, "chunk_reasoning": events.segment_reasoning,
            "chunk_tool_buffer": events.segment_tool_buffer, "early_cut": events.reasoning_pieces,
        }[name](chunks)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"hashpartitioning\(response_id#\d+L?, _block#\d+L?", text)
    assert text.count("FileScan parquet") <= 2
