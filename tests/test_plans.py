"""The plans are the ones meant: pruned scans, early limits, no giant expands."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as contract
from millrace import queries as catalog
from millrace.operators import patterns
from millrace.plans import ordered
from millrace.sources.lines import table


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def plan(spark, folder):
    return lambda name: plan_of(contract.queries()[name](spark, folder))


def test_hot_items(plan):
    text = plan("hot_items_topn")
    assert "Expand" not in text
    assert "row_number(), 3, Partial" in text  # every task keeps three rows per window
    assert "partial_count" in text
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    # Panes, blocks and rankings: three shuffles, none of them of all window rows.
    assert text.count("Exchange hashpartitioning") == 3


def test_window_rows_are_not_shuffled(plan):
    text = plan("sliding_count_5s")
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("explode(sequence((__run_from") < text.index("Exchange")


def test_patterns_shuffle_stage_rows_once(plan):
    text = plan("pattern_timeout")
    assert text.count("Exchange hashpartitioning") == 1
    assert "Or(EqualTo(event_type,signup),EqualTo(event_type,purchase))" in text


def test_long_sequences_do_not_meet_in_one_task(spark, folder):
    events = table(spark, folder, "events")
    text = plan_of(patterns.fail_streaks(events, "ts", "event_id", fail="error", keys=[], rows_per_group=50))
    # One shuffle each for the window, the summaries and what they carry; only the last is by key alone.
    assert "SinglePartition" not in text
    by_key = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and ordered.CHUNK not in line]
    assert len(by_key) <= 1


@pytest.mark.parametrize("name", ["split_select", "freeze_side_output", "connect_map", "parse_sensor", "document_payload"])
def test_row_by_row_operators_do_not_shuffle(plan, name):
    assert "Exchange" not in plan(name)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if not n.startswith("stream_")])
def test_no_python_in_batch_plans(plan, name):
    text = plan(name)
    assert "Python" not in text and "InPandas" not in text and "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text
