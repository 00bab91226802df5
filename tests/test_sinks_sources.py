from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import words
from millrace.session import shared_dir
from millrace.sinks import documents, files
from millrace.sinks import kafka as kafka_sink
from millrace.sources import kafka, lines


def test_text_round_trip(spark, make, tmp_path):
    out = str(tmp_path / "words")
    files.write_pairs(words.word_count(make([("a b a",)], "value STRING")), out)
    assert sorted(r.value for r in lines.text_lines(spark, out).collect()) == ["(a,2)", "(b,1)"]


def test_collection_keeps_arrival_order(make):
    rows = make([("x",), ("y",)], "value STRING")
    assert [(r.value, r.seq) for r in rows.orderBy("seq").collect()] == [("x", 0), ("y", 1)]


def test_kafka_options():
    options = kafka.consumer_options("h:1", "t", "g")
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "kafka.group.id": "g"
    }
    assert kafka.consumer_options("h:1", "t", offset_reset="earliest", max_offsets_per_batch=5)["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError):
        kafka.consumer_options("h:1", "t", offset_reset="none")
    assert kafka_sink.producer_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_kafka_values(make):
    rows = kafka_sink.encode_values(make([(5,)], "x LONG"), F.col("x"))
    assert rows.columns == ["value"] and rows.first().value == "5"


def test_bulk_body():
    body = documents.bulk_body(['{"a":"1"}', '{"a":"2"}'], "sensors", "reading").splitlines()
    assert len(body) == 4 and json.loads(body[0]) == {"index": {"_index": "sensors", "_type": "reading"}}


def test_print_rows(make, capsys):
    assert files.print_rows(make([("x",)], "value STRING"), "main") is None
    assert "main" in capsys.readouterr().out


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_no_console_query_without_a_stream(make):
    assert not make([("x",)], "value STRING").isStreaming
