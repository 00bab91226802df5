"""Bulk requests through lost tasks and repeated batches."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import jobs
from millrace.sinks import documents
from millrace.sources.lines import stream_text_lines

REPO = str(Path(__file__).resolve().parents[1])


def stored(folder):
    """Documents by id as an index would hold them, and how often each request came."""
    index, times = {}, Counter()
    for path in sorted(Path(folder).iterdir()):
        times[path.name.split("_")[0]] += 1
        lines = path.read_text().splitlines()
        for action, document in zip(lines[::2], lines[1::2]):
            index.setdefault(json.loads(action)["index"]["_id"], set()).add(document)
    return index, times


def sender(folder, fails=None):
    def send(request):
        import os
        import uuid

        name = f"{request.batch}-{request.part}-{request.number}"
        with open(os.path.join(folder, f"{name}_{uuid.uuid4().hex}"), "w") as out:
            out.write(request.body("readings"))
        if fails and name == fails:
            raise RuntimeError("connection lost")

    return send


def rows(spark):
    return spark.range(0, 1000, 1, 4).withColumn("document", F.to_json(F.struct("id")))


def test_a_repeated_batch_sends_what_is_left(spark, tmp_path):
    target, ledger = tmp_path / "sent", str(tmp_path / "ledger")
    target.mkdir()
    with pytest.raises(Exception, match="connection lost"):
        documents.write_once(rows(spark), F.col("document"), sender(str(target), "7-2-1"), ledger, 7, 50)
    # The rows of the second call do not count: the batch was laid down by the first.
    documents.write_once(rows(spark).limit(0), F.col("document"), sender(str(target)), ledger, 7, 50)
    index, times = stored(target)
    assert len(index) == 1000 and all(len(d) == 1 for d in index.values())
    assert {json.loads(d)["id"] for [d] in map(list, index.values())} == set(range(1000))
    assert len(times) == 20 and times["7-2-1"] == 2 and sum(times.values()) < 40
    documents.write_once(rows(spark), F.col("document"), sender(str(target)), ledger, 7, 50)
    assert stored(target)[1] == times
    documents.write_once(rows(spark), F.col("document"), sender(str(target)), ledger, 8, 50)
    assert sorted(os.listdir(ledger)) == ["batch=8"] and len(stored(target)[0]) == 2000


KILLED = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from millrace.sinks import documents
target, ledger = sys.argv[1:]
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()

def send(request):
    import uuid
    with open(os.path.join(target, f"{request.number}_{uuid.uuid4().hex}"), "w") as out:
        out.write(request.body("readings"))
    flag = os.path.join(ledger + "-killed")
    if request.number == 3 and not os.path.exists(flag):
        open(flag, "w").close()
        os._exit(1)

rows = spark.range(0, 500, 1, 1).withColumn("document", F.to_json(F.struct("id")))
documents.write_once(rows, F.col("document"), send, ledger, 0, 50)
"""


def test_a_killed_task_leaves_each_document_once(tmp_path):
    """The Python worker dies right after a request; Spark runs the task again."""
    target, ledger = tmp_path / "sent", tmp_path / "ledger"
    target.mkdir()
    env = {**os.environ, "PYTHONPATH": REPO}
    done = subprocess.run(
        [sys.executable, "-c", KILLED, str(target), str(ledger)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
    index, times = stored(target)
    assert times["3"] == 2 and len(index) == 500 and all(len(d) == 1 for d in index.values())


def test_sensor_documents_as_a_stream(spark, tmp_path):
    target, folder = tmp_path / "sent", tmp_path / "lines"
    target.mkdir(), folder.mkdir()
    for n in range(2):
        (folder / f"{n}.txt").write_text("".join(f"p{i}, {i}, 1.5\n" for i in range(150 * n, 150 * n + 150)))
        jobs.start_sensor_documents(
            stream_text_lines(spark, str(folder)), sender(str(target)), str(tmp_path / "state"), available_now=True
        ).awaitTermination()
    index, times = stored(target)
    assert len(index) == 300 and set(times.values()) == {1}


def test_ids_need_a_document_each():
    with pytest.raises(ValueError):
        documents.bulk_body(["{}", "{}"], "readings", ids=["1"])
