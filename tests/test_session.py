"""The shared folder, in sessions with and without the setting."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from millrace.session import folders, remove_folder, scratch_path

REPO = str(Path(__file__).resolve().parents[1])
PLAIN = """
from millrace.session import local_session, reliable_checkpoint, scratch_path, shared_dir
spark = local_session(cores=1, partitions=1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert first == shared_dir(spark)
assert reliable_checkpoint(spark.range(5)).count() == 5
path = scratch_path(spark, "rows")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3 and path.startswith(first)
"""


def test_plain_session(tmp_path):
    """No setting at all: a temporary folder, the same one throughout."""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO}
    done = subprocess.run([sys.executable, "-c", PLAIN], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_folders_come_and_go(spark):
    path = scratch_path(spark, "parts")
    assert folders(spark, path) == []
    for name in ("b", "a"):
        spark.range(1).write.parquet(f"{path}/{name}")
    assert folders(spark, path) == ["a", "b"]
    remove_folder(spark, f"{path}/a")
    remove_folder(spark, f"{path}/a")
    assert folders(spark, path) == ["b"]
