"""Tasks that still write while their run is taken back."""

import os
import threading
import time
from types import SimpleNamespace

import pyarrow as pa
import pyspark
import pytest
from pyspark.sql import functions as F

from tessella.sources import sinks


def test_a_late_task_leaves_nothing(tmp_path, monkeypatch):
    """A task that writes on while its run is aborted: it fails, and no file of it stays."""
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: SimpleNamespace(taskAttemptId=lambda: 7))
    writer = sinks.FileSource({"path": str(tmp_path / "out")}).writer(None, False)
    started, failed = threading.Event(), threading.Event()

    def batches():
        for i in range(1000):
            yield pa.RecordBatch.from_pydict({"name": [f"a{i % 50}/f{i}.txt"], "data": [b"x"]})
            if i == 200:
                started.set()
            time.sleep(0.001)

    def late():
        try:
            writer.write(batches())
        except FileNotFoundError:
            failed.set()

    task = threading.Thread(target=late)
    task.start()
    assert started.wait(20)
    writer.abort([])
    task.join(30)
    assert os.listdir(tmp_path / "out") == [] and failed.is_set()


def test_a_task_behind_the_killed_one_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.range(0, 4000, 1, 4).select(F.format_string("a%02d/f%04d.txt", F.col("id") % 40, "id").alias("name"), F.when(F.col("id") == 100, F.raise_error(F.lit("killed")).cast("binary")).otherwise(F.lit("x").cast("binary")).alias("data"))
    with pytest.raises(Exception, match="killed"):
        sinks.write_files(rows, folder)
    assert sinks.published(folder) is None and [n for _, _, names in os.walk(folder) for n in names] == []
