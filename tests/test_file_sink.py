"""Files that appear as a whole: killed, repeated and overwriting runs."""

import os

import pytest
from pyspark.sql import functions as F

from tessella import session
from tessella.sources import sinks


def files(folder):
    return sorted(os.path.relpath(os.path.join(d, n), folder) for d, _, names in os.walk(folder) for n in names if n != sinks.MANIFEST)


def rows(spark, n, text="x", start=0):
    return spark.range(start, n).select(F.format_string("a/f%03d.txt", "id").alias("name"), F.lit(text).cast("binary").alias("data"))


def test_a_killed_run_shows_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    broken = rows(spark, 40).repartition(4).withColumn("data", F.when(F.col("name") == "a/f017.txt", F.raise_error(F.lit("killed")).cast("binary")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="killed"):
        sinks.write_files(broken, folder)
    assert sinks.published(folder) is None and files(folder) == []
    sinks.write_files(rows(spark, 5), folder)
    first = sinks.published(folder)
    with pytest.raises(Exception, match="killed"):
        sinks.write_files(broken, folder, "overwrite")
    assert sinks.published(folder) == first and files(folder) == [f"a/f00{i}.txt" for i in range(5)]


def test_repeated_and_overwriting_runs(spark, tmp_path):
    folder = str(tmp_path / "out")
    sinks.write_files(rows(spark, 6).repartition(3), folder)
    sinks.write_files(rows(spark, 8, "y", 4).repartition(2), folder)
    assert files(folder) == [f"a/f00{i}.txt" for i in range(8)] and sinks.published(folder)["files"] == 4
    assert [open(f"{folder}/a/f00{i}.txt").read() for i in range(8)] == ["x"] * 4 + ["y"] * 4
    sinks.write_files(rows(spark, 3, "z"), folder, "overwrite")
    assert files(folder) == [f"a/f00{i}.txt" for i in range(3)] and not [n for n in os.listdir(folder) if n.startswith("_staging")]
    assert spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).count() == 3


def test_no_rows_are_a_run_too(spark, tmp_path):
    folder = str(tmp_path / "out")
    sinks.write_files(rows(spark, 3), folder)
    sinks.write_files(rows(spark, 0), folder, "overwrite")
    assert files(folder) == [] and sinks.published(folder)["files"] == 0


def test_shared_folders_can_be_dropped(spark):
    kept = len(session._MADE)
    df = session.materialise(spark.range(5), "dropped")
    path = session._MADE[-1]
    assert df.count() == 5 and session.drop_shared(spark, kept) == kept
    assert not os.path.exists(path.removeprefix("file://")) and len(session._MADE) == kept
