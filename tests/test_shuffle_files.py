"""Shuffle files of a table that is written go with the end of the write."""

import time

from tessella import session


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session._CLEANUP, None)
    df = session.materialise(spark.range(1000).repartition(5).groupBy("id").count(), "shuffled")
    ends = time.time() + 10
    while shuffle_files(spark) - before and time.time() < ends:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert df.count() == 1000 and spark.conf.get(session._CLEANUP, None) == setting
