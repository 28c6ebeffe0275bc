"""Arriving files: the row-local operators over a streaming file source, and rolling run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving_files(spark: SparkSession, root: str, pattern: str = "*.png") -> DataFrame:
    """(path, length, content, modified) of files as they appear."""
    stream = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").schema("path string, modificationTime timestamp, length long, content binary").load(root)
    return stream.select("path", "length", "content", F.col("modificationTime").alias("modified"))


def arriving_metrics(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(root)


def rolling_loss(metrics: DataFrame, time_col: str = "ts", size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(window begin, n, mean train and val loss) by event time; late rows are dropped behind the watermark."""
    by = metrics.withWatermark(time_col, delay).groupBy(F.window(time_col, size))
    return by.agg(F.count("*").alias("n"), F.avg("train_loss").alias("train_loss"), F.avg("val_loss").alias("val_loss")).select(F.col("window.start").alias("begin"), "n", "train_loss", "val_loss")


def run_to_end(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Take in all that is there and stop; a later call goes on where this one ended."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(folder)
    query.awaitTermination()
    return query
