"""Streaming intake: Markdown files that arrive in a folder become figure tokens, each image content once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import text as X
from plinth.sources.layout import base_name


def markdown_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """paper_id, markdown, arrived: one row per file; the file's time is the event time."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.md").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select(F.regexp_replace(base_name(F.col("path")), r"\.md$", "").alias("paper_id"), F.decode("content", "UTF-8").alias("markdown"), F.col("modificationTime").alias("arrived"))


def image_stream(papers: DataFrame, delay: str = "1 day") -> DataFrame:
    """paper_id, raw_path, arrived of the images of a stream of papers; copies within the delay appear once."""
    rows = papers.select("paper_id", "arrived", F.explode(F.regexp_extract_all("markdown", F.lit(X.IMAGE), F.lit(2))).alias("raw_path"))
    return rows.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["paper_id", "raw_path"])


def counts_per_window(images: DataFrame, width: str = "1 hour") -> DataFrame:
    """Images that arrived in each window of time, as a windowed aggregation with the watermark's late-data bound."""
    return images.groupBy(F.window("arrived", width).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")
