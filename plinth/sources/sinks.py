"""Writers: JSON lines of figures, candidates, summary, table files and image copies."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.classify import false_candidates, review_candidates
from plinth.operators.tables import table_csv, table_json


def write_figures(figures: DataFrame, path: str) -> None:
    """One JSON object per line with all fields, nulls too; one folder per paper, rows by position within it."""
    ordered = figures.repartition("paper_id").sortWithinPartitions("paper_id", "position", "is_merged_figure")
    ordered.withColumn("paper", F.col("paper_id")).write.mode("overwrite").partitionBy("paper").json(path, ignoreNullFields=False)


def write_candidates(figures: DataFrame, path: str) -> None:
    write_figures(false_candidates(figures), f"{path}/figure_false_candidates")
    write_figures(review_candidates(figures), f"{path}/figure_review_candidates")


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_markdown(papers: DataFrame, path: str) -> None:
    papers.select(F.regexp_replace("markdown", r"\r\n?", "\n").alias("value"), F.col("paper_id").alias("paper")).write.mode("overwrite").partitionBy("paper").text(path)


def table_files(info: DataFrame) -> DataFrame:
    """paper_id, table_id, csv (binary, with a byte order mark), json: the two files of each parsed table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch["headers"].to_pylist(), batch["cells"].to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([batch["paper_id"], batch["table_id"], pa.array([table_csv(h, c) for h, c in pairs], pa.binary()), pa.array([table_json(h, c) for h, c in pairs])], ["paper_id", "table_id", "csv", "json"])

    return info.filter("error is null").select("paper_id", "table_id", "headers", "cells").mapInArrow(build, "paper_id string, table_id string, csv binary, json string")


def write_tables_index(info: DataFrame, path: str) -> None:
    info.drop("headers", "cells", "error").write.mode("overwrite").json(path, ignoreNullFields=False)


def vision_copies(figures: DataFrame, folder: str) -> DataFrame:
    """Figures with vision_image_path set for those that are sent to the vision model and have a file."""
    sent = F.col("send_to_vision_model") & ~F.col("is_fragment") & (F.coalesce("image_path", F.lit("")) != "")
    return figures.withColumn("vision_image_path", F.when(sent, F.concat(F.lit(f"{folder}/"), F.regexp_extract("image_path", r"([^/]*)$", 1))))


def write_images(figures: DataFrame, contents: DataFrame, path: str) -> None:
    """Copies of the images with a vision_image_path (contents: image_path, content), as a table of names and bytes.

    The last of equal names stays. A table is written, since executors share no local folders.
    """
    rows = figures.filter("vision_image_path is not null").join(contents, "image_path")
    rows.groupBy("paper_id", "vision_image_path").agg(F.max_by("content", "position").alias("content")).write.mode("overwrite").parquet(path)
