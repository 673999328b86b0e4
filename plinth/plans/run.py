"""One run from settings to files: PDFs or archives of the OCR service to figures, tables, summary and a report."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators.figures import image_tokens
from plinth.operators.summary import class_histogram
from plinth.plans.extraction import Extraction, extract
from plinth.sources import files, sinks
from plinth.sources.layout import FILES, base_name, image_layout
from plinth.sources.service import Service, ServiceError, converted
from plinth.sources.settings import figure_options, resolved

DONE, NO_INPUT, FAILED = 0, 1, 2
IMAGES = r"(?i)\.(?:png|jpe?g|gif|bmp|webp)$"


def _paper_id():
    return F.regexp_replace(base_name(F.col("path")), r"\.[^.]*$", "").alias("paper_id")


def keeper(spark: SparkSession, folder: str) -> Callable[[DataFrame], DataFrame]:
    """Writes a table in the folder and reads it back, so that what follows starts from there."""
    numbers = iter(range(1_000_000))

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(numbers):03d}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


def service_of(settings: dict, env: dict[str, str]) -> Service:
    """The service by the environment variables that the settings name."""
    given = settings["service"]
    key, url = (env.get(given.get(name, default), "") for name, default in (("api_key_env", "OCR_API_KEY"), ("base_url_env", "OCR_BASE_URL")))
    return Service(url, key, poll_seconds=given["poll_interval_seconds"], most_seconds=given["max_wait_seconds"])


def extracted(members: DataFrame, settings: dict, keep: Callable[[DataFrame], DataFrame]) -> tuple[Extraction, DataFrame]:
    """The extraction of archive members (path, member, content), and the contents of all images (image_path, content)."""
    papers = keep(files.papers_from_members(members))
    pictures = members.filter(F.col("member").rlike(IMAGES)).select(_paper_id(), F.col("member").alias("file"), "content")
    contents = keep(pictures.select(F.concat_ws("/", "paper_id", "file").alias("image_path"), "content"))
    sizes = keep(files.image_sizes(contents))
    found = files.resolved_images(image_tokens(papers).select("paper_id", "raw_path"), pictures.select("paper_id", "file"))
    images = found.withColumn("image_path", F.concat_ws("/", "paper_id", "image_path")).join(sizes.select("image_path", "image_hash"), "image_path", "left")
    parts = [files.first_named(members.filter("member is not null"), name).withColumn("name", F.lit(name)) for name in FILES]
    named = reduce(DataFrame.unionByName, parts)
    layout = image_layout(named.join(members, ["path", "member"]).select(_paper_id(), "name", F.decode("content", "UTF-8").alias("json")))
    chemistry = settings["chemistry_normalization"]
    done = extract(
        papers, images.select("paper_id", "raw_path", "image_path", "image_hash"), keep(layout), sizes, options=figure_options(settings),
        normalize=chemistry["enabled"], unicode_subscript=chemistry["unicode_subscript"], contents=contents, keep=keep,
    )
    canvases = done.canvases.filter("content is not null").select(F.col("path").alias("image_path"), "content")
    return done, contents.unionByName(canvases)


def write(done: Extraction, contents: DataFrame, out: str) -> None:
    figures = sinks.vision_copies(done.figures, "figures_for_vision")
    sinks.write_figures(figures, f"{out}/figures")
    sinks.write_candidates(done.figures, out)
    sinks.write_images(figures, contents, f"{out}/figures_for_vision")
    sinks.table_files(done.tables).write.mode("overwrite").parquet(f"{out}/tables")
    sinks.write_tables_index(done.tables, f"{out}/tables_index")
    sinks.write_markdown(done.papers, f"{out}/markdown")
    sinks.write_summary(done.summary, f"{out}/figure_stage2_summary")


def report(done: Extraction) -> list[str]:
    """Lines of the counts over all papers, of the clip decisions and of the classes."""
    names = [f.name for f in done.summary.schema if f.name.endswith("_count")]
    row = done.summary.agg(F.count(F.lit(1)).alias("papers"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    lines = [f"papers: {row['papers']}", f"tables_count: {done.tables.filter('error is null').count()}"]
    clip = [n for n in names if n.startswith("clip_")]
    lines += [f"{n}: {row[n]}" for n in names if n not in clip]
    lines += ["clip_decision_counts:", *(f"  {n.removeprefix('clip_').removesuffix('_count')}: {row[n]}" for n in clip)]
    return [*lines, "figure_class_counts:", *(f"  {r['figure_class']}: {r['n']}" for r in class_histogram(done.figures).orderBy("ord").collect())]


def run(spark: SparkSession, settings: dict, root: str | Path, say: Callable[[str], None] = print) -> int:
    """Exit code: DONE, NO_INPUT if there is nothing to read, FAILED if no paper came out of it.

    paths.archives names a folder of the service's zip files; without it the PDFs of paths.input_pdf go through the
    service. Everything is written to paths.output_dir, which executors must share.
    """
    paths = settings.get("paths") or {}
    out = str(resolved(paths.get("output_dir", "data/outputs"), root))
    keep = keeper(spark, f"{out}/work")
    source = resolved(paths.get("archives") or paths.get("input_pdf", "data/pdfs"), root)
    if not source.exists():
        say(f"Input not found: {source}")
        return NO_INPUT
    archives = files.binary_files(spark, str(source), "*.zip" if paths.get("archives") else "*.pdf").select("path", "content")
    if not paths.get("archives"):
        try:
            archives = keep(converted(archives, service_of(settings, {**_env_file(spark, root), **os.environ})))
        except ServiceError as e:
            say(f"Conversion failed: {e}")
            return FAILED
        for r in archives.filter("error is not null").select("path", "error").limit(20).collect():
            say(f"Conversion failed: {r['path']}: {r['error']}")
    members = keep(files.archive_members(archives.filter("content is not null")))
    for r in members.filter("error is not null").select("path", "error").limit(20).collect():
        say(f"Archive not read: {r['path']}: {r['error']}")
    if files.papers_from_members(members).isEmpty():
        say("No paper could be read.")
        return FAILED
    done, contents = extracted(members, settings, keep)
    write(done, contents, out)
    for line in report(done):
        say(line)
    say(f"output_dir: {out}")
    return DONE


def _env_file(spark: SparkSession, root: str | Path) -> dict[str, str]:
    path = Path(root) / ".env"
    return {r["key"]: r["value"] for r in files.env_settings(spark.read.text(str(path))).collect()} if path.exists() else {}
