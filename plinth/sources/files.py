"""Files of OCR runs as DataFrames: archives, Markdown, images with their sizes, and lookups by name."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.sources.layout import base_name


#: What of an image is read for its size: headers may hold a preview of 64 KB or more before it.
HEAD = 1 << 18


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def archive_members(files: DataFrame) -> DataFrame:
    """path, member, content, error: the files inside zip archives (path, content), one by one.

    An archive that cannot be read (to its end) has a row with an error and no member; the others go on.
    """

    def row(path: str, member: str | None, content: bytes | None, error: str | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": pa.array([path]), "member": pa.array([member], pa.string()), "content": pa.array([content], pa.binary()), "error": pa.array([error], pa.string())})

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        for info in z.infolist():
                            if not info.is_dir():
                                yield row(path, info.filename, z.read(info), None)
                except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError) as e:
                    yield row(path, None, None, str(e)[:200])

    return files.select("path", "content").mapInArrow(unzip, "path string, member string, content binary, error string")


def papers_from_members(members: DataFrame) -> DataFrame:
    """paper_id, markdown: of each archive ``full.md`` wherever it lies, else the first Markdown file by name."""
    name = base_name(F.col("member"))
    rows = members.filter(F.lower("member").endswith(".md")).withColumn("_rank", F.row_number().over(Window.partitionBy("path").orderBy((name == "full.md").desc(), "member")))
    return rows.filter("_rank = 1").select(F.regexp_replace(base_name(F.col("path")), r"\.[^.]*$", "").alias("paper_id"), F.decode("content", "UTF-8").alias("markdown"))


def first_named(files: DataFrame, name: str) -> DataFrame:
    """path, member of the file with a name in each archive: at the root, else the first of deeper ones."""
    hit = files.filter(base_name(F.col("member")) == name)
    return hit.groupBy("path").agg(F.min_by("member", F.struct(F.col("member") != name, "member")).alias("member"))


def env_settings(lines: DataFrame) -> DataFrame:
    """key, value of KEY=VALUE lines (column value); comments and other lines skipped, the first of equal keys kept."""
    line = F.trim(F.regexp_replace("value", "^﻿", ""))
    rows = lines.select(F.monotonically_increasing_id().alias("n"), line.alias("line")).filter("not startswith(line, '#') and contains(line, '=')")
    rows = rows.select("n", F.trim(F.substring_index("line", "=", 1)).alias("key"), F.regexp_replace(F.trim(F.regexp_replace("line", "^[^=]*=", "")), "^[\"']+|[\"']+$", "").alias("value"))
    return rows.groupBy("key").agg(F.min_by("value", "n").alias("value"))


def image_header(content: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF, BMP or JPEG; None for anything else."""
    c = content or b""
    try:
        if c[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", c[16:24])
        if c[:4] == b"GIF8":
            return struct.unpack("<HH", c[6:10])
        if c[:2] == b"BM":
            w, h = struct.unpack("<ii", c[18:26])
            return w, abs(h)
        if c[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(c):
                if c[at] != 0xFF:
                    return None
                kind = c[at + 1]
                if kind in (0xFF, 0x01) or 0xD0 <= kind <= 0xD8:
                    at += 1 if kind == 0xFF else 2
                    continue
                if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", c[at + 5 : at + 9])
                    return w, h
                at += 2 + struct.unpack(">H", c[at + 2 : at + 4])[0]
    except struct.error:
        pass
    return None


def image_sizes(images: DataFrame) -> DataFrame:
    """image_path, width, height, image_hash of images (image_path, content); null sizes where unreadable."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [image_header(c) or (None, None) for c in batch["head"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["image_path"], batch["image_hash"], pa.array([w for w, _ in found], pa.int32()), pa.array([h for _, h in found], pa.int32())], ["image_path", "image_hash", "width", "height"])

    rows = images.select("image_path", F.sha2("content", 256).alias("image_hash"), F.substring("content", 1, HEAD).alias("head"))
    return rows.mapInArrow(read, "image_path string, image_hash string, width int, height int")


def copied_names(tokens: DataFrame) -> DataFrame:
    """Adds target, the file name of each image's copy: one per content and suffix, and of images that share a name the
    later contents get the start of their hash in it. tokens: paper_id, position, name, image_hash."""
    suffix, stem = F.regexp_extract("name", r"(\.[^.]*)$", 1), F.regexp_replace("name", r"\.[^.]*$", "")
    same = Window.partitionBy("paper_id", "image_hash", suffix).orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = tokens.withColumn("_name", F.first("name").over(same)).withColumn("_at", F.first("position").over(same))
    holder = F.first("image_hash").over(Window.partitionBy("paper_id", "_name").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stem = F.regexp_replace("_name", r"\.[^.]*$", "")
    return rows.withColumn("target", F.when(holder == F.col("image_hash"), F.col("_name")).otherwise(F.concat(stem, F.lit("_"), F.left("image_hash", F.lit(8)), F.regexp_extract("_name", r"(\.[^.]*)$", 1)))).drop("_name", "_at")


def decoded_target(raw: Column) -> Column:
    """URL-decoded; ``+`` stays, and what does not decode stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def resolved_images(tokens: DataFrame, files: DataFrame) -> DataFrame:
    """paper_id, raw_path, image_path: the file of each local target, by path, by name, or by a long name's beginning.

    files: paper_id, file (path within the paper). Truncated names count if the suffix is equal and one name (of 16
    characters at least) begins with the other or both begin with the same 32 characters.
    """
    wanted = tokens.select("paper_id", "raw_path").distinct().withColumn("path", decoded_target(F.col("raw_path"))).filter(~F.lower("raw_path").rlike(r"^(?:https?://|data:)"))
    wanted = wanted.withColumn("name", base_name(F.replace("path", F.lit("\\"), F.lit("/"))))
    have = files.select("paper_id", "file", base_name(F.col("file")).alias("fname"))
    suffix, stem = (lambda c: F.regexp_extract(c, r"(\.[^.]*)$", 1)), (lambda c: F.regexp_replace(c, r"\.[^.]*$", ""))
    exact = wanted.join(have, (wanted["paper_id"] == have["paper_id"]) & (wanted["name"] == have["fname"])).select(wanted["paper_id"], "raw_path", "file", F.when(F.col("path") == F.col("file"), 0).otherwise(1).alias("ord"))
    # names that are alike share their first 16 characters, so that is the join key
    w, h = wanted.withColumn("head", F.left("name", F.lit(16))), have.withColumn("head", F.left("fname", F.lit(16)))
    a, b = stem("name"), stem("fname")
    alike = (F.length(a) >= 16) & (suffix("name") == suffix("fname")) & (a.startswith(b) | b.startswith(a) | (F.left(a, F.lit(32)) == F.left(b, F.lit(32))))
    near = w.join(h.withColumnRenamed("paper_id", "pid"), (F.col("paper_id") == F.col("pid")) & (w["head"] == h["head"])).filter(alike).select("paper_id", "raw_path", "file", F.lit(2).alias("ord"))
    return exact.unionByName(near).groupBy("paper_id", "raw_path").agg(F.min_by("file", F.struct("ord", "file")).alias("image_path"))


def chosen_result(results: Column, name: Column) -> Column:
    """The result of a service's answer for one file name, else its first; results: array of structs with file_name."""
    return F.coalesce(F.get(F.filter(results, lambda r: r["file_name"] == name), F.lit(0)), F.get(results, F.lit(0)))


def checked_answer(body: Column, status: Column) -> Column:
    """The data of a service's JSON answer; an error unless the status is 200 and its code 0."""
    good = (status == 200) & (F.get_json_object(body, "$.code") == "0")
    return F.when(good, F.get_json_object(body, "$.data")).otherwise(F.raise_error(F.concat(F.lit("service error: "), F.left(F.coalesce(body, F.lit("")), F.lit(200)))).cast("string"))


