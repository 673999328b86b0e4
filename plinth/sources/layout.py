"""Page-layout JSON of OCR runs, in three dialects, as records that are found by an image's path or name."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions import text as X

# Names under which the third dialect keeps paths, boxes and page sizes.
PATH_KEYS = ("img_path", "image_path", "path", "file_name", "filename")
BOX_KEYS = ("bbox", "box", "position")
SIZE_KEYS = (("page_width", "page_height"), ("width", "height"), ("img_width", "img_height"))
BLOCK = "struct<type:string,img_path:string,image_path:string,page_idx:int,bbox:array<double>,image_caption:string,caption:string,content:struct<image_source:struct<path:string>,image_caption:string>>"
RECORD = "paper_id string, seq long, image_path string, page_idx int, bbox array<double>, caption string, source string"
#: Dialects in the order of preference.
FILES = {"content_list_v2.json": 0, "content_list.json": 1, "model.json": 2}


def caption_text(raw: Column) -> Column:
    """Caption of a JSON value: a text, a list of texts or objects, or an object with content or text."""
    pieces = F.transform(F.from_json(raw, "array<string>"), lambda x: F.trim(F.when(x.startswith("{"), F.coalesce(X.blank_to_null(F.get_json_object(x, "$.content")), F.get_json_object(x, "$.text"), F.lit(""))).otherwise(x)))
    listed = F.array_join(F.filter(pieces, lambda p: p != ""), " ")
    named = F.trim(F.coalesce(X.blank_to_null(F.get_json_object(raw, "$.content")), F.get_json_object(raw, "$.text")))
    return X.blank_to_null(F.when(raw.startswith("["), listed).when(raw.startswith("{"), named).otherwise(F.trim(raw)))


def is_box(b: Column) -> Column:
    return F.coalesce((F.size(b) == 4) & F.forall(b, lambda x: x.isNotNull()), F.lit(False))


def _records(blocks: DataFrame, page: Column, path: Column, caption: Column, source: str) -> DataFrame:
    rows = blocks.select("paper_id", F.col("seq").cast("long").alias("seq"), path.alias("image_path"), page.cast("int").alias("page_idx"), F.col("b.bbox").alias("bbox"), caption_text(caption).alias("caption"), F.lit(source).alias("source"))
    return rows.filter((F.coalesce("image_path", F.lit("")) != "") & is_box(F.col("bbox")))


def _first(*names: str) -> Column:
    return F.coalesce(*[X.blank_to_null(F.col(n)) for n in names])


def content_list_v2(files: DataFrame) -> DataFrame:
    """files: paper_id, json (a list of pages, each a list of blocks); only image blocks count."""
    pages = files.select("paper_id", F.posexplode(F.from_json("json", f"array<array<{BLOCK}>>")).alias("page", "blocks"))
    blocks = pages.select("paper_id", "page", F.posexplode("blocks").alias("k", "b")).withColumn("seq", F.col("page") * 1_000_000 + F.col("k"))
    return _records(blocks.filter("b.type = 'image'"), F.col("page"), _first("b.content.image_source.path", "b.img_path", "b.image_path"), F.col("b.content.image_caption"), "content_list_v2")


def content_list(files: DataFrame) -> DataFrame:
    """files: paper_id, json (a list of blocks, or an object with it as content); every block with a path counts."""
    listed = F.coalesce(F.when(F.ltrim("json").startswith("{"), F.get_json_object("json", "$.content")), F.col("json"))
    blocks = files.select("paper_id", F.posexplode(F.from_json(listed, f"array<{BLOCK}>")).alias("seq", "b"))
    inner = F.when(F.col("b.type") == "image", X.blank_to_null(F.col("b.content.image_source.path")))
    return _records(blocks, F.col("b.page_idx"), F.coalesce(_first("b.img_path", "b.image_path"), inner), _first("b.image_caption", "b.caption"), "content_list")


def objects(value) -> Iterator[dict]:
    """Every JSON object inside a value, parents first."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            yield v
        if isinstance(v, (dict, list)):
            todo.extend(reversed(list(v.values()) if isinstance(v, dict) else v))


def _number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def page_size(block: dict) -> tuple[float, float] | None:
    for w, h in SIZE_KEYS:
        if _number(block.get(w)) and _number(block.get(h)) and min(block[w], block[h]) > 1:
            return float(block[w]), float(block[h])
    size = block.get("page_size")
    return (float(size[0]), float(size[1])) if isinstance(size, list) and len(size) > 1 and all(map(_number, size[:2])) else None


def model_json(files: DataFrame) -> DataFrame:
    """files: paper_id, json (any nesting); boxes within [0, 1] are scaled by the page's size, or dropped without one.
    A page 0 counts as no page, as in the format's other readers."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("paper_id", "seq", "image_path", "page_idx", "bbox", "raw")}
            for paper, text in zip(batch["paper_id"].to_pylist(), batch["json"].to_pylist(), strict=True):
                try:
                    root = json.loads(text or "null")
                except ValueError:
                    continue
                for seq, block in enumerate(objects(root)):
                    source = block.get("image_source")
                    path = next((block[k] for k in PATH_KEYS if block.get(k) is not None), None) or (source.get("path") if isinstance(source, dict) else None)
                    box = next((block[k] for k in BOX_KEYS if block.get(k) is not None), None)
                    if not path or not (isinstance(box, list) and len(box) == 4 and all(map(_number, box))):
                        continue
                    if all(0 <= v <= 1 for v in box):
                        if (size := page_size(block)) is None:
                            continue
                        box = [v * size[i % 2] for i, v in enumerate(box)]
                    page = block.get("page_idx") or block.get("page_id")
                    caption = block.get("caption") or block.get("image_caption")
                    values = (paper, seq, str(path), int(page) if page else None, [float(v) for v in box], caption if isinstance(caption, str) or caption is None else json.dumps(caption, ensure_ascii=False))
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    rows = files.select(F.col("paper_id").cast("string").alias("paper_id"), "json").mapInArrow(walk, "paper_id string, seq long, image_path string, page_idx int, bbox array<double>, raw string")
    return rows.select("paper_id", "seq", "image_path", "page_idx", "bbox", caption_text(F.col("raw")).alias("caption"), F.lit("model_json").alias("source"))


def normalized_key(path: Column) -> Column:
    return F.regexp_replace(F.trim(F.replace(path, F.lit("\\"), F.lit("/"))), r"^[./]+", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def keyed(records: DataFrame) -> DataFrame:
    """paper_id, key, ...: each record under its path and its name; of equal keys the last record stays."""
    rows = records.withColumn("path", normalized_key(F.col("image_path"))).withColumn("key", F.explode(F.array_distinct(F.array("path", base_name(F.col("path"))))))
    value = F.struct("page_idx", (F.col("page_idx") + 1).alias("page_number"), "bbox", F.lit("pixel").alias("bbox_format"), "caption", "source", F.col("path").alias("mineru_img_path"))
    return rows.groupBy("paper_id", "key").agg(F.max_by(value, "seq").alias("r")).select("paper_id", "key", "r.*")


def image_layout(files: DataFrame) -> DataFrame:
    """Layout of each paper from files (paper_id, name, json): the first dialect in FILES that has any record."""
    readers = (content_list_v2, content_list, model_json)
    parts = [keyed(read(files.filter(F.col("name") == name))).withColumn("_order", F.lit(order)) for (name, order), read in zip(FILES.items(), readers, strict=True)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    best = F.min("_order").over(Window.partitionBy("paper_id"))
    return both.withColumn("_best", best).filter("_order = _best").drop("_order", "_best")


def candidate_keys(*paths: Column) -> Column:
    """Keys under which an image may be found, the likeliest first."""
    keys = [k for p in paths for n in [normalized_key(F.coalesce(p, F.lit("")))] for k in (n, base_name(n), F.concat(F.lit("images/"), base_name(n)))]
    return F.array_distinct(F.filter(F.array(*keys), lambda k: ~k.isin("", "images/")))


def with_layout(figures: DataFrame, layout: DataFrame) -> DataFrame:
    """Figures (with raw_path and image_path) joined with the first record that one of their keys finds."""
    keys = figures.select("paper_id", "position", F.posexplode(candidate_keys(F.col("raw_path"), F.col("image_path"))).alias("ord", "key"))
    fields = ("mineru_img_path", "page_idx", "page_number", "bbox", "bbox_format", "source")
    hit = keys.join(layout.select("paper_id", "key", F.struct(*fields).alias("r")), ["paper_id", "key"]).groupBy("paper_id", "position").agg(F.min_by("r", "ord").alias("r"))
    rows = figures.join(hit, ["paper_id", "position"], "left")
    return rows.withColumns({("bbox_source" if f == "source" else f): F.col(f"r.{f}") for f in fields}).drop("r")
