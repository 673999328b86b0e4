import json
import struct
import zipfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from plinth.functions import images, models, taxonomy
from plinth.operators import classify as C
from plinth.operators import figures as G
from plinth.operators import fragments as H
from plinth.operators import linking as L
from plinth.operators import stitching
from plinth.operators import summary as K
from plinth.operators import tables as B
from plinth.plans import run
from plinth.plans.extraction import extract
from plinth.sources import files, layout, settings, sinks


def paper(spark, text, name="p"):
    return spark.createDataFrame([(name, text)], "paper_id string, markdown string")


def test_grouped_images_share_a_caption(spark):
    text = "# Head\n![](a.png)\n![](b.png)\n![](c.png)\nFig. 6 Photos (A) one (B) two (C) three\n\nBody."
    rows = G.figure_rows(paper(spark, text)).orderBy("position").collect()
    assert [(r["figure_id"], r["subfigure_index"], r["subfigure_label"]) for r in rows] == [("Fig.6", 1, "A"), ("Fig.6", 2, "B"), ("Fig.6", 3, "C")]
    assert {r["section_title"] for r in rows} == {"Head"}


def test_alt_texts_are_labels(spark):
    text = "![Fill](a.png)\n![Spin](b.png)\n图1.3 四个步骤\n"
    rows = G.figure_rows(paper(spark, text)).orderBy("position").collect()
    assert [(r["figure_id"], r["subfigure_label"]) for r in rows] == [("图1.3", "Fill"), ("图1.3", "Spin")]


def test_two_captions_for_three_images(spark):
    text = "![](a.png)\n![](b.png)\n![](c.png)\n图2-4 甲(a)乙(b) 图2-5 丙\n"
    rows = G.figure_rows(paper(spark, text)).orderBy("position").collect()
    assert [(r["figure_id"], r["subfigure_label"]) for r in rows] == [("图2-4", "a"), ("图2-4", "b"), ("图2-5", None)]


def test_copies_and_unknown_figures(spark):
    text = "![](a.png)\n\nNothing here.\n\n![](b.png)\n\nNothing.\n\n![](c.png)\n"
    local = spark.createDataFrame([("p", "a.png", "/a", "h1"), ("p", "b.png", "/b", "h1"), ("p", "c.png", "/c", "h2")], "paper_id string, raw_path string, image_path string, image_hash string")
    rows = G.figure_rows(paper(spark, text), local).orderBy("position").collect()
    assert [(r["figure_id"], r["image_path"]) for r in rows] == [("Unknown Figure 1", "/a"), ("Unknown Figure 2", "/c")]


def test_linking_takes_exact_numbers(spark):
    p = paper(spark, "![](a.png)\nFig. 2 XRD\n\nAs shown in Fig. 2, peaks grow. Fig. 21 is other text here. json) See Fig. 2 again for more; ok.")
    row = L.linked(G.figure_rows(p), p).first()
    assert row["reference_sentences"] == ["As shown in Fig. 2, peaks grow.", "See Fig. 2 again for more;"]


def classified(spark, **given):
    row = {"paper_id": "p", "figure_id": "Fig.1", "position": 0, "caption": None, "description_text": None, "reference_sentences": [], **given}
    kinds = {f.name: f.dataType.simpleString() for f in G.FIGURE.fields}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {kinds[k]}" for k in row))
    return C.classify(G.as_figures(df))


def test_classes(spark):
    cases = (
        ({"caption": "Fig. 1 NMR integration of sol"}, "nmr_quantification_plot", True), ({"caption": "Fig. 1 EDS mapping"}, "elemental_mapping", True),
        ({"caption": "Fig. 1 schematic diagram"}, "schematic_or_flow", False), ({"caption": "Fig. 1 logo"}, "logo_or_icon", False),
        ({"caption": "Fig. 1 流变曲线"}, "rheology_curve", True), ({"caption": "Fig. 1 system overview"}, "other", False),
        ({"caption": "Fig. 1 item", "clip_decision": "negative", "clip_label": "a barcode or qr code"}, "qr_code_or_barcode", False),
        ({"caption": "Fig. 1 item", "resnet_raw_class": "Line graph"}, "generic_chart_or_plot", True),
    )
    for given, name, sent in cases:
        row = classified(spark, **given).first()
        assert (row["figure_class"], row["send_to_vision_model"]) == (name, sent), given
    row = classified(spark, caption="Fig. 1 NMR", is_fragment=True, fragment_group_id="g").first()
    assert row["exclude_reason"] == C.REPLACED and not row["send_to_vision_model"]
    assert C.false_candidates(classified(spark, caption="Fig. 1 NMR", is_fragment=True)).isEmpty()
    assert classified(spark, caption="该酶的比值").first()["review_reason"] == "caption_ocr_suspect"
    assert not taxonomy.is_token("spectrum") and taxonomy.is_token("ir")


def test_fragments_merge(spark):
    text = "".join(f"![](f{i}.jpg)\n" for i in range(5)) + "Fig. 7 A long strip\n\nEnd."
    p = paper(spark, text)
    figs = G.figure_rows(p).withColumn("image_path", F.concat(F.lit("/i/"), F.col("position").cast("string")))
    k = F.col("subfigure_index").cast("double")
    boxed = figs.withColumns({"page_idx": F.lit(3), "bbox": F.array(F.lit(0.0), k * 80, F.lit(600.0), k * 80 + 80)})
    sizes = figs.select("image_path", F.lit(600).alias("width"), F.lit(80).alias("height"))
    rows = H.merge_fragments(boxed, p, sizes).orderBy("position", "is_merged_figure").collect()
    merged = [r for r in rows if r["is_merged_figure"]]
    assert len(rows) == 6 and len(merged) == 1 and sum(r["is_fragment"] for r in rows) == 5
    assert merged[0]["bbox"] == [0.0, 80.0, 600.0, 480.0] and merged[0]["fragment_group_id"] == "p_fragment_group_001"
    assert merged[0]["fragment_merge_confidence"] == 0.99 and len(merged[0]["source_fragment_ids"]) == 5
    review = H.merge_fragments(figs, p, sizes).collect()
    assert {r["review_reason"] for r in review} == {"bbox_missing_for_fragment_group"} and len(review) == 5


def test_tables(spark):
    html = "<table><thead><tr><th>样品</th><th>值</th><th>值</th></tr></thead><tr><td rowspan=2>S1</td><td>0.10</td><td>x</td></tr><tr><td>2</td></tr></table>"
    assert B.read_table(html) == (["样品", "值", "值.1"], [["S1", "0.1", "x"], ["S1", "2.0", ""]])
    p = paper(spark, f"intro\n\n表1 结果\n{html}\n<table></table>")
    info = B.table_info(p).orderBy("position").collect()
    assert (info[0]["caption"], info[0]["rows"], info[0]["columns"], info[0]["error"]) == ("表1 结果", 2, 3, None) and info[1]["error"]
    out = sinks.table_files(B.table_info(p)).first()
    assert bytes(out["csv"]).startswith(b"\xef\xbb\xbf") and json.loads(out["json"])[0]["样品"] == "S1"
    text = B.replaced_tables(p, B.table_info(p)).first()["markdown"]
    assert "[TableID: table_001]" in text and "| S1 | 0.1 | x |" in text and "<table></table>" in text


def test_layout_dialects(spark):
    v2 = [[], [{"type": "image", "bbox": [1, 2, 3, 4], "content": {"image_source": {"path": "images/b.jpg"}, "image_caption": [{"type": "text", "content": "Fig. 1 b"}]}}]]
    v1 = [{"type": "image", "img_path": "images/a.jpg", "page_idx": 3, "bbox": [1, 2, 3, 4], "image_caption": ["Fig. 2"]}]
    model = [{"blocks": [{"type": "image", "path": "images/c.jpg", "page_idx": 2, "page_width": 1000, "page_height": 2000, "bbox": [0.1, 0.2, 0.3, 0.4]}]}]
    rows = [("p1", "content_list_v2.json", json.dumps(v2)), ("p1", "content_list.json", json.dumps(v1)), ("p2", "content_list.json", json.dumps(v1)), ("p3", "model.json", json.dumps(model)), ("p4", "model.json", "{")]
    got = {(r["paper_id"], r["key"]): r for r in layout.image_layout(spark.createDataFrame(rows, "paper_id string, name string, json string")).collect()}
    assert set(got) == {("p1", "images/b.jpg"), ("p1", "b.jpg"), ("p2", "images/a.jpg"), ("p2", "a.jpg"), ("p3", "images/c.jpg"), ("p3", "c.jpg")}
    assert (got["p1", "b.jpg"]["page_idx"], got["p1", "b.jpg"]["page_number"], got["p1", "b.jpg"]["caption"]) == (1, 2, "Fig. 1 b")
    assert got["p2", "a.jpg"]["page_idx"] == 3 and got["p3", "c.jpg"]["bbox"] == [100.0, 400.0, 300.0, 800.0]


def test_files(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR\x00\x00\x00\x10\x00\x00\x00\x20"
    assert files.image_header(png) == (16, 32) and files.image_header(b"x") is None
    lines = spark.createDataFrame([("A='1'",), ("# c",), ("A=2",), ("B=x=y",)], "value string").coalesce(1)
    assert {r["key"]: r["value"] for r in files.env_settings(lines).collect()} == {"A": "1", "B": "x=y"}
    tokens = spark.createDataFrame([("p", 1, "a.png", "h1"), ("p", 2, "a.png", "h2"), ("p", 3, "b.png", "h1")], "paper_id string, position int, name string, image_hash string")
    assert [r["target"] for r in files.copied_names(tokens).orderBy("position").collect()] == ["a.png", "a_h2.png", "a.png"]
    wanted = spark.createDataFrame([("p", "images/a.png"), ("p", "x/0123456789abcdef0123.png"), ("p", "http://h/a.png")], "paper_id string, raw_path string")
    have = spark.createDataFrame([("p", "deep/a.png"), ("p", "images/0123456789abcdef.png")], "paper_id string, file string")
    assert {r["raw_path"]: r["image_path"] for r in files.resolved_images(wanted, have).collect()} == {"images/a.png": "deep/a.png", "x/0123456789abcdef0123.png": "images/0123456789abcdef.png"}


def test_models(spark):
    rows = spark.createDataFrame([("a", b"1"), ("b", None)], "image_path string, content binary")
    assert {r["image_path"]: r["c"] for r in models.predicted(rows, lambda: lambda xs: ["Tables" for _ in xs], "string", "c").collect()} == {"a": "Tables", "b": None}

    def broken():
        raise OSError

    assert models.predicted(rows, broken, "string", "c").filter("c is not null").isEmpty()
    scores = [0.0] * 25
    scores[3], scores[20] = 0.5, 0.49
    got = spark.createDataFrame([(scores,)], "s array<double>").select(models.clip_decision(F.col("s")).alias("c")).first()["c"]
    assert (got["clip_label"], got["clip_decision"]) == ("an XRD diffraction pattern", "uncertain")


def test_whole_extraction(spark, tmp_path):
    p = paper(spark, "# T\n\n![](a.png)\nFig. 1 XRD of $\\alpha$-Al_{2}O_{3}\n\nAs shown in Fig. 1, it is pure.\n\nTable 1 x\n<table><tr><th>a</th></tr><tr><td>1</td></tr></table>\n")
    e = extract(p)
    row = e.figures.first()
    assert row["caption"] == "Fig. 1 XRD of α-Al2O3" and row["figure_class"] == "xrd_pattern"
    s = e.summary.first()
    assert s["final_figure_record_count"] == 1 and s["figure_class_counts"]["xrd_pattern"] == 1 and s["merge_mode_counts"] == {"none": 1}
    sinks.write_figures(sinks.vision_copies(e.figures, "vision"), str(tmp_path / "f"))
    back = spark.read.json(str(tmp_path / "f")).first()
    assert back["figure_id"] == "Fig.1" and back["vision_image_path"] is None
    assert K.class_histogram(e.figures).count() == 28


def test_run_from_archives(spark, tmp_path):
    rng = np.random.default_rng(1)
    strips = [rng.integers(0, 200, (80, 600, 3)).astype(np.uint8) for _ in range(5)]
    blocks = [{"type": "image", "img_path": f"images/f{i}.png", "page_idx": 3, "bbox": [100, 50 + 90 * i, 700, 130 + 90 * i]} for i in range(5)]
    text = "# 结果\n" + "".join(f"![](images/f{i}.png)\n" for i in range(5)) + "图3-17 损伤形貌\n\n如图3-17所示，纤维表面出现条带状损伤形貌。\n\n表1 组成\n<table><tr><th>a</th></tr><tr><td>1</td></tr></table>\n"
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "one.zip", "w") as z:
        z.writestr("full.md", text)
        z.writestr("content_list.json", json.dumps(blocks))
        for i, pixels in enumerate(strips):
            z.writestr(f"images/f{i}.png", images.encoded(pixels))
    (tmp_path / "zips" / "broken.zip").write_bytes(b"PK no archive")
    said = []
    given = {**settings.DEFAULTS, "paths": {"archives": "zips", "output_dir": "out"}}
    assert run.run(spark, given, tmp_path, said.append) == run.DONE
    rows = spark.read.json(str(tmp_path / "out" / "figures")).collect()
    merged = [r for r in rows if r["is_merged_figure"]]
    assert len(rows) == 6 and len(merged) == 1 and merged[0]["reference_sentences"] == ["如图3-17所示，纤维表面出现条带状损伤形貌。"]
    assert merged[0]["figure_class"] == "microscopy_image" and merged[0]["vision_image_path"].startswith("figures_for_vision/stitched_figure_001")
    stored = spark.read.parquet(str(tmp_path / "out" / "figures_for_vision")).collect()
    canvas = images.decoded(bytes(stored[0]["content"]))
    assert len(stored) == 1 and canvas.shape == (460, 620, 3) and {"papers: 1", "tables_count: 1", "merged_figure_count: 1", "  microscopy_image: 6"} <= set(said)
    if images.Image is None:
        assert all((canvas[10 + 90 * i : 90 + 90 * i, 10:610] == pixels).all() for i, pixels in enumerate(strips))
    assert any(line.startswith("Archive not read") for line in said)
    (tmp_path / "zips" / "one.zip").unlink()
    assert run.run(spark, given, tmp_path, said.append) == run.FAILED
    assert run.run(spark, {**given, "paths": {"archives": "none"}}, tmp_path, said.append) == run.NO_INPUT
    assert run.run(spark, {**given, "paths": {"input_pdf": "zips"}}, tmp_path, said.append) == run.FAILED  # no key


def test_blank_and_small_canvases_are_refused(spark):
    text = "".join(f"![](f{i}.png)\n" for i in range(5)) + "Fig. 7 A long strip\n\nEnd."
    p = paper(spark, text)
    figs = spark.createDataFrame(G.figure_rows(p).withColumn("image_path", F.concat(F.lit("/i/"), F.col("position").cast("string"))).collect(), G.FIGURE)
    k = F.col("subfigure_index").cast("double")
    sizes = figs.select("image_path", F.lit(600).alias("width"), F.lit(80).alias("height"))
    for pixels, wide, reason in ((np.full((80, 600, 3), 255, np.uint8), 600.0, "stitched_image_too_sparse"), (None, 600.0, "stitched_image_abnormal"), (np.zeros((4, 4, 3), np.uint8), 600.0, None)):
        boxed = figs.withColumns({"page_idx": F.lit(3), "bbox": F.array(F.lit(0.0), k * 80, F.lit(wide), k * 80 + 80)})
        contents = figs.select("image_path", F.lit(None if pixels is None else images.encoded(pixels)).cast("binary").alias("content"))
        rows = H.merge_fragments(boxed, p, sizes, stitching.stitched_groups(boxed, p, sizes, contents)).collect()
        assert {r["review_reason"] for r in rows} == {reason} and sum(r["is_merged_figure"] for r in rows) == (reason is None)


def test_image_codec():
    rng = np.random.default_rng(2)
    pixels = rng.integers(0, 256, (7, 5, 3)).astype(np.uint8)
    raw = bytearray()
    above = np.zeros(15, int)
    for y, kind in enumerate((0, 1, 2, 3, 4, 4, 3)):  # every filter of a PNG
        line = pixels[y].reshape(-1).astype(int)
        left, corner = np.concatenate([[0, 0, 0], line[:-3]]), np.concatenate([[0, 0, 0], above[:-3]])
        near = np.stack([left, above, corner])
        paeth = near[np.abs(left + above - corner - near).argmin(axis=0), np.arange(15)]
        guess = (0 * line, left, above, (left + above) // 2, paeth)[kind]
        raw += bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        above = line

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + b"0000"

    png = images.PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(raw))) + chunk(b"IEND", b"")
    assert (images._png(png) == pixels).all() and images.decoded(b"no image") is None
    bmp = b"BM" + bytes(8) + struct.pack("<IIiiHHIIiiII", 54, 40, 5, 7, 1, 24, 0, 0, 0, 0, 0, 0) + b"".join(pixels[y][:, ::-1].tobytes() + b"\0" for y in range(6, -1, -1))
    assert (images._bmp(bmp) == pixels).all()
    assert images.resized(pixels, 5, 7) is pixels and images.resized(np.full((4, 4, 3), 9, np.uint8), 8, 2).shape == (2, 8, 3)
    assert images.blank_share(np.full((2, 2, 3), 250, np.uint8)) == 1.0 and images.blank_share(np.zeros((2, 2, 3), np.uint8)) == 0.0


def test_models_by_batches_and_urls(spark, tmp_path):
    def load():
        def predictor(contents):
            if b"bad" in contents:
                raise ValueError
            return [f"{len(contents)}" for _ in contents]

        return predictor

    rows = spark.createDataFrame([(str(i), b"bad" if i == 5 else b"x") for i in range(6)] + [("n", None)], "image_path string, content binary").coalesce(1)
    got = {r["image_path"]: r["c"] for r in models.predicted(rows, load, "string", "c", batch_size=3).collect()}
    assert got == {"0": "3", "1": "3", "2": "3", "3": "1", "4": "1", "5": None, "n": None}
    (tmp_path / "i.png").write_bytes(b"pixels")
    urls = spark.createDataFrame([("a", None, (tmp_path / "i.png").as_uri()), ("b", b"own", "http://no.invalid/x"), ("c", None, "no url"), ("d", None, None)], "image_path string, content binary, image_url string")
    assert {r["image_path"]: r["content"] and bytes(r["content"]) for r in models.fetched(urls).collect()} == {"a": b"pixels", "b": b"own", "c": None, "d": None}


def test_stream(spark, tmp_path):
    from plinth.streaming import intake

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text("![](a.png) \n![](a.png)\n![](b.png)")
    stream = intake.image_stream(intake.markdown_stream(spark, str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("images").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r["paper_id"], r["raw_path"]) for r in spark.table("images").collect()} == {("one", "a.png"), ("one", "b.png")}
