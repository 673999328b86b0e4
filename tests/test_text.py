from pyspark.sql import functions as F

from plinth.functions import text as X
from plinth.functions.chemistry import normalize_chemistry
from plinth.operators import captions, linking


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("out")).first()["out"]


def test_chemistry_line(spark):
    raw = r"关键词 $\alpha - \mathrm { A l } _ { 2 } \mathrm { O } _ { 3 }$ ；柔性纤维"
    assert one(spark, normalize_chemistry(F.col("t")), t=raw) == "关键词 α-Al2O3 ；柔性纤维"
    assert one(spark, normalize_chemistry(F.col("t")), t="![a_b](x_1,y.png) H_2O") == "![a_b](x_1,y.png) H2O"
    assert one(spark, normalize_chemistry(F.col("t"), True), t="Al2O3") == "Al₂O₃"


def test_wrappers_nest_to_any_depth(spark):
    deep = "x"
    for i in range(30):
        deep = f"\\{('mathrm', 'text', 'mathbf')[i % 3]}{{ {deep} }}"
    assert one(spark, normalize_chemistry(F.col("t")), t=f"a {deep} b") == "a x b"


def test_long_texts_in_one_pass(spark):
    text = "Ein Satz mit Zeichen. " * 20_000
    assert one(spark, F.size(X.sentences(F.col("t"))), t=text) == 20_000
    assert one(spark, F.element_at(X.matches(F.col("t"), "Satz"), -1)["s"], t=text) == text.rindex("Satz")


def test_sentences(spark):
    text = "See Fig. 2 for 3.5 units of it. Short. 这是一个完整的句子。An open tail of text"
    got = one(spark, X.complete_sentences(F.col("t")), t=text)
    assert got == ["See Fig. 2 for 3.5 units of it.", "这是一个完整的句子。"]
    spans = one(spark, X.sentences(F.col("t")), t=text)
    assert spans[-1]["m"] == "An open tail of text" and spans[-1]["e"] == len(text)


def test_offsets_are_code_points(spark):
    got = one(spark, X.matches(F.col("t"), X.IMAGE), t="😀 a ![x](y.png)\n b ![](z)")
    assert [(r["s"], r["e"]) for r in got] == [(4, 15), (19, 25)]
    assert one(spark, X.masked(F.col("t"), X.IMAGE), t="a![x](y)b") == "a" + " " * 7 + "b"


def test_ids_and_mentions(spark):
    assert one(spark, X.figure_id(F.col("t")), t="见 图 3-17 与 Fig. S1").asDict() == {"raw": "图 3-17", "id": "图3-17"}
    assert one(spark, X.figure_id(F.col("t")), t="Fig S1 text")["id"] == "Fig.S1"
    assert one(spark, X.mentions(F.col("t"), F.lit("图2.3")), t="由图2.3可知") is True
    assert one(spark, X.mentions(F.col("t"), F.lit("图2.3")), t="由图2.30可知") is False
    assert one(spark, X.mentions(F.col("t"), F.lit("Fig.2")), t="as in Fig. 2.") is False
    assert one(spark, X.labels(F.col("t")), t="（A）x (b1) (A)") == ["A", "b1"]
    assert one(spark, X.pseudo_caption(F.lit("图3-17"), F.col("t")), t="核磁结果见图3") == "图3 相关测试结果图"


def test_caption_cuts(spark):
    def cut(text, name=None):
        return one(spark, captions.caption_details(F.col("t"), F.lit(name).cast("string")), t=text).asDict()

    assert cut("Fig. 1 XRD pattern")["reason"] is None
    d = cut("图2.1 样品的TG曲线 由图2.1可知样品在加热时失重明显。")
    assert d["caption"] == "图2.1 样品的TG曲线" and d["refs"] == ["由图2.1可知样品在加热时失重明显。"] and d["reason"] == "repeated_figure_id"
    assert cut("图2.1 样品的TG曲线 表明样品稳定")["reason"] == "explanatory_phrase"
    assert cut("图2.1 甲 图2.2 乙")["reason"] == "multiple_figure_ids_in_caption"
    assert cut("图2.1 甲, 0.5 wt%")["caption"] == "图2.1 甲"  # a decimal after a comma cuts, as a shorthand would
    d = cut("Fig. 1 sample Fig. 1 shows the trend of it.")
    assert d["caption"] == "Fig. 1 sample" and d["reason"] == "repeated_figure_id"
    assert cut("图3 不同温度下样品的形貌变化 本文对样品做了测试")["reason"] == "space_body_start"
    assert one(spark, captions.segments(F.col("t")), t="图2-4(a) 甲 图2-5 乙") == ["图2-4(a) 甲", "图2-5 乙"]


def test_caption_lines(spark):
    def lines(text):
        return one(spark, captions.caption_lines(F.col("t")), t=text)

    assert lines("\nFig. 1 A caption\nwith a second line\n\nbody") == ["Fig. 1 A caption", "with a second line"]
    assert lines("\n\n\nFig. 1 too far") == []
    assert lines("\nplain text") == []
    assert lines("\n图6溶胶") == []  # no word boundary after the number


def test_reference_cleaning(spark):
    def clean(text, name="Fig.2"):
        return one(spark, linking.cleaned(F.col("t"), F.lit(name)), t=text)

    assert clean("json) As Fig. 2 shows, it grows") == "As Fig. 2 shows, it grows"
    assert clean("The TG/DSC of Fig. 2 is clear") is None
    assert clean("Nothing of the kind here") is None
