"""Papers for queries over the given tables: Markdown built from documents by concatenation alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What figures are about; papers take them in turn.
PHRASES = (
    "XRD pattern of the fibers", "SEM image of the surface", "NMR spectrum of the sol", "FTIR spectrum of the gel",
    "TG curve in air", "schematic diagram of the setup", "Raman shift of the powder", "viscosity curve of the sol",
    "publisher logo", "photo of the sample", "particle size distribution", "zeta potential of the sol",
    "tensile strength of fibers", "calibration curve", "EDS mapping of aluminium", "overview of the work",
)
CHINESE = ("溶胶的红外谱图", "纤维形貌", "装置示意图", "核磁谱图", "温度变化图", "工艺参数影响", "可纺性照片", "流变曲线")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """paper_id, doc_id, markdown of every document: two headings, three captioned images (two in a group), an image
    without a caption, sentences that mention figures, LaTeX leftovers, and a table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = F.col("doc_id").cast("string")
    phrase, chinese = (F.element_at(F.array(*map(F.lit, words)), (F.col("doc_id") % len(words) + 1).cast("int")) for words in (PHRASES, CHINESE))
    parts = (
        "# Part ", (F.col("doc_id") % 7).cast("string"), "\n", F.coalesce("text", F.lit("")), "!",
        "\n\n![](images/", d, "_1.png)\nFig. 1 ", phrase, "\n\nAs shown in Fig. 1, the trend is clear; see the text. ",
        "The value in Fig. 12 differs.\n\n## Results\n\n![](images/", d, "_2.png)\n![](images/", d, "_3.png)\n图2 ", chinese,
        "(A)(B)\n\n由图2可知结果是好的。\n\n![logo](https://example.org/", d, ".png)\n\nClosing words $\\alpha$ - Al_{2}O_{3}, 5 \\mu m.\n\n",
        "Table 1 counts\n<table><tr><th>id</th><th>chars</th></tr><tr><td>", d, "</td><td>", F.col("n_chars").cast("string"), "</td></tr></table>\n",
    )
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return docs.select(d.alias("paper_id"), "doc_id", F.concat(*columns).alias("markdown"))


def papers_sql() -> str:
    """The same rows in SQL, with the pieces that oracles need: phrase and chinese."""

    def listed(words: tuple[str, ...]) -> str:
        return "[" + ", ".join("'" + w + "'" for w in words) + f"][(doc_id % {len(words)} + 1)::INT]"

    return f"""
SELECT doc_id, paper_id, phrase, chinese, concat(
  '# Part ', (doc_id % 7)::VARCHAR, chr(10), coalesce(text, ''), '!', chr(10), chr(10),
  '![](images/', paper_id, '_1.png)', chr(10), 'Fig. 1 ', phrase, chr(10), chr(10),
  'As shown in Fig. 1, the trend is clear; see the text. The value in Fig. 12 differs.', chr(10), chr(10),
  '## Results', chr(10), chr(10), '![](images/', paper_id, '_2.png)', chr(10), '![](images/', paper_id, '_3.png)', chr(10),
  '图2 ', chinese, '(A)(B)', chr(10), chr(10), '由图2可知结果是好的。', chr(10), chr(10),
  '![logo](https://example.org/', paper_id, '.png)', chr(10), chr(10),
  'Closing words $\\alpha$ - Al_{{2}}O_{{3}}, 5 \\mu m.', chr(10), chr(10),
  'Table 1 counts', chr(10), '<table><tr><th>id</th><th>chars</th></tr><tr><td>', paper_id, '</td><td>', n_chars::VARCHAR,
  '</td></tr></table>', chr(10)) AS markdown
FROM (SELECT *, doc_id::VARCHAR AS paper_id, {listed(PHRASES)} AS phrase, {listed(CHINESE)} AS chinese FROM documents)
"""
