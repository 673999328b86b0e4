"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing sources to target weights, best-fit packing.

Each stage takes (spark, docs, sf_dir). Its rows are written as Parquet and read again as the next stage's docs; all
stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.llm.common import delete, normalised, saved, shared_dir, table, temporary, text_digest, unused
from plinth.llm.conflict_packing import pack_documents
from plinth.llm.exact_dedup import exact_dedup
from plinth.llm.language_id import with_language
from plinth.llm.mixing import mixed_documents
from plinth.llm.near_dedup import near_first

#: Documents whose sets of five-word shingles are alike from this percentage on are near copies.
NEAR_PERCENT = 80


def _staying(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id and text are in wanted (doc_id, copy, null too), with the columns of docs.

    Always by a shuffle: wanted grows with the documents, so there is no size at which it may be broadcast.
    """
    wanted = saved(wanted.distinct()).hint("merge")
    same = docs["doc_id"].cast("long").eqNullSafe(wanted["doc_id"]) & text_digest(docs["text"]).eqNullSafe(wanted["copy"])
    return docs.join(wanted, same, "left_semi")


def _one_row(docs: DataFrame) -> DataFrame:
    """One row for each doc_id and normalised text, by its other columns; every column keeps its name."""
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    others = [F.hash(F.col(f"`{c}`")) for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.select(row, F.col("doc_id").alias("of"), F.sha2(normalised(F.col("text")), 256).alias("digest"), F.array(F.hash("text"), *others).alias("order"))
    first = F.row_number().over(Window.partitionBy("of", "digest").orderBy("order"))
    return own.withColumn("n", first).filter("n = 1").select("row.*")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without any letter (``und``: null, empty, or marks alone); every other row stays as it is.

    A text with letters stays also where no row has a language to learn from.
    """
    lang, score = unused("lang_pred", docs), unused("score", docs)
    return with_language(docs, lang=lang, score=score).filter((F.col(lang) != "und") | F.col("text").rlike(r"\p{L}")).drop(lang, score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the least doc_id, rows without one only if no other is there.

    Decided by doc_id and text, so a doc_id with several texts may keep one and lose another. Null texts are empty.
    """
    kept = exact_dedup(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = _one_row(docs)
    own = own.select(row, F.col("doc_id").cast("long").alias("of"), F.sha2(normalised(F.col("text")), 256).alias("digest"))
    kept = saved(kept).hint("merge")
    return own.join(kept, own["of"].eqNullSafe(kept["doc_id"]) & (own["digest"] == kept["text_sha256"]), "left_semi").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are linked from NEAR_PERCENT on; texts without words are in no group.

    Decided by doc_id and text, as in drop_copies; of several rows with one doc_id and text one stays.
    """
    return _staying(_one_row(docs), near_first(docs, NEAR_PERCENT))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, in whole documents and in the order of its schedule.

    Every source comes within one document of its target, so documents of sources above theirs are left out and
    others come twice. Texts without words are in no mix. Null sources are a source, null doc_ids documents.
    """
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of stretches of the mix; texts without words are in no bin (bin_id null)."""
    return pack_documents(docs, deal=False)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; tables of a stage that the next one has read are deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/plinth-stage-{uuid.uuid4().hex}"
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
