"""Shared helpers: reading tables, word counting, tables that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words as the contracts define them (ASCII only).
WORD = r"[^\x20\x09-\x0D]++"
#: Runs of white space other than one single space; replacing them by one space normalises a text.
SPACE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"

#: A key of more than this share of the rows is hot.
HOT = 1000
#: Tables written within `temporary`, if any is open.
_made: list[str] | None = None
#: The folder of a local session without the setting.
_own: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def text_digest(text: Column) -> Column:
    """128 bits of the text as it is; null for null. With the doc_id it tells a row from those with other texts."""
    return F.unhex(F.md5(text.cast("binary")))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a local session (one machine) may run without the setting; it gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _own
    if _own is None:  # the setting itself cannot be changed while a session runs
        _own = tempfile.mkdtemp(prefix="plinth-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


def saved(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts the lineage and outlives lost executors, and later reads prune its columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plinth-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _made is not None:
        _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a table by the file system that its path names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that `saved` wrote within it: their results must be written by then."""
    global _made
    outer, _made = _made, []
    try:
        yield
    finally:
        made, _made = _made, outer
        for path in made:
            delete(spark, path)


def unused(name: str, df: DataFrame) -> str:
    """A name that no column of df has (letters of either case are alike)."""
    there = {c.lower() for c in df.columns}
    while name.lower() in there:
        name += "_"
    return name


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys of more than one row in HOT: there are fewer than HOT of them."""
    counts = saved(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return saved(counts.filter(F.col("n") * HOT > total).select(key))


def joined(df: DataFrame, by_key: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """df with by_key, which has at most one row for each key. Rows of hot keys stay where they are."""
    hot = F.broadcast(hot.filter(F.col(key).isNotNull()))
    stay = df.join(F.broadcast(by_key.join(hot, key, "left_semi")), key)
    return stay.unionByName(df.join(hot, key, "left_anti").join(by_key, key))


def held(column: Column, folds: int, fold: int) -> Column:
    """Whether crc32(column as text) mod folds equals fold; false for null."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def unit_hash(*columns: Column, seed: int = 17) -> Column:
    """A number in [0, 1) that depends on the columns' values only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)
