"""Every query with SQL gives its rows, at the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__
from plinth.oracles import ORACLES
from plinth.queries import QUERIES

DATA = "/root/testdata/sf0.001"
#: One query of each family; the driver compares them all.
CHECKED = (
    "image_groups", "section_asof", "vision_select", "sentence_counts", "compact_documents", "token_counts", "chem_normalize", "html_table_cells",
    "caption_split", "table_captions", "merge_confidence", "replaced_tables", "layout_records", "layout_join", "fragment_groups", "union_bbox", "bbox_overlap", "clip_decision", "base64_checks", "safe_data_ids",
)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


def plain(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(plain, df.select(*columns).collect()), key=str)
    want = sorted(map(plain, sql.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()), key=str)
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 28
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
