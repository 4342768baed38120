"""The registered queries run over the smallest tables with the columns that are asked for."""

import os

import pytest

from tidewell.llm import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("source_field", "string"), ("record_key", "string"), ("brand_id", "bigint")], "p2_found": [("shopid_a", "string"), ("shopid_b", "string")], "p3_found": [("source_table", "string"), ("keep_id", "bigint"), ("copy_id", "bigint")],
    "p7_found": [("custref_no", "string"), ("shopid", "string"), ("start_ms", "bigint"), ("end_ms", "bigint")], "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p9_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p10_found": [("doc_id", "bigint"), ("start_char", "int"), ("end_char", "int")],
}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_distinct_rows(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    assert df.dtypes == COLUMNS[name]
    rows = [str(r) for r in df.collect()]
    assert len(rows) == len(set(rows)) and (rows or name == "p2_found")
