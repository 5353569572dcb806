"""The queries on the smallest tables: columns, and each row once."""

import pytest

from gleanery.llm import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {"p1_found": ["tbl", "row_id"], "p3_found": ["tbl", "keep_id", "copy_id"], "p4_found": ["meta_id", "fld", "term_id"], "p6_found": ["tbl", "row_id"], "p8_found": ["doc_id", "eval_id"], "p10_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    n = df.count()
    assert n > 0
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and df.distinct().count() == n
