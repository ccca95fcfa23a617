"""Queries of the subpackage over whole small tables, beside their SQL where they have one."""

import os

import pytest

from tandemtext.llm.queries import QUERIES, SQL
from tests.oracle import connection, differences

SF = os.environ.get("TANDEMTEXT_TEST_SF", "/root/testdata/sf0.001")
SHAPES = {
    "p2_found": ["source", "score_name", "pair_id"],
    "p3_found": ["section_id", "sub_no", "start_at", "end_at"],
    "p4_found": ["pair_id", "side", "lang"],
    "p5_found": ["pair_id_a", "pair_id_b"],
    "p6_found": ["pt_id", "french_no", "moore_no"],
    "p7_found": ["unit_kind", "unit_id", "line_no", "noise"],
    "p8_ids": ["doc_id", "ids"],
    "p9_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in SQL:
        assert differences(spark, connection(SF), QUERIES[name], SQL[name], SF) == ""
        return
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in SHAPES:
        assert df.columns == SHAPES[name]
        assert len({str(r) for r in rows}) == len(rows)
