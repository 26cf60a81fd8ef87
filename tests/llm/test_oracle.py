import compare
import pytest

from costledger.llm import queries
from costledger.llm.oracle import ORACLE

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op4_near_dedup", "op8_topk", "op10_vector_dedup", "op11_quality", "op12_bitplanes"])
def test_query_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) == []
