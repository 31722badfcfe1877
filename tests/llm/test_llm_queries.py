import pytest
from compare import same

from foliospark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        same(df, duck.sql(ORACLE[name]))
    else:
        assert df.collect()


def test_columns(spark, sf):
    wanted = {
        "p1_found": "block_uid bigint, line_no int, kind string", "p2_found": "item_kind string, item_id bigint",
        "p3_found": "doc string, kind string", "p4_found": "record_kind string, record_id bigint",
        "p6_ids": "doc_id bigint, ids array<int>", "p8_found": "doc_id bigint, level string"
    }
    for name, schema in wanted.items():
        assert ", ".join(f"{c} {t}" for c, t in QUERIES[name](spark, sf).dtypes) == schema
