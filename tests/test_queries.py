"""Every named query of the core against its SQL on the smallest tables; those without SQL must at least run."""

import pytest
from compare import same

from foliospark.plans.oracle import ORACLE
from foliospark.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        same(df, duck.sql(ORACLE[name]))
    else:
        assert df.collect() is not None


def test_whole_queries(spark, sf):
    from foliospark.plans.queries import _candidates

    wanted = {
        r["doc_id"]: r["text"] or "" for r in spark.read.parquet(
            f"{sf}/documents.parquet"
        ).where("doc_id % 100 = 0").collect()
    }
    got = {r["query_id"]: r["query"] for r in _candidates(spark, sf)[1].collect()}
    assert got == wanted and any(len(t) > 100 for t in wanted.values())


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert set(ORACLE) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns


def test_candidates_go_to_the_texts(spark, sf):
    """The texts of all documents are not shuffled for the few candidates of each query."""
    from foliospark.plans.queries import _candidates

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        c = _candidates(spark, sf)[0]
        plan = c._jdf.queryExecution().executedPlan().toString()
        n, different = c.count(), c.select("query_id", "source_kind", "doc_id").distinct().count()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert n == different > 0


def test_query_weights_are_not_broadcast_by_the_driver(spark, sf):
    """The duplicates are dropped from a search whose weights are no hash table of the driver."""
    plan = QUERIES["drop_near_duplicates"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "idf" not in plan


def test_conditions_on_the_content_meet_candidates_only(spark, sf):
    """Hidden instructions are looked for in the candidates, not in the texts of all documents."""
    from foliospark.operators import context
    from foliospark.plans.queries import _candidates

    plan = context.safe_candidates(_candidates(spark, sf)[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "Join" in plan
    assert "RLIKE" not in plan[plan.index("Join") :].split("\n", 1)[1]
