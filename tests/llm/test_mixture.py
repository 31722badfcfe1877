from foliospark.llm import mixture as M


def frames(spark):
    sizes = [
        (i, "big", 10 + i % 7) for i in range(400)
    ] + [(1000 + i, "small", 5) for i in range(40)] + [(2000, "other", 99), (3000, "big", 0)]
    targets = [("Big", 0.5, 1), ("small ", 0.4, 3), ("missing", 0.1, 2), (None, 0.5, 1), ("zero", 0.0, 1)]
    return spark.createDataFrame(sizes, "doc_id bigint, source string, n_tokens bigint"), spark.createDataFrame(
        targets, "source string, target_share double, max_repeats int"
    )


def test_budgets_and_mix(spark):
    sizes, targets = frames(spark)
    plan = {r["source"]: r for r in M.budgets(sizes, targets).collect()}
    assert plan["small"]["budget"] == 600 and plan["big"]["budget"] == 750 and plan["missing"]["budget"] == 0
    for ranges in (1, 7, 64):
        rows = M.mix(sizes, targets, M.Settings(ranges=ranges)).collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        small = [r for r in rows if r["source"] == "small"]
        assert sum(r["copies"] * r["n_tokens"] for r in small) == 600 and all(r["copies"] == 3 for r in small)
        big = sum(r["copies"] * r["n_tokens"] for r in rows if r["source"] == "big")
        assert abs(big - 750) <= 8 and all(r["copies"] == 1 for r in rows if r["source"] == "big")
        chosen = {r["doc_id"] for r in rows}
        first = chosen if ranges == 1 else first
        assert chosen == first  # the ranges do not change the choice


def test_partial_epoch_and_shares(spark):
    sizes, targets = frames(spark)
    s = {r["source"]: r for r in M.shares(sizes, targets, M.Settings(total_tokens=700)).collect()}
    assert s["small"]["budget"] == 280 and s["small"]["tokens"] == 280 and s["small"]["most_copies"] == 2
    assert abs(s["big"]["actual_share"] - 0.5 / 0.9) < 0.02 and s["missing"]["tokens"] == 0
    assert M.mix(sizes.limit(0), targets).collect() == []


def test_source_names(spark):
    df = spark.createDataFrame(
        [("Lecture Notes",), (" lecture_notes ",), ("lecture-notes",), (" ",), (None,)], "s string"
    )
    assert [r[0] for r in df.select(M.source_key(df.s)).collect()] == ["lecture_notes"] * 3 + [None] * 2
