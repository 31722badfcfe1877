import random

import numpy as np
from quality_model import counts

from foliospark.llm import quality as Q

PARTS = [
    "the ", "  ", "a", "bc ", ".\n", "\n", "|", "\t", " ,", "Mỗi ", "• ", "9", "\n\n", "é-", "(iv) ", "12. ", "a) ",
    "WHENEVER", "because,", "x; y, 5, 7, 8", "\r", "𝔘", "　", "_", "one two three four", "ﬁ", "½", "\xad\n", "ß", "İ "
]


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_states_of_many_texts_against_the_model():
    sample = [*texts(1500), "", "\n", "x" * 3000, " " * 50, "and" + "\n" * 9]
    assert Q.finish(Q.chunk_states(sample)).tolist() == [counts(t) for t in sample]


def test_rounds_against_the_model():
    sample, rng = texts(400, 4), random.Random(1)
    for size in (1, 2, 3, 7, 20, 64):
        cut = [[t[i : i + size] for i in range(0, max(len(t), 1), size)] for t in sample]
        number = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        states, text = Q.merge_texts(Q.chunk_states([p for c in cut for p in c]), number)
        assert text.tolist() == list(range(len(cut)))
        assert Q.finish(states).tolist() == [counts(t) for t in sample]
    for t in sample[:60]:  # any tree
        parts = [Q.chunk_states([c]) for c in (t[i : i + 5] for i in range(0, max(len(t), 1), 5))]
        while len(parts) > 1:
            j = rng.randrange(len(parts) - 1)
            parts[j : j + 2] = [Q.merge(parts[j], parts[j + 1])]
        assert Q.finish(parts[0]).tolist() == [counts(t)]


def test_texts_over_batches(spark, monkeypatch):
    sample = texts(40, 5) + [("one two, the three\n" * 50 + "\t| x") * 3, "", None]
    df = spark.createDataFrame(
        [("d", i, t, None if i % 3 else t) for i, t in enumerate(sample)],
        "doc string, block_uid bigint, raw_content string, markdown_result string"
    ).coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r["block_uid"], r["field"]): list(r[3:]) for r in Q.block_counts(df, chunk=5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {
        (i, f): counts((t or "") if not f or i % 3 == 0 else "") for i, t in enumerate(sample) for f in (0, 1)
    }


def test_same_kinds_by_small_chunks(spark, sf):
    blocks = spark.read.parquet(f"{sf}/document_blocks.parquet")
    kinds = lambda chunk: {(r["doc"], r["kind"], r["raw_words"]) for r in Q.document_stats(blocks, chunk).collect()}
    assert kinds(7) == kinds(Q.CHUNK) and len(kinds(7)) > 3
