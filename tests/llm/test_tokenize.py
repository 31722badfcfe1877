import pytest

from foliospark.llm import tokenize as T

TEXTS = [
    "", None, "Hello world", "aaaaaaaaaaa", "a" * 3001, "Các kiểm định học thuật.\r\n\t x", "<|endoftext|> x",
    "😀👩‍💻 é́", " \n\n  ", "ab" * 500, "0123456789" * 20, "don't we'll"
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(T.vocabulary_path())
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


def test_ids_and_round_trip(spark, reference):
    df = spark.createDataFrame(
        [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, "x", 0), (0, "again", 0)],
        "doc_id bigint, text string, ids int"
    )
    got = T.encode_table(df).collect()
    assert len(got) == len(TEXTS) + 2
    by_id = {r["doc_id"]: r["ids"] for r in got if r["doc_id"] not in (None, 0)}
    assert by_id == {i: reference(t) for i, t in enumerate(TEXTS) if i}
    assert sorted(r["ids"] for r in got if r["doc_id"] == 0) == sorted([[], reference("again")])
    counts = {r["doc_id"]: r["n_tokens"] for r in T.encode_table(df, count_only=True).collect() if r["doc_id"]}
    assert counts == {i: len(v) for i, v in by_id.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.encode_table(df).collect() == []


def test_memory_is_emptied(reference, monkeypatch):
    monkeypatch.setattr(T, "MEMORY_WORDS", 3)
    bpe = T.BatchBpe(T.vocabulary_path())
    for text in ("one two three four", "five six one", "x" * 100 + " one " + "x" * 100):
        flat, number = bpe.encode([text])
        assert flat.tolist() == reference(text) and number.tolist() == [len(flat)]


def test_long_words_rank_by_rank(reference, monkeypatch):
    import random
    import time

    rng = random.Random(4)
    words = [
        "".join(rng.choice("abcdethin" if k % 2 else "aab") for _ in range(n)) for k,
        n in enumerate((3, 40, 700, 5000, 9000))
    ] + ["ab" * 3000, "a" * 4097, "não" * 900]
    for rounds in (0, 3, 48):
        monkeypatch.setattr(T, "ROUNDS", rounds)
        flat, number = T.BatchBpe(T.vocabulary_path()).encode([*words, "short words here"])
        got, at = [], 0
        for n in number:
            got.append(flat[at : at + n].tolist())
            at += n
        assert got == [reference(w) for w in [*words, "short words here"]]
    began = time.monotonic()
    T.BatchBpe(T.vocabulary_path()).encode(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))])
    assert time.monotonic() - began < 30


def test_columns_beside_the_ids(spark):
    df = spark.createDataFrame(
        [(1, "a b", "s", 5), (None, None, None, 6)], "doc_id bigint, text string, ids string, n_tokens int"
    )
    assert sorted(
        map(tuple, T.encode_table(df, count_only=True, keep=("ids",)).collect()), key=str
    ) == [(1, "s", 2), (None, None, 0)]
