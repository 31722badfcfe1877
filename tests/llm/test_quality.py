import random

from foliospark.llm import quality as Q


def test_merge_equals_whole():
    rng = random.Random(5)
    for _ in range(600):
        text = "".join(
            rng.choice(
                ["the ", "  ", "a", "bc ", ".\n", "\n", "|", "\t", " ,", "Mỗi ", "• ", "9", "\n\n", "é-"]
            ) for _ in range(rng.randrange(300))
        )
        size = rng.randrange(1, 60)
        parts = [Q.chunk_states([text[i : i + size]]) for i in range(0, max(len(text), 1), size)]
        while len(parts) > 1:
            j = rng.randrange(len(parts) - 1)
            parts[j : j + 2] = [Q.merge(parts[j], parts[j + 1])]
        assert Q.finish(parts[0])[0].tolist() == Q.text_counts(text)


ROWS = [
    (
        "prose", 1,
        "The day is long and the road is dry, because every cloud\nkeeps away from the hill. It was a good week.", "x"
    ),
    (
        "prose", 1,
        "The day is long and the road is dry, because every cloud\nkeeps away from the hill. It was a good week.", "x"
    ),
    ("list", 2, "• one thing\n• another thing\n3. more", None),
    ("table", 3, "| a | b |\n| 1 | 2 |\nc\t3\t4\t5", ""),
    ("junk", 4, "zxq wvk ### @@@ pqz qqq kkk zzz vvv www xxx jjj qqq zzz kkk 777 %%% $$$", None),
    ("none", 5, None, None), (None, 6, "", " \n "),
]


def frame(spark):
    return spark.createDataFrame(
        [(*r, 0) for r in ROWS], "doc string, block_uid bigint, raw_content string, markdown_result string, salt int"
    )


def test_stats(spark):
    got = {r["doc"]: r for r in Q.document_stats(frame(spark)).collect()}
    assert {d: r["kind"] for d, r in got.items()} == {
        "prose": "prose", "list": "list", "table": "table", "junk": "junk", "none": "empty", None: "empty"
    }
    assert got["prose"]["raw_words"] == 22 and got["prose"][
        "raw_punct_line_share"
    ] == 0.5 and got["none"]["raw_mean_word_length"] is None
    assert {r["doc"] for r in Q.found(frame(spark)).collect()} == {"list", "table", "junk"}


def test_chunks_change_nothing(spark):
    a = sorted(map(str, Q.document_stats(frame(spark)).collect()))
    assert sorted(map(str, Q.document_stats(frame(spark), chunk=7).collect())) == a
    assert Q.document_stats(frame(spark).limit(0)).collect() == []
