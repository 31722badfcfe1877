import random

from foliospark.llm import split as S


def check(text, most, overlap):
    cuts, strength = S.pieces(text, most, overlap), S.strengths(text)
    assert bool(cuts) == bool(text)
    over = max(0, min(overlap, most - 1))
    least = min(most, max(over + 1, most // 2))
    assert not cuts or (cuts[0][0] == 0 and cuts[-1][1] == len(text) and all(0 < b - a <= most for a, b in cuts))
    for (a, b), (c, _) in zip(cuts, cuts[1:]):
        assert a < c <= b and b - c <= over
        window = list(strength[a + least : a + most + 1])
        assert b == a + least + max(range(len(window)), key=lambda i: (window[i], i))


def test_against_brute_force(monkeypatch):
    monkeypatch.setattr(S, "SLAB", 1 << 9)
    rng = random.Random(1)
    for _ in range(250):
        text = "".join(rng.choice("ab cd. ,\n\n é́😀x") for _ in range(rng.randrange(0, 3000))).strip()
        check(text, rng.randrange(1, 400), rng.randrange(0, 120))


def test_boundaries():
    text = "One sentence here. Another one, with a clause.\n\nA new paragraph that is long enough."
    assert [text[a:b] for a, b in S.pieces(text, 60, 0)] == [
        "One sentence here. Another one, with a clause.\n\n", "A new paragraph that is long enough."
    ]
    assert S.pieces("x" * 25, 10, 3) == [(0, 10), (7, 17), (14, 24), (21, 25)]


def test_items(spark):
    limits = spark.createDataFrame(
        [("text", 10, 2), ("page", 12, None)], "item_kind string, max_chars int, overlap_chars int"
    )
    blocks = spark.createDataFrame(
        [
            (1, "text", "  short \n"), (2, "text", "much longer than ten"), (2, "text", "much longer than ten"),
            (3, "image", "x" * 50), (4, "text", None), (None, "text", "y" * 11), (6, None, "z" * 30)
        ],
        "block_uid bigint, block_type string, markdown_result string"
    )
    entry = "page_uid bigint, blocks array<struct<block_id:int,block_type:string,markdown_result:string>>"
    pages = spark.createDataFrame(
        [
            (7, [(1, "text", "second"), (0, "text", " first "), (1, "text", "second"), (2, "text", "  ")]), (8, None),
            (9, []), (10, [(0, "text", None)])
        ],
        entry
    )
    items = S.all_items(blocks, pages)
    assert {
        (r["item_kind"], r["item_id"]): r["text"] for r in items.where("item_kind = 'page'").collect()
    } == {("page", 7): "first\n\nsecond", ("page", 8): "", ("page", 9): "", ("page", 10): ""}
    got = S.split_items(items, limits)
    assert {(r["item_kind"], r["item_id"]) for r in got.collect()} == {("block", 2), ("block", None), ("page", 7)}
    rows = got.where("item_id = 2").orderBy("piece_no").collect()
    assert [r["piece_no"] for r in rows] == list(range(1, len(rows) + 1)) and all(len(r["piece"]) <= 10 for r in rows)
    assert S.split_items(items.limit(0), limits).collect() == []
