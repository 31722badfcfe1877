import pytest

from foliospark.llm import lookalike as L

CASES = [
    ("tｈａｔ", "that", True), ("ﬁeld", "field", True), ("một", "một", True), ("th​is", "this", True),
    ("a\xa0b", "a b", True), ("Сơ sở", "Cơ sở", True), ("thiѕ", "this", True), ("Εach", "Each", True),
    ("νà", "và", True), ("ɡió", "gió", True), ("\u03bff \u039fn", "of On", True), ("\u03bdt", "\u03bdt", False),
    ("Ðồ", "Đồ", True),
    ("Kỹ", "Kỹ", True), ("h​i‌d﻿e", "hide", True), ("сигнaл", "сигнал", True), ("6.３", "6.3", True),
    ("x̄ = 1", "x̄ = 1", False), ("H₂O № ½ m²", "H₂O № ½ m²", False), ("сигнал", "сигнал", False),
    ("αx + βy, Δt = 5 μs, kΩ", "αx + βy, Δt = 5 μs, kΩ", False), ("👩‍💻 ok", "👩‍💻 ok", False),
    ("plain  text\t\n", "plain  text\t\n", False), ("", "", False), (None, None, False),
    ("end\xad\nline", "end\xad\nline", False),
]


@pytest.fixture(scope="module")
def folded(spark):
    df = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)], "id bigint, t string, folded string")
    return {r["id"]: r for r in L.fold_table(df, "id", "t").collect()}, {
        r["id"] for r in L.fold_table(df, "id", "t", suspects_only=True).where("differs").collect()
    }


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(folded, i):
    rows, suspects = folded
    assert (rows[i]["folded"], rows[i]["differs"]) == CASES[i][1:] and (i in suspects) == CASES[i][2]


def test_folding_twice_changes_nothing(spark):
    df = spark.createDataFrame([(i, c[1]) for i, c in enumerate(CASES)], "id bigint, t string")
    assert not [r for r in L.fold_table(df, "id", "t").collect() if r["differs"]]


def test_names(spark):
    courses = spark.createDataFrame(
        [(1, "Сơ\xa0SỞ  "), (2, "unknown"), (3, None), (1, "Сơ\xa0SỞ  ")], "course_uid bigint, name string"
    )
    names = spark.createDataFrame([(9, "Cơ sở"), (4, "Cơ sở"), (5, None)], "name_id int, name string")
    got = {r["course_uid"]: (r["name"], r["name_id"]) for r in L.consistent_names(courses, names).collect()}
    assert got == {1: ("Cơ SỞ", 4), 2: ("unknown", None), 3: (None, None)}
    assert L.found(
        courses.limit(0).selectExpr("course_uid AS block_uid", "name AS raw_content"), courses
    ).collect() == [("course", 1)]


def test_no_changed_text_is_passed_by(spark):
    import sys
    import unicodedata

    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}b" for c in chars]
    # every canonical pair, every mark after a letter, jamo, and words among look-alikes
    texts += [
        unicodedata.normalize(
            "NFD", c
        ) for c in chars if unicodedata.decomposition(c) or 0xAC00 <= ord(c) < 0xAC00 + 600
    ]
    texts += [f"xi{c}o" for c in chars if unicodedata.category(c) == "Mn"] + [
        "\u1100\u1161", "\u0627\u0653", "\u304b\u3099", "\u0391\u0301"
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").repartition(8)
    changed = {r["id"] for r in L.fold_table(df, "id", "t").where("differs").collect()}
    assert {r["id"] for r in L.fold_table(df, "id", "t", suspects_only=True).where("differs").collect()} == changed
    assert {texts[i] for i in changed} >= {"\u1100\u1161", "\u0627\u0653", "\u304b\u3099"}
