import pytest
from pyspark.sql import functions as F

from foliospark.llm import scan

SCHEMA = "doc string, page int, block_id int, block_uid bigint, block_type string, heading_level int, raw_content string, kind string"
#: Enough plain text that the words below count as frequent.
FILL = [
    "every measurement reads the temperature near the road",
    "that temperature keeps the measurement on the time-series road",
    "the class opens every window near the time-series map", "những thời tiết đồng thời ghi nhận mỗi độ ẩm"
] * 12


@pytest.fixture(scope="module")
def blocks(spark):
    rows, uid = [], 0

    def add(doc, page, block, text, kind="text", level=None):
        nonlocal uid
        uid += 1
        rows.append((doc, page, block, uid, kind, level, text, "x"))
        return uid

    for i, t in enumerate(FILL):
        add(f"f{i}", 1, 0, t)
    ids = {}
    ids["title"] = add("d", 1, 0, "Guide to the road", level=1)
    ids["a"] = add("d", 1, 1, "The class reads every temperature near the ro-\nad and opens the meas-")
    for p in (2, 3, 4):
        ids[f"h{p}"] = add("d", p, 0, f"{p} | GUIDE TO THE R0AD" if p % 2 else "Guide  to the road")
        ids[f"b{p}"] = add(
            "d", p, 1,
            "urement near the time-\nseries map for pre-\nand post-test use" if p == 2 else "the class goes on" if p == 4 else "the ternperature near the wind0w keeps\nđồng thờ1 tiết"
        )
        ids[f"i{p}"] = add("d", p, 2, "", "image")
        ids[f"n{p}"] = add("d", p, 3, f"text goes on here\n- {p + 10} -")
    rows.append(rows[-1])
    ids["code"] = add("e", 1, 0, "QX1010 x1y7 B1-404 n9 and H0sora", "text")
    ids["null"] = add("e", 1, 1, None)
    return spark.createDataFrame(rows, SCHEMA), ids


def test_found(blocks):
    df, ids = blocks
    got = {(r["block_uid"], r["line_no"], r["kind"]) for r in scan.found(df, scan.Settings(frequent_least=3)).collect()}
    wanted = {(ids[f"h{p}"], 1, "running_head") for p in (2, 3, 4)} | {(ids[f"n{p}"], 2, "page_no") for p in (2, 3, 4)}
    wanted |= {(ids["a"], 1, "hyphen"), (ids["a"], 2, "hyphen")} | {(ids["b3"], n, "misread") for n in (1, 2)}
    assert got == wanted


def test_repair(blocks):
    df, ids = blocks
    got = {r["block_uid"]: r["text"] for r in scan.repair(df, scan.Settings(frequent_least=3)).collect()}
    assert len(got) == df.select("block_uid").distinct().count()
    assert got[ids["a"]] == "The class reads every temperature near the road and opens the measurement"
    assert got[ids["b2"]] == "near the time-series map for pre- and post-test use" and got[ids["h3"]] == ""
    assert got[ids["b3"]] == "the temperature near the window keeps đồng thời tiết" and got[ids["n2"]] == "text goes on here" and got[
        ids["null"]
    ] is None and got[ids["i2"]] == ""


def test_repair_of_markdown(spark, blocks):
    df, ids = blocks
    own = F.col("block_uid")
    md = F.regexp_replace(F.regexp_replace("raw_content", "(?<=[a-z])-\n", "- "), "\n", " ")
    md = F.when(own == ids["title"], F.concat(F.lit("# "), md)).when(
        own == ids["code"], F.lit("| x1y7 | n9 |\n| --- | --- |")
    ).when(own == ids["n4"], None).when(own == ids["i2"], F.lit("![a](b.png)"))
    # not made from raw_content: a word more
    md = md.when(
        own == ids["b3"], F.lit("## The road\nthe ternperature near the wind0w keeps the mea- surement")
    ).otherwise(F.regexp_replace(F.regexp_replace("raw_content", "(?<=[a-z])-\n", "- "), "\n", " "))
    got = {
        r["block_uid"]: r for r in scan.repair_both(
            df.withColumn("markdown_result", md), scan.Settings(frequent_least=3)
        ).collect()
    }
    plain = {r["block_uid"]: r["text"] for r in scan.repair(df, scan.Settings(frequent_least=3)).collect()}
    assert {k: r["text"] for k, r in got.items()} == plain
    text = {k: got[i]["markdown_text"] for k, i in ids.items()}
    assert text["a"] == "The class reads every temperature near the road and opens the measurement" and text[
        "title"
    ] == "# Guide to the road"
    assert text[
        "b2"
    ] == "near the time-series map for pre- and post-test use" and text["h3"] == "" and text["n2"] == "text goes on here"
    assert text[
        "code"
    ] == "| x1y7 | n9 |\n| --- | --- |" and text["n4"] is None and text["null"] is None and text["i2"] == "![a](b.png)"
    assert text["b3"] == "## The road\n\nthe temperature near the window keeps the measurement"


def test_repair_of_a_very_long_line(spark):
    rows = [("f", i, 0, i, "text", None, "the temperature near the road", "x") for i in range(6)]
    rows.append(("d", 1, 0, 10, "text", None, "near the tempera-\nture " + "road " * 100_001 + "end", "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["block_uid"]: r["text"] for r in scan.repair(df, scan.Settings(frequent_least=3)).collect()}[10].split()
    assert len(got) == 100_005 and got[:4] == ["near", "the", "temperature", "road"] and got[-1] == "end"


def test_skeletons(spark):
    pairs = [
        ("t0àn", "toàn"), ("rnethod", "method"), ("fiinction", "function"), ("vvith", "with"), ("clay", "day"),
        ("hiẹu", "hiệu"), ("điếm", "điểm"), ("dồng", "đồng"), ("para9raph", "paragraph"), ("tbe", "the")
    ]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert all(r[0] for r in df.select(scan.skeleton(df.a) == scan.skeleton(df.b)).collect())
    other = spark.createDataFrame(
        [("đồ", "độ"), ("nhưng", "những"), ("toàn", "toán"), ("ma", "mà")], "a string, b string"
    )
    assert not any(r[0] for r in other.select(scan.skeleton(other.a) == scan.skeleton(other.b)).collect())


def test_empty(spark):
    assert scan.found(spark.createDataFrame([], SCHEMA)).collect() == []


def test_heads_of_chapters_addresses_and_long_lines(spark):
    long = "A very long head that names the whole series, its editors and their institute " * 4 + "and the year"
    rows, uid = [], 0
    for p in range(1, 61):
        lines = [f"Line {chr(96 + i)} of page {'x' * p} stays" for i in range(1, 5)]
        if 20 <= p < 32:
            lines = [f"{p} The Middle Chapter", *lines]
        if p % 2:
            lines = [*lines, "https://example.org/series"]
        else:
            lines = [long, *lines]
        uid += 1
        rows.append(("d", p, 0, uid, "text", None, "\n".join(lines), "x"))
    # twice in a document of three pages: a sentence that goes on in a small letter is no head
    rows += [
        (
            "e", p, 0, 100 + p, "text", None,
            f"Opening {'y' * p}\nThis {'z' * p} says that\nit goes on and on again here" if p < 3 else "Other", "x"
        ) for p in (1, 2, 3)
    ]
    got = {
        (r["block_uid"], r["line_no"]) for r in scan.heads_and_numbers(
            spark.createDataFrame(rows, SCHEMA)
        ).where("kind = 'running_head'").collect()
    }
    wanted = {(p, 1) for p in range(2, 61, 2)} | {(p, 1 + (p % 2 == 0)) for p in range(20, 32)} | {
        (p, 5 + (20 <= p < 32)) for p in range(1, 61, 2)
    }
    assert got == wanted


def test_support_over_line_ends_and_forms_of_any_length(spark):
    form = "interdependence" * 4
    rows = [
        ("f", i, 0, i, "text", None, f"the {form} opens near the window and the temperature", "x") for i in range(20)
    ]
    rows += [
        ("d", 1, 0, 50, "text", None, "it opens near the\nwind0w.", "x"), ("d", 2, 0, 51, "text", None, "wind0w", "x"),
        ("d", 3, 0, 52, "text", None, f"the {form[:-1]}0 x{'y' * 200} opens", "x"),
        ("d", 4, 0, 53, "text", None, f"the {form[:5]}0{form[6:]} opens", "x")
    ]
    rows[-2] = ("d", 3, 0, 52, "text", None, f"the {form.replace('c', 'e', 1)} opens", "x")
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["block_uid"], r["line_no"]) for r in scan.found(df).collect() if r["kind"] == "misread"}
    assert got >= {(50, 2), (52, 1)} and (51, 1) not in got


def test_second_half_after_all_noise_lines(spark):
    fill = [("f", i, 0, i, "text", None, "the temperature near the road", "x") for i in range(8)]
    page = lambda p, lines: ("d", p, 0, 20 + p, "text", None, "\n".join(lines), "x")
    rows = [
        page(
            p,
            [
                "Head One Line", "Head Two Line", f"body {'z' * p} near the {'tempera-' if p == 2 else 'road.'}",
                "Foot One Line", "Foot Two Line"
            ]
        ) for p in (1, 2)
    ]
    rows += [page(3, ["Head One Line", "Head Two Line", "ture near the road", "Foot One Line", "Foot Two Line"])]
    got = {
        (r["block_uid"], r["line_no"], r["kind"]) for r in scan.found(
            spark.createDataFrame(fill + rows, SCHEMA), scan.Settings(frequent_least=3)
        ).collect()
    }
    assert {(22, 3, "hyphen")} == {x for x in got if x[2] == "hyphen"} and len(
        [x for x in got if x[2] == "running_head" and x[0] > 20]
    ) == 12


def test_repair_chooses_by_neighbours_counted_once_per_block(spark):
    # a look-alike that two frequent words explain takes the one that stands beside the same neighbours
    rows = [
        (
            "f", i, 0, i, "text", None, "they draw near the clay pot" if i % 2 else "they count every single day again",
            "x"
        ) for i in range(40)
    ]
    rows += [
        ("d", 1, 0, 100, "text", None, "they count every single c1ay again", "x"),
        ("d", 1, 1, 101, "text", None, "they draw near the c1ay pot", "x")
    ]
    got = {r["block_uid"]: r["text"] for r in scan.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[100] == "they count every single day again" and got[101] == "they draw near the clay pot"
