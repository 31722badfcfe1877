import random

from pyspark.sql import functions as F

from foliospark.operators import layout as L

BOX = "doc string, page int, ord bigint, bbox struct<x0:double,y0:double,x1:double,y1:double>, block_type string, content string, heading_level int, font_size double, has_inline_math boolean, ocr_mode string, caption string"


def block(page, ord_, box, kind="text", content="x", **more):
    return (
        "d", page, ord_, box, kind, content, more.get("level"), more.get("size"), False, kind, more.get("caption", "")
    )


def dims(spark, n, w=600.0, h=800.0):
    return spark.createDataFrame(
        [("d", p, w, h) for p in range(1, n + 1)], "doc string, page int, width double, height double"
    )


def model_order(blocks, two, split, width):
    """Independent model of the two-column merge: take the higher of full-width and left, the right column after the
    left one.
    """
    if not two:
        return [b[2] for b in sorted(blocks, key=lambda b: (round(b[3][1] / 5) * 5, b[3][0]))]
    full, left, right = [], [], []
    for b in blocks:
        x0, _, x1, _ = b[3]
        side = full if x1 - x0 > 0.65 * width else left if x1 <= split + 20 else right if x0 >= split - 20 else full
        side.append(b)
    for s in (full, left, right):
        s.sort(key=lambda b: b[3][1])
    out = []
    while full or left or right:
        if full and (not left or full[0][3][1] <= left[0][3][1]):
            out.append(full.pop(0))
        elif left:
            out.append(left.pop(0))
        else:
            out.append(right.pop(0))
    return [b[2] for b in out]


def test_reading_order_against_model(spark):
    rng = random.Random(1)
    every, wanted, layouts = [], {}, []
    for page in range(1, 60):
        two = page % 3 > 0
        bs = []
        for i in range(rng.randrange(1, 9)):
            x0 = rng.choice([0.0, 50.0, 310.0, 250.0])
            bs.append(block(page, i, (x0, float(rng.randrange(0, 40)), x0 + rng.choice([100.0, 240.0, 500.0]), 50.0)))
        every += bs
        wanted[page] = model_order(bs, two, 300.0, 600.0)
        layouts.append(("d", page, "2-column" if two else "1-column", 300.0 if page % 2 else None))
    lay = spark.createDataFrame(layouts, "doc string, page int, layout string, gutter double")
    rows = L.reading_order(spark.createDataFrame(every, BOX), lay, dims(spark, 60)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["page"], r["place"])):
        got.setdefault(r["page"], []).append(r["ord"])
    assert got == wanted


def test_merge_formulas(spark):
    rows = [
        block(1, 1, (0.0, 0.0, 100.0, 10.0), "math", "a", size=9.0, level=1),
        block(1, 2, (80.0, 24.0, 180.0, 30.0), "math", "b"), block(1, 3, (164.1, 31.0, 264.1, 40.0), "math", "c"),
        block(1, 4, (164.1, 35.0, 164.1, 36.0), "math", "d"), block(1, 5, (164.1, 60.0, 200.0, 70.0), "math", ""),
        block(1, 6, (0.0, 71.0, 9.0, 72.0), "text", "t", level=2),
    ]
    df = spark.createDataFrame(rows, BOX).withColumn("place", F.col("ord").cast("int"))
    got = [
        (
            r["content"], r["heading_level"], r["font_size"], r["bbox"]["y1"]
        ) for r in L.merge_formulas(df).orderBy("place").collect()
    ]
    assert got == [("a\nb", None, 9.0, 30.0), ("c\nd", None, None, 40.0), ("", None, None, 70.0), ("t", 2, None, 72.0)]


def model_gutter(boxes, w, h):
    n = int(w / 2) + 1
    cover = [0.0] * n
    for x0, y0, x1, y1 in boxes:
        for s in range(max(0, int(x0 / 2)), min(n - 1, int(x1 / 2)) + 1):
            cover[s] += max(0.0, y1 - y0)
    best, start = None, None
    for s in range(n + 1):
        free = s < n and cover[s] < 0.4 * h and 0.3 * w <= 2 * s <= 0.7 * w
        if free and start is None:
            start = s
        if not free and start is not None:
            width = 2 * (s - start)
            if width >= 8 and (best is None or width > best[0]):
                best = (width, 2 * start + width / 2)
            start = None
    return best and best[1]


def test_gutters_against_model(spark):
    rng = random.Random(2)
    rows, wanted = [], {}
    for page in range(1, 50):
        boxes = []
        for _ in range(rng.randrange(1, 6)):
            x0, y0 = rng.uniform(-5, 500), rng.uniform(0, 300)
            boxes.append((x0, y0, x0 + rng.uniform(0, 260), y0 + rng.choice([-5.0, 100.0, 330.0, 400.0])))
        rows += [("d", page, *b) for b in boxes]
        wanted[page] = model_gutter(boxes, 600.0, 800.0)
    got = {
        r["page"]: r["gutter"] for r in L.gutters(
            spark.createDataFrame(rows, "doc string, page int, x0 double, y0 double, x1 double, y1 double"),
            dims(spark, 49)
        ).collect()
    }
    assert got == {p: g for p, g in wanted.items() if g is not None}


def spans_df(spark, rows):
    return spark.createDataFrame(
        [
            ("d", 1, b, line, i, 10.0, 100.0 + 20 * b, 200.0, 112.0 + 20 * b, font, size, flags, text) for b, line, i,
            font, size, flags, text in rows
        ],
        "doc string, page int, block int, line int, span int, x0 double, y0 double, x1 double, y1 double, font string, size double, flags int, text string"
    )


def test_analyze_blocks(spark):
    body = [(9, line, 0, "Times", 10.0, 0, "plain words of the body of the page") for line in range(6)]
    rows = body + [
        (1, 0, 0, "Times", 16.0, 0, "A Title"), (2, 0, 0, "CMMI10", 10.0, 0, "p"), (2, 0, 1, "CMMI7", 7.0, 0, "g"),
        (2, 0, 2, "Times", 10.0, 0, "("), (2, 0, 3, "CMMI10", 10.0, 0, "x"), (2, 0, 4, "Times", 10.0, 0, ")"),
        (2, 0, 5, "Times", 10.0, 0, " is a density, "), (2, 0, 6, "Times", 10.0, 0, "so"),
        (3, 0, 0, "CMSY10", 10.0, 0, "∑"), (3, 0, 1, "CMMI10", 10.0, 0, "x"), (4, 0, 0, "Courier", 10.0, 0, "for i"),
        (4, 1, 0, "Courier", 10.0, 0, "  pass"), (5, 0, 0, "Times-Bold", 10.0, 0, "Bold head"),
        (6, 0, 0, "Times", 10.0, 16, "12345"), (7, 0, 0, "Times", 10.0, 0, "  "),
    ]
    s = spans_df(spark, rows)
    fonts = L.font_hierarchy(s)
    assert fonts.first().asDict() == {"doc": "d", "page": 1, "body": 10.0, "h1": 16.0, "h2": 13.5, "h3": 11.5}
    got = {r["ord"]: r for r in L.analyze_blocks(s, fonts).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 9}
    assert got[1]["heading_level"] == 1 and got[5]["heading_level"] == 3 and got[6]["heading_level"] is None
    assert got[2]["content"] == "$pg(x)$ is a density, so" and got[2][
        "has_inline_math"
    ] and got[2]["block_type"] == "text"
    assert got[3][
        "block_type"
    ] == "math" and got[3]["content"] == "∑ x" and got[4][
        "block_type"
    ] == "algorithm" and got[4]["content"] == "for i\n  pass"


def test_images_tables_and_segments(spark):
    s = spans_df(
        spark,
        [
            (0, 0, 0, "Times", 10.0, 0, "Text before"), (10, 0, 0, "Times", 10.0, 0, "Hình 1: ảnh"),
            (20, 0, 0, "Times", 10.0, 0, "in the table")
        ]
    )
    cells = "doc string, page int, ord int, bbox struct<x0:double,y0:double,x1:double,y1:double>, cells array<array<string>>"
    tables = spark.createDataFrame([("d", 1, 0, (0.0, 490.0, 300.0, 540.0), [["a", "b"], ["1", None]])], cells)
    images = spark.createDataFrame(
        [
            ("d", 1, 0, (10.0, 200.0, 200.0, 270.0)), ("d", 1, 1, (10.0, 280.0, 12.0, 281.0)),
            ("d", 1, 3, (300.0, 290.0, 302.0, 291.0)), ("d", 1, 2, (0.0, 0.0, 50.0, 40.0))
        ],
        "doc string, page int, ord int, bbox struct<x0:double,y0:double,x1:double,y1:double>"
    )
    got = [
        (
            r["block_id"], r["block_type"], r["raw_content"], r["caption"], r["ocr_mode"]
        ) for r in L.segment_pages(s, tables, images, dims(spark, 1)).orderBy("block_id").collect()
    ]
    assert got == [
        (0, "text", "Text before", "", "text"), (1, "figure", "", "Hình 1: ảnh", "figure"),
        (2, "text", "Hình 1: ảnh", "Hình 1: ảnh", "figure"), (3, "text", L.NO_IMAGE, "", "image"),
        (4, "text", "Hình 1: ảnh", "", "text"), (5, "table", "| a | b |\n| --- | --- |\n| 1 |  |", "", "table_complex")
    ]


def test_page_layout_and_vote(spark):
    left = [("d", 1, 50.0, 60.0 + 30 * i, 250.0, 80.0 + 30 * i) for i in range(3)]
    right = [("d", 1, 340.0, 60.0 + 30 * i, 560.0, 80.0 + 30 * i) for i in range(3)]
    one = [("d", 2, 50.0, 60.0, 560.0, 700.0), ("d", 3, 50.0, 0.0, 560.0, 40.0)]
    boxes = spark.createDataFrame(
        left + right + one, "doc string, page int, x0 double, y0 double, x1 double, y1 double"
    )
    got = {r["page"]: r["layout"] for r in L.page_layouts(boxes, dims(spark, 4)).collect()}
    assert got == {1: "2-column", 2: "1-column", 3: "1-column", 4: "1-column"}
    v = spark.createDataFrame(
        [("a", 1, "2-column"), ("b", 1, "1-column"), ("b", 2, "2-column"), ("b", 3, "1-column")],
        "doc string, page int, layout string"
    )
    assert {r["doc"]: r["layout"] for r in L.document_layouts(v).collect()} == {"a": "2-column", "b": "1-column"}
