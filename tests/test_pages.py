import os

from pyspark.sql import functions as F

from foliospark.operators import assemble as A
from foliospark.operators import pages as P
from foliospark.sources import files, sinks

PAGE = "doc string, page int, markdown string"


def test_repeated_and_dropped(spark):
    rows = [("d", p, f"Head\n\ntext {p}\nmore text {p}\nfoot") for p in (1, 2)] + [
        ("d", 3, "Head\nfoot"), ("d", 4, "abc"), ("d", 5, None), ("e", 1, "x\n")
    ]
    pages = spark.createDataFrame(rows, PAGE)
    rep = {(r["line"], r["n"]) for r in P.repeated_lines(pages).collect()}
    assert rep == {("Head", 4), ("foot", 4)}
    got = {(r["doc"], r["page"]): r["markdown"] for r in P.drop_repeated(pages, P.repeated_lines(pages)).collect()}
    assert got[
        ("d", 1)
    ] == "\ntext 1\nmore text 1" and got[("d", 3)] == "" and got[("e", 1)] == "x\n" and got[("d", 5)] is None


def test_edge_candidates(spark):
    df = spark.createDataFrame(
        [("one line",), ("abc\nabcd\n" + "x" * 80 + "\n" + "y" * 81,), ("a b c d e f g h i j k\nok line",)], "t string"
    )
    assert [r[0] for r in df.select(P.edge_candidates(F.col("t"))).collect()] == [
        ["one line", "one line"], ["abcd", "x" * 80], ["ok line", "ok line"]
    ]


def test_sections_and_marks(spark):
    heads = [
        ("d", 1, 1, "A", 1), ("d", 2, 2, "B", 1), ("d", 3, 3, "C", 2), ("d", 4, 2, "D", 4), ("d", 5, 1, "E", 5),
        ("d", 6, 3, "F", 5)
    ]
    h = spark.createDataFrame(heads, "doc string, ord int, level int, title string, page int")
    assert [
        r["path"] for r in P.section_paths(h).orderBy("ord").collect()
    ] == ["A", "A > B", "A > B > C", "A > D", "E", "E > F"]
    rows = [
        ("d", p, t) for p, t in ((1, "one"), (2, "# References"), (3, "three"), (4, "  REFERENCES \nx"), (5, "five"))
    ]
    pages = spark.createDataFrame(rows, PAGE)
    assert P.references_pages(pages).first()["references_page"] == 4
    out = {r["page"]: r["markdown"] for r in P.postprocess(pages, h).collect()}
    assert out[1] == "<!-- section: A > B -->\n\none" and out[3] == "three"
    assert out[4] == "<!-- section: A > D -->\n\n<!-- references section -->\n\nREFERENCES x"
    assert out[5].startswith("<!-- section: E > F -->\n\n<!-- references section -->")


def test_font_headings(spark):
    rows = [
        ("d", 1, 0, 0, 0, "Times", 10.0, 0, "body text " * 9), ("d", 1, 1, 0, 0, "Times", 16.0, 0, "Top"),
        ("d", 2, 0, 0, 0, "Times-Bold", 10.0, 0, "Sub"), ("d", 2, 1, 0, 0, "Times", 12.0, 0, "99")
    ]
    s = spark.createDataFrame(
        rows, "doc string, page int, block int, line int, span int, font string, size double, flags int, text string"
    )
    assert [
        (r["level"], r["title"], r["page"]) for r in P.font_headings(s).orderBy("ord").collect()
    ] == [(1, "Top", 1), (3, "Sub", 2)]


def test_documents_and_sinks(spark, tmp_path):
    pages = spark.createDataFrame([("a b.pdf", 2, "two"), ("a b.pdf", 1, "one"), ("a b.pdf", 3, "  ")], PAGE)
    assert A.document_markdown(pages).first()["markdown"] == "<!-- page 1 -->\n\none\n\n---\n\n<!-- page 2 -->\n\ntwo"
    lay = spark.createDataFrame([("a b.pdf", "2-column")], "doc string, layout string")
    whole = A.final_markdown(pages, lay).first()["markdown"]
    assert whole.startswith(
        '---\ntitle: "a b"\nsource: "a b.pdf"\npages: 3\nlayout: "2-column"\n---\n\n\n---\n\n<!-- page 1 -->'
    )
    done = sinks.write_markdown(pages, str(tmp_path), lay).collect()
    assert open(done[0]["path"], encoding="utf-8").read() == whole and os.listdir(tmp_path) == ["a b.md"]
    (tmp_path / "x y+z.pdf").write_bytes(b"123")
    (tmp_path / "B.pdf").write_bytes(b"1")
    got = [(r["name"], r["size_bytes"]) for r in files.list_files(spark, str(tmp_path)).collect()]
    assert got == [("B.pdf", 1), ("x y+z.pdf", 3)]
    assert [
        r["name"] for r in files.list_files(spark, str(tmp_path), contains="Y+", skip=["B.pdf"]).collect()
    ] == ["x y+z.pdf"]


def test_merge_and_routes(spark):
    c = spark.createDataFrame(
        [("d", "c_2", None), ("d", "c_1", " one "), ("d", "c_3", "three")], "name string, path string, content string"
    )
    assert A.merge_chunks(c, "g").first()[
        "markdown"
    ] == "<!-- Source: d -->\n<!-- Generated by g -->\n\none\n\n\nthree\n"
    f = spark.createDataFrame(
        [("a.pdf", 5_000_000, 1, None), ("b.pdf", 1, 100, 0), ("c.pdf", 1, None, 7), ("d.pdf", None, 31, None)],
        "name string, size_bytes bigint, pages int, output_size bigint"
    )
    assert [(r["route"], r["status"]) for r in A.plan_files(f, resume=True).collect()] == [
        ("chunked", None), ("chunked", None), ("normal", "skipped"), ("normal", None)
    ]
    assert [
        r["name"] for r in A.plan_files(f, skip=["a.pdf"], contains="B").collect()
    ] == ["b.pdf"] and A.plan_files(f, skip=["a.pdf"], only="a.pdf").count() == 1
    assert [
        r["chunk_name"] for r in A.chunk_ranges(f.where("name = 'd.pdf'")).orderBy("chunk_no").collect()
    ] == ["d_chunk_001_p1-30", "d_chunk_002_p31-31"]
    s = spark.createDataFrame([(1000, 500), (500, 1200), (10, 20)], "w int, h int")
    w, h = A.resized(F.col("w"), F.col("h"))
    assert [tuple(r) for r in s.select(w, h).collect()] == [(896, 448), (373, 896), (10, 20)]


def test_readings(spark):
    schema = "doc string, page int, block_id int, block_type string, raw_content string, has_crop boolean, is_done boolean, markdown_result string, caption string"
    rows = [
        ("d.pdf", 1, 0, "math", "x", True, False, "", ""), ("d.pdf", 1, 1, "figure", "", True, False, "", "Fig"),
        ("d.pdf", 1, 2, "image", "", False, False, "", ""), ("d.pdf", 1, 3, "algorithm", "go", True, False, "", None),
        ("d.pdf", 1, 4, "text", "t", False, True, "t", "")
    ]
    b = spark.createDataFrame(rows, schema)
    r = spark.createDataFrame(
        [("d.pdf", 1, 1, " seen "), ("d.pdf", 1, 3, "[OCR Failed: x]"), ("d.pdf", 1, 2, "lost")],
        "doc string, page int, block_id int, reading string"
    )
    got = [x["markdown_result"] for x in A.apply_readings(b, r).orderBy("block_id").collect()]
    assert got == [
        "$$ [Formula p1 #0] $$", "![Image p1 #1](images/d_p1_b1_figure.png)\n\n> Fig\n\nseen", "",
        "```algorithm\n// [Algorithm p1 #3]\ngo\n```", "t"
    ]
    assert [x["markdown_result"] for x in A.apply_readings(b, r, True).orderBy("block_id").collect()][2] == "lost"
    assert [x["markdown_result"] for x in A.placeholders(b).orderBy("block_id").collect()] == [
        "$[Formula block #0]$", "![Image p1 #1](images/d_p1_b1_figure.png)", "> [Image block #2]",
        "![Image p1 #3](images/d_p1_b3_algorithm.png)", "t"
    ]
    assert A.page_markdown(A.placeholders(b)).first()["has_ocr_blocks"]


def test_reports_as_rows(spark):
    from foliospark.operators import assemble as A

    results = spark.createDataFrame(
        [("b", "ok"), ("a", "ok"), ("c", None), ("d", "failed")], "name string, status string"
    )
    assert [tuple(r) for r in A.status_rollup(results).collect()] == [
        (None, 1, "c"), ("failed", 1, "d"), ("ok", 2, "a"), ("ok", 2, "b")
    ]
    assert A.status_rollup(results.limit(0)).collect() == []
    blocks = spark.createDataFrame(
        [("x", 1, "image"), ("x", 2, "math"), ("y", 1, "text")], "doc string, page int, block_type string"
    )
    got = {r["doc_name"]: r for r in A.run_summary(A.block_counts(blocks), 1.234).collect()}
    assert (
        got[None]["total_files"], got[None]["total_pages"], got[None]["ocr_blocks"], got[None]["elapsed_sec"]
    ) == (2, 3, 2, 1.23)
    assert (
        got["x"]["total_files"], got["x"]["total_blocks"], got["y"]["text_blocks"]
    ) == (None, 2, 1) and len(got) == 3
    none = A.run_summary(A.block_counts(blocks.limit(0)), 0.0).collect()
    assert len(none) == 1 and none[0]["total_pages"] == 0


def test_names_sizes_and_payloads(spark, tmp_path):
    from pyspark.sql import functions as F

    from foliospark.operators import assemble as A
    from foliospark.sources import files, sinks

    assert spark.range(1).select(A.chunk_image_name(F.lit(7), F.lit("a.png"))).first()[0] == "chunk007_a.png"
    assert spark.range(1).select(files.size_mb(F.lit(2500000))).first()[0] == 2.5
    pages = spark.createDataFrame([("x", 3), ("x", 9), ("y", 1)], "doc string, page int")
    assert {tuple(r) for r in files.page_counts(pages).collect()} == {("x", 9), ("y", 1)}
    rows = spark.createDataFrame([(1, '{"a": 1}'), (2, None)], "query_id bigint, payload string")
    sinks.write_json(rows, str(tmp_path / "out"))
    assert sorted(
        map(tuple, files.read_json_lines(spark, str(tmp_path / "out")).collect())
    ) == [(1, '{"a": 1}'), (2, None)]


def test_sections_of_a_long_document_over_ranges(spark):
    import random

    rng = random.Random(7)
    docs = ["long"] * 300 + ["b"] * 20 + [None] * 40
    heads = [(d, i * 3, rng.randrange(1, 5), f"t{i}", 1 + i // 4) for i, d in enumerate(docs)]
    h = spark.createDataFrame(heads, "doc string, ord bigint, level int, title string, page int")
    stack, wanted = {}, {}
    for d, o, level, title, _ in heads:
        s = [x for x in stack.get(d, []) if x[0] < level] + [(level, title)]
        stack[d], wanted[(d, o)] = s, " > ".join(x[1] for x in s)
    for width in (10, 1 << 24):
        assert {(r["doc"], r["ord"]): r["path"] for r in P.section_paths(h, width=width).collect()} == wanted
    pages = spark.createDataFrame([(d, p) for d in ("long", "b") for p in range(1, 100, 2)], "doc string, page int")
    every = lambda w: {tuple(r) for r in P.section_map(pages, h, w).collect()}
    assert every(7) == every(10_000) and len(every(7)) == 100
    marked = pages.withColumn("markdown", F.lit("x"))
    refs = spark.createDataFrame([("b", 5)], "doc string, references_page int")
    marks = lambda w: {tuple(r) for r in P.mark_sections(marked, P.section_map(pages, h), refs, w).collect()}
    assert marks(7) == marks(10_000)
