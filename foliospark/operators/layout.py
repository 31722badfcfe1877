"""Page layout: from spans, tables and images of a page to typed blocks in reading order.

Inputs are tables that a PDF reader fills (the reader itself is outside):
``spans`` (doc, page, block, line, span, x0, y0, x1, y1, font, size, flags,
text), ``page_dims`` (doc, page, width, height), ``tables`` (doc, page, ord,
bbox, cells) and ``images`` (doc, page, ord, bbox).  The grain of every window
and aggregation is the page, so nothing gathers a whole document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T

#: Parts of the names of fonts for formulas and of fonts of one width.
MATH_FONTS = "CMMI CMSY CMEX MSAM MSBM EUFM RSFS CMTI Symbol MathJax STIX MathTime Euler LMM DejaVuMath".split()
MONO_FONTS = "Courier CourierNew Typewriter Mono CMTypewriter CMTT LMMono Inconsolata SourceCode FiraMono RobotoMono DejaVuSansMono UbuntuMono".split()
#: Characters of formulas, and punctuation that may stand inside one.
MATH_CHARS = "∑∂∇√≈≠≤≥±×÷∫∏∀∃∈∉⊂⊃∪∩→⇒⟨⟩‖αβγδεζηθλμπρστφψωΑΒΓΔΕΖΗΘΛΜΠΡΣΤΦΨΩ′″‴∞∝∼≃≅≡∓⊕⊗⊥∧∨¬⊢⊨⟹⟺∘∙·⁻¹²³⁴⁰½⅓"
MATH_PUNCTUATION = "()[]{}.,;:+=-_/*^|\\<>!?~’‘“”´`"
CAPTION = r"(?iu)^(Figure|Fig\.|Table|Tbl\.|Hình|Bảng|Algorithm|Alg\.)\s*\d+"
#: Points, ratios and limits of the layout rules.
EDGE_ZONE, GUTTER_GAP, GUTTER_WIDTH, GUTTER_ZONE, GUTTER_COVER, SLOT = 48, 20, 8.0, (0.3, 0.7), 0.4, 2.0
MIN_BLOCKS_PER_COLUMN, FULL_WIDTH = 3, 0.65
HEADING_RATIOS, HEADING_CHARS, HEADING_LINES = {1: 1.6, 2: 1.35, 3: 1.15}, (3, 200), 3
DEFAULT_BODY, LEAST_BODY = 10.0, 6.0
MATH_CHAR_SHARE, MATH_SHARE, MONO_SHARE = 0.05, 0.75, 0.6
MERGE_GAP, MERGE_OVERLAP, CAPTION_GAP, CAPTION_OVERLAP = 14.0, 0.2, 30, 0.3
LATEX_COLUMNS, CROP_DPI, MATH_DPI, LEAST_CROP = 5, 150, 200, 40 * 40
NO_IMAGE = "[Image could not be extracted]"
OCR_TYPES = ("image", "figure", "math", "algorithm")
BLOCK_SCHEMA = "doc string, page int, ord bigint, bbox struct<x0:double,y0:double,x1:double,y1:double>, block_type string, content string, heading_level int, font_size double, has_inline_math boolean, ocr_mode string, caption string"


def _has_any(font: Column, names: list[str]) -> Column:
    upper = F.upper(F.coalesce(font, F.lit("")))
    out = F.lit(False)
    for name in dict.fromkeys(n.upper() for n in names):
        out = out | upper.contains(name)
    return out


def is_math_font(font: Column) -> Column:
    return _has_any(font, MATH_FONTS)


def is_mono_font(font: Column) -> Column:
    return _has_any(font, MONO_FONTS)


def is_math_span(font: Column, text: Column) -> Column:
    """A formula font, or more than one in twenty characters from a formula."""
    kept = F.length(F.translate(text, MATH_CHARS, ""))
    share = (F.length(text) - kept) > MATH_CHAR_SHARE * F.length(text)
    return is_math_font(font) | ((F.length(T.strip(F.coalesce(text, F.lit("")))) > 0) & share)


def in_edge_zone(y0: Column, y1: Column, height: Column) -> Column:
    return (y1 < EDGE_ZONE) | (y0 > height - EDGE_ZONE)


def font_hierarchy(spans: DataFrame) -> DataFrame:
    """doc, page, body (the size with most characters outside formula fonts; of equal ones the first seen), h1, h2,
    h3.
    """
    size = F.round("size", 1)
    seen = spans.where(~is_math_font(F.col("font"))).select(
        "doc", "page", F.struct("block", "line", "span").alias("at"), size.alias("size"),
        F.length(T.strip(F.col("text"))).alias("n")
    ).where((F.col("size") > 0) & (F.col("n") > 0))
    sums = seen.groupBy("doc", "page", "size").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    body = sums.groupBy("doc", "page").agg(
        F.min_by("size", F.struct(-F.col("n"), F.col("at"))).alias("size")
    ).select("doc", "page", F.greatest("size", F.lit(LEAST_BODY)).alias("body"))
    pages = spans.select("doc", "page").distinct()
    out = pages.join(body, ["doc", "page"], "left").withColumn("body", F.coalesce("body", F.lit(DEFAULT_BODY)))
    return out.withColumns({f"h{k}": F.round(F.col("body") * r, 2) for k, r in HEADING_RATIOS.items()})


def line_text(spans: Column) -> Column:
    """Text of a line: formula spans that stand together become one ``$...$``.

    ``spans`` is an array of structs (text, math, mono) in order.  Inside a group
    short punctuation joins if a formula follows, closing brackets always, and a
    blank span like punctuation; a fixed-width span ends it.
    """
    zero = F.struct(F.lit("").alias("out"), F.lit("").alias("buf"), F.lit(False).alias("open"))
    closed = lambda a: F.when(
        a["open"] & (F.length(T.strip(a["buf"])) > 0), F.concat(a["out"], F.lit("$"), T.strip(a["buf"]), F.lit("$"))
    ).otherwise(a["out"])
    punct = F.lit(
        r"^[" + "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in MATH_PUNCTUATION) + r"]{0,3}$"
    )

    def step(a: Column, s: Column) -> Column:
        bare = T.strip(s["text"])
        joins = s["math"] | (
            a["open"] & (F.regexp_like(bare, F.lit(r"^[)\]}>]{1,3}$")) | (F.regexp_like(bare, punct) & s["next"]))
        )
        joins = joins & ~s["mono"]
        grown = F.struct(
            a["out"].alias("out"), F.concat(a["buf"], s["text"]).alias("buf"), (a["open"] | s["math"]).alias("open")
        )
        flushed = F.struct(
            F.concat(closed(a), s["text"]).alias("out"), F.lit("").alias("buf"), F.lit(False).alias("open")
        )
        return F.when(joins, grown).otherwise(flushed)

    return F.aggregate(spans, zero, step, closed)


def analyze_blocks(spans: DataFrame, fonts: DataFrame) -> DataFrame:
    """One row per text block: block schema with type text, math or algorithm, content, heading level, largest font
    size.
    """
    math, mono = is_math_span(F.col("font"), F.col("text")), is_mono_font(F.col("font"))
    s = spans.repartition("doc", "page").select(
        "*", math.alias("math"), mono.alias("mono"), is_math_font(F.col("font")).alias("math_font"),
        (
            ((F.col("flags").bitwiseAND(16)) != 0) | F.col("font").contains("Bold") | F.col("font").contains("bold")
        ).alias("bold")
    )
    s = s.withColumn(
        "next",
        F.coalesce(
            F.lead("math").over(Window.partitionBy("doc", "page", "block", "line").orderBy("span")), F.lit(False)
        )
    )
    items = F.array_sort(
        F.collect_list(
            F.struct(
                "span", "text", "math", "mono", "next",
                F.when(~F.col("math_font") & ~F.col("mono"), F.col("text")).otherwise("").alias("plain")
            )
        )
    )
    per_line = s.groupBy("doc", "page", "block", "line").agg(
        items.alias("spans"), F.count("*").alias("n"), F.count_if("mono").alias("n_mono"),
        F.count_if(F.col("math") & ~F.col("mono")).alias("n_math"), F.max("size").alias("size"),
        F.max(F.when(~F.col("math_font") & ~F.col("mono"), F.col("size"))).alias("plain_size"),
        F.max(F.col("bold") & ~F.col("math_font") & ~F.col("mono")).alias("bold"),
        *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))],
    )
    texts = per_line.select(
        "*", T.strip(line_text(F.col("spans"))).alias("merged"),
        F.array_join(F.transform("spans", lambda x: x["text"]), " ").alias("spaced"),
        F.array_join(F.transform("spans", lambda x: x["text"]), "").alias("close"),
        F.array_join(F.transform("spans", lambda x: x["plain"]), "").alias("plain")
    ).drop("spans")
    ordered = F.array_sort(F.collect_list(F.struct("line", "merged", "spaced", "close", "plain")))
    b = texts.groupBy("doc", "page", "block").agg(
        ordered.alias("lines"), F.sum("n").alias("n"), F.sum("n_mono").alias("n_mono"), F.sum("n_math").alias("n_math"),
        F.max("size").alias("size"), F.max("plain_size").alias("plain_size"), F.bool_or("bold").alias("bold"),
        *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))],
    )
    kind = F.when(
        F.col("n_mono") / F.col("n") >= MONO_SHARE, "algorithm"
    ).when(F.col("n_math") / F.col("n") >= MATH_SHARE, "math").otherwise("text")
    nonblank = lambda field: F.filter(F.transform("lines", lambda x: x[field]), lambda t: F.length(T.strip(t)) > 0)
    b = b.withColumn("block_type", kind)
    content = F.when(
        F.col("block_type") == "math", F.array_join(F.transform(nonblank("spaced"), T.strip), "\n")
    ).when(
        F.col("block_type") == "algorithm", F.array_join(nonblank("close"), "\n")
    ).otherwise(F.array_join(nonblank("merged"), "\n"))
    b = b.join(fonts, ["doc", "page"])
    plain = T.strip(F.array_join(F.transform("lines", lambda x: x["plain"]), ""))
    level = heading_level(
        plain, F.size("lines"), F.coalesce("plain_size", F.lit(0.0)), F.coalesce("bold", F.lit(False)), F.col("body"),
        F.col("h1"), F.col("h2"), F.col("h3")
    )
    return b.select(
        "doc", "page", F.col("block").cast("bigint").alias("ord"), F.struct("x0", "y0", "x1", "y1").alias("bbox"),
        "block_type", content.alias("content"), level.alias("heading_level"),
        F.when(F.col("size") > 0, F.col("size")).alias("font_size"),
        (
            (F.col("block_type") == "text") & F.exists("lines", lambda x: x["merged"].contains("$"))
        ).alias("has_inline_math"),
        F.col("block_type").alias("ocr_mode"), F.lit("").alias("caption"),
    ).where(F.length(T.strip(F.col("content"))) > 0)


def heading_level(
    plain: Column, n_lines: Column, size: Column, bold: Column, body: Column, h1: Column, h2: Column, h3: Column
) -> Column:
    """Level 1 to 3 of a block of few lines by its largest ordinary font, or bold text of body size; else null."""
    n = F.length(plain)
    fits = (n_lines <= HEADING_LINES) & n.between(*HEADING_CHARS) & ~plain.rlike(r"(?U)^\d+$")
    return F.when(
        fits, F.when(size >= h1, 1).when(size >= h2, 2).when(size >= h3, 3).when(bold & (size >= body) & (n <= 100), 3)
    )


def table_blocks(tables: DataFrame) -> DataFrame:
    """Tables as blocks: Markdown and whether they need a complex reading (five columns and more, or a merged cell
    below the header).
    """
    width = F.size(F.get("cells", F.lit(0)))
    merged = F.exists(
        F.slice("cells", 2, F.greatest(F.size("cells"), F.lit(1))), lambda row: F.exists(row, lambda c: c.isNull())
    )
    t = tables.where((F.size("cells") > 0) & (width > 0))
    return t.select(
        "doc", "page", F.col("ord").cast("bigint").alias("ord"), "bbox", F.lit("table").alias("block_type"),
        T.table_markdown(F.col("cells")).alias("content"), F.lit(None).cast("int").alias("heading_level"),
        F.lit(None).cast("double").alias("font_size"), F.lit(False).alias("has_inline_math"),
        F.when((width >= LATEX_COLUMNS) | merged, "table_complex").otherwise("table_simple").alias("ocr_mode"),
        F.lit("").alias("caption")
    )


def outside_tables(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """Blocks that touch no table of their page (equi-join on the page, inequalities within it)."""
    t = tables.where((F.size("cells") > 0) & (F.size(F.get("cells", F.lit(0))) > 0)).select(
        F.col("doc").alias("_d"), F.col("page").alias("_p"), F.col("bbox").alias("_t")
    )
    b, o = F.col("bbox"), F.col("_t")
    hit = (F.col("doc") == F.col("_d")) & (
        F.col("page") == F.col("_p")
    ) & (b["x0"] < o["x1"]) & (o["x0"] < b["x1"]) & (b["y0"] < o["y1"]) & (o["y0"] < b["y1"])
    return blocks.join(t, hit, "left_anti")


def captioned_images(images: DataFrame, texts: DataFrame) -> DataFrame:
    """Images as blocks; one with a caption just below it (first in ``ord``) is a figure."""
    i = images.select("doc", "page", F.col("ord").cast("bigint").alias("ord"), "bbox")
    t = texts.select(
        "doc", "page", F.col("ord").alias("_o"), F.col("bbox").alias("_t"), T.strip(F.col("content")).alias("_c")
    ).where(F.col("_c").rlike(CAPTION))
    gap = F.col("_t.y0") - F.col("bbox.y1")
    overlap = F.least("bbox.x1", "_t.x1") - F.greatest("bbox.x0", "_t.x0")
    width = F.col("bbox.x1") - F.col("bbox.x0")
    near = i.join(t, ["doc", "page"]).where(
        gap.between(0, CAPTION_GAP) & (width > 0) & (overlap / F.when(width > 0, width) > CAPTION_OVERLAP)
    )
    first = near.groupBy("doc", "page", "ord").agg(F.min_by("_c", "_o").alias("caption"))
    kind = F.when(F.col("caption").isNotNull(), "figure").otherwise("image")
    out = i.join(first, ["doc", "page", "ord"], "left")
    return out.select(
        "doc", "page", "ord", "bbox", kind.alias("block_type"), F.lit("").alias("content"),
        F.lit(None).cast("int").alias("heading_level"), F.lit(None).cast("double").alias("font_size"),
        F.lit(False).alias("has_inline_math"), kind.alias("ocr_mode"), F.coalesce("caption", F.lit("")).alias("caption")
    )


def coverage(boxes: DataFrame, dims: DataFrame) -> DataFrame:
    """Summed heights of the boxes over each 2-point slot of a page: doc, page, slot, covered (0 for slots without a
    box).
    """
    n = F.floor(F.col("width") / SLOT).cast("int") + 1
    slots = dims.where((F.col("width") > 0) & (F.col("height") > 0)).select(
        "doc", "page", "width", "height", F.explode(F.sequence(F.lit(0), n - 1)).alias("slot")
    )
    b = boxes.join(dims.select("doc", "page", n.alias("n")), ["doc", "page"])
    lo, hi = F.greatest(F.lit(0), (F.col("x0") / SLOT).cast("int")), F.least(
        F.col("n") - 1, (F.col("x1") / SLOT).cast("int")
    )
    filled = b.select(
        "doc", "page", F.greatest(F.lit(0.0), F.col("y1") - F.col("y0")).alias("h"), lo.alias("lo"), hi.alias("hi")
    ).where("lo <= hi").select("doc", "page", "h", F.explode(F.sequence("lo", "hi")).alias("slot"))
    sums = filled.groupBy("doc", "page", "slot").agg(F.sum("h").alias("covered"))
    return slots.join(sums, ["doc", "page", "slot"], "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))


def gutters(boxes: DataFrame, dims: DataFrame) -> DataFrame:
    """doc, page, gutter: the middle of the widest run of nearly empty slots in the centre of a page (of equal ones
    the leftmost); pages without one have no row.

    The cover of a page is a step function: each box adds its height at its first
    slot and takes it away after its last, so two rows per box and a running sum
    give what ``coverage`` gives slot by slot.
    """
    n = F.floor(F.col("width") / SLOT).cast("int") + 1
    first, last = F.ceil(GUTTER_ZONE[0] * F.col("width") / SLOT), F.least(
        n - 1, F.floor(GUTTER_ZONE[1] * F.col("width") / SLOT)
    )
    zone = dims.where((F.col("width") > 0) & (F.col("height") > 0)).select(
        "doc", "page", "height", n.alias("n"), first.cast("int").alias("first"), last.cast("int").alias("last")
    ).where("first <= last")
    b = boxes.join(zone, ["doc", "page"])
    lo, hi, h = F.greatest(F.lit(0), (F.col("x0") / SLOT).cast("int")), F.least(
        F.col("n") - 1, (F.col("x1") / SLOT).cast("int")
    ), F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    step = lambda slot, d: F.struct(slot.cast("int").alias("slot"), d.alias("d"))
    # every box also marks the ends of the zone, at no height
    ends = F.array(step(F.col("first"), F.lit(0.0)), step(F.col("last") + 1, F.lit(0.0)))
    steps = F.when(lo <= hi, F.concat(ends, F.array(step(lo, h), step(hi + 1, -h)))).otherwise(ends)
    steps = b.select(
        "doc", "page", "height", "first", "last", F.explode(steps).alias("s")
    ).select("doc", "page", "height", "first", "last", "s.slot", "s.d")
    order = Window.partitionBy("doc", "page").orderBy("slot")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = steps.groupBy("doc", "page", "slot").agg(
        F.sum("d").alias("d"), *[F.max(c).alias(c) for c in ("height", "first", "last")]
    )
    levels = levels.withColumn(
        "free", F.round(F.sum("d").over(upto), 9) < GUTTER_COVER * F.col("height")
    ).withColumn("next", F.lead("slot").over(order)).where("slot >= first AND slot <= last")
    runs = levels.withColumn("run", F.sum((~F.col("free")).cast("int")).over(upto)).where("free").groupBy("doc", "page", "run").agg(
        (F.min("slot") * SLOT).alias("start"), (F.max("next") * SLOT).alias("end")
    )
    runs = runs.withColumn("width", F.col("end") - F.col("start")).where(F.col("width") >= GUTTER_WIDTH)
    return runs.groupBy("doc", "page").agg(
        F.max_by(F.col("start") + F.col("width") / 2, F.struct(F.col("width"), -F.col("start"))).alias("gutter")
    )


def page_layouts(boxes: DataFrame, dims: DataFrame) -> DataFrame:
    """doc, page, layout, gutter of every page of ``dims``: two columns by a gutter, or by three blocks and more at
    either side of the middle.
    """
    body = boxes.join(dims, ["doc", "page"]).where(
        ~in_edge_zone(F.col("y0"), F.col("y1"), F.col("height"))
    ).select("doc", "page", "x0", "y0", "x1", "y1")
    has_text = boxes.select("doc", "page").distinct().withColumn("_text", F.lit(True))
    mid = F.col("width") / 2
    sides = body.join(dims, ["doc", "page"]).groupBy("doc", "page").agg(
        F.count_if(F.col("x1") <= mid - GUTTER_GAP).alias("left"),
        F.count_if(F.col("x0") >= mid + GUTTER_GAP).alias("right")
    )
    # a page whose blocks all lie at its edges has no boxes to search
    found = gutters(body, dims.join(body.select("doc", "page").distinct(), ["doc", "page"], "left_semi"))
    out = dims.join(
        has_text, ["doc", "page"], "left"
    ).join(found, ["doc", "page"], "left").join(sides, ["doc", "page"], "left")
    both = (F.col("left") >= MIN_BLOCKS_PER_COLUMN) & (F.col("right") >= MIN_BLOCKS_PER_COLUMN)
    gutter = F.when(F.col("_text"), F.coalesce("gutter", F.when(both, mid)))
    return out.select("doc", "page", gutter.alias("gutter")).select(
        "doc", "page", F.when(F.col("gutter").isNotNull(), "2-column").otherwise("1-column").alias("layout"), "gutter"
    )


def document_layouts(layouts: DataFrame) -> DataFrame:
    """doc, layout: the vote of pages 2 to 5 (of shorter documents what there is); two columns need more than half."""
    n = layouts.groupBy("doc").agg(F.max("page").alias("n"))
    sampled = n.select(
        "doc",
        F.explode(
            F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.least(i, F.col("n") - 1) + 1))
        ).alias("page")
    )
    votes = layouts.join(sampled, ["doc", "page"]).groupBy("doc").agg(
        F.avg((F.col("layout") == "2-column").cast("double")).alias("share")
    )
    return votes.select("doc", F.when(F.col("share") > 0.5, "2-column").otherwise("1-column").alias("layout"))


def reading_order(blocks: DataFrame, layouts: DataFrame, dims: DataFrame) -> DataFrame:
    """Blocks with ``place`` (from 1) in the reading order of their page.

    One column: rows of 5 points, then left to right.  Two columns: full-width
    blocks and the left column by their tops (full-width first at one height),
    then the right column.  Ties keep ``ord``.
    """
    b = blocks.join(layouts, ["doc", "page"]).join(dims, ["doc", "page"])
    x0, y0, x1 = F.col("bbox.x0"), F.col("bbox.y0"), F.col("bbox.x1")
    split = F.coalesce("gutter", F.col("width") / 2)
    side = F.when(
        x1 - x0 > F.col("width") * FULL_WIDTH, "full"
    ).when(x1 <= split + GUTTER_GAP, "left").when(x0 >= split - GUTTER_GAP, "right").otherwise("full")
    two = F.col("layout") == "2-column"
    key = F.when(
        two,
        F.struct((side == "right").cast("double").alias("a"), y0.alias("b"), (side == "left").cast("double").alias("c"))
    ).otherwise(F.struct((F.bround(y0 / 5) * 5).alias("a"), x0.alias("b"), F.lit(0.0).alias("c")))
    return b.withColumn(
        "place", F.row_number().over(Window.partitionBy("doc", "page").orderBy(key, "ord"))
    ).select(*blocks.columns, "place")


def merge_formulas(blocks: DataFrame) -> DataFrame:
    """Formulas that follow one another closely in a column become one block (gaps and islands over the reading
    order).
    """
    order = Window.partitionBy("doc", "page").orderBy("place")
    before = F.lag(F.struct("block_type", "bbox")).over(order)
    b = blocks.withColumn("_b", before)
    p, q = F.col("_b.bbox"), F.col("bbox")
    width = F.least(p["x1"] - p["x0"], q["x1"] - q["x0"])
    overlap = F.least(p["x1"], q["x1"]) - F.greatest(p["x0"], q["x0"])
    joins = (F.col("block_type") == "math") & (F.col("_b.block_type") == "math") & (q["y0"] - p["y1"] <= MERGE_GAP) & (
        (width <= 0) | (overlap >= MERGE_OVERLAP * width)
    )
    b = b.withColumn(
        "_i",
        F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
    )
    first = lambda c: F.min_by(c, "place").alias(c)
    one = F.count("*") == 1
    content = F.array_join(
        F.filter(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "content"))), lambda x: x["content"]),
            lambda t: F.length(t) > 0
        ),
        "\n"
    )
    box = F.struct(
        *[f(F.col(f"bbox.{c}")).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]
    )
    return b.groupBy("doc", "page", F.col("_i").alias("place")).agg(
        first("ord"), box.alias("bbox"), first("block_type"), content.alias("content"),
        F.when(one, F.min("heading_level")).alias("heading_level"), first("font_size"),
        (one & F.bool_or("has_inline_math")).alias("has_inline_math"), first("ocr_mode"),
        F.when(one, F.min("caption")).otherwise("").alias("caption")
    )


def number_blocks(merged: DataFrame) -> DataFrame:
    """Final blocks: block_id from 0 on each page, crop sizes, what became of images too small to crop, and the blocks
    that need no further reading done.
    """
    dpi = F.when(F.col("block_type") == "math", MATH_DPI).otherwise(CROP_DPI)
    area = F.round(
        (F.col("bbox.x1") - F.col("bbox.x0")) * dpi / 72
    ) * F.round((F.col("bbox.y1") - F.col("bbox.y0")) * dpi / 72)
    b = merged.withColumn("block_id", F.row_number().over(Window.partitionBy("doc", "page").orderBy("place")) - 1)
    b = b.withColumn("has_crop", needs_ocr(F.col("block_type")) & (area >= LEAST_CROP))
    lost = F.col("block_type").isin("image", "figure") & ~F.col("has_crop")
    b = b.withColumn(
        "content", F.when(lost, F.coalesce(F.nullif("caption", F.lit("")), F.lit(NO_IMAGE))).otherwise(F.col("content"))
    ).withColumn("block_type", F.when(lost, "text").otherwise(F.col("block_type")))
    done = ~needs_ocr(F.col("block_type"))
    return b.select(
        "doc", "page", "block_id", "bbox", "block_type", F.col("content").alias("raw_content"), "has_crop",
        "heading_level", "font_size", "has_inline_math", "ocr_mode", "caption", done.alias("is_done"),
        F.when(done, F.col("content")).otherwise("").alias("markdown_result")
    )


def needs_ocr(block_type: Column) -> Column:
    return block_type.isin(*OCR_TYPES)


def box_measures(blocks: DataFrame) -> DataFrame:
    """Blocks with width, height, area and needs_ocr."""
    w, h = F.col("bbox.x1") - F.col("bbox.x0"), F.col("bbox.y1") - F.col("bbox.y0")
    return blocks.withColumns({"width": w, "height": h, "area": w * h, "needs_ocr": needs_ocr(F.col("block_type"))})


def segment_pages(spans: DataFrame, tables: DataFrame, images: DataFrame, dims: DataFrame) -> DataFrame:
    """All pages to numbered blocks: fonts, tables, text, images, reading order, merged formulas, ids."""
    boxes = spans.groupBy("doc", "page", "block").agg(
        F.max(F.length(T.strip(F.col("text")))).alias("n"),
        *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]
    ).where("n > 0")
    layouts = page_layouts(boxes.select("doc", "page", "x0", "y0", "x1", "y1"), dims)
    texts = analyze_blocks(spans, font_hierarchy(spans)).join(dims, ["doc", "page"]).where(
        ~in_edge_zone(F.col("bbox.y0"), F.col("bbox.y1"), F.col("height"))
    ).drop("width", "height")
    texts = outside_tables(texts, tables)
    shown = images.join(dims, ["doc", "page"]).where(
        ~in_edge_zone(F.col("bbox.y0"), F.col("bbox.y1"), F.col("height"))
    ).drop("width", "height")
    # tables come before texts and texts before images at equal places
    kinds = [(table_blocks(tables), 0), (texts, 1), (captioned_images(shown, texts), 2)]
    every = None
    for blocks, kind in kinds:
        blocks = blocks.withColumn("ord", F.lit(kind).cast("bigint") * (1 << 40) + F.col("ord"))
        every = blocks if every is None else every.unionByName(blocks)
    # one shuffle for all that follows; what the union itself says of its partitions does not hold once they are
    # coalesced at run time
    every = every.repartition("doc", "page")
    return number_blocks(merge_formulas(reading_order(every, layouts, dims)))
