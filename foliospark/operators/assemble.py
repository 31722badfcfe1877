"""Assembly of results: block texts, page and document Markdown, metadata, run reports, page chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.layout import OCR_TYPES, needs_ocr
from foliospark.sources.files import size_mb

#: Limits of large files, pages of a chunk, longest image side for reading.
LARGE_MB, LARGE_PAGES, CHUNK_PAGES, IMAGE_SIDE = 5.0, 100, 30, 896
COUNTS = {"text_blocks": "text", "table_blocks": "table", "image_blocks": "image", "math_blocks": "math"}
FAILED = "[OCR Failed"


def crop_name(doc: Column, page: Column, block_id: Column, block_type: Column) -> Column:
    """File of a block's crop, below ``images/``."""
    return F.format_string(
        "images/%s_p%d_b%d_%s.png", F.replace(doc, F.lit(".pdf"), F.lit("")), page, block_id, block_type
    )


def placeholders(blocks: DataFrame) -> DataFrame:
    """Results of a run without reading of images: formulas and images are named by number, all other blocks keep
    their text.
    """
    path = F.when(
        F.col("has_crop") & needs_ocr(F.col("block_type")),
        crop_name(F.col("doc"), F.col("page"), F.col("block_id"), F.col("block_type"))
    )
    shown = F.when(
        F.col("block_type") == "math", F.format_string("$[Formula block #%d]$", F.col("block_id"))
    ).when(
        path.isNotNull(), T.block_image(path, F.col("page"), F.col("block_id"))
    ).otherwise(F.format_string("> [Image block #%d]", F.col("block_id")))
    out = blocks.withColumn("image_rel_path", path)
    result = F.when(needs_ocr(F.col("block_type")), shown).when(
        F.col("is_done"), F.col("markdown_result")
    ).otherwise(F.coalesce("raw_content", F.lit("")))
    return out.withColumn("markdown_result", result).withColumn("is_done", F.lit(True))


def reading_mode(block_type: Column, ocr_mode: Column) -> Column:
    """What a reader of images is asked for: the prompt of the block's type, else of its mode (image by default)."""
    mode = F.when(
        block_type.isin("math", "figure", "algorithm"), block_type
    ).when(block_type == "table", "table_complex").otherwise(F.coalesce(ocr_mode, F.lit("image")))
    return F.when(mode == "text", "math").when(mode == "table_simple", "table_complex").when(
        mode.isin("image", "figure", "math", "table_complex", "algorithm"), mode
    ).otherwise("image")


def apply_readings(blocks: DataFrame, readings: DataFrame, keep_without_crop: bool = False) -> DataFrame:
    """Blocks with the results of an image reader (doc, page, block_id, reading) joined back.

    A missing, empty or failed reading gives a fallback by type.  A block that
    needed one but had no crop ends empty; ``keep_without_crop`` gives it the
    fallback instead.
    """
    b = blocks.join(readings.select("doc", "page", "block_id", "reading"), ["doc", "page", "block_id"], "left")
    path = F.when(F.col("has_crop"), crop_name(F.col("doc"), F.col("page"), F.col("block_id"), F.col("block_type")))
    kind, page, bid = F.col("block_type"), F.col("page"), F.col("block_id")
    failed = F.col("reading").isNull() | (F.col("reading") == "") | F.col("reading").startswith(FAILED)
    fallback = (
        F.when(kind == "math", F.format_string("$$ [Formula p%d #%d] $$", page, bid))
        .when(
            kind == "algorithm",
            F.concat(
                F.format_string("```algorithm\n// [Algorithm p%d #%d]\n", page, bid),
                F.coalesce("raw_content", F.lit("")), F.lit("\n```")
            )
        )
        .when(path.isNotNull(), T.block_image(path, page, bid))
        .otherwise(F.concat(F.lit("> ["), F.initcap(kind), F.format_string(" p%d — OCR Fallback]", page)))
    )
    caption = F.when(
        F.coalesce(F.length("caption"), F.lit(0)) > 0, F.concat(F.lit("\n\n> "), F.col("caption"))
    ).otherwise("")
    good = F.when(
        kind.isin("image", "figure") & path.isNotNull(),
        F.concat(T.block_image(path, page, bid), caption, F.lit("\n\n"), T.strip(F.col("reading")))
    ).otherwise(T.strip(F.col("reading")))
    result = F.when(failed, fallback).otherwise(good)
    if not keep_without_crop:
        result = F.when(F.col("has_crop"), result).otherwise("")
    waiting = needs_ocr(kind) & ~F.col("is_done")
    return b.withColumn("image_rel_path", path).withColumn(
        "markdown_result", F.when(waiting, result).otherwise(F.col("markdown_result"))
    ).withColumn("is_done", F.lit(True)).drop("reading")


def finish_texts(blocks: DataFrame) -> DataFrame:
    """Clean-up of the text and simple table blocks that are not done yet (a pipeline that marks them done earlier
    leaves nothing to do here).
    """
    text = T.heading_prefix(T.clean_text(F.col("raw_content")), F.col("heading_level"))
    table = T.repair_table(F.col("raw_content"))
    is_text, is_table = F.col("block_type") == "text", (F.col("block_type") == "table") & (
        F.col("ocr_mode") == "table_simple"
    )
    made = F.when(is_text, text).when(
        is_table, F.when(table != "", table).otherwise(F.col("raw_content"))
    ).otherwise(F.col("markdown_result"))
    return blocks.withColumn(
        "markdown_result", F.when(F.col("is_done"), F.col("markdown_result")).otherwise(made)
    ).withColumn("is_done", F.col("is_done") | is_text | is_table)


def page_markdown(blocks: DataFrame) -> DataFrame:
    """doc, page, markdown: the stripped, non-blank results of a page's blocks by block_id, an empty line between
    (pages without any have an empty text), and whether a block needed reading.
    """
    items = F.array_sort(
        F.collect_list(F.struct("block_id", T.strip(F.coalesce("markdown_result", F.lit(""))).alias("text")))
    )
    return blocks.groupBy("doc", "page").agg(
        F.array_join(F.filter(F.transform(items, lambda x: x["text"]), lambda t: t != ""), "\n\n").alias("markdown"),
        F.bool_or(needs_ocr(F.col("block_type"))).alias("has_ocr_blocks")
    )


def document_markdown(pages: DataFrame) -> DataFrame:
    """doc, markdown: the non-blank pages with a comment of their number, a rule between.

    One string per document; for documents beyond what a string can hold use
    ``foliospark.sources.sinks.write_markdown``, which streams the pages.
    """
    part = F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n\n"), F.col("markdown"))
    items = F.array_sort(
        F.collect_list(F.when(F.length(T.strip(F.col("markdown"))) > 0, F.struct("page", part.alias("text"))))
    )
    return pages.groupBy("doc").agg(
        F.array_join(F.transform(items, lambda x: x["text"]), "\n\n---\n\n").alias("markdown")
    )


def front_matter(title: Column, source: Column, n_pages: Column, layout: Column) -> Column:
    return F.concat(
        F.lit('---\ntitle: "'), title, F.lit('"\nsource: "'), source, F.lit('"\npages: '), n_pages.cast("string"),
        F.lit('\nlayout: "'), layout, F.lit('"\n---\n')
    )


def stem(doc: Column) -> Column:
    return F.regexp_replace(doc, r"(?<=.)\.[^./]*$", "")


def final_markdown(pages: DataFrame, layouts: DataFrame) -> DataFrame:
    """doc, markdown: front matter, rule, pages."""
    counts = pages.groupBy("doc").agg(F.count("*").alias("n"))
    body = document_markdown(pages).join(counts, "doc").join(layouts.select("doc", "layout"), "doc", "left")
    head = front_matter(stem(F.col("doc")), F.col("doc"), F.col("n"), F.coalesce("layout", F.lit("1-column")))
    return body.select(
        "doc",
        F.concat(
            head, F.when(F.col("markdown") != "", F.concat(F.lit("\n\n---\n\n"), F.col("markdown"))).otherwise("")
        ).alias("markdown")
    )


def block_counts(blocks: DataFrame, keys: tuple[str, ...] = ("doc",)) -> DataFrame:
    """Pages and blocks by type of each document (figures and algorithms only in the total)."""
    of = [F.count_if(F.col("block_type") == t).alias(n) for n, t in COUNTS.items()]
    return blocks.groupBy(*keys).agg(
        F.count_distinct("page").alias("total_pages"), F.count("*").alias("total_blocks"), *of,
        F.lit(0).cast("bigint").alias("ocr_failed")
    )


def metadata_json(counts: DataFrame, layouts: DataFrame, references: DataFrame, sections: DataFrame) -> DataFrame:
    """doc, metadata: one JSON object per document; pages are the keys of its section map."""
    maps = sections.groupBy("doc").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "section")))).alias("section_map")
    )
    m = counts.join(
        layouts.select("doc", "layout"), "doc", "left"
    ).join(references, "doc", "left").join(maps, "doc", "left")
    fields = [
        F.col("doc").alias("doc_name"), "total_pages", "total_blocks", *COUNTS, "ocr_failed", "layout",
        "references_page", F.transform_keys("section_map", lambda k, v: k.cast("string")).alias("section_map")
    ]
    return m.select("doc", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("metadata"))


def run_summary(counts: DataFrame, elapsed_sec: float) -> DataFrame:
    """The run's report as rows: one with the totals (doc_name null), and one for each document.

    Documents stay rows, so the report of a very large run is no single value;
    ``sinks.write_json`` writes a line for each.
    """
    ocr = (F.col("image_blocks") + F.col("math_blocks")).alias("ocr_blocks")
    docs = counts.select(
        F.col("doc").alias("doc_name"), F.lit(None).cast("bigint").alias("total_files"), "total_pages", "total_blocks",
        *COUNTS, "ocr_failed", ocr, F.lit(None).cast("double").alias("elapsed_sec")
    )
    names = ["total_pages", "total_blocks", *COUNTS, "ocr_failed", "ocr_blocks"]
    total = docs.agg(
        F.lit(None).cast("string").alias("doc_name"), F.count("*").alias("total_files"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.lit(round(elapsed_sec, 2)).alias("elapsed_sec")
    )
    return docs.unionByName(total)


def is_large(size_bytes: Column, n_pages: Column) -> Column:
    """A file of 5 MB and more or of 100 pages and more; unknown sizes do not count."""
    return F.coalesce(size_mb(size_bytes) >= LARGE_MB, F.lit(False)) | F.coalesce(n_pages >= LARGE_PAGES, F.lit(False))


def chunk_ranges(files: DataFrame, size: int = CHUNK_PAGES) -> DataFrame:
    """Page ranges of ``size`` of each file (name, pages): name, chunk_no (from 1), first_page, last_page, chunk_name;
    a file without pages has none.
    """
    n = F.ceil(F.col("pages") / size).cast("int")
    rows = files.where(F.col("pages") > 0).select("name", "pages", F.explode(F.sequence(F.lit(1), n)).alias("chunk_no"))
    first, last = (F.col("chunk_no") - 1) * size + 1, F.least(F.col("chunk_no") * size, F.col("pages"))
    out = rows.select("name", "chunk_no", first.cast("int").alias("first_page"), last.cast("int").alias("last_page"))
    return out.withColumn(
        "chunk_name",
        F.format_string("%s_chunk_%03d_p%d-%d", stem(F.col("name")), "chunk_no", "first_page", "last_page")
    )


def merge_chunks(chunks: DataFrame, generator: str = "MinerU PDF2Markdown Pipeline") -> DataFrame:
    """name, markdown of chunk texts (name, path, content null where missing): two comments, then the stripped texts
    by path as strings; after the first place an empty line goes before each.
    """
    ordered = F.array_sort(
        F.collect_list(
            F.struct("path", F.col("content").isNull().alias("gone"), F.coalesce("content", F.lit("")).alias("content"))
        )
    )
    texts = F.transform(
        ordered,
        lambda c, i: F.when(c["gone"], F.lit("")).otherwise(
            F.concat(F.when(i > 0, "\n\n").otherwise(""), T.strip(c["content"]), F.lit("\n"))
        )
    )
    head = F.concat(F.lit("<!-- Source: "), F.col("name"), F.lit(f" -->\n<!-- Generated by {generator} -->\n\n"))
    return chunks.groupBy("name").agg(F.array_join(texts, "").alias("_t")).select(
        "name", F.concat(head, F.col("_t")).alias("markdown")
    )


def chunk_image_name(chunk_no: Column, name: Column) -> Column:
    return F.format_string("chunk%03d_%s", chunk_no, name)


def plan_files(
    files: DataFrame, skip: list[str] | None = None, only: str | None = None, contains: str | None = None,
    resume: bool = False
) -> DataFrame:
    """Files (name, size_bytes, pages, output_size) to convert, by name, with ``route`` (normal, chunked) and
    ``status`` (null, or skipped where ``resume`` finds an output that is not empty).

    ``only`` is an exact name (the skip list does not apply to it), ``contains`` a part of the name in any case.
    """
    out = files
    if only is not None:
        out = out.where(F.col("name") == only)
    elif skip:
        out = out.where(~F.col("name").isin(*skip))
    if contains is not None:
        out = out.where(F.contains(F.lower("name"), F.lit(contains.lower())))
    done = F.coalesce(F.col("output_size") > 0, F.lit(False)) if resume else F.lit(False)
    return out.withColumn(
        "route", F.when(is_large(F.col("size_bytes"), F.col("pages")), "chunked").otherwise("normal")
    ).withColumn("status", F.when(done, "skipped")).orderBy("name")


def status_rollup(results: DataFrame) -> DataFrame:
    """status, n (files of that status), name: a row for each file (name, status), in order of status and name.

    The counts are combined map-side and joined back (a row per status), and the
    order is a range sort, so no status is a single task's group.
    """
    n = results.groupBy("status").agg(F.count("*").alias("n"))
    mine = results.select(F.col("status").alias("_s"), "name")
    return mine.join(
        F.broadcast(n), F.col("_s").eqNullSafe(F.col("status"))
    ).select("status", "n", "name").orderBy("status", "name")


def resized(width: Column, height: Column, side: int = IMAGE_SIDE) -> tuple[Column, Column]:
    """Width and height of an image whose longer side is at most ``side``; the other is cut to whole pixels."""
    fits, wide = F.greatest(width, height) <= side, width >= height
    return (
        F.when(fits, width).when(wide, F.lit(side)).otherwise(F.floor(width * side / height).cast("int")),
        F.when(fits, height).when(wide, F.floor(height * side / width).cast("int")).otherwise(F.lit(side)),
    )
