"""Clean-up of page texts: repeated lines, hyphenation, paragraphs, references, section paths.

Input is ``pages`` (doc, page, markdown).  Text work stays on the page's row;
only short lines and headings are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.scale import carry
from foliospark.operators import layout

#: Headings of the list of references.
REFERENCES = (
    r"(?mdU)^#+\s*(References|REFERENCES)\s*$", r"(?mdU)^\s*(References|REFERENCES)\s*$",
    r"(?mdU)^\s*(Bibliography|BIBLIOGRAPHY)\s*$",
    r"(?mdU)^\s*TÀI LIỆU THAM KHẢO\s*$", r"(?imdU)^\s*References and Further Reading\s*$",
)
REFERENCES_MARK = "<!-- references section -->"
SEPARATOR = " > "


def edge_candidates(markdown: Column) -> Column:
    """The first two and last two non-blank lines of a page (a short page gives a line twice), as far as they could be
    heads: 4 to 80 characters, at most ten words.
    """
    kept = F.filter(F.transform(T.lines(T.strip(F.coalesce(markdown, F.lit("")))), T.strip), lambda x: x != "")
    ends = F.concat(F.slice(kept, 1, 2), F.when(F.size(kept) <= 2, kept).otherwise(F.slice(kept, -2, 2)))
    return F.filter(ends, lambda x: F.length(x).between(4, 80) & (F.size(T.word_tokens(x)) <= 10))


def repeated_lines(pages: DataFrame, least: int = 4) -> DataFrame:
    """doc, line, n: lines that stand ``least`` times and more at the edges of a document's pages.

    Counted by partial aggregation on (doc, line): a document with a third of
    the pages is spread over its lines.
    """
    lines = pages.select("doc", F.explode(edge_candidates(F.col("markdown"))).alias("line"))
    return lines.groupBy("doc", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def drop_repeated(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """Pages without the repeated lines of their document (few short strings for each document, Spark chooses the join
    by their size); a document without any keeps its text as it is.
    """
    sets = repeated.groupBy("doc").agg(F.collect_set("line").alias("_r"))
    kept = F.array_join(F.filter(T.lines(F.col("markdown")), lambda x: ~F.array_contains("_r", T.strip(x))), "\n")
    return pages.join(sets, "doc", "left").withColumn(
        "markdown", F.when(F.col("_r").isNull(), F.col("markdown")).otherwise(kept)
    ).drop("_r")


def clean_pages(pages: DataFrame, least: int = 4) -> DataFrame:
    """Pages after all clean-up: repeated lines, hyphens, split paragraphs, white space."""
    out = drop_repeated(pages, repeated_lines(pages, least))
    return out.withColumn("markdown", T.normalize_space(T.merge_split_paragraphs(T.repair_hyphens(F.col("markdown")))))


def is_references(markdown: Column) -> Column:
    out = F.lit(False)
    for pattern in REFERENCES:
        out = out | markdown.rlike(pattern)
    return out


def references_pages(pages: DataFrame) -> DataFrame:
    """doc, references_page: the last page with a heading of references (null where there is none)."""
    return pages.groupBy("doc").agg(
        F.max(F.when(is_references(F.col("markdown")), F.col("page"))).alias("references_page")
    )


def section_paths(headings: DataFrame, levels: int = 10, width: int = 1 << 24) -> DataFrame:
    """Headings (doc, ord, level, title, page) with ``path``: the titles of the open headings, outermost first.

    A heading closes all of its own and deeper levels.  A level is open where its
    last heading came after the last heading of every outer level, so the path
    needs the last heading of each level up to the row, and no stack; these are
    carried over ranges of ``ord`` of the given ``width``, so a very long document
    is many tasks.  Levels beyond ``levels`` count as the deepest.
    """
    h = headings.withColumn("_l", F.least(F.greatest(F.col("level"), F.lit(1)), F.lit(levels)))
    h = carry(
        h, {f"_o{k}": F.when(F.col("_l") == k, F.struct("ord", "title")) for k in range(1, levels + 1)}, ("doc",),
        "ord", width
    )
    parts = []
    for k in range(1, levels + 1):
        outer = F.greatest(
            *[F.coalesce(F.col(f"_o{j}.ord"), F.lit(-1)) for j in range(1, k)], F.lit(-1), F.lit(-1)
        ) if k > 1 else F.lit(-1)
        open_ = (F.lit(k) <= F.col("_l")) & F.col(f"_o{k}.ord").isNotNull() & (F.col(f"_o{k}.ord") > outer)
        parts.append(F.when(open_, F.col(f"_o{k}.title")))
    path = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), SEPARATOR)
    return h.withColumn("path", path).drop("_l", *[f"_o{k}" for k in range(1, levels + 1)])


def font_headings(spans: DataFrame, page_limit: int = 10) -> DataFrame:
    """Headings by font where a document has no outline: doc, ord, level, title, page.

    The body size of the document is that of most characters on its first pages
    (formula fonts count); a block of up to three lines above it is a heading, a
    bold one of body size one of level 3.
    """
    sizes = spans.where(F.col("page") <= page_limit).select(
        "doc", F.struct("page", "block", "line", "span").alias("at"), F.round("size", 1).alias("size"),
        F.length(T.strip(F.col("text"))).alias("n")
    ).where((F.col("size") > 0) & (F.col("n") > 0))
    sums = sizes.groupBy("doc", "size").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    body = sums.groupBy("doc").agg(
        F.greatest(F.min_by("size", F.struct(-F.col("n"), F.col("at"))), F.lit(layout.LEAST_BODY)).alias("body")
    )
    bold = (F.col("flags").bitwiseAND(16) != 0) | F.col("font").contains("Bold")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("line", "span", "text"))), lambda x: x["text"])
    blocks = spans.groupBy("doc", "page", "block").agg(
        F.count_distinct("line").alias("lines"), T.strip(F.array_join(texts, "")).alias("title"),
        F.max("size").alias("size"), F.bool_or(bold).alias("bold")
    )
    b = blocks.join(body, "doc").where(
        (
            F.col("lines") <= layout.HEADING_LINES
        ) & F.length("title").between(*layout.HEADING_CHARS) & ~F.col("title").rlike(r"(?U)^\d+$")
    )
    ratio = layout.HEADING_RATIOS
    level = F.when(F.col("size") >= F.col("body") * ratio[1], 1).when(F.col("size") >= F.col("body") * ratio[2], 2).when(
        (F.col("size") >= F.col("body") * ratio[3]) | (F.col("bold") & (F.col("size") >= F.col("body"))), 3
    )
    ord_ = F.col("page").cast("bigint") * (1 << 32) + F.col("block").cast("bigint")
    return b.select("doc", ord_.alias("ord"), level.alias("level"), "title", "page").where(F.col("level").isNotNull())


def section_map(pages: DataFrame, headings: DataFrame, width: int = 1024) -> DataFrame:
    """doc, page, section: path of the last heading on the page, else that of the pages before, else empty; carried
    over ranges of ``width`` pages.
    """
    last = section_paths(headings).groupBy("doc", "page").agg(F.max_by("path", "ord").alias("path"))
    filled = carry(
        pages.select("doc", "page").join(last, ["doc", "page"], "left"), {"section": F.col("path")}, ("doc",), "page",
        width
    )
    return filled.select("doc", "page", F.coalesce("section", F.lit("")).alias("section"))


def mark_sections(pages: DataFrame, sections: DataFrame, references: DataFrame, width: int = 1024) -> DataFrame:
    """Pages with comments on top: the section where it changes (a first page's if it has one), then the references
    from their page on.
    """
    changed = carry(sections, {"_before": F.col("section")}, ("doc",), "page", width, current=False)
    changed = changed.withColumn(
        "_new", (F.col("section") != "") & ~F.col("section").eqNullSafe(F.col("_before"))
    ).drop("_before")
    out = pages.join(changed, ["doc", "page"], "left").join(references, "doc", "left")
    marked = F.when(
        F.col("page") >= F.col("references_page"), F.concat(F.lit(REFERENCES_MARK + "\n\n"), F.col("markdown"))
    ).otherwise(F.col("markdown"))
    marked = F.when(
        F.col("_new"), F.concat(F.lit("<!-- section: "), F.col("section"), F.lit(" -->\n\n"), marked)
    ).otherwise(marked)
    return out.withColumn("markdown", marked).select(*pages.columns)


def postprocess(pages: DataFrame, headings: DataFrame, least: int = 4) -> DataFrame:
    """Raw page texts to final ones; repeated lines and references are found on the raw text."""
    return mark_sections(clean_pages(pages, least), section_map(pages, headings), references_pages(pages))
