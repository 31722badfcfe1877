"""Repair of text from scanned pages: running heads, page numbers, hyphenation over line ends, wrongly read characters.

* Heads and page numbers: the lines at the edges of a page are masked (numbers
  dropped, look-alike glyphs folded to one skeleton); a masked line that returns
  on enough pages of its document is a head or foot, a number that keeps its
  distance to the page's place is the page number.
* Wrongly read characters: the words of the corpus are grouped by the skeleton
  of their glyphs; a rare form gives way to a frequent form of its group where
  a neighbour in the text is a frequent word too.
* Hyphenation: the joined word, or the compound, that the corpus knows better decides.
* Reflow: windows over the lines of a block number its paragraphs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.scale import broadcast_if, cut
from foliospark.functions.text import WHITE

#: Vietnamese letters with marks, their base letters, and what is left of them where small marks are
#: lost: the tone (a hook reads like an acute).
MARKED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
BASE = "a" * 17 + "e" * 11 + "i" * 5 + "o" * 17 + "u" * 11 + "y" * 5 + "d"
TONED = "àááãạ" + "aàááãạ" * 2 + "èééẽẹ" + "eèééẽẹ" + "ìííĩị" + "òóóõọ" + "oòóóõọ" * 2 + "ùúúũụ" + "uùúúũụ" + "ỳýýỹỵ" + "d"
#: Glyphs that are read for each other, by their class.
GLYPHS, CLASSES = "0o1il!|5s9gq6b8hce", "ooLLLLLssgggbbbbcc"
#: Letters that are read as two others.
DOUBLES = (("m", "rn"), ("d", "cL"), ("w", "vv"), ("u", "LL"))
HYPHENS = "-‐‑¬\xad"
#: A printed word: letters and digits, possibly with hyphens inside, in plain punctuation.
PLAIN = r"^[(\[\"'“‘–—]*+([\p{L}\p{N}]++(?:[-‐][\p{L}\p{N}]++)*+)[)\]\"'”’.,;:!?…–—]*+$"
#: Characters inside words that are not seen; words are looked at without them.
UNSEEN = "\u200b\u200c\u200d\u2060\ufeff"
TEXT_TYPES = ("text", "unknown")
ROMAN = "ivxlcdm"
#: Marks that Markdown sets before headings and list items.
BULLETS = "•◦▪‣*+"
#: So many tokens can be looked for by a list in the plan; more are joined.
LISTED = 1000
#: Longer lines are masked before they are shuffled.
LONG_LINE = 200


@dataclass(frozen=True)
class Settings:
    """What counts as frequent, rare and returning."""

    #: A frequent form stands in at least this share of the blocks, and in at least ``frequent_least`` of them.
    frequent_share: float = 0.001
    frequent_least: int = 4
    #: It stands in this many times the blocks of the rare form: of one with a digit in it, and of others, which may
    #: be words of their own.  A small count says little, so of ``n`` blocks of the latter only ``n - doubt *
    #: sqrt(n)`` are held against them.
    times: float = 8.0
    times_letters: float = 50.0
    doubt: float = 0.75
    #: It stands so often in lower case (names and codes do not).
    lower_share: float = 0.3
    #: A head returns on this share of the document's pages (left and right pages may have their own), two pages at
    #: least; or, as a chapter's head, on so many pages and on this share of those from its first to its last.
    #: A line that begins in a small letter may be a sentence that goes on: it needs so many pages in any case.
    head_share: float = 0.28
    head_run: int = 6
    #: Lines at each edge of a page that can be heads and page numbers.
    edge_lines: int = 2
    #: Most frequent tokens that every task keeps to pass by the bulk of the text: at most this many short strings
    #: (about 1 MB); rarer ones are joined by shuffle.
    passed_tokens: int = 20_000
    #: Of these the first get no row at all.
    skipped_tokens: int = 1000
    #: Parts that a document's heads are spread over in joins.
    salts: int = 16


def skeleton(word: Column) -> Column:
    """Glyph skeleton of a lower-case word: words that are read for each other have the same."""
    out = F.translate(F.translate(word, MARKED, TONED), GLYPHS, CLASSES)
    for one, two in DOUBLES:
        out = F.replace(out, F.lit(one), F.lit(two))
    return out


def _marks(text: Column) -> Column:
    return F.translate(text, MARKED.upper() + MARKED, BASE + BASE)


def _features(line: Column) -> Column:
    """What the search for heads needs of a line: value, style and marked as a page number, ``key`` (hash of the
    masked line), whether it can be a head at all (``fit``) and whether it may be a sentence that goes on (``small``).
    """
    value, style, marked = _number(line)
    letters = F.regexp_replace(
        F.regexp_replace(_marks(F.lower(line)), r"(?<!\S)[^\p{L}\s]+(?!\S)", " "), r"[^\p{L}\p{N}]+", ""
    )
    numbers = F.size(F.regexp_extract_all(line, F.lit(r"(?<!\S)[^\p{L}\s]*\p{N}[^\p{L}\s]*(?!\S)"), F.lit(0)))
    fit = (F.length(letters) >= 4) & (numbers <= 1) & ~line.rlike(
        r"^\s*(?:[•◦▪*+‣]|[-–]\s|\(?(?:\d{1,3}|[A-Za-z])[.)]\s|#)"
    ) & ~line.rlike(r"[.,;:!?-]\s*$") & ~line.rlike(r"\t|\|.*\|")
    return F.struct(
        value.alias("value"), style.alias("style"), marked.alias("marked"), F.xxhash64(skeleton(letters)).alias("key"),
        fit.alias("fit"), (line.rlike(r"^\p{Ll}") & (F.length(line) > 14)).alias("small")
    )


def edge_lines(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The non-blank lines nearest to the top (zone T) and bottom (zone B) of each page, with their ``place`` from the
    edge and their features.

    Of each block only its first (last) lines can be the page's, and of the blocks
    that a task has of a page only its first (last) lines reach the shuffle (the
    rank is limited before it).  A long line travels as its features.  A repeated
    delivery has the same places.
    """
    k = settings.edge_lines
    numbered = F.filter(
        F.transform(
            F.split("raw_content", "\n"), lambda x, i: F.struct((i + 1).alias("line_no"), F.trim(x).alias("line"))
        ),
        lambda x: x["line"] != ""
    )
    own = blocks.select("doc", "page", "block_id", "block_uid", "block_type", "heading_level", numbered.alias("lines"))
    part = lambda zone, sign, lines: F.transform(
        lines,
        lambda x: F.struct(
            F.lit(zone).alias("zone"), (F.col("block_id") * sign).alias("b"), (x["line_no"] * sign).alias("l"),
            x["line_no"].alias("line_no"), x["line"].alias("line")
        )
    )
    ends = F.concat(
        part("T", 1, F.slice("lines", 1, k)),
        part("B", -1, F.slice("lines", F.greatest(F.size("lines") - k + 1, F.lit(1)), k))
    )
    lines = own.select(
        "doc", "page", "block_uid", "block_type", "heading_level",
        F.explode(F.when(F.size("lines") > 0, ends)).alias("e")
    )
    long = F.length("e.line") > LONG_LINE
    lines = lines.select(
        "doc", "page", "e.zone", "e.b", "e.l", "block_uid", "block_type", "heading_level", "e.line_no",
        F.when(~long, F.col("e.line")).alias("line"), F.when(long, _features(F.col("e.line"))).alias("long")
    )
    ranked = lines.withColumn(
        "place", F.dense_rank().over(Window.partitionBy("doc", "page", "zone").orderBy("b", "l"))
    ).where(F.col("place") <= k)
    return ranked.select(
        "doc", "page", "block_uid", "block_type", "heading_level", "line_no", "zone", "place",
        F.coalesce("long", _features(F.col("line"))).alias("f")
    ).select("doc", "page", "block_uid", "block_type", "heading_level", "line_no", "zone", "place", "f.*")


def _number(line: Column) -> tuple[Column, Column, Column]:
    """Of a line that is only a printed page number: its value (null if none), its style, and whether it is marked as
    one.
    """
    low = F.lower(F.trim(line))
    fmt = r"^[\[(|{<~*·•\-–—_=.\s]*(?:(trang|page|pages|pg|pag|tr|p|seite|sheet)[.:\s]*)?(\d{1,5}|[" + ROMAN + r"]{1,7}|[0-9olisgbq]{1,4})(\s*(?:/|of|trên|von)\s*\d{1,5})?[\])|}>~*·•\-–—_=.\s]*$"
    prefix, digits, total = (F.regexp_extract(low, fmt, i) for i in (1, 2, 3))
    folded = F.translate(digits, "olisgbq", "0115969")
    roman = None
    for letters, value in (("m", 1000), ("d", 500), ("c", 100), ("l", 50), ("x", 10), ("v", 5), ("i", 1)):
        term = (F.length(digits) - F.length(F.replace(digits, F.lit(letters), F.lit("")))) * value
        roman = term if roman is None else roman + term
    for pair, less in (("iv", 2), ("ix", 2), ("xl", 20), ("xc", 20), ("cd", 200), ("cm", 200)):
        roman = roman - F.when(digits.contains(pair), less).otherwise(0)
    is_roman = digits.rlike(f"^[{ROMAN}]+$") & (total == "")
    value = F.when(digits == "", None).when(is_roman, roman).when(folded.rlike(r"^\d+$"), folded.try_cast("int"))
    # letters alone are a number only where something else says so
    value = F.when(digits.rlike(r"\d") | is_roman | (prefix != "") | (total != ""), value)
    style = F.concat(F.when(is_roman, "r").otherwise("d"), F.when(prefix != "", "p").otherwise(""))
    marked = (prefix != "") | low.rlike(r"^[\[(|{<~*·•\-–—_=].*[\])|}>~*·•\-–—_=]$")
    return value, style, marked


def heads_and_numbers(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """block_uid, line_no, kind (``running_head``, ``page_no``) of each such line."""
    edges = edge_lines(blocks, settings).withColumn("salt", F.pmod("page", F.lit(settings.salts)))
    edges = cut(edges)  # a few narrow rows per page, used four times
    own = F.col("heading_level").isNull() & F.col("block_type").isin(*TEXT_TYPES)
    # one row for each doc, zone and masked line of a page, then counted over pages
    keyed = edges.where(F.col("fit") & (own | (F.col("heading_level") == 1)))
    by_page = keyed.groupBy("doc", "zone", "key", "page").agg(
        F.max(F.col("heading_level").isNull()).alias("own"), F.min("small").alias("small")
    )
    counted = by_page.groupBy("doc", "zone", "key").agg(
        F.count_if("own").alias("n"), F.count_if(~F.col("own")).alias("titles"),
        (F.max("page") - F.min("page") + 1).alias("span"), F.min("small").alias("small")
    )
    # a heading of the first level above may name what later pages repeat
    pages = edges.select("doc", "page").distinct().groupBy("doc").agg(F.count("*").alias("pages"))
    enough = ~F.col("small") | (F.col("n") >= settings.head_run)
    everywhere_ = (F.col("n") >= 2) & (F.col("n") >= settings.head_share * (F.col("pages") - 1))
    chapter = (F.col("n") >= settings.head_run) & (F.col("n") >= settings.head_share * F.col("span"))
    heads = counted.where(F.col("n") > 0).join(pages, "doc").where(enough).where(
        everywhere_ | chapter | (
            (F.col("titles") >= 1) & (F.col("n") >= 1) & ((F.col("pages") <= 5) | (F.col("n") >= 2))
        )
    )
    everywhere = F.explode(F.array(*[F.lit(i) for i in range(settings.salts)])).alias("salt")
    head_rows = edges.where(F.col("fit") & own & F.col("value").isNull()).join(
        heads.select("doc", "zone", "key", everywhere), ["doc", "zone", "key", "salt"], "left_semi"
    ).select("block_uid", "line_no", F.lit("running_head").alias("kind"))
    numbered = edges.where(F.col("value").isNotNull() & own).withColumn("offset", F.col("value") - F.col("page"))
    series = numbered.groupBy("doc", "style", "offset", "page").agg(F.max("marked").alias("marked")).groupBy("doc", "style", "offset").agg(
        F.count("*").alias("n"), F.max("marked").alias("marked")
    )
    series = series.join(pages, "doc").where(
        (F.col("n") >= 2) & (F.col("n") >= 0.2 * (F.col("pages") - 1)) | F.col("marked") & (F.col("pages") <= 3)
    )
    number_rows = numbered.join(
        series.select("doc", "style", "offset", everywhere), ["doc", "style", "offset", "salt"], "left_semi"
    ).select("block_uid", "line_no", F.lit("page_no").alias("kind"))
    return head_rows.unionByName(number_rows).distinct()


def tokens(blocks: DataFrame) -> DataFrame:
    """Tokens between blanks of the corpus: token, n (blocks it stands in; a repeated delivery counts again).

    The distinct tokens of a block are counted by partial aggregation, so a
    frequent word is no hot key; all further work on words is done once per
    distinct token.  The token ``''`` counts the blocks.
    """
    found = F.array_distinct(F.split(F.concat(F.lit(" "), F.translate("raw_content", "\n\t\r" + UNSEEN, "   ")), " "))
    each = blocks.where(F.col("raw_content").isNotNull()).select(F.explode(found).alias("token"))
    return each.groupBy("token").agg(F.count("*").alias("n"))


def words(known_tokens: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Words and compounds: form (lower case), n, key (skeleton), frequent (whether it is a frequent form)."""
    core = F.regexp_extract("token", PLAIN, 1)
    cores = known_tokens.select(core.alias("core"), "n").where(F.col("core").rlike(r"\p{L}"))
    parts = F.when(
        F.col("core").contains("-"), F.concat(F.array("core"), F.split("core", "-"))
    ).otherwise(F.array("core"))
    each = cores.select(F.explode(parts).alias("w"), "n")
    counts = each.groupBy(F.lower("w").alias("form")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("w") == F.lower("w"), F.col("n")).otherwise(0)).alias("n_lower")
    )
    total = known_tokens.where(F.col("token") == "").agg(F.max("n").alias("n")).first()["n"] or 0  # one number
    least = max(settings.frequent_least, settings.frequent_share * total)
    frequent = (F.col("n") >= least) & F.col("form").rlike(r"^\p{L}{2,}$") & (
        F.col("n_lower") >= settings.lower_share * F.col("n")
    )
    return counts.select("form", "n", skeleton(F.col("form")).alias("key"), frequent.alias("frequent"))


def corrections(known: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """wrong, right, n_right: each rare form of two characters and more (one character alone has no readable rest)
    with the frequent forms of its glyph group.

    The frequent forms are a bounded list (``words``), broadcast after a look at its size.
    """
    rare = known.where(
        F.col("form").rlike(r"^[\p{L}\p{N}]{2,}$") & ~F.col("form").rlike(r"^\p{N}+$")
    ).select(F.col("form").alias("wrong"), F.col("n").alias("n_wrong"), "key")
    pairs = rare.join(
        broadcast_if(known.where("frequent").select(F.col("form").alias("right"), F.col("n").alias("n_right"), "key")),
        "key"
    )
    against = F.col("n_wrong") - settings.doubt * F.sqrt("n_wrong")
    least = F.greatest(
        settings.times * F.col("n_wrong"),
        F.when(F.col("wrong").rlike(r"\d"), 0.0).otherwise(settings.times_letters * against)
    )
    return pairs.where(
        (F.col("wrong") != F.col("right")) & (F.col("n_right") >= least)
    ).select("wrong", "right", "n_right")


def wrong_tokens(known_tokens: DataFrame, fixes: DataFrame) -> DataFrame:
    """token, wrong, right, n_right: the corpus's tokens with a form to correct (a token with a hyphen at its end is
    half a word and has none).
    """
    core = F.regexp_extract("token", PLAIN, 1)
    parts = known_tokens.select("token", F.explode(F.split(core, "-")).alias("w")).where(
        F.col("w").rlike(r"\p{L}") & ~F.col("w").rlike(r"^\p{Lu}+\d+$|^\p{L}\d$")
    )
    return parts.select(
        "token", F.lower("w").alias("wrong")
    ).join(fixes, "wrong").select("token", "wrong", "right", "n_right")


def token_neighbours(blocks: DataFrame, skip: list[str] | None = None, only: list[str] | None = None) -> DataFrame:
    """block_uid, line_no, place (of the token in its line, from 0), token, and the tokens before and after it in the
    block's text, over line ends.  Tokens to ``skip``, or all but those in ``only``, get no row (short lists: they are
    part of the plan).
    """
    clean = F.translate("raw_content", "\t\r" + UNSEEN, "  ")
    lines = F.transform(
        F.split(clean, "\n"),
        lambda line, i: F.transform(
            F.filter(F.split(line, " "), lambda x: x != ""),
            lambda x, j: F.struct((i + 1).alias("line_no"), j.alias("place"), x.alias("token"))
        )
    )
    texts = blocks.where(
        F.col("block_type").isin(*TEXT_TYPES) & F.col("raw_content").isNotNull()
    ).select("block_uid", F.flatten(lines).alias("t"))
    at = F.when(F.size("t") > 0, F.sequence(F.lit(0), F.size("t") - 1))
    if skip:
        at = F.filter(at, lambda i: ~F.get("t", i)["token"].isin(*skip))
    if only is not None:
        at = F.filter(at, lambda i: F.get("t", i)["token"].isin(*only))
    beside = F.transform(
        at,
        lambda i: F.struct(
            F.get("t", i)["line_no"].alias("line_no"), F.get("t", i)["place"].alias("place"),
            F.get("t", i)["token"].alias("token"), F.get("t", i - 1)["token"].alias("before"),
            F.get("t", i + 1)["token"].alias("after")
        )
    )
    return texts.select("block_uid", F.explode(beside).alias("s")).select("block_uid", "s.*")


def misread_words(
    blocks: DataFrame, known_tokens: DataFrame, known: DataFrame, wrong: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """block_uid, line_no, place (of the token in its line), token, wrong, right, n_right, before, after of every
    wrongly read word with a frequent word beside it.

    The most frequent tokens (a bounded list that every task keeps) are passed by
    where the text is; only the others are joined with the tokens to correct.  A
    neighbour that is a frequent word supports the reading (those are a bounded
    list too); neighbours that are none are looked up among the wrongly read
    forms, which are rare, so no frequent neighbour is a join key.  A word without
    neighbours has no support.
    """
    passed = known_tokens.where(F.col("n") >= settings.frequent_least).orderBy(F.desc("n"), "token").limit(
        settings.passed_tokens
    ).select("token", "n").join(wrong.select("token"), "token", "left_anti")
    passed = cut(passed)
    first = [r["token"] for r in passed.orderBy(F.desc("n"), "token").limit(settings.skipped_tokens).collect()]
    odd = token_neighbours(blocks, skip=first).join(F.broadcast(passed.select("token")), "token", "left_anti")
    hits = odd.join(wrong, "token")
    near = hits.select("*", F.explode(F.array("before", "after")).alias("x")).select(
        "*", F.lower(F.regexp_extract("x", PLAIN, 1)).alias("form")
    ).drop("x").where("form <> ''")
    frequent = broadcast_if(known.where("frequent").select("form"))
    near = near.join(frequent.withColumn("known", F.lit(True)), "form", "left")
    by_misread = near.where("known IS NULL").join(
        wrong.select(F.col("wrong").alias("form")).distinct(), "form", "left_semi"
    )
    return near.where("known").unionByName(by_misread).drop("form", "known").distinct()


def line_halves(blocks: DataFrame, settings: Settings = Settings(), with_moved: bool = False) -> DataFrame:
    """Of each block of text what hyphenation needs: ``halves`` (lines that end in a hyphen: line_no, left, sign, and
    the openings of the lines after) and ``first`` (the openings of its first lines), a repeated delivery once.

    Noise lies in the ``edge_lines`` at the top and bottom of a page, so one more
    line than those always holds the next one of the text, if there is any; a line
    that is not among those of its block is no noise, so it is the next one alone.
    ``with_moved`` adds all that stands before the first blank of a line.
    """
    k = settings.edge_lines
    after = 2 * k + 1
    texts = blocks.where(F.col("block_type").isin(*TEXT_TYPES) & F.col("raw_content").isNotNull())
    opening = r"^([\p{L}\p{N}]++(?:-[\p{L}\p{N}]++)*+)"
    numbered = F.filter(
        F.transform(
            F.split("raw_content", "\n"),
            lambda x, i: F.struct((i + 1).alias("line_no"), F.trim(F.translate(x, "\t\r" + UNSEEN, "  ")).alias("line"))
        ),
        lambda x: x["line"] != ""
    )
    lines = texts.select(
        "doc", "page", "block_id", "block_uid", F.col("heading_level").isNotNull().alias("heading"),
        numbered.alias("lines")
    )
    opened = lambda part: F.transform(
        part,
        lambda x: F.struct(
            x["line_no"].alias("line_no"), F.regexp_extract(x["line"], opening, 1).alias("right"),
            (F.split(x["line"], " ", 2)[0] if with_moved else F.lit(None).cast("string")).alias("moved")
        )
    )
    many = lambda i: F.when((i + 1 >= k) & (i + 1 < F.size("lines") - k), 1).otherwise(after)
    ends = F.filter(
        F.transform(
            "lines", lambda x, i: F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), i.alias("i"))
        ),
        lambda x: F.substring(x["line"], -1, 1).isin(*HYPHENS)
    )
    left = rf"(?<![^\s(\[\"'“‘])([\p{{L}}\p{{N}}]+(?:-[\p{{L}}\p{{N}}]+)*)[{HYPHENS}]$"
    halves = F.transform(
        ends,
        lambda x: F.struct(
            x["line_no"].alias("line_no"), F.regexp_extract(x["line"], left, 1).alias("left"),
            F.substring(x["line"], -1, 1).alias("sign"),
            opened(F.slice("lines", x["i"] + 2, many(x["i"]))).alias("rest")
        )
    )
    return lines.select(
        "doc", "page", "block_id", "block_uid", "heading",
        F.filter(halves, lambda h: h["left"].rlike(r"\p{L}")).alias("halves"),
        opened(F.slice("lines", 1, after)).alias("first")
    ).dropDuplicates(["block_uid"])


def hyphenated(
    blocks: DataFrame, noise: DataFrame, known: DataFrame, settings: Settings = Settings(), with_moved: bool = False
) -> DataFrame:
    """block_uid, line_no, next_uid, next_line, left, right, moved (all of the next line before its first blank, null
    unless ``with_moved``), last, head, right_whole, word of each line that ends in the first half of a word, or
    (``word`` false) in that of a compound.

    The other half opens the next line of the text that is neither blank nor
    ``noise`` (heads and page numbers): in the block, in the page's next block of
    text, or in the next page's first one.  Pages are joined by their number, so
    no document is a single task.  ``right_whole`` is the frequent form where the
    joined word is wrongly read.
    """
    own = cut(line_halves(blocks, settings, with_moved))
    noisy = noise.groupBy("block_uid").agg(F.collect_set("line_no").alias("noisy"))  # at most a page's edge lines
    clean = own.join(noisy, "block_uid", "left")
    free = lambda part: F.filter(part, lambda x: ~F.coalesce(F.array_contains("noisy", x["line_no"]), F.lit(False)))
    clean = clean.select(
        "doc", "page", "block_id", "block_uid",
        F.transform(
            free(F.col("halves")),
            lambda h: F.struct(
                h["line_no"].alias("line_no"), h["left"].alias("left"), h["sign"].alias("sign"),
                F.get(free(h["rest"]), F.lit(0)).alias("next")
            )
        ).alias("halves"),
        F.when(~F.col("heading"), F.get(free(F.col("first")), F.lit(0))).alias("first")
    )
    opens = F.when(
        F.col("first").isNotNull(),
        F.struct(
            "block_uid", F.col("first.line_no").alias("line_no"), F.col("first.right").alias("right"),
            F.col("first.moved").alias("moved")
        )
    )
    on_page = Window.partitionBy("doc", "page").orderBy("block_id")
    chained = clean.withColumn("opens", opens).withColumn(
        "after", F.first("opens", ignorenulls=True).over(on_page.rowsBetween(1, Window.unboundedFollowing))
    )
    half = chained.select("doc", "page", "block_uid", "after", F.explode("halves").alias("h")).select(
        "doc", "page", "block_uid", "h.line_no", "h.left", "h.sign",
        F.coalesce(
            F.when(F.col("h.next").isNotNull(), F.struct("block_uid", "h.next.line_no", "h.next.right", "h.next.moved")),
            "after"
        ).alias("to")
    )
    openings = clean.withColumn("opens", opens).where(F.col("opens").isNotNull()).groupBy("doc", "page").agg(
        F.min_by("opens", "block_id").alias("later")
    ).withColumn("page", F.col("page") - 1)
    pairs = half.join(
        openings, ["doc", "page"], "left"
    ).withColumn("to", F.coalesce("to", "later")).where(F.col("to").isNotNull())
    pairs = pairs.select(
        "block_uid", "line_no", F.col("to.block_uid").alias("next_uid"), F.col("to.line_no").alias("next_line"), "left",
        F.col("to.right").alias("right"), F.col("to.moved").alias("moved"), "sign"
    ).where(F.col("right").rlike(r"^\p{Ll}|^\d\p{Ll}"))
    last, head = F.regexp_extract(F.lower("left"), r"([^-]+)$", 1), F.regexp_extract(F.lower("right"), r"^([^-]+)", 1)
    pairs = pairs.withColumns({"last": last, "head": head}).withColumn("whole", F.concat("last", "head"))
    # the joined word, the compound and the second half are looked up in one join
    ask = F.array(
        *[
            F.struct(F.lit(role).alias("role"), form.alias("form")) for role,
            form in (
                ("w", F.col("whole")), ("c", F.concat_ws("-", F.lower("left"), F.lower("right"))), ("h", F.col("head"))
            )
        ]
    )
    asked = pairs.select(
        "block_uid", "line_no", F.explode(ask).alias("a")
    ).select("block_uid", "line_no", "a.role", "a.form").join(known.select("form", "n", "frequent"), "form")
    told = asked.groupBy("block_uid", "line_no").agg(
        F.max(F.when(F.col("role") == "w", F.col("n"))).alias("n_whole"),
        F.max(F.when(F.col("role") == "c", F.col("n"))).alias("n_compound"),
        F.bool_or((F.col("role") == "h") & F.col("frequent")).alias("head_frequent")
    )
    groups = known.where("frequent").groupBy("key").agg(
        F.max("n").alias("n_group"), F.max_by("form", "n").alias("right_group")
    )
    pairs = pairs.withColumn("key", skeleton(F.col("whole"))).join(
        broadcast_if(cut(groups)), "key", "left"
    ).join(told, ["block_uid", "line_no"], "left")
    n_whole = F.coalesce("n_whole", F.lit(0))
    whole, compound = F.greatest(n_whole, F.coalesce("n_group", F.lit(0))), F.coalesce("n_compound", F.lit(0))
    neither = (whole == 0) & (compound == 0)
    word = F.when(
        F.col("sign") != "-", (compound == 0) | (whole > 0)
    ).when(neither, ~F.coalesce("head_frequent", F.lit(False))).otherwise((whole > 0) & (whole >= compound))
    misread = (F.col("n_group") >= 8 * n_whole) & (F.col("right_group") != F.col("whole"))
    return pairs.where(word | (compound > 0)).select(
        "block_uid", "line_no", "next_uid", "next_line", "left", "right", "moved", "last", "head",
        F.when(word & misread, F.col("right_group")).alias("right_whole"), word.alias("word")
    )


def misread_halves(hyphens: DataFrame) -> DataFrame:
    """block_uid, line_no of the lines with a wrongly read half of a hyphenated word."""
    broken = hyphens.where(F.col("right_whole").isNotNull())
    starts, ends = F.col("right_whole").startswith(F.col("last")), F.col("right_whole").endswith(F.col("head"))
    sides = F.array(
        F.when(~starts, F.struct("block_uid", "line_no")),
        F.when(~ends, F.struct(F.col("next_uid").alias("block_uid"), F.col("next_line").alias("line_no")))
    )
    return broken.select(
        F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("x")
    ).select("x.block_uid", "x.line_no")


def _source(document_blocks: DataFrame) -> DataFrame:
    return document_blocks.select("doc", "page", "block_id", "block_uid", "block_type", "heading_level", "raw_content")


@dataclass(frozen=True)
class Noise:
    """What the stages found; each table is computed once and lies in the shared checkpoint folder."""

    lines: DataFrame  # block_uid, line_no, kind: heads and page numbers
    hyphens: DataFrame
    compounds: DataFrame  # broken at their own hyphen
    misread: DataFrame
    tokens: DataFrame  # of the corpus


def stages(
    document_blocks: DataFrame, settings: Settings = Settings(), corpus: DataFrame | None = None,
    with_moved: bool = False
) -> Noise:
    """``corpus`` has the blocks whose words are counted (by default the same ones)."""
    blocks = _source(document_blocks)
    known_tokens = cut(tokens(blocks if corpus is None else _source(corpus)))
    known = cut(words(known_tokens, settings))
    noise = cut(heads_and_numbers(blocks, settings))
    pairs = cut(hyphenated(blocks, noise, known, settings, with_moved))
    hyphens, compounds = pairs.where("word"), pairs.where("NOT word")
    wrong = wrong_tokens(known_tokens, corrections(known, settings))
    misread = misread_words(blocks, known_tokens, known, cut(wrong), settings)
    second = hyphens.select(
        F.col("next_uid").alias("block_uid"), F.col("next_line").alias("line_no"), F.lit(0).alias("place")
    )
    return Noise(
        noise, hyphens, compounds, misread.join(second, ["block_uid", "line_no", "place"], "left_anti"), known_tokens
    )


def found(document_blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """block_uid, line_no (from 1), kind of every noisy line of raw_content; see TESTDATA.md for the kinds.

    Null and empty texts have no line; a repeated delivery gives its rows once;
    blocks of tables, formulas and code can only take part as page edges.
    """
    noise = stages(document_blocks, settings)
    misread = noise.misread.select("block_uid", "line_no").unionByName(misread_halves(noise.hyphens)).withColumn("kind", F.lit("misread")).join(
        noise.lines.select("block_uid", "line_no"), ["block_uid", "line_no"], "left_anti"
    )
    return noise.lines.unionByName(
        noise.hyphens.select("block_uid", "line_no", F.lit("hyphen").alias("kind"))
    ).unionByName(misread).distinct()


def best_readings(misread: DataFrame, blocks: DataFrame, known_tokens: DataFrame) -> DataFrame:
    """One reading per wrongly read word: block_uid, line_no, place, token, wrong, right.

    Of several frequent forms the one that the corpus has most often beside the
    same neighbours is taken, then the more frequent, then the alphabetically
    first.  Only the neighbours of forms in question are counted, where the text
    is and before any shuffle: these forms are some of the frequent ones, a
    bounded list.
    """
    clean = lambda c: F.lower(F.regexp_extract(c, PLAIN, 1))
    m = misread.select(
        "block_uid", "line_no", "place", "token", "wrong", "right", "n_right", clean(F.col("before")).alias("before"),
        clean(F.col("after")).alias("after")
    )
    several = m.groupBy("block_uid", "line_no", "place").agg(
        F.count_distinct("right").alias("k")
    ).where("k > 1").drop("k")
    asked = cut(m.join(several, ["block_uid", "line_no", "place"]))
    sides = F.explode(
        F.array(
            F.struct(F.lit("b").alias("side"), F.col("before").alias("beside")),
            F.struct(F.lit("a").alias("side"), F.col("after").alias("beside"))
        )
    ).alias("p")
    ask = asked.select(
        "block_uid", "line_no", "place", "right", sides
    ).select("block_uid", "line_no", "place", "right", "p.*").where("beside <> ''")
    forms = known_tokens.select("token", clean(F.col("token")).alias("right")).join(
        broadcast_if(cut(asked.select("right").distinct())), "right"
    )
    forms = cut(forms)
    few = [r["token"] for r in forms.select("token").limit(LISTED + 1).collect()]
    each = token_neighbours(blocks, only=few if len(few) <= LISTED else None)
    near = each.join(broadcast_if(forms), "token").select(
        "right", clean(F.coalesce("before", F.lit(""))).alias("before"),
        clean(F.coalesce("after", F.lit(""))).alias("after")
    )
    counts = near.select("right", sides).select("right", "p.*").where("beside <> ''").groupBy(
        "right", "side", "beside"
    ).agg(F.count("*").alias("n"))
    support = ask.join(counts, ["right", "side", "beside"]).groupBy(
        "block_uid", "line_no", "place", "right"
    ).agg(F.sum("n").alias("support"))
    scored = m.join(support, ["block_uid", "line_no", "place", "right"], "left")
    return scored.groupBy("block_uid", "line_no", "place", "token", "wrong").agg(
        F.min_by("right", F.struct(-F.coalesce("support", F.lit(0)), -F.col("n_right"), F.col("right"))).alias("right")
    )


def _as_written(form: Column, like: Column) -> Column:
    """``form`` in the case of ``like``."""
    return F.when(
        (F.length(like) > 1) & (like == F.upper(like)) & like.rlike(r"\p{Lu}.*\p{Lu}"), F.upper(form)
    ).when(like.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(form, 1, 1)), F.substr(form, F.lit(2)))).otherwise(form)


def repair(
    document_blocks: DataFrame, settings: Settings = Settings(), corpus: DataFrame | None = None, markdown: bool = False
) -> DataFrame:
    """block_uid, text: the text of each block without heads and page numbers, with words joined and corrected, as
    paragraphs (an empty line between).

    A word hyphenated over blocks or pages stands whole at the end of the first.
    Blocks of other types keep their text, null stays null; a repeated delivery
    gives one row.  A paragraph ends at an empty line, before a list item, and
    after a sentence that ends a line well short of the block's longest; with
    ``markdown`` also around headings, and the rows of a table stay lines.
    """
    found_ = stages(document_blocks, settings, corpus, with_moved=True)
    blocks = _source(document_blocks)
    fixes = best_readings(cut(found_.misread), blocks if corpus is None else _source(corpus), found_.tokens)
    core = F.regexp_extract("token", PLAIN, 1)
    part = F.get(F.filter(F.split(core, "-"), lambda p: F.lower(p) == F.col("wrong")), F.lit(0))
    fixes = fixes.select(
        "block_uid", "line_no", "place", F.replace("token", part, _as_written(F.col("right"), part)).alias("new")
    )
    pairs = found_.hyphens.unionByName(found_.compounds)
    is_text = F.col("block_type").isin(*TEXT_TYPES)
    # lines and what is to be done with them, in one shuffle by block; line 0 stands for the block
    lines = blocks.select(
        "block_uid", F.when(~is_text, F.col("raw_content")).alias("own"),
        F.when(
            is_text & F.col("raw_content").isNotNull(),
            F.concat(F.array(F.lit(None).cast("string")), F.split("raw_content", "\n"))
        ).alias("lines"),
        (is_text & F.col("raw_content").isNotNull()).alias("has")
    )
    lines = lines.select("block_uid", "has", "own", F.posexplode_outer("lines").alias("line_no", "line")).select(
        "block_uid", F.coalesce("line_no", F.lit(0)).alias("line_no"), "line",
        F.when(F.coalesce("line_no", F.lit(0)) == 0, F.struct("has", "own")).alias("block")
    )
    halves = pairs.select("block_uid", "line_no", F.struct("moved", "word", "right_whole").alias("half"))
    parts = [
        lines, fixes.select("block_uid", "line_no", F.struct("place", "new").alias("edit")),
        found_.lines.select("block_uid", "line_no", F.lit(True).alias("gone")),
        halves,
        pairs.select(
            F.col("next_uid").alias("block_uid"), F.col("next_line").alias("line_no"), F.lit(True).alias("opened")
        ),
    ]
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    # one edit of a place: words with several wrong parts take the first
    work = rows.repartition("block_uid").groupBy("block_uid", "line_no").agg(
        F.max("line").alias("line"), F.max("block").alias("block"), F.collect_set("edit").alias("edits"),
        F.bool_or("gone").alias("gone"), F.max("half").alias("half"), F.bool_or("opened").alias("opened")
    )
    toks = F.filter(F.split(F.translate("line", "\t\r", "  "), " "), lambda x: x != "")
    edits = F.when(F.size("edits") > 0, F.array_sort("edits"))
    toks = F.when(edits.isNull(), toks).otherwise(
        F.transform(
            toks, lambda x, i: F.coalesce(F.get(F.filter(edits, lambda e: e["place"] == i), F.lit(0))["new"], x)
        )
    )
    toks = F.when(F.col("opened"), F.slice(toks, F.lit(2), F.greatest(F.size(toks), F.lit(1)))).otherwise(toks)
    left = F.when(
        F.col("half.word"), F.regexp_replace(F.element_at(toks, -1), rf"[{HYPHENS}]$", "")
    ).otherwise(F.element_at(toks, -1))
    stem = F.regexp_extract(left, r"^(.*?)[\p{L}\p{N}]+$", 1)
    end = F.regexp_extract("half.moved", r"([^\p{L}\p{N}]*)$", 1)
    last = F.regexp_extract(left, r"([\p{L}\p{N}]+)$", 1)
    whole = F.when(
        F.col("half.right_whole").isNotNull(), F.concat(stem, _as_written(F.col("half.right_whole"), last), end)
    ).otherwise(F.concat(left, "half.moved"))
    joined = F.when(
        F.col("half").isNotNull() & (F.size(toks) > 0), F.concat(F.slice(toks, 1, F.size(toks) - 1), F.array(whole))
    ).otherwise(toks)
    shaped = work.where(F.col("gone").isNull()).select(
        "block_uid", "line_no", "block", F.when(F.col("line").isNotNull(), F.array_join(joined, " ")).alias("line")
    )
    by = Window.partitionBy("block_uid")
    order = by.orderBy("line_no")
    before = F.lag("line").over(order)  # null before the first line
    ends = before.rlike(r"[.!?…:][\"')\]]*$") & (F.length(before) < 0.75 * F.max(F.length("line")).over(by))
    breaks = before.isNull() | (F.col("line") == "") | (before == "") | ends | F.col("line").rlike(
        r"^(?:[•◦▪*+–-]|\(?(?:\d{1,3}|[A-Za-z])[.)])\s"
    )
    if markdown:
        breaks = breaks | F.col("line").rlike(r"^(?:\||#{1,6} )") | before.rlike(r"^(?:\||#{1,6} )")
    numbered = shaped.withColumn("b", F.coalesce(breaks, F.lit(True))).withColumn(
        "paragraph", F.sum(F.col("b").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    in_order = lambda *c: F.transform(
        F.array_sort(F.collect_list(F.when(F.length(c[1]) > 0, F.struct(*c)))), lambda x: x[c[1]]
    )
    paragraphs = numbered.groupBy("block_uid", "paragraph").agg(
        F.array_join(in_order("line_no", "line"), " ").alias("text"), F.max("block").alias("block")
    )
    texts = paragraphs.groupBy("block_uid").agg(
        F.array_join(in_order("paragraph", "text"), "\n\n").alias("text"), F.max("block").alias("block")
    )
    text = F.regexp_replace("text", r"(?<=\|)\n\n(?=\|)", "\n") if markdown else F.col("text")
    return texts.select("block_uid", F.when(F.col("block.has"), text).otherwise(F.col("block.own")).alias("text"))


def repair_both(document_blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """block_uid, text, markdown_text: both raw_content and markdown_result of each block, repaired.

    Markdown made from a text has lost its line ends, so that heads stand inside
    paragraphs and halves of words in the middle of lines.  Where it differs from
    raw_content in nothing but white space, hyphens and the marks of headings and
    lists, the noise is what was found in the lines of raw_content, and its repair
    is that text under Markdown's marks.  Any other Markdown goes through the
    stages itself, among the pages of its document and with the words of the
    corpus.  Tables and blocks that are no text stay, null stays null.
    """
    bare = lambda c: F.translate(c, WHITE + HYPHENS + UNSEEN + BULLETS + "#", "")
    md = F.col("markdown_result")
    prose = F.col("block_type").isin(*TEXT_TYPES) & md.isNotNull() & ~(
        md.contains("|") & ~md.rlike(r"(?m)^[ \t]*[^\s|]")
    )
    made = prose & F.coalesce(bare(F.col("raw_content")) == bare(md), F.lit(False))
    marked = document_blocks.withColumns({"made": made, "other": prose & ~made})
    # of Markdown made from the text only its marks are shuffled
    marks = marked.select(
        "block_uid", "made", F.when(~F.col("made"), md).alias("kept"),
        F.when(F.col("made"), F.regexp_extract(md, r"^\s*(#{1,6} )", 1)).alias("heading"),
        F.when(F.col("made"), md.rlike(r"(?m)^[ \t]*- ")).alias("dashes")
    ).dropDuplicates(["block_uid"])
    listed = F.when(F.col("dashes"), F.regexp_replace("text", r"(?m)^[•◦▪‣] ?", "- ")).otherwise(F.col("text"))
    as_raw = F.when(
        (F.col("text") == "") | F.col("text").startswith("#"), listed
    ).otherwise(F.concat("heading", listed))
    both = marks.join(repair(document_blocks, settings), "block_uid").select(
        "block_uid", "text", F.when(F.col("made"), as_raw).otherwise(F.col("kept")).alias("markdown_text")
    )
    docs = cut(marked.where("other").select("doc").distinct())
    if docs.isEmpty():
        return both
    # a half of a word inside a line ends it, as it did before
    lined = F.regexp_replace("markdown_result", rf"(?<=[\p{{L}}\p{{N}}])([{HYPHENS}])[ \t]+(?=\p{{Ll}})", "$1\n")
    pages = marked.join(docs, "doc", "left_semi").withColumn(
        "raw_content", F.when(F.col("other"), lined).otherwise(F.col("raw_content"))
    )
    own = repair(pages, settings, document_blocks, markdown=True).join(
        marked.where("other").select("block_uid"), "block_uid", "left_semi"
    )
    return both.join(own.select("block_uid", F.col("text").alias("own")), "block_uid", "left").select(
        "block_uid", "text", F.coalesce("own", "markdown_text").alias("markdown_text")
    )
