"""Text expressions with Unicode-aware semantics, all of them built from Spark SQL functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: Fixed value: the white space characters of Unicode, with the four separators that count as white space in most
#: runtimes.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Fixed value: inline and displayed formulas, which the repairs leave alone.
MATH = r"\$[^$\n]+\$|\$\$[\s\S]+?\$\$"
#: Marks for replacements that need to know which alternative matched; code points that are no characters.
_A, _B, _C = "\ufdd0", "\ufdd1", "\ufdd2"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def lines(text: Column) -> Column:
    """Lines at any line separator; the empty piece after a last separator is no line."""
    return F.split(F.regexp_replace(text, rf"(?:{LINE_END})\z", ""), LINE_END)


def joined_lines(text: Column) -> Column:
    """The text with one kind of line end, and none at its end."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?:{LINE_END})\z", ""), LINE_END, "\n")


def to_float(text: Column) -> Column:
    """A number with a decimal point or comma; null where it is null, empty or no number."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def round_binary(value: Column | str, digits: Column | int) -> Column:
    """Rounding of the exact binary value, ties to even (2.675 is below the tie); SQL's round works on the decimal
    digits shown.

    The nearest integer of ``value * 10^digits`` may be one off, so twice that
    product is compared with the odd numbers beside it: the product's rounding
    error is exact (the value is split in two halves of 26 bits), and so is its
    distance from a near integer.  Up to seven digits; larger values are whole.
    """
    value = F.col(value) if isinstance(value, str) else value
    scale = F.pow(F.lit(10.0), digits) if isinstance(digits, Column) else F.lit(10.0**digits)
    double = scale * 2
    n = F.rint(value * scale)
    split = value * F.lit(134217729.0)  # 2^27 + 1
    high = split - (split - value)
    product = value * double
    error = (high * double - product) + (value - high) * double
    above, below = (product - n * 2 - 1) + error, (product - n * 2 + 1) + error
    odd = n % 2 != 0
    near = F.when(above > 0, n + 1).when(below < 0, n - 1).when(
        (above == 0) & odd, n + 1
    ).when((below == 0) & odd, n - 1).otherwise(n)
    return F.when(F.abs(value) * scale < F.lit(2.0**52), near / scale).otherwise(value)


def repair_hyphens(text: Column) -> Column:
    """Joins words hyphenated over a line end (three letters and more before, a small letter after) and then lines
    that go on in a small letter; formulas stay.

    Matches do not overlap: of ``a, b, c`` on three lines only the first two join.
    The two patterns beside the formulas are fixed values.
    """
    whole = F.regexp_replace(text, rf"(?U)({MATH})|(\w{{3,}})-\s*\n\s*([a-z])", "$1$2$3")
    marked = F.regexp_replace(whole, rf"({MATH})|([a-z,;:])[ \t]*\n[ \t]*([a-z])", f"$1{_A}$2{_B}$3{_C}")
    return F.translate(F.replace(F.replace(marked, F.lit(_A + _B + _C), F.lit("")), F.lit(_B), F.lit(" ")), _A + _C, "")


def normalize_space(text: Column) -> Column:
    """No blanks at line ends, at most one empty line in a row, none at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?md)[ \t]+$", ""), r"\n{3,}", "\n\n"))


def merge_split_paragraphs(text: Column) -> Column:
    """Joins a line that does not end a sentence with a next one that begins in a small letter.

    Lines of headings, lists, tables and formulas are not continued; a joined
    line is not joined again, so lines pair from the left.
    """
    pair = r"(?mdU)^(?!#|- |\* |\d+\.|\$\$|\|)([^\n]*[^\s.?!:])(?<!\$\$)[^\S\n]*\n(?=\p{IsLowercase})([^\n]*)$"
    return F.regexp_replace(joined_lines(text), pair, "$1 $2")


def clean_text(text: Column) -> Column:
    """Text of a block: words hyphenated over a line end joined, no blanks at line ends, at most one empty line;
    formulas within a line stay.
    """
    inline = r"\$[^$\n]+\$"
    out = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U)({inline})|(\w+)-\n(\w+)", "$1$2$3")
    out = F.regexp_replace(out, rf"(?md)({inline})|[ \t]+$", "$1")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def heading_prefix(text: Column, level: Column) -> Column:
    """``#`` to ``###`` before the first non-blank line, for levels 1 to 3."""
    marked = F.regexp_replace(
        text, r"(?U)\A((?:[^\S\n]*\n)*)[^\S\n]*([^\n]*\S)[^\S\n]*",
        F.concat(F.lit("$1"), F.repeat(F.lit("#"), level), F.lit(" $2"))
    )
    return F.when(level.between(1, 3) & (F.length(strip(text)) > 0), marked).otherwise(text)


def table_row(cells: Column) -> Column:
    """One Markdown row of cells; null cells are empty, bars are escaped."""
    return F.concat(
        F.lit("| "),
        F.array_join(
            F.transform(cells, lambda c: strip(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")))), " | "
        ),
        F.lit(" |")
    )


def table_markdown(rows: Column) -> Column:
    """Markdown of an array of rows: header, rule, body; null for a table without cells."""
    width = F.size(F.get(rows, F.lit(0)))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    made = F.transform(rows, table_row)
    return F.when(
        (F.size(rows) > 0) & (width > 0),
        F.array_join(
            F.concat(F.slice(made, 1, 1), F.array(rule), F.slice(made, 2, F.greatest(F.size(rows), F.lit(1)))), "\n"
        )
    )


def repair_table(text: Column) -> Column:
    """A Markdown table with stripped lines and a rule under its header; empty with fewer than two lines."""
    kept = F.filter(F.transform(lines(strip(F.coalesce(text, F.lit("")))), strip), lambda x: x != "")
    head = F.get(kept, F.lit(0))
    bars = F.length(head) - F.length(F.replace(head, F.lit("|"), F.lit("")))
    # fewer than two bars leave a rule without columns
    rule = F.concat(
        F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.greatest(bars - 1, F.lit(0))), " | "), F.lit(" |")
    )
    has_rule = F.get(kept, F.lit(1)).rlike(r"(?U)^\|[\s\-|]+\|$")
    with_rule = F.when(has_rule, kept).otherwise(
        F.concat(F.slice(kept, 1, 1), F.array(rule), F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))))
    )
    return F.when(F.size(kept) < 2, F.lit("")).otherwise(F.array_join(with_rule, "\n"))


def url_path(path: Column) -> Column:
    """Percent-encoded path; slashes stay, backslashes become slashes."""
    out = F.url_encode(F.replace(path, F.lit("\\"), F.lit("/")))
    for code, char in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def image_tag(alt: Column, path: Column) -> Column:
    """Markdown image with escaped alternative text and an encoded path."""
    for char in ("\\", "[", "]"):
        alt = F.replace(alt, F.lit(char), F.lit("\\" + char))
    return F.concat(F.lit("!["), alt, F.lit("]("), url_path(path), F.lit(")"))


def block_image(path: Column, page: Column, block_id: Column) -> Column:
    return image_tag(F.format_string("Image p%d #%d", page, block_id), path)


def word_tokens(text: Column) -> Column:
    """Words between white space; none for null and blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


#: A character of a term: a letter, mark or digit.
TERM = r"[\p{L}\p{M}\p{N}]"


def terms(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits, for keyword search."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"{TERM}+"), 0)


def term_characters(spark: SparkSession) -> np.ndarray:
    """Of every code point, whether ``terms`` takes it as part of a term: asked of the JVM once, since the Unicode
    versions of Python and Java differ.
    """
    context = spark.sparkContext
    if getattr(context, "_foliospark_terms", None) is None:
        every = "".join(" " if 0xD800 <= c < 0xE000 else chr(c) for c in range(0x110000))
        left = context._jvm.java.util.regex.Pattern.compile(TERM).matcher(every).replaceAll("\0")
        context._foliospark_terms = (np.frombuffer(left.encode("utf-32-le"), np.uint32) == 0) & (np.arange(0x110000) > 0)
    return context._foliospark_terms


def json_indented(value: Column, kind: DataType, level: int = 0) -> Column:
    """JSON with two blanks of indentation for each level and with null fields, as text tools print it; ``kind`` is
    the type of ``value``.
    """
    pad, end = "  " * (level + 1), "\n" + "  " * level
    if isinstance(kind, StructType):
        parts = [
            F.concat(
                F.lit(f'{pad}"{f.name}": '), json_indented(value[f.name], f.dataType, level + 1)
            ) for f in kind.fields
        ]
        return F.when(value.isNull(), "null").otherwise(
            F.concat(F.lit("{\n"), F.concat_ws(",\n", *parts), F.lit(end + "}"))
        )
    if isinstance(kind, ArrayType):
        items = F.transform(value, lambda x: F.concat(F.lit(pad), json_indented(x, kind.elementType, level + 1)))
        return F.when(value.isNull(), "null").when(F.size(value) == 0, "[]").otherwise(
            F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit(end + "]"))
        )
    return F.regexp_replace(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", "$1")
