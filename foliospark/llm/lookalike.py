"""One consistent form of text that looks the same but is written with other characters.

The folding is SQL that DuckDB runs inside each Arrow partition: canonical
composition (nfc_normalize), translate for full-width forms, blanks and
look-alike letters, regular expressions for ligatures and invisible characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Full-width forms U+FF01..U+FF5E stand for U+0021..U+007E.
FULL = "".join(map(chr, range(0xFF01, 0xFF5F)))
HALF = "".join(map(chr, range(0x21, 0x7F)))
#: Ligatures.
LIGATURES = {
    "\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st",
    "Ĳ": "IJ", "ĳ": "ij", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz",
    "ǳ": "dz"
}
#: Blanks other than U+0020, tab and line ends.
BLANKS = "\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
#: Characters that are not seen.
INVISIBLE = "\xad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\ufeff"
#: Cyrillic letters that look like Latin ones.
CYRILLIC, CYRILLIC_AS = "\u0430\u0435\u043e\u0440\u0441\u0443\u0445\u0456\u0458\u0455\u04bb\u0501\u051b\u051d\u04cf\u0410\u0412\u0415\u041a\u041c\u041d\u041e\u0420\u0421\u0422\u0423\u0425\u0406\u0408\u0405\u050c\u051a\u051c", "aeopcyxijshdqwlABEKMHOPCTYXIJSGQW"
#: Greek letters that look like Latin ones (not those that serve as symbols of their own look, as alpha
#: or mu).
GREEK, GREEK_AS = "\u03bf\u03bd\u03f2\u03f3\u0391\u0392\u0395\u0396\u0397\u0399\u039a\u039c\u039d\u039f\u03a1\u03a4\u03a5\u03a7\u03f9\u037f", "ovcjABEZHIKMNOPTYXCJ"
#: The one of these that is a common symbol beside a consonant.
NU = "\u03bd"
#: The same, but also common as symbols: only in words of three letters and more.
GREEK_LONG, GREEK_LONG_AS = "\u03c1\u03c5\u03b9\u03ba", "puik"
#: Letters of other alphabets or of phonetic script that look like Latin ones.
OTHER, OTHER_AS = "ɡɑ\u0585\u057d\u0578\u0570\u0581ɩÐƉǃ", "gaounhgiĐĐ!"
#: Words whose own letters are only Latin look like this after translation; letters of these alphabets that look
#: different keep a word as it is.
_CYRILLIC_OWN = "[\u0431\u0432\u0433\u0434\u0451\u0436\u0437\u0438\u0439\u043a\u043b\u043c\u043d\u043f\u0442\u0444\u0446\u0447\u0448\u0449\u044a\u044b\u044c\u044d\u044e\u044f\u0411\u0413\u0414\u0401\u0416\u0417\u0418\u0419\u041b\u041f\u0424\u0426\u0427\u0428\u0429\u042a\u042b\u042c\u042d\u042e\u042f\u0454\u0404\u0457\u0407\u0491\u0490]"
_GREEK_OWN = "[\u03b1\u03b2\u03b3\u03b4\u03b5\u03b6\u03b7\u03b8\u03b9\u03bb\u03bc\u03be\u03c0\u03c3\u03c4\u03c6\u03c7\u03c8\u03c9\u03c2\u03ac\u03ad\u03ae\u03af\u03cc\u03cd\u03ce\u0393\u0394\u0398\u039b\u039e\u03a0\u03a3\u03a6\u03a8\u03a9]"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _word_sql() -> str:
    """SQL of one word ``w``: look-alike letters become those of the word's own script."""
    latin, cyr, greek = "regexp_matches(w, '\\p{Latin}')", f"regexp_matches(w, '[{CYRILLIC}]')", f"regexp_matches(w, '[{GREEK}{GREEK_LONG}]')"
    to_latin_cyr = f"translate(w, {_quote(CYRILLIC)}, {_quote(CYRILLIC_AS)})"
    short = f"translate(w, {_quote(GREEK)}, {_quote(GREEK_AS)})"
    long = f"translate(w, {_quote(GREEK + GREEK_LONG)}, {_quote(GREEK_AS + GREEK_LONG_AS)})"
    other = f"translate(w, {_quote(OTHER)}, {_quote(OTHER_AS)})"
    return f"""CASE
        WHEN {latin} AND {cyr} AND NOT regexp_matches(w, '{_CYRILLIC_OWN}') THEN translate({to_latin_cyr}, {_quote(GREEK)}, {_quote(GREEK_AS)})
        WHEN {latin} AND regexp_matches(w, '{_CYRILLIC_OWN}') AND regexp_matches(w, '[{CYRILLIC_AS}]') AND NOT regexp_matches(translate(w, {_quote(CYRILLIC_AS)}, {_quote(CYRILLIC)}), '\\p{{Latin}}') THEN translate(w, {_quote(CYRILLIC_AS)}, {_quote(CYRILLIC)})
        WHEN {latin} AND {greek} AND NOT regexp_matches(replace(w, '\u03b9', ''), '{_GREEK_OWN}') AND (length(w) > 2 OR regexp_matches(w, '[{GREEK.replace(NU, '')}]') OR regexp_matches(w, '[aeiouyAEIOUY\\x{{c0}}-\\x{{24f}}\\x{{1e00}}-\\x{{1eff}}]')) THEN CASE WHEN length(w) > 2 THEN {long} ELSE {short} END
        WHEN length(w) > 1 AND regexp_matches(w, '[{OTHER}]') AND regexp_matches({other}, '\\p{{Latin}}') THEN {other}
        ELSE w END"""


def _fold_sql() -> str:
    """SQL of a text ``t``: its folded form, in which nothing that looks different from the original is changed."""
    wide = f"translate(t, {_quote(FULL)}, {_quote(HALF)})"
    for sign, plain in LIGATURES.items():
        wide = f"replace({wide}, {_quote(sign)}, {_quote(plain)})"
    blanks = f"translate({wide}, {_quote(BLANKS)}, {_quote(' ' * len(BLANKS))})"
    inner = f"([\\p{{L}}\\p{{M}}\\p{{N}}])[{INVISIBLE}]+([\\p{{L}}\\p{{N}}])"
    clear = f"regexp_replace(regexp_replace({blanks}, {_quote(inner)}, '\\1\\2', 'g'), {_quote(inner)}, '\\1\\2', 'g')"
    return f"nfc_normalize({clear})"


#: Characters that folding never changes, alone or beside one another: those of Latin-1 but its blank, soft hyphen and
#: the letter eth, the precomposed letters of Vietnamese, and common dashes, quotes and dots.  None of them is in a
#: table above, and none composes.
INERT = "\x00-\x9f\xa1-\xac\xae-\xcf\xd1-\xffĂăĐđĨĩŨũƠơƯư\u1ea0-\u1ef9\u2010-\u2015\u2018-\u201e\u2020-\u2022\u2026"

FOLD_SQL = f"""
WITH folded AS (
    SELECT id, t, {_fold_sql()} AS f FROM texts
), worded AS (
    SELECT id, t, CASE WHEN regexp_matches(f, '[{CYRILLIC}{GREEK}{GREEK_LONG}{OTHER}]')
        THEN array_to_string(list_transform(regexp_extract_all(f, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'), lambda w: {_word_sql()}), '')
        ELSE f END AS f FROM folded
)
SELECT id, f AS folded, f <> t AS differs FROM worded
"""
#: The comparison form drops what is still invisible (the joiners of emoji excepted) and makes runs of blanks one.
_COMPARE = f"[{INVISIBLE.replace(chr(0x200D), '')}]"


def fold_table(df: DataFrame, id_col: str, text_col: str, suspects_only: bool = False) -> DataFrame:
    """``id_col``, ``folded`` (string), ``differs`` (boolean) of each row of ``df``.

    A null text has null folded and differs false; an empty text is empty.
    With ``suspects_only`` the rows whose text consists of ``INERT`` characters are
    left out before they reach Python (they would have differs false).  Line ends, tabs, ordinary blanks and letter
    case stay.  Rows are
    processed where they are, a DuckDB of one thread per task, batch by batch;
    rows stay one to one (repeated ids included) and other columns are dropped.
    """
    df = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    if suspects_only:
        df = df.where(F.col("t").rlike(f"[^{INERT}]"))
    id_type = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for batch in batches:
            # texts of a batch go through in slices of bounded size
            for piece in _slices(batch):
                con.register("texts", pa.Table.from_batches([piece]))
                out = con.sql(FOLD_SQL).to_arrow_table()
                con.unregister("texts")
                for part in out.combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).cast(batch.schema.field(0).type), part.column(1).cast(pa.string()),
                            part.column(2)
                        ],
                        ["id", "folded", "differs"]
                    )
        con.close()

    out = df.mapInArrow(run, f"id {id_type}, folded string, differs boolean")
    return out.select(F.col("id").alias(id_col), "folded", F.coalesce("differs", F.lit(False)).alias("differs"))


def _slices(batch: pa.RecordBatch, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    if batch.nbytes <= most or batch.num_rows <= 1:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from _slices(batch.slice(0, half), most)
        yield from _slices(batch.slice(half), most)


def comparison(folded: Column) -> Column:
    """Form for equality: the folded text without invisible characters, in lower case, runs of white space as one
    blank, none at the ends.
    """
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(folded, _COMPARE, "")), r"\s+", " "))


def found(document_blocks: DataFrame, courses: DataFrame) -> DataFrame:
    """record_kind, record_id of the blocks and courses whose text differs from its folded form; repeated deliveries
    once.
    """
    parts = [(document_blocks, "block", "block_uid", "raw_content"), (courses, "course", "course_uid", "name")]
    out = None
    for df, kind, key, text in parts:
        rows = fold_table(df, key, text, suspects_only=True).where("differs").select(
            F.lit(kind).alias("record_kind"), F.col(key).alias("record_id")
        )
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def consistent_names(courses: DataFrame, course_names: DataFrame) -> DataFrame:
    """course_uid, name in consistent form, and the name_id of the official list with the same comparison form (null
    where none).

    The list is small and fixed; Spark broadcasts it if its size allows, else
    both sides are shuffled by the comparison form.  A form that stands twice in
    the list gives the smallest name_id.
    """
    listed = fold_table(course_names, "name_id", "name").groupBy(
        comparison(F.col("folded")).alias("form")
    ).agg(F.min("name_id").alias("name_id"))
    ours = fold_table(courses, "course_uid", "name").dropDuplicates(["course_uid"]).withColumn(
        "form", comparison(F.col("folded"))
    )
    return ours.join(listed, "form", "left").select(
        "course_uid", F.trim(F.regexp_replace(F.regexp_replace("folded", _COMPARE, ""), r"\s+", " ")).alias("name"),
        "name_id"
    )
