"""Cutting of oversized texts at natural boundaries, with an overlap between consecutive pieces.

Each place between two characters has a boundary strength.  A sparse table
(range maximum over powers of two) answers which place is the strongest within
the window of permissible piece lengths; of equal ones the rightmost is taken.
The next piece begins one overlap further back.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the white space characters of Unicode, and the four separators that count as white space in most
#: runtimes.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Strengths of a cut: inside a character with its marks, between two characters, after a blank, a clause, a sentence,
#: a line, a paragraph.
INSIDE, BETWEEN, BLANK, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(7)
#: Characters of one sparse table; longer texts are worked through table by table, so memory does not follow the
#: text's length.
SLAB = 1 << 18
#: Characters around it that are looked at too.
CONTEXT = 256
#: Places of one table at most; strength and place are one integer.
WIDE = 1 << 28


@lru_cache(1)
def _classes() -> np.ndarray:
    """Of each code point of the basic plane: 1 white, 2 line end, 3 clause mark, 4 sentence mark, 5 mark that belongs
    to the character before it.
    """
    kinds = np.zeros(0x10000, np.int8)
    for c in range(0x10000):
        if unicodedata.category(chr(c)) in ("Mn", "Me", "Mc") or c in (0x200D, 0xFE0F):
            kinds[c] = 5
    kinds[[ord(c) for c in WHITE]] = 1
    kinds[[ord(c) for c in "\n\u2028\u2029"]] = 2
    kinds[[ord(c) for c in ",;:，；：、"]] = 3
    kinds[[ord(c) for c in ".!?…。！？"]] = 4
    return kinds


def strengths(text: str) -> np.ndarray:
    """Strength of the cut before each character of ``text`` and at its end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[np.where(points < 0x10000, points, 0)]
    n = len(kind)
    out = np.full(n + 1, BETWEEN, np.int8)
    inside = kind == 5
    inside[1:] |= points[:-1] == 0x200D
    out[:n][inside] = INSIDE
    white = (kind == 1) | (kind == 2)
    # a run of white space belongs to what stands before it: the cut comes after the run
    before = np.concatenate(([False], white))
    after = np.concatenate((white, [False]))
    ends = np.flatnonzero(before & ~after)
    if len(ends):
        where = np.arange(n + 1)
        begins = np.flatnonzero(white & ~np.concatenate(([False], white[:-1])))
        lines = np.concatenate(([0], np.cumsum(kind == 2)))
        breaks = lines[ends] - lines[begins]
        last = np.where(begins > 0, kind[np.maximum(begins - 1, 0)], 0)
        out[where[ends]] = np.select(
            [breaks > 1, breaks == 1, last == 4, last == 3], [PARAGRAPH, LINE, SENTENCE, CLAUSE], BLANK
        )
    out[n] = PARAGRAPH
    return out


class StrongestCut:
    """Sparse table over one slab of strengths; windows up to ``widest`` places."""

    def __init__(self, strength: np.ndarray, widest: int):
        level = strength.astype(np.int32) * WIDE + np.arange(len(strength), dtype=np.int32)
        self.levels = [level]
        step = 1
        while 2 * step <= min(widest, len(strength)):
            level = np.maximum(level[:-step], level[step:])
            self.levels.append(level)
            step *= 2

    def query(self, low: int, high: int) -> int:
        """The place of the strongest cut in ``low .. high`` (both included), of equal ones the rightmost."""
        k = (high - low + 1).bit_length() - 1
        level = self.levels[k]
        return int(max(level[low], level[high - (1 << k) + 1])) % WIDE


def pieces(text: str, max_chars: int, overlap: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces of ``text``; one piece where it is not longer than ``max_chars``.

    Every piece has at most ``max_chars`` characters, together they cover the
    text, and each begins after the one before it begins.  A piece has at least
    half of ``max_chars`` (the last excepted).  The shared part is up to
    ``overlap`` characters and at least half of it, so that it opens at the
    strongest boundary there.
    """
    n, max_chars = len(text), max(1, max_chars)
    overlap = max(0, min(overlap, max_chars - 1))
    if n <= max_chars:
        return [(0, n)] if n else []
    least = min(max_chars, max(overlap + 1, max_chars // 2))
    span = max(SLAB, 4 * max_chars)
    out: list[tuple[int, int]] = []
    start, base, reach = 0, 0, -1
    while n - start > max_chars:
        low, high = start + least, start + max_chars
        if high > reach:
            # the strengths of the next stretch, with some text before it for white space that began there
            base, reach = max(0, start - CONTEXT), min(n, start + span)
            strength = strengths(text[base : reach + CONTEXT])
            table = StrongestCut(strength[: reach - base + 1], high - low + 1)
        end = base + table.query(low - base, high - base)
        out.append((start, end))
        if overlap:
            first, last = end - overlap - base, end - overlap // 2 - base
            at = first + int(np.argmax(strength[first : last + 1]))
            start = base + (at if strength[at] > BETWEEN else first + int(strength[first] == INSIDE and overlap > 1))
        else:
            start = end
    out.append((start, n))
    return out


def stripped(text: Column) -> Column:
    """``text`` without white space at both ends."""
    return F.btrim(text, F.lit(WHITE))


def page_text(blocks: Column) -> Column:
    """Text of a page: the non-blank, stripped ``markdown_result`` of its blocks by ``block_id``, a repeated
    ``block_id`` once (its first non-blank entry), joined by an empty line.
    """
    return F.array_join(F.transform(blocks, lambda b: b["text"]), "\n\n")


def page_items(page_results: DataFrame) -> DataFrame:
    """``item_kind, item_id, text`` of each page (empty text where no block has any)."""
    entries = F.array_sort(
        F.filter(
            F.transform(
                F.coalesce(
                    "blocks", F.array().cast("array<struct<block_id:int,block_type:string,markdown_result:string>>")
                ),
                lambda b, i: F.struct(
                    b["block_id"].alias("block_id"), i.alias("i"), stripped(b["markdown_result"]).alias("text")
                )
            ),
            lambda b: F.length(b["text"]) > 0,
        )
    )
    ordered = page_results.select("page_uid", entries.alias("entries"))
    once = ordered.select(
        "page_uid",
        F.filter(
            "entries", lambda b, i: (i == 0) | ~F.get(F.col("entries"), i - 1)["block_id"].eqNullSafe(b["block_id"])
        ).alias("entries")
    )
    return once.select(
        F.lit("page").alias("item_kind"), F.col("page_uid").alias("item_id"), page_text(F.col("entries")).alias("text"),
        F.lit("page").alias("limit_kind")
    )


def block_items(document_blocks: DataFrame) -> DataFrame:
    """``item_kind, item_id, text`` of each block; its limit is that of its block_type."""
    return document_blocks.select(
        F.lit("block").alias("item_kind"), F.col("block_uid").alias("item_id"),
        stripped(F.col("markdown_result")).alias("text"), F.col("block_type").alias("limit_kind")
    )


def split_items(items: DataFrame, limits: DataFrame, with_text: bool = True) -> DataFrame:
    """Pieces of every item whose text is longer than the ``max_chars`` of its ``limit_kind``.

    ``items`` has item_kind, item_id, text, limit_kind; ``limits`` has item_kind,
    max_chars, overlap_chars.  Result: item_kind, item_id, piece_no (from 1),
    start_char, end_char (code points of the stripped text) and, ``with_text``,
    piece.  Items without a limit, with null or empty text, or within the limit
    have no row; a null limit is none; an overlap at or above the limit counts
    as the limit less one.  A repeated delivery of an item gives its rows once.
    Cutting happens where the rows are (no shuffle); only the pieces are made
    unique by key.
    """
    limits = limits.select(
        F.col("item_kind").alias("limit_kind"), "max_chars",
        F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars")
    )
    big = items.join(limits, "limit_kind").where(F.char_length("text") > F.col("max_chars")).select(
        "item_kind", "item_id", "text", "max_chars", "overlap_chars"
    )
    id_type = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ids, texts, most, overlaps = (c.to_pylist() for c in batch.columns)
            rows: list[tuple] = []
            size = 0
            for kind, item, text, limit, overlap in zip(kinds, ids, texts, most, overlaps):
                cuts = pieces(text, limit, overlap)
                rows += [(kind, item, i + 1, a, b, text[a:b] if with_text else None) for i, (a, b) in enumerate(cuts)]
                size += len(text)
                if size > 4_000_000:
                    yield _batch(rows, batch.schema)
                    rows, size = [], 0
            yield _batch(rows, batch.schema)

    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 6
        types = (pa.string(), schema.field(1).type, pa.int32(), pa.int32(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["item_kind", "item_id", "piece_no", "start_char", "end_char", "piece"]
        )

    out = big.mapInArrow(
        run, f"item_kind string, item_id {id_type}, piece_no int, start_char int, end_char int, piece string"
    )
    out = out.dropDuplicates(["item_kind", "item_id", "piece_no"])
    return out if with_text else out.drop("piece")


def all_items(document_blocks: DataFrame, page_results: DataFrame) -> DataFrame:
    """Blocks and pages as items."""
    return block_items(document_blocks).unionByName(page_items(page_results))
