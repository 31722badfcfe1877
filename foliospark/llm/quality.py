"""Text quality statistics per document, from associative partial counts.

Every text is cut into chunks of bounded size.  A chunk's state has the counts of
its complete lines and, for the line it opens in and the line it ends in, a
fragment: counts of complete words plus the word pieces and the white space at
both edges.  Two neighbouring states merge into one (the fragments at the seam
become one, with the word across the seam whole), so any tree of merges gives
the counts of the uncut text.  States are arrays: all chunks of an Arrow batch
are counted at once, and a round merges all pairs of neighbours at once.  The
counts of the texts are then summed by block, by salted part of a document and
by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Common words of English and Vietnamese.
COMMON = frozenset(
    "the of and to a in is that it for was on are as with his they at be this have from or one had by but not what all were we when your can said there use an each which she do how their if will up other about out many then them these so some her would make like him into time has look two more no way could my than been who its now find may every any because while during after before between within although whenever also only such very our over near".split()
    + "và của là các những một mỗi có không cho trong được với này đó khi đã sẽ đang thì mà ở từ đến để vì nên nếu như về ra vào lên xuống trên dưới theo tại bởi do cũng vẫn còn chỉ rất hơn nhất lại nữa đều hay hoặc nhưng vốn sau trước giữa gần suốt đồng thời mặc dù vậy rằng bất kể".split()
)
#: Characters of one chunk.
CHUNK = 1 << 10
#: Chunks of a batch that are counted together have about so many characters.
SLAB = 1 << 20
#: Marks that open a list item, characters that end a sentence, and those after which a short line goes
#: on.
BULLETS = "•◦▪‣·∙●○*+–—-"
ENDS = ".!?…:;。！？\"”)"
GOES_ON = ",-\xac\xad"
#: Most characters and words of a line that can be an item without a mark.
SHORT_LINE, SHORT_WORDS = 48, 9
#: What a state counts.
COUNTS = (
    "chars", "nonspace", "words", "word_chars", "common", "lines", "punct_lines", "list_chars", "table_chars",
    "prose_chars", "junk_chars"
)
#: Characters of a line's opening that are kept (an item's mark has at most eight), and of a word at an edge (no
#: common word has more).
_OPENING, _EDGE = 12, max(map(len, COMMON))
#: Kinds of characters, as bits.
_WORD, _SPACE, _LOWER, _DIGIT, _TAB, _BAR, _COMMA, _BREAK = (1 << i for i in range(8))


class _Characters:
    """Kinds and lower-case forms by code point; planes beyond the first are filled as they are met."""

    def __init__(self):
        self.kind = np.zeros(0x110000, np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.seen = np.zeros(0x110000 >> 8, bool)

    def learn(self, codes: np.ndarray) -> None:
        pages = np.zeros(len(self.seen), bool)
        pages[codes >> 8] = True
        for page in np.flatnonzero(pages & ~self.seen):
            for code in range(page << 8, (page + 1) << 8):
                c = chr(code)
                self.kind[
                    code
                ] = _WORD * c.isalnum() | _SPACE * c.isspace() | _LOWER * c.islower() | _DIGIT * c.isdecimal()
                if len(c.lower()) == 1:
                    self.lower[code] = ord(c.lower())
            self.seen[page] = True
        for chars, kind in (("\t", _TAB), ("|", _BAR), (",;", _COMMA), ("\n", _BREAK)):
            for c in chars:
                self.kind[ord(c)] |= kind


@lru_cache(maxsize=1)
def _characters() -> _Characters:
    return _Characters()


@lru_cache(maxsize=1)
def _common_words() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common words and their code points, in the same order."""
    codes = np.zeros((len(COMMON), _EDGE), np.uint32)
    for i, word in enumerate(sorted(COMMON)):
        codes[i, : len(word)] = [ord(c) for c in word]
    hashes = _hash(codes)
    order = np.argsort(hashes)
    return hashes[order], codes[order]


def _hash(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for column in words.T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _is_common(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the words (code points, padded with zeros; cut where they are too long) are common ones, in any case."""
    hashes, codes = _common_words()
    out = np.zeros(len(words), bool)
    short = np.flatnonzero((sizes > 0) & (sizes <= _EDGE))
    lower = _characters().lower[words[short]]
    found = _hash(lower)
    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    out[short] = (hashes[at] == found) & (codes[at] == lower).all(1)
    return out


def _window(codes: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` of the ``size`` code points from each ``start``, padded with zeros."""
    step = np.arange(most)
    inside = step < size[:, None]
    return np.where(inside, codes[np.where(inside, start[:, None] + step, 0)] if len(codes) else 0, 0).astype(np.uint32)


def _concat(a: np.ndarray, size_a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``a`` (of which ``size_a`` count) followed by those of ``b``, as wide as they are."""
    step = np.arange(a.shape[1]) - size_a[:, None]
    follow = np.take_along_axis(b, np.clip(step, 0, b.shape[1] - 1), 1)
    return np.where(step < 0, a, follow)


@dataclass
class Lines:
    """Lines or parts of lines, a row each.

    ``left`` and ``right`` are the word pieces at the edges (their sizes and
    code points, not in the counts of words); a piece that is one word
    throughout has a negative right size.  ``lead`` and ``trail`` are sizes of
    the white space at the edges, a blank piece is all lead.
    """

    chars: np.ndarray
    nonspace: np.ndarray
    words: np.ndarray
    word_chars: np.ndarray
    common: np.ndarray
    bars: np.ndarray
    gaps: np.ndarray
    commas: np.ndarray
    last: np.ndarray
    lead: np.ndarray
    lead_tab: np.ndarray
    trail: np.ndarray
    trail_tab: np.ndarray
    left_size: np.ndarray
    right_size: np.ndarray
    opening: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def __getitem__(self, rows) -> Lines:
        return Lines(**{f.name: getattr(self, f.name)[rows] for f in fields(self)})

    def where(self, mine: np.ndarray, other: Lines) -> Lines:
        """These rows where ``mine``, else those of ``other``."""
        pick = lambda a, b: np.where(mine if a.ndim == 1 else mine[:, None], a, b)
        return Lines(**{f.name: pick(getattr(self, f.name), getattr(other, f.name)) for f in fields(self)})

    def join(self, b: Lines) -> Lines:
        """Each row with the row of ``b`` that follows it in its line."""
        a, text, blank = self, self.nonspace > 0, b.nonspace == 0
        total = {
            n: getattr(a, n) + getattr(b, n) for n in (
                "chars", "nonspace", "words", "word_chars", "common", "bars", "gaps", "commas"
            )
        }
        total["gaps"] = total["gaps"] + (text & ~blank & ((a.trail + b.lead >= 3) | (a.trail_tab | b.lead_tab)))
        shown = np.minimum(np.maximum(a.chars - a.lead, 0), _OPENING)
        padded = np.concatenate((np.full((len(shown), _OPENING), 32, np.uint32), b.opening), 1)
        grown = _concat(
            a.opening, shown,
            np.take_along_axis(padded, np.arange(_OPENING) + (_OPENING - np.minimum(b.lead, _OPENING))[:, None], 1)
        )
        opening = np.where(text[:, None], grown, b.opening)
        # the word across the seam
        one_a, one_b = a.right_size < 0, b.right_size < 0
        size_a = np.where(one_a, a.left_size, a.right_size)
        size, seam = size_a + b.left_size, _concat(np.where(one_a[:, None], a.left, a.right), size_a, b.left)
        whole = ~one_a & ~one_b & (size > 0)
        total["words"] = total["words"] + whole
        total["word_chars"] = total["word_chars"] + np.where(whole, size, 0)
        total["common"] = total["common"] + (whole & _is_common(seam, size))
        out = Lines(
            **total, last=np.where(blank, a.last, b.last), opening=opening,
            lead=np.where(text, a.lead, a.lead + b.lead), lead_tab=np.where(text, a.lead_tab, a.lead_tab | b.lead_tab),
            trail=np.where(blank, np.where(text, a.trail + b.lead, 0), b.trail),
            trail_tab=np.where(blank, text & (a.trail_tab | b.lead_tab), b.trail_tab),
            left_size=np.where(one_a, size, a.left_size), left=np.where(one_a[:, None], seam, a.left),
            right_size=np.where(one_b, np.where(one_a, -1, size), b.right_size),
            right=np.where(one_b[:, None], seam, b.right),
        )
        return a.where(b.chars == 0, b.where(a.chars == 0, out))

    def counts(self) -> np.ndarray:
        """Counts of the rows as complete lines, one column for each of COUNTS."""
        words, word_chars, common = self.words, self.word_chars, self.common
        for size, word in ((self.left_size, self.left), (self.right_size, self.right)):
            words, word_chars, common = words + (size > 0), word_chars + np.maximum(size, 0), common + _is_common(
                word, size
            )
        nonspace, last, none = self.nonspace, self.last, np.zeros_like(self.chars)
        shown, short = nonspace > 0, nonspace <= SHORT_LINE
        ends, goes_on = (np.isin(last, [ord(c) for c in marks]) for marks in (ENDS, GOES_ON))
        spread = (self.commas >= 2) & (common <= words * 0.15) & ~ends
        # cells; of fields between commas those that are mostly numbers
        table = (self.bars >= 2) | (self.gaps >= 2) | ((self.gaps == 1) & short) | (
            spread & (word_chars <= 2.7 * words)
        )
        lettered = word_chars >= 0.7 * nonspace
        small = _characters().kind[self.opening[:, 0]] & _LOWER > 0  # a short line that goes on in lower case is a wrapped one
        item = _is_item(self.opening) | (spread & (words > 0) & lettered) | (
            short & ~ends & ~goes_on & (words > 0) & (words <= SHORT_WORDS) & lettered & ~small
        )
        prose = ((common >= np.maximum(1, words * 0.08)) | (short & (words > 0))) & (word_chars >= 0.6 * nonspace)
        kinds = [shown & ~table & item, shown & table, shown & ~table & ~item & prose, shown & ~table & ~item & ~prose]
        return np.stack(
            [
                self.chars, nonspace, words, word_chars, common, shown, shown & ends,
                *[np.where(k, nonspace, none) for k in kinds]
            ],
            1
        )


def _is_item(opening: np.ndarray) -> np.ndarray:
    """Openings of list items: a bullet, or a number, a letter or a Roman number, in brackets or before a stop, and
    white space.
    """
    kind = _characters().kind[opening]
    space, digit = (kind & _SPACE) > 0, (kind & _DIGIT) > 0
    letter = (opening < 128) & ((kind & _WORD) > 0) & ~digit
    roman = np.isin(opening, [ord(c) for c in "ivxIVX"])
    stop = np.isin(opening, [ord(c) for c in ".)"])
    out = np.isin(opening[:, 0], [ord(c) for c in BULLETS]) & space[:, 1]
    for at, fits in ((0, np.ones(len(opening), bool)), (1, opening[:, 0] == ord("("))):
        for size in range(1, 6):
            end = at + size
            mark = roman[:, at:end].all(1) | ((size <= 3) & digit[:, at:end].all(1)) | ((size == 1) & letter[:, at])
            out |= fits & mark & stop[:, end] & space[:, end + 1]
    return out


@dataclass
class States:
    """States of texts or chunks, a row each: counts of the complete lines, the opening line and, where there is a
    line end, the closing one.
    """

    counts: np.ndarray
    head: Lines
    tail: Lines
    open: np.ndarray  # no line end: head is all there is

    def __getitem__(self, rows) -> States:
        return States(self.counts[rows], self.head[rows], self.tail[rows], self.open[rows])


def _stack(a: States, b: States) -> States:
    rows = lambda x, y: Lines(
        **{f.name: np.concatenate((getattr(x, f.name), getattr(y, f.name))) for f in fields(Lines)}
    )
    return States(
        np.concatenate((a.counts, b.counts)), rows(a.head, b.head), rows(a.tail, b.tail),
        np.concatenate((a.open, b.open))
    )


def chunk_states(chunks: list[str]) -> States:
    """The states of the chunks."""
    known = _characters()
    codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
    known.learn(codes)
    kind = known.kind[codes]
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    begin = np.cumsum(size) - size
    # segments: the pieces of each chunk between line ends
    breaks = np.flatnonzero(kind & _BREAK)
    before = np.searchsorted(breaks, np.stack((begin, begin + size)))
    number = before[1] - before[0] + 1
    first = np.cumsum(number) - number
    last = first + number - 1
    inner = np.ones(number.sum(), bool)
    inner[first] = False
    start = np.empty(len(inner), np.int64)
    start[first], start[inner] = begin, breaks + 1
    inner[:] = True
    inner[last] = False
    end = np.empty(len(inner), np.int64)
    end[last], end[inner] = begin + size, breaks
    edge = np.zeros(len(codes) + 1, bool)
    edge[start] = edge[end] = True
    total = lambda flags: _sums(flags, start, end)
    # words
    word = (kind & _WORD) > 0
    w0, w1 = _runs(word, edge)
    w_size = w1 - w0
    common = np.zeros(len(codes) + 1, bool)
    common[w0] = _is_common(_window(codes, w0, w_size, _EDGE), w_size)
    is_start = np.zeros(len(codes) + 1, bool)
    is_start[w0] = True
    # white space; a run between other characters is a gap if it is long or has a tab
    space = (kind & _SPACE) > 0
    blank = space & ((kind & _BREAK) == 0)
    tabs = np.concatenate(([0], np.cumsum((kind & _TAB) > 0)))
    s0, s1 = _runs(blank, edge)
    gap = np.zeros(len(codes) + 1, bool)
    gap[s0] = ~edge[s0] & ~edge[s1] & ((s1 - s0 >= 3) | (tabs[s1] > tabs[s0]))
    shown = np.flatnonzero(~space)
    at = np.searchsorted(shown, start)
    nonspace = np.searchsorted(shown, end) - at
    has = nonspace > 0
    look = lambda i: shown[np.where(has, i, 0)] if len(shown) else np.zeros(len(i), np.int64)
    begins, ends = np.where(has, look(at), end), np.where(has, look(at + nonspace - 1) + 1, end)
    # words at the edges
    long = end > start
    flag = np.concatenate((word, [False]))
    w_at = np.searchsorted(w0, start)
    get = lambda values, i: values[
        np.minimum(np.maximum(i, 0), len(values) - 1)
    ] if len(values) else np.zeros(len(i), np.int64)
    left = np.where(long & flag[np.where(long, start, -1)], get(w_size, w_at), 0)
    one = (left == end - start) & long
    right = np.where(long & ~one & flag[np.where(long, end - 1, -1)], get(w_size, np.searchsorted(w0, end) - 1), 0)
    edges = (left > 0).astype(np.int64) + (right > 0)
    left_word, right_word = _window(codes, start, left, _EDGE), _window(codes, end - right, right, _EDGE)
    lines = Lines(
        chars=end - start, nonspace=nonspace, words=total(is_start) - edges, word_chars=total(word) - left - right,
        common=total(common) - _is_common(left_word, left) - _is_common(right_word, right),
        bars=total((kind & _BAR) > 0), gaps=total(gap), commas=total((kind & _COMMA) > 0),
        last=np.where(has, codes[np.maximum(ends - 1, 0)] if len(codes) else 0, 0),
        lead=begins - start, lead_tab=tabs[begins] > tabs[start], trail=end - ends, trail_tab=tabs[end] > tabs[ends],
        left_size=left, right_size=np.where(one, -1, right), opening=_window(codes, begins, end - begins, _OPENING),
        left=left_word, right=right_word,
    )
    # complete lines: all but the first and last of each chunk
    closed = np.ones(len(inner), bool)
    closed[first] = closed[last] = False
    rows = np.flatnonzero(closed)
    done = np.concatenate((np.zeros((1, len(COUNTS)), np.int64), np.cumsum(lines[rows].counts(), 0)))
    counts = done[np.searchsorted(rows, last)] - done[np.searchsorted(rows, first)]
    return States(counts, lines[first], lines[last], number == 1)


def _runs(flags: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``flags`` that do not go over an ``edge``."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = flags.copy(), flags.copy()
    starts[1:] &= ~flags[:-1] | edge[1:-1]
    ends[:-1] &= ~flags[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[end] - sums[start]


def merge(a: States, b: States) -> States:
    """The states of the rows of ``a``, each with the row of ``b`` that follows it."""
    seam = a.head.where(a.open, a.tail).join(b.head)
    closes = ~a.open & ~b.open
    counts = a.counts + b.counts + np.where(closes[:, None], seam.counts(), 0)
    return States(counts, seam.where(a.open, a.head), seam.where(b.open, b.tail), a.open & b.open)


def merge_texts(states: States, text: np.ndarray) -> tuple[States, np.ndarray]:
    """One state per text: rounds merge all pairs of neighbours (chunks 2i and 2i + 1 of a text) at once.  ``text``
    numbers the texts and rises.
    """
    while True:
        fresh = np.concatenate(([True], text[1:] != text[:-1]))
        if fresh.all():
            return states, text
        place = np.arange(len(text)) - np.maximum.accumulate(np.where(fresh, np.arange(len(text)), 0))
        left = np.flatnonzero((place % 2 == 0) & ~np.concatenate((fresh[1:], [True])))
        kept = np.flatnonzero(place % 2 == 0)
        merged = _stack(merge(states[left], states[left + 1]), states[np.setdiff1d(kept, left)])
        order = np.argsort(np.concatenate((left, np.setdiff1d(kept, left))), kind="stable")
        states, text = merged[order], text[kept]


def finish(states: States) -> np.ndarray:
    """Counts of the texts whose states these are."""
    return states.counts + states.head.counts() + np.where(states.open[:, None], 0, states.tail.counts())


def text_counts(text: str) -> list[int]:
    """Counts of one text."""
    return finish(chunk_states([text]))[0].tolist()


def block_counts(document_blocks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc, block_uid, field (0: raw_content, 1: markdown_result) and COUNTS, a row for each text of each delivery.

    The JVM cuts every text into chunks, a row each; a task counts the chunks of a
    batch, merges those of a text in rounds, and carries the state of the text
    that is still open over to its next batch.  Nothing is shuffled, and what a
    task holds does not grow with the length of a text.  Null and empty texts
    count nothing.
    """
    source = document_blocks.select(
        "doc", "block_uid", F.col("raw_content").alias("raw"), F.col("markdown_result").alias("markdown")
    )
    cut = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    texts = source.select(
        "doc", "block_uid", F.posexplode(F.array(cut(F.col("raw")), cut(F.col("markdown")))).alias("field", "chunks")
    )
    pieces = texts.select("doc", "block_uid", "field", F.posexplode_outer("chunks").alias("chunk_no", "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = keys = None  # the open text
        for batch in batches:
            texts = [p or "" for p in batch.column(4).to_pylist()]
            fresh = np.array([not n for n in batch.column(3).to_pylist()], bool)
            table = pa.Table.from_batches([batch.select([0, 1, 2])])
            for a, b in _slabs(texts):
                now, _ = merge_texts(chunk_states(texts[a:b]), np.cumsum(fresh[a:b]))
                begun = table.take(pa.array(np.flatnonzero(fresh[a:b]) + a))
                if not fresh[a]:
                    state, now = merge(state, now[:1]), now[1:]
                # all but the last text are at their end
                if state is not None and begun.num_rows:
                    now, begun = _stack(state, now), pa.concat_tables([keys, begun])
                if begun.num_rows:
                    yield from _output(begun.slice(0, begun.num_rows - 1), now[:-1])
                    state, keys = now[-1:], begun.slice(begun.num_rows - 1)
        if state is not None:
            yield from _output(keys, state)

    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return pieces.mapInArrow(
        run,
        f"doc {types['doc']}, block_uid {types['block_uid']}, field int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    )


def _slabs(chunks: list[str]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, chunk in enumerate(chunks):
        chars += len(chunk)
        if chars >= SLAB:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(chunks):
        yield start, len(chunks)


def _output(keys: pa.Table, states: States) -> Iterator[pa.RecordBatch]:
    counts = finish(states)
    for name, column in zip(COUNTS, counts.T):
        keys = keys.append_column(name, pa.array(np.ascontiguousarray(column)))
    yield from keys.combine_chunks().to_batches()


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def document_stats(document_blocks: DataFrame, chunk: int = CHUNK, salts: int = 16) -> DataFrame:
    """Statistics of each doc over its raw_content (``raw_``) and its markdown_result (``markdown_``), and ``kind``.

    words; mean_word_length (letters and digits in a word); symbol_share (of the
    characters that are no white space); punct_line_share (of the lines that are
    not blank); common_share (of the words).  Ratios over nothing are null.
    ``kind`` by the raw text: ``prose`` where at least half of its characters
    stand in lines of prose, else the largest of ``table``, ``list`` and
    ``junk``; ``empty`` without any characters.  Null and empty texts add
    nothing; a repeated delivery counts once; a null doc is a doc of its own.
    A document that holds most rows is summed in ``salts`` parts first.
    """
    counts = block_counts(document_blocks, chunk).dropDuplicates(["block_uid", "field"])
    names = [(f, c) for f in ("raw", "markdown") for c in COUNTS]
    part = counts.groupBy("doc", F.pmod("block_uid", F.lit(salts)).alias("salt")).agg(
        *[
            F.sum(F.when(F.col("field") == int(f == "markdown"), F.col(c)).otherwise(0)).alias(f"{f}_{c}") for f,
            c in names
        ]
    )
    doc = part.groupBy("doc").agg(*[F.sum(f"{f}_{c}").alias(f"{f}_{c}") for f, c in names])
    out = [F.col("doc")]
    for f in ("raw", "markdown"):
        col = lambda c, f=f: F.col(f"{f}_{c}")
        out += [
            col("words"), _ratio(col("word_chars"), col("words")).alias(f"{f}_mean_word_length"),
            _ratio(col("nonspace") - col("word_chars"), col("nonspace")).alias(f"{f}_symbol_share"),
            _ratio(col("punct_lines"), col("lines")).alias(f"{f}_punct_line_share"),
            _ratio(col("common"), col("words")).alias(f"{f}_common_share"),
        ]
    prose, tab, lst, junk = (F.col(f"raw_{c}_chars") for c in ("prose", "table", "list", "junk"))
    total = prose + tab + lst + junk
    kind = F.when(total == 0, "empty").when(prose * 2 >= total, "prose").when(
        (tab >= lst) & (tab >= junk), "table"
    ).when(lst >= junk, "list").otherwise("junk")
    return doc.select(
        *out, *[_ratio(F.col(f"raw_{c}_chars"), total).alias(f"{c}_share") for c in ("prose", "table", "list", "junk")],
        kind.alias("kind")
    )


def found(document_blocks: DataFrame) -> DataFrame:
    """doc and kind of the docs whose text is mostly list, table or junk."""
    return document_stats(document_blocks).where(F.col("kind").isin("list", "table", "junk")).select("doc", "kind")
