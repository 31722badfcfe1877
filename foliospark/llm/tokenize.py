"""Token ids of a public byte-level BPE tokenizer, for whole tables of text.

The merges of many words run together: the symbols of all distinct words of an
Arrow batch lie in one flat array, and every round looks up the rank of each
neighbouring pair by binary search over the sorted pair keys, takes the lowest
rank of each word and merges it at all its places.  Words that are not done
after some rounds (very long ones) go on rank by rank, where only the pairs
beside a merge are looked up again.  A word is merged once per task, later uses
are array look-ups.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split pattern that goes with the byte-level vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_PAIR = np.iinfo(np.int32).max
#: Words kept merged per task before the memory is emptied (about 100 bytes each).
MEMORY_WORDS = 300_000
#: Longer words are merged but not kept.
MEMORY_WORD_CHARS = 64
#: Rounds over all symbols; a word takes as many as it has different ranks to merge, so most are done before.
ROUNDS = 48
#: Characters of text taken together in one round of merges.
BATCH_CHARS = 2_000_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file as installed; pass another path to the operators where it lies elsewhere."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary file: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BatchBpe:
    """Merges of a byte-level BPE vocabulary over flat arrays."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in _byte_symbols().items():
            self.byte_id[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.base = max(vocab.values()) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.known: dict[str, int] = {}
        self.store = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int32)
        self.words = self.used = 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge ``symbols`` of words of ``sizes`` (each at least 1) to the end; returns the flat ids and each word's
        number of ids.
        """
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word = np.arange(len(sizes))
        for done in itertools.count():
            if not len(word):
                break
            if done == ROUNDS:
                out.append((word, *self._by_rank(symbols, sizes)))
                break
            begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            rank = np.full(len(symbols), NO_PAIR, np.int32)
            inner = np.ones(len(symbols), bool)
            inner[begin + sizes - 1] = False  # no pair starts at a word's last symbol
            at = np.flatnonzero(inner)
            rank[at] = self._rank(symbols[at], symbols[at + 1])
            lowest = np.minimum.reduceat(rank, begin)
            live = lowest != NO_PAIR
            if not live.all():
                keep = np.repeat(live, sizes)
                out.append((word[~live], symbols[~keep], sizes[~live]))
                symbols, rank, word, sizes, lowest = symbols[keep], rank[keep], word[live], sizes[live], lowest[live]
                if not len(word):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # of overlapping hits (a pair of equal symbols in a run) every second one, from the left
            places = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(places) != 1))
            first = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - first) % 2 == 0]
            symbols[places] = self.merged[rank[places]]
            stay = np.ones(len(symbols), bool)
            stay[places + 1] = False
            sizes = np.add.reduceat(
                stay, np.concatenate(([0], np.cumsum(sizes)[:-1])), dtype=np.int64
            ).astype(sizes.dtype)
            symbols = symbols[stay]
        number = np.zeros(sum(len(w) for w, _, _ in out), np.int64)
        for w, _, n in out:
            number[w] = n
        offset = np.concatenate(([0], np.cumsum(number)))
        flat = np.zeros(offset[-1], np.int32)
        for w, ids, n in out:
            flat[_spread(offset[w], n)] = ids
        return flat, number

    def _by_rank(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges, rank after rank over all words: symbols are linked, and each rank has the places where its
        pair may stand.
        """
        n, ends = len(symbols), np.cumsum(sizes)
        word = np.repeat(np.arange(len(sizes)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[ends - sizes] = -1, -1
        rank = np.full(n, NO_PAIR, np.int32)
        at = np.flatnonzero(after >= 0)
        rank[at] = self._rank(symbols[at], symbols[at + 1])
        order = np.argsort(rank, kind="stable")
        order = order[rank[order] != NO_PAIR]
        begin = np.flatnonzero(np.diff(rank[order], prepend=-1))
        places = {int(rank[part[0]]): [part] for part in np.split(order, begin[1:]) if len(part)}
        queue = list(places)
        heapq.heapify(queue)
        alive = np.ones(n, bool)
        while queue:
            lowest = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            # of overlapping places (a pair of equal symbols in a run) every second one, from the left
            fresh = np.concatenate(([True], after[at[:-1]] != at[1:]))
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            gone = after[at]
            symbols[at] = self.merged[lowest]
            alive[gone], rank[gone] = False, NO_PAIR
            after[at] = after[gone]
            follow = after[at] >= 0
            before[after[at][follow]] = at[follow]
            rank[at] = NO_PAIR
            left = before[at]
            left = left[left >= 0]
            touched = np.unique(np.concatenate((at[follow], left)))
            rank[touched] = self._rank(symbols[touched], symbols[after[touched]])
            for r, i in zip(rank[touched].tolist(), touched.tolist()):
                if r != NO_PAIR:
                    if r not in places:
                        places[r] = []
                        heapq.heappush(queue, r)
                    places[r].append(np.array([i]))
        return symbols[alive], np.bincount(word[alive], minlength=len(sizes))

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, number = self.merge(self.byte_id[np.frombuffer(b"".join(raw), np.uint8)], sizes)
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate((self.store, np.zeros_like(self.store)))
        while self.words + len(words) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
        self.store[self.used : self.used + len(ids)] = ids
        self.starts[self.words : self.words + len(words)] = self.used + np.cumsum(number) - number
        self.sizes[self.words : self.words + len(words)] = number
        self.words += len(words)
        self.used += len(ids)

    def encode(self, texts: list[str | None], count_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of ``texts`` and the number of ids of each; null and empty texts have none."""
        if self.words > MEMORY_WORDS:
            self.known.clear()
            self.words = self.used = 0
        known, new, index, per_text = self.known, [], [], np.zeros(len(texts), np.int64)
        passing: list[str] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            words = self.split(text)
            per_text[i] = len(words)
            for w in words:
                at = known.get(w)
                if at is None:
                    at = known[w] = self.words + len(new)
                    new.append(w)
                    if len(w) > MEMORY_WORD_CHARS:
                        passing.append(w)
                index.append(at)
        if new:
            self._learn(new)
        for w in passing:
            del known[w]
        uses = np.array(index, np.int64)
        sizes = self.sizes[uses]
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        ends = np.cumsum(per_text)
        number = total[ends] - total[ends - per_text]
        if count_only:
            return np.zeros(0, np.int32), number
        return self.store[_spread(self.starts[uses], sizes)], number


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + size - 1`` of every run, one after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars > BATCH_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_table(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, count_only: bool = False,
    keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col``, the columns ``keep`` and ``ids`` (array<int>), or with ``count_only`` ``n_tokens`` (bigint), of
    every row, without special tokens.

    Null and empty texts give an empty list (0 tokens); text that spells a special
    token is ordinary text; rows are kept one to one, repeated ids and null ids
    included; an empty table gives an empty table.  Other columns are dropped.
    No shuffle: each task encodes its own rows, and its memory is bounded by
    ``BATCH_CHARS``, ``MEMORY_WORDS`` and the longest single text.
    """
    where = path or vocabulary_path()
    kept = [f"c{i}" for i in range(len(keep) + 1)]
    df = df.select(
        F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip((id_col, *keep), kept)]
    )
    types = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or BatchBpe(where)
            texts = batch.column(0).to_pylist()
            for a, b in _slices(texts):
                flat, number = bpe.encode(texts[a:b], count_only)
                if count_only:
                    out = pa.array(number, pa.int64())
                else:
                    offsets = np.concatenate(([0], np.cumsum(number))).astype(np.int32)
                    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns[1:]], out], [*kept, "ids"])

    kind = "bigint" if count_only else "array<int>"
    out = df.mapInArrow(run, f"{types}, ids {kind}")
    return out.select(
        *[F.col(k).alias(c) for c, k in zip((id_col, *keep), kept)],
        F.col("ids").alias("n_tokens" if count_only else "ids")
    )
