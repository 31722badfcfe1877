"""Reading level of documents: a familiar-word formula over a list that the corpus itself gives.

A word is familiar if at least a set share of the documents of its language has
it.  A document's difficulty is a weighted sum of the share of its words outside
that list and of its average sentence length; two thresholds on it give the
level.  Weights and thresholds start from those of the classic formula and move
with the labelled documents (a bounded sample of them), few or many.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.scale import cut

LEVELS = ("low", "mid", "high")
WORDS = r"\p{L}[\p{L}\p{M}]*+(?:-[\p{L}\p{M}]++)*+"
#: Letters that Vietnamese has and English has not.
VIETNAMESE = "ăâđêôơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ"
#: Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = r"e\.g|i\.e|No|no|Nr|vol|ver|vs|cf|Fig|Figs|Eq|Sec|Ch|pp|p|ed|eds|al|ca|approx|Dr|Mr|Mrs|Ms|Prof|St|Jr|vd|tr|VD|TS|ThS|GS|PGS|TP|Tp|tp"


#: Weights of the classic familiar-word formula (share of unfamiliar words, words in a sentence), and
#: the difficulties at which a text stops being low and starts being high.
CLASSIC = (15.79, 0.0496, 3.65, 6.6)
#: How far labels may move each of them (standard deviations of the prior), first those of all languages, then those
#: of one.
MOVES = ((30.0, 1.0, 20.0, 20.0), (15.0, 0.5, 10.0, 10.0))


@dataclass(frozen=True)
class Settings:
    #: A familiar word stands in at least this share of the documents of its language.  The list has at most (words of
    #: a document / share) words, so what is kept in memory is bounded whatever the corpus.
    familiar: float = 0.3
    #: At most this many labelled documents are used for the fit.
    max_labels: int = 2000
    #: Prose has so many words, in sentences of so many words on average, so large a share of them in lines of prose,
    #: not more than that share outside the list, and so many different ones (over the root of their number; a few
    #: words over and over are none).
    least_words: int = 40
    least_sentence: float = 5.0
    least_prose: float = 0.5
    most_unknown: float = 0.72
    least_variety: float = 1.0


def language(text: Column) -> Column:
    """``vi`` where more than one in fifty characters is a Vietnamese letter, else ``en``."""
    letters = F.length(text) - F.length(F.translate(F.lower(text), VIETNAMESE, ""))
    return F.when(letters * 50 > F.length(text), "vi").otherwise("en")


def familiar_words(documents: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """lang, word: the words that at least the share ``familiar`` of the documents of the language with
    ``least_words`` words and more have.
    """
    texts = documents.where(F.col(text_col).isNotNull()).select(
        language(F.col(text_col)).alias("lang"), F.regexp_extract_all(F.lower(text_col), F.lit(WORDS), 0).alias("words")
    )
    # the empty word counts the documents; a filter on the words would be pushed below them and find them twice
    long = F.when(F.size("words") >= settings.least_words, F.array_distinct(F.concat("words", F.array(F.lit("")))))
    each = texts.select("lang", F.explode(long).alias("word"))
    counts = cut(each.groupBy("lang", "word").agg(F.count("*").alias("n")))
    total = counts.where(F.col("word") == "").select("lang", F.col("n").alias("total"))  # two rows
    return counts.where(F.col("word") != "").join(F.broadcast(total), "lang").where(
        F.col("n") >= settings.familiar * F.col("total")
    ).select("lang", "word")


class Reader:
    """Features of one text."""

    def __init__(self, familiar: dict[str, frozenset[str]], settings: Settings):
        import regex

        self.settings = settings
        self.familiar = familiar
        self.all_words = regex.compile(WORDS).findall
        # the same words in texts of Latin letters whose lower case is one too, and common punctuation (no marks)
        latin = "A-Za-zªµºÀ-ÖØ-öø-ɏḀ-ỿ"
        self.latin_words = re.compile(f"[{latin}]+(?:-[{latin}]+)*").findall
        self.other = re.compile("[^\x00-įı-ſƠơƯưḀ-ỿ\u2000-\u2064]").search
        self.words = self.all_words
        self.letter = regex.compile(r"\p{L}").search
        self.sentence = regex.compile(rf"(?<=[.!?…])(?<!\b(?:{ABBREVIATIONS})\.)[\"')\]]*\s+(?=[\p{{Lu}}\"'(])").split
        self.item = regex.compile(r"\s*(?:[•◦▪*+–-]|\(?(?:\d{1,3}|[A-Za-z]|[ivx]{1,4})[.)])\s").match
        self.lines = regex.compile(r"\r\n?|[\n  ]").split
        self.end = regex.compile(r"[.!?…]").search
        self.vi = re.compile(f"[{VIETNAMESE}]").findall
        self.signs = re.compile(r"[^\w\s]").findall  # and the underscore

    def _prose(self, line: str) -> bool:
        shown = len(line) - line.count(" ") - line.count("\t")
        signs = len(self.signs(line)) + line.count("_")
        if line[0] == "#" or line.count("|") >= 2 or (signs > 0.2 * shown and shown > 8) or self.item(line):
            return False
        if "\t" in line and len(self.words(line)) < 4 * (line.count("\t") + 1):
            return False  # cells; tabs between long pieces are only blanks
        return not (line.count(",") >= 2 and not self.end(line) and len(self.words(line)) < 9)

    def paragraphs(self, text: str) -> tuple[list[str], int]:
        """Lines of prose, joined where the next goes on in lower case, and the number of words in other lines."""
        out: list[str] = []
        fresh, others = True, 0
        for line in self.lines(text):
            line = line.strip()
            if not line:
                fresh = True
            elif self._prose(line):
                if not fresh and line[0].islower():
                    out[-1] += " " + line
                else:
                    out.append(line)
                fresh = False
            else:
                others += len(self.words(line))
        return out, others

    def features(self, text: str | None) -> tuple[str, int, bool, float, float] | None:
        """``(lang, words, is prose, share of words outside the list, average sentence length)``; null for a text
        without words.
        """
        if not text:
            return None
        self.words = self.all_words if self.other(text) else self.latin_words
        paragraphs, total = self.paragraphs(text)
        lang = "vi" if not text.isascii() and len(self.vi(text.lower())) * 50 > len(text) else "en"
        known = self.familiar.get(lang, frozenset()).__contains__
        number = words = familiar = 0
        different: set[str] = set()
        for paragraph in paragraphs:
            found = self.words(paragraph.lower())
            if found:
                words += len(found)
                familiar += sum(map(known, found))
                different.update(found)
                number += sum(1 for sentence in self.sentence(paragraph) if self.letter(sentence))
        total += words
        if not total:
            return None
        s = self.settings
        if not words:
            return lang, total, False, 1.0, 0.0
        unknown, length = 1 - familiar / words, words / number
        prose = total >= s.least_words and words >= s.least_prose * total and length >= s.least_sentence
        prose = prose and unknown <= s.most_unknown and len(different) >= s.least_variety * words**0.5
        return lang, total, prose, unknown, length


@dataclass(frozen=True)
class Formula:
    """Weights of the two features and the two thresholds, by language (``vi`` or not)."""

    weights: dict[bool, np.ndarray]

    def difficulty(self, rows: np.ndarray, vietnamese: np.ndarray) -> np.ndarray:
        """Weighted sum for each row (share of unfamiliar words, sentence length)."""
        return np.where(vietnamese, rows @ self.weights[True][:2], rows @ self.weights[False][:2])

    def predict(self, rows: np.ndarray, vietnamese: np.ndarray) -> np.ndarray:
        z = self.difficulty(rows, vietnamese)
        return sum(
            (z > np.where(vietnamese, self.weights[True][i], self.weights[False][i])).astype(int) for i in (2, 3)
        )


def fit(rows: np.ndarray, vietnamese: np.ndarray, level: np.ndarray) -> Formula:
    """The formula after the labels, for any number of them (none leaves it classic): all languages together from the
    classic weights, then each language from those of all.
    """
    both = _moved(rows, level, np.array(CLASSIC), np.array(MOVES[0]))
    return Formula(
        {vi: _moved(rows[vietnamese == vi], level[vietnamese == vi], both, np.array(MOVES[1])) for vi in (False, True)}
    )


def _moved(rows: np.ndarray, level: np.ndarray, start: np.ndarray, moves: np.ndarray, steps: int = 60) -> np.ndarray:
    """Most likely weights and thresholds of two logistic cuts of one sum, near ``start``: Newton steps on a concave
    function, so deterministic.
    """
    x = np.concatenate(
        [np.column_stack([rows, -(k == 0) * np.ones(len(rows)), -(k == 1) * np.ones(len(rows))]) for k in (0, 1)]
    ) * moves
    y = np.concatenate([level > 0, level > 1]).astype(float)
    delta = np.zeros(4)
    base = x @ (start / moves)

    def loss(d: np.ndarray) -> float:
        z = base + x @ d
        return float(np.logaddexp(0, z).sum() - y @ z + d @ d / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(base + x @ delta, -500, 500)))
        gradient = x.T @ (p - y) + delta
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(4), gradient)
        size, now = 1.0, loss(delta)
        while loss(delta - size * step) > now and size > 1e-6:
            size /= 2
        delta = delta - size * step
        if np.abs(step).max() < 1e-9:
            break
    out = start + moves * delta
    out[2:] = np.sort(out[2:])
    return out


_FEATURES = "lang string, n_words int, is_prose boolean, unknown double, sentence_length double, difficulty double"


def document_features(
    documents: DataFrame, familiar: dict[str, frozenset[str]], settings: Settings = Settings(),
    formula: Formula | None = None
) -> DataFrame:
    """doc_id, lang, n_words, is_prose, unknown (share of words outside the list), sentence_length, and with
    ``formula`` difficulty and level (both null where it is no prose).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(familiar, settings)
        for batch in batches:
            found = [reader.features(t) or ("en", 0, False, 0.0, 0.0) for t in batch.column(1).to_pylist()]
            cols = list(zip(*found)) if found else [[]] * 5
            rows, prose, vietnamese = np.array(cols[3:5], float).T.reshape(len(found), 2), np.array(cols[2], bool), np.array(
                [c == "vi" for c in cols[0]], bool
            )
            shown = prose & (formula is not None)
            difficulty, level = (
                formula.difficulty(rows, vietnamese), formula.predict(rows, vietnamese)
            ) if formula else (np.zeros(len(found)), np.zeros(len(found), int))
            arrays = [
                pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.bool_(), pa.float64(), pa.float64()))
            ]
            arrays += [
                pa.array(difficulty, pa.float64(), mask=~shown),
                pa.array([LEVELS[i] for i in level], pa.string(), mask=~shown)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays],
                ["doc_id", "lang", "n_words", "is_prose", "unknown", "sentence_length", "difficulty", "level"]
            )

    source = documents.select("doc_id", "text")
    return source.mapInArrow(
        run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {_FEATURES}, level string"
    )


def levels(documents: DataFrame, level_labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The features of every document, its difficulty and its estimated level.

    Null, empty and blank texts, texts under ``least_words`` words and texts that
    are not running prose have a null level.  Labels of unknown documents, with a
    null or an unknown level, are left out; of two labels of one document the
    alphabetically first counts.  Without labels the classic formula decides.  The
    list of familiar words (bounded, see Settings) and the formula are sent to the
    tasks.
    """
    words: dict[str, set[str]] = {}
    for row in familiar_words(documents, settings).collect():  # bounded by the share
        words.setdefault(row["lang"], set()).add(row["word"])
    familiar = {lang: frozenset(w) for lang, w in words.items()}
    labels = level_labels.where(F.col("level").isin(*LEVELS)).groupBy("doc_id").agg(F.min("level").alias("label"))
    labels = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_labels)
    sample = document_features(
        documents.join(labels.select("doc_id"), "doc_id", "left_semi"), familiar, settings
    ).where("is_prose").join(labels, "doc_id")
    rows = sample.select("lang", "unknown", "sentence_length", "label", "doc_id").collect()  # at most max_labels
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([[r["unknown"], r["sentence_length"]] for r in rows], float).reshape(len(rows), 2)
    formula = fit(
        x, np.array([r["lang"] == "vi" for r in rows], bool), np.array([LEVELS.index(r["label"]) for r in rows], int)
    )
    return document_features(documents, familiar, settings, formula)


def found(documents: DataFrame, level_labels: DataFrame) -> DataFrame:
    """doc_id and level of the documents of low or high level."""
    return levels(documents, level_labels).where(F.col("level").isin("low", "high")).select("doc_id", "level")
