"""Language by words first: known words by per-language log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .shared import discard, held, staged, taken

#: For each language the model is fitted on about this many labelled rows, drawn by a hash (all, if there are fewer), and
#: keeps this many words and n-grams of each length.
TRAIN_ROWS, TRAIN_WORDS = 20_000, 100_000
LENGTHS = (4, 3, 2, 1)
#: Parts of the hash that draws rows.
DRAW = 1 << 40
SMOOTHING = 0.5
UNKNOWN = "und"
#: Words whose scores a worker remembers.
CACHE = 200_000
_WORD = re.compile(r"[^\W\d_]+")
#: Texts whose new words are scored together.
BATCH = 200


def _words(text: str) -> list[str]:
    """Runs of letters, lower-cased. What counts as a word character but is no letter (as ½ or Ⅷ) separates."""
    found = _WORD.findall(text.lower())
    if "".join(found).isalpha() or not found:
        return found
    return [x for word in found for x in "".join(c if c.isalpha() else " " for c in word).split()]


def _grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Table:
    """Text -> log frequency in each language; sent as one string and one array, which workers hold in little memory."""

    def __init__(self, texts: list[str], logs: np.ndarray):
        self.at, self.logs = {x: i for i, x in enumerate(texts)}, logs

    def __getstate__(self):
        return "\n".join(self.at), self.logs

    def __setstate__(self, state):
        texts, self.logs = state
        self.at = {x: i for i, x in enumerate(texts.split("\n"))} if texts else {}

    def __iter__(self) -> Iterator[str]:
        return iter(self.at)

    def __getitem__(self, text: str) -> list[float]:
        return self.logs[self.at[text]].tolist()

    def values(self) -> Iterator[list[float]]:
        return map(self.__getitem__, self.at)


@dataclass
class Model:
    """languages; words and grams[n]: text -> log frequency in each language."""

    languages: list[str]
    words: Table
    grams: dict[int, Table]

    @classmethod
    def fit(cls, counts: list[tuple[str, str, int]], grams: list[tuple[str, int, str, int]] | None = None) -> Model:
        """counts: (language, word, occurrences); grams: (language, length, n-gram, occurrences), by default those of counts."""
        languages = sorted({x[0] for x in counts})
        at = {x: i for i, x in enumerate(languages)}

        def table(pieces: Iterator[tuple[str, str, int]]) -> Table:
            place: dict[str, int] = {}
            cells = np.array([(place.setdefault(piece, len(place)), at[language], n) for language, piece, n in pieces], np.int64).reshape(-1, 3)
            found = np.zeros((len(place), len(languages)))
            np.add.at(found, (cells[:, 0], cells[:, 1]), cells[:, 2])
            return Table(list(place), np.log((found + SMOOTHING) / (found.sum(0) + SMOOTHING * len(found))))

        if grams is None:
            grams = [(language, n, g, c) for language, word, c in counts for n in LENGTHS for g in _grams(word, n)]
        return cls(languages, table(iter(counts)), {n: table((x, g, c) for x, m, g, c in grams if m == n) for n in LENGTHS})

    def score(self, word: str) -> list[float]:
        """Log frequency in each language: of the word, or else the mean of its known n-grams of the greatest n that has any."""
        if word in self.words.at:
            return self.words[word]
        for n in LENGTHS:
            known = self.grams[n]
            found = [i for g in _grams(word, n) if (i := known.at.get(g)) is not None]
            if found:
                return known.logs[found].mean(0).tolist()
        return [0.0] * len(self.languages)


class Scorer(dict):
    """Word -> row of an array of scores, filled as words come."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.table = model, np.zeros((1024, len(model.languages)))

    def learn(self, new: set[str]) -> None:
        """Score words (as Model.score does), all at once."""
        if len(self) + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(new)), self.table.shape[1]))])
        left, known = [], self.model.words.at
        for i, word in enumerate(new, len(self)):
            self[word] = i
            left.append(word)
        rows = {w: known[w] for w in left if w in known}
        self.table[[self[w] for w in rows]] = self.model.words.logs[list(rows.values())]
        left = [w for w in left if w not in rows]
        for n in LENGTHS:
            table, at, found, first, rest = self.model.grams[n], [], [], [], []
            for word in left:
                own = [i for g in _grams(word, n) if (i := table.at.get(g)) is not None]
                if own:
                    at.append(self[word])
                    first.append(len(found))
                    found += own
                else:
                    rest.append(word)
            if at:
                size = np.diff([*first, len(found)])
                self.table[at] = np.add.reduceat(table.logs[found], first, axis=0) / size[:, None]
            left = rest
        self.table[[self[w] for w in left]] = 0.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, their probabilities, and whether any piece of the text is known (else the language is a guess)."""
        names, sure, known = [], np.zeros(len(texts)), np.zeros(len(texts), bool)
        for a in range(0, len(texts), BATCH):
            lists = [_words(text) if text else [] for text in texts[a : a + BATCH]]
            if len(self) > CACHE:
                self.clear()
            self.learn(set().union(*lists).difference(self))
            for k, words in enumerate(lists, a):
                if not words or not self.model.languages:
                    names.append(UNKNOWN)
                    continue
                total = self.table[list(map(self.__getitem__, words))].sum(0)
                known[k] = total.any()
                best = int(total.argmax())
                names.append(self.model.languages[best])
                sure[k] = 1 / np.exp(total - total[best]).sum()
        return names, sure, known


def _top(counts: DataFrame, group: list[str], most: int) -> list[tuple]:
    """The rows of each group with the greatest n, at most so many; a group within that needs no order."""
    sizes = {tuple(r)[:-1]: r["count"] for r in counts.groupBy(*group).count().collect()}
    large = [k for k, n in sizes.items() if n > most]
    of = lambda k: reduce(and_, (F.col(c) == F.lit(v) for c, v in zip(group, k, strict=True)))
    small = counts.filter(~reduce(or_, (of(k) for k in large))) if large else counts
    rest = [c for c in counts.columns if c != "n"]
    parts = [small] + [counts.filter(of(k)).orderBy(F.desc("n"), *rest).limit(most) for k in large]
    return [r for part in parts for r in zip(*(c.to_pylist() for c in part.toArrow().columns), strict=True)]


def train(docs: DataFrame, rows: int = TRAIN_ROWS, words: int = TRAIN_WORDS, key: str = "doc_id") -> Model:
    """Fit on docs (key, text, lang); key only draws the sample, so that copies of a text are drawn apart. Rows with a null text or lang are left out. No rows give a model that knows nothing.

    rows and words bound what is drawn and kept for each language, so a language's part depends on no other and not
    on the size of the corpus. Words are counted over whole texts and n-grams over all these words, on the
    executors; only the kept counts come to the driver.
    """
    good = docs.select("text", "lang", key).filter("text is not null and lang is not null")
    there = good.groupBy("lang").count().filter(F.col("count") > rows).collect()
    drawn = F.pmod(F.xxhash64(key, F.when(F.col(key).isNull(), F.col("text"))), F.lit(DRAW))
    if there:
        shares = F.create_map(*(F.lit(x) for r in there for x in (r["lang"], math.ceil(DRAW * rows / r["count"]))))
        good = good.filter(drawn < F.coalesce(shares[F.col("lang")], F.lit(DRAW)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(_words(text)).items():
                    found[lang, word] += n
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for length in LENGTHS:
                    for gram in _grams(word, length):
                        found[lang, length, gram] += n
            keys = list(found)
            kinds = (pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], t) for i, t in enumerate(kinds)), pa.array(list(found.values()), pa.int64())], ["lang", "length", "gram", "n"])

    counts = map_arrow(good.select("text", "lang"), count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = staged(counts, "word-counts")
    grams = staged(map_arrow(counts, cut, "lang string, length int, gram string, n long").groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    model = Model.fit(_top(counts, ["lang"], words), _top(grams, ["lang", "length"], words))
    discard(counts, grams)
    return model


def _scorer(box, name: str) -> Scorer:
    return held(name, lambda: Scorer(taken(box)))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score (posterior probability, 0 to 1) for each row; only text decides.

    und with score 0 if the text is null, empty or has no letter; a text whose letters are all unknown gets
    the first language with the score of a guess. Whole texts count, however long. Equal texts get equal
    answers; other columns are not read.
    """
    box, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(box, name)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                names, sure, _ = scorer.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(sure)], [key, "lang_pred", "score"])

    own = docs.select(key, text)
    return map_arrow(own, run, f"{key} {own.schema[key].dataType.simpleString()}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, whose text has letters, some piece that the model knows, and a language sure to at least the given score.

    Null and empty texts go, as do texts whose letters are all unknown: their language would be a guess, whatever
    its score. Rows that repeat share a fate; all columns stay as they are; an empty table gives an empty one. A
    model that has learned nothing keeps nothing.
    """
    box, name, at = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(box, name)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                _, sure, known = scorer.predict(part.column(at).to_pylist())
                yield part.filter(pa.array(known & (sure >= least)))

    return map_arrow(docs, run, docs.schema)
