"""A classifier chain: linear models predict toxicity categories in turn, each fed the earlier categories' probabilities."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words

BITS = 18
#: About this many labelled rows of each class are drawn for training; a model keeps this many features.
ROWS_PER_CLASS, FEATURES, FOLDS = 3000, 20_000, 5
EPOCHS, RATE, DECAY = 120, 0.3, 1e-3
#: The threshold is the one with the best share of toxic rows caught less ALARM times the share of clean rows hit.
ALARM = 10.0
PREFIXES = (4, 5, 6, 7, 8)
#: Categories before the last: kinds of toxic text, as they cluster. Rounds of clustering; a row is of a kind if it is
#: nearer to that centre than to the others by this share.
KINDS, ROUNDS, CLEAR = 2, 12, 1.1
CHAIN = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each word of letters and of its beginnings, with repeats."""
    starts, ends, first = words.word_spans(data, offsets, words.NOT_LETTERS)
    hashed = words.span_hasher(data)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    kinds = [hashed(starts, ends)]
    rows = [row]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        kinds.append(words.mixed(hashed(starts[long], starts[long] + k) + np.uint64(k)))
        rows.append(row[long])
    return np.concatenate(rows), (np.concatenate(kinds) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Logistic regression on sets of hashed features and a few dense inputs; shift moves a balanced sample's odds to the corpus'."""

    at: np.ndarray  # feature -> weight, 0 where not kept
    dense: np.ndarray
    bias: float

    @classmethod
    def fit(cls, row: np.ndarray, feature: np.ndarray, dense: np.ndarray, label: np.ndarray, use: np.ndarray, keep: int = FEATURES) -> Linear:
        """row, feature: distinct pairs; use: the rows to learn from."""
        mine = use[row]
        row, feature = row[mine], feature[mine]
        n = [max(1, int((use & (label == c)).sum())) for c in (0, 1)]
        seen = [np.bincount(feature[label[row] == c], minlength=1 << BITS) for c in (0, 1)]
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        worth = np.abs(odds) * (seen[0] + seen[1] >= 2)
        top = np.argsort(-worth, kind="stable")[:keep]
        top = top[worth[top] > 1.0]
        place = np.full(1 << BITS, -1, np.int64)
        place[top] = np.arange(len(top))
        hit = place[feature] >= 0
        row, column = row[hit], place[feature[hit]]
        size = len(label)
        w, d, bias = np.zeros(len(top)), np.zeros(dense.shape[1]), 0.0
        square = [np.full(len(top), 1e-8), np.full(len(d), 1e-8), 1e-8]
        active = use.astype(float)
        for _ in range(EPOCHS):
            gap = (_logistic(np.bincount(row, w[column], size) + dense @ d + bias) - label) * active / max(1.0, active.sum())
            steps = [np.bincount(column, gap[row], len(top)) + DECAY * w, dense.T @ gap + DECAY * d, gap.sum()]
            for s, g in zip((0, 1, 2), steps, strict=True):
                square[s] = square[s] + g * g
            w = w - RATE * steps[0] / np.sqrt(square[0])
            d = d - RATE * steps[1] / np.sqrt(square[1])
            bias -= RATE * steps[2] / math.sqrt(square[2])
        at = np.zeros(1 << BITS)
        at[top] = w
        return cls(at, d, float(bias))

    def logit(self, row: np.ndarray, feature: np.ndarray, dense: np.ndarray, size: int) -> np.ndarray:
        """row, feature may repeat pairs; each counts once."""
        some = np.flatnonzero(self.at[feature])
        pair = np.unique(row[some].astype(np.int64) << BITS | feature[some])
        return np.bincount(pair >> BITS, self.at[pair & ((1 << BITS) - 1)], size) + dense @ self.dense + self.bias


@dataclass
class Chain:
    names: tuple[str, ...]
    models: list[Linear]
    shift: float
    threshold: float

    @classmethod
    def fit(cls, row: np.ndarray, feature: np.ndarray, labels: np.ndarray, names: tuple[str, ...], shift: float = 0.0, fold: np.ndarray | None = None) -> Chain:
        """labels: rows x categories; fold: the fold of each row, the same for copies of a text.

        Later models learn from out-of-fold predictions of the earlier ones; those of the last set the threshold.
        """
        pair = row.astype(np.int64) << BITS | feature
        if (np.diff(pair) <= 0).any():
            pair = np.unique(pair)
        row, feature = (pair >> BITS).astype(np.int32), (pair & ((1 << BITS) - 1)).astype(np.int32)
        del pair
        size = len(labels)
        fold = np.arange(size) % FOLDS if fold is None else fold
        dense, models, honest = np.zeros((size, 0)), [], np.zeros(size)
        for k in range(labels.shape[1]):
            label = labels[:, k].astype(float)
            honest = np.zeros(size)
            for f in range(FOLDS):
                part = Linear.fit(row, feature, dense, label, fold != f)
                own = fold[row] == f
                honest[fold == f] = part.logit(row[own], feature[own], dense, size)[fold == f]
            models.append(Linear.fit(row, feature, dense, label, np.ones(size, bool)))
            dense = np.column_stack([dense, _logistic(honest)])
        return cls(names, models, shift, _threshold(_logistic(honest + shift), labels[:, -1] if labels.size else np.zeros(size, bool)))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities, rows x categories."""
        row, feature = features(data, offsets)
        size = len(offsets) - 1
        dense, out = np.zeros((size, 0)), []
        for model in self.models:
            logit = model.logit(row, feature, dense, size)
            dense = np.column_stack([dense, _logistic(logit)])
            out.append(_logistic(logit + self.shift))
        return np.column_stack(out)


def _threshold(p: np.ndarray, toxic: np.ndarray) -> float:
    """Midway between the probabilities of the best cut and of the row below it; 0.5 without both classes."""
    toxic = toxic.astype(bool)
    if toxic.all() or not toxic.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, toxic = p[order], toxic[order]
    worth = np.cumsum(toxic) / toxic.sum() - ALARM * np.cumsum(~toxic) / (~toxic).sum()
    worth[:-1][p[:-1] == p[1:]] = -np.inf  # equal probabilities aren't cut apart
    best = int(worth.argmax())
    return float(p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2


def kinds_of(row: np.ndarray, feature: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """rows x KINDS: of which kinds toxic rows are, found without any word list by clustering them (k-means on cosines).

    Features count by their log odds in toxic rows, so centres differ in what makes rows toxic. The first centre starts
    from the row least like the mean, each further one from the row least like the centres before. A row that is about
    as near to two centres is of no kind.
    """
    size, out = len(toxic), np.zeros((len(toxic), KINDS), bool)
    mine = toxic[row]
    if toxic.sum() < 2 * KINDS:
        return out
    seen = [np.bincount(feature[m], minlength=1 << BITS) for m in (mine, ~mine)]
    odds = np.log((seen[0] + 0.5) / (toxic.sum() + 1)) - np.log((seen[1] + 0.5) / ((~toxic).sum() + 1))
    use = mine & (odds[feature] > 1.0) & (seen[0][feature] >= 2)
    row, feature = row[use], feature[use]
    kept, column = np.unique(feature, return_inverse=True)
    value = odds[kept][column]
    value = value / np.sqrt(np.maximum(np.bincount(row, value**2, size), 1e-12))[row]
    some = np.flatnonzero(np.bincount(row, minlength=size))
    if len(some) < 2 * KINDS:
        return out

    def centre(rows: np.ndarray) -> np.ndarray:
        total = np.bincount(column, value * rows[row], len(kept))
        return total / max(1e-12, float(np.sqrt((total**2).sum())))

    near = lambda c: np.bincount(row, value * c[column], size)
    far = near(centre(np.ones(size)))
    centres: list[np.ndarray] = []
    for _ in range(KINDS):
        pick = np.zeros(size)
        pick[some[far[some].argmin()]] = 1
        centres.append(centre(pick))
        far = np.max([near(c) for c in centres], axis=0)
    for _ in range(ROUNDS):
        of = np.argmax([near(c) for c in centres], axis=0)
        member = np.zeros(size, bool)
        member[some] = True
        centres = [centre((member & (of == k)).astype(float)) if (member & (of == k)).any() else c for k, c in enumerate(centres)]
    close = np.stack([near(c) for c in centres], axis=1)
    for k in range(KINDS):
        others = np.delete(close, k, axis=1).max(axis=1, initial=0.0)
        out[:, k] = toxic & (close[:, k] > 0) & (close[:, k] >= CLEAR * others)
    return out


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Chain:
    """Fit on documents with a toxic label: about rows_per_class of each class, drawn by a hash of doc_id.

    What comes to the driver are the hashed features of this bounded sample. Labels that are null, or whose
    document is missing, are left out; a doc_id with both labels counts as toxic, and all its texts do. Without any
    toxic label every probability is that of a chain that has learned nothing. The categories before the last are kinds
    of toxic text (see kinds_of); folds go by the text, so copies share one. A model keeps FEATURES features.
    """
    marks = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    limit = lambda c: math.ceil(1_000_000 * min(1.0, rows_per_class / max(n.get(c, 0), 1)))
    drawn = marks.filter(part < F.when(F.col("toxic") == 1, limit(1)).otherwise(limit(0))).withColumnRenamed("doc_id", "__id")
    own = docs.select("doc_id", "text")
    sample = own.join(F.broadcast(drawn), own["doc_id"] == drawn["__id"]).select("text", (F.col("toxic") == 1).alias("toxic"), "doc_id", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(0)):
                row, feature = features(data, offsets)
                pair = np.unique(row << BITS | feature)
                first = np.searchsorted(pair >> BITS, np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pair & ((1 << BITS) - 1), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in (1, 2, 3)), lists], ["toxic", "doc_id", "fold", "features"])

    kind = own.schema["doc_id"].dataType.simpleString()
    got = map_arrow(sample, read, f"toxic boolean, doc_id {kind}, fold long, features array<int>").toArrow().sort_by([("doc_id", "ascending"), ("fold", "ascending")])
    toxic = got["toxic"].to_numpy().astype(bool)
    fold = got["fold"].to_numpy()
    lists = got["features"].combine_chunks()
    count = lists.value_lengths().to_numpy() if len(lists) else np.zeros(0, np.int64)
    row, feature = np.repeat(np.arange(len(toxic), dtype=np.int32), count), (lists.flatten().to_numpy() if len(lists) else np.zeros(0, np.int32))
    del got, lists
    kinds = np.column_stack([kinds_of(row, feature, toxic), toxic])
    corpus = math.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))
    return Chain.fit(row, feature, kinds, CHAIN, corpus - math.log((toxic.sum() + 1) / ((~toxic).sum() + 1)), fold)


def predict(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, p_<category> for each category of the chain, is_toxic (the last at the chain's threshold or more), for each row, from the whole text.

    A null or empty text has the probabilities of a text without known words. The chain (a few arrays of fixed
    size) is broadcast; other columns are not read.
    """
    box = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{x}" for x in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(1)):
                p = box.value.predict(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(p[:, k].copy()) for k in range(len(names))), pa.array(p[:, -1] >= box.value.threshold)], [key, *names, "is_toxic"])

    own = docs.select(key, text)
    kind = own.schema[key].dataType.simpleString()
    return map_arrow(own, run, f"{key} {kind}, {', '.join(f'{x} double' for x in names)}, is_toxic boolean")
