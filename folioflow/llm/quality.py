"""Importance resampling: hashed n-gram models of target and raw text, their ratio, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words
from .sharding import find_splitters
from .shared import staged

#: Buckets of the hashed uni- and bigrams; added to each count; about so many labelled target rows are used.
BUCKETS, SMOOTHING, TARGET_ROWS = 1 << 14, 1.0, 20_000


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each uni- and bigram in a row's order, first of each row and the end)."""
    one, first = words.word_hashes(data, offsets)
    two = words.mixed(one[:-1] * np.uint64(0xD1B54A32D192ED03) + one[1:])
    n = np.diff(first)
    count = 2 * n - (n > 0)
    at = np.zeros(len(first), np.int64)
    np.cumsum(count, out=at[1:])
    out = np.empty(at[-1], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    place = at[row] + np.arange(len(one)) - first[row]
    out[place] = one & np.uint64(BUCKETS - 1)
    inside = np.flatnonzero(row[:-1] == row[1:]) if len(one) else np.zeros(0, np.int64)
    out[place[inside] + n[row[inside]]] = two[inside] & np.uint64(BUCKETS - 1)
    return out, at


def log_ratios(docs: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket. docs: text, target (boolean); raw counts cover every row and whole text.

    Each task adds up its own counts, so what is shuffled has a fixed size for a task, and BUCKETS rows are collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            chosen = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in words.chunks(batch.column(0)):
                found, at = features(data, offsets)
                total[0] += np.bincount(found, minlength=BUCKETS)
                mine = np.repeat(chosen[a:b], np.diff(at))
                total[1] += np.bincount(found[mine], minlength=BUCKETS)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], ["bucket", "raw", "target"])

    counts = map_arrow(docs.select("text", "target"), count, "bucket long, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    p = [(x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS) for x in (target, raw)]
    return np.log(p[0]) - np.log(p[1]) if target.sum() else np.zeros(BUCKETS)


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """key, log_weight, gumbel_key, rank_bits (a long in the order of gumbel_key), tie (what the noise comes from) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(1)):
                found, at = features(data, offsets)
                weight = words.row_sums(ratios[found], at)
                noise = (batch.column(2).slice(a, b - a).to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64)
                drawn = weight - np.log(-np.log((noise + 0.5) / 2.0**53))
                bits = (drawn + 0.0).view(np.int64)
                bits = np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(weight), pa.array(drawn), pa.array(bits), batch.column(2).slice(a, b - a)], [key, "log_weight", "gumbel_key", "rank_bits", "tie"])

    own = docs.select(key, "text", F.xxhash64(F.col(key).cast("string"), "text", F.lit(seed)).alias("noise"))
    return map_arrow(own, run, f"{key} {own.schema[key].dataType.simpleString()}, log_weight double, gumbel_key double, rank_bits long, tie long")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0, target_rows: int = TARGET_ROWS) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected: a sample of round(share * rows) rows without replacement, by weight.

    Target text: documents with quality 1 in labels, about target_rows of them drawn by a hash of doc_id (a
    bounded broadcast); raw text: every document. share: as the labels' share of quality 1 if not given. The
    Gumbel noise depends on doc_id (of any type, null too), text and seed only. The k-th key is found by exact
    histograms, not by a global sort. A null text has weight 0; a null doc_id or label is no target; rows that repeat
    both doc_id and text draw the same noise and are taken or left together, so k may be missed by such a tie and by no
    other. No labels: all weights are 0 and share is 1. Other columns are not read; an empty table gives an empty result.
    """
    marks = labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known, good = marks.agg(F.count(F.lit(1)), F.count_if(F.col("quality") == 1)).first()
    share = share if share is not None else good / known if known else 1.0
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, target_rows / max(good, 1)))
    target = marks.filter((F.col("quality") == 1) & part).select(F.col("doc_id").alias("__id"), F.lit(True).alias("target"))
    own = docs.select("doc_id", "text")
    ratios = log_ratios(own.join(F.broadcast(target), own["doc_id"] == target["__id"], "left").select("text", "target"))
    drawn = staged(weigh(own, ratios, seed), "gumbel")
    keys = drawn.select(F.col("rank_bits").alias("k1"), F.col("tie").alias("k2"), F.lit(1).alias("size"))
    n = keys.count()
    out = n - round(share * n)
    if 0 < out < n:
        cut = find_splitters(keys, [(out, 0)], 0, 1 << 128, (n, n))[0]
        a, b = (cut >> 64) - 2**63, (cut & (2**64 - 1)) - 2**63
        taken = (F.col("rank_bits") > F.lit(a)) | ((F.col("rank_bits") == F.lit(a)) & (F.col("tie") >= F.lit(b)))
    else:
        taken = F.lit(out <= 0)
    return drawn.select("doc_id", "log_weight", "gumbel_key", taken.alias("selected"))
