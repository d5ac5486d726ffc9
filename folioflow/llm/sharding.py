"""Histogram sort into shards of near equal bytes, in DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import staged

#: Candidate boundaries probed inside each open interval and round.
PROBES = 7
#: A shard boundary may lie this share of a shard away from its place, an inner bucket boundary INNER of a bucket.
TOLERANCE, INNER = 0.002, 0.25
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 32, 512
NEW = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_HALF = 1 << 63


def _below(k1: str, k2: str, key: int) -> str:
    """SQL: (k1, k2) < the 128-bit boundary."""
    if key >= _HALF << 65:
        return "true"
    a, b = (key >> 64) - _HALF, (key & (2 * _HALF - 1)) - _HALF
    a_, b_ = (f"{x}L" if x > -_HALF else f"(-{_HALF - 1}L - 1L)" for x in (a, b))
    return f"{k1} < {a_} or ({k1} = {a_} and {k2} < {b_})" if b > -_HALF else f"{k1} < {a_}"


def _interval(k1: str, k2: str, bounds: list[int]) -> Column:
    """How many of the sorted boundaries a key reaches, by a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> str:
        m = (lo + hi) // 2
        return str(lo) if lo == hi else f"if({_below(k1, k2, bounds[m])}, {tree(lo, m)}, {tree(m + 1, hi)})"

    return F.expr(tree(0, len(bounds)))


def _histogram(keys: DataFrame, bounds: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int] | None]]:
    """(bytes, rows) below each boundary, and the least and greatest key of each interval between them.

    One hash aggregate with a map-side combine; len(bounds) + 1 rows go to the driver. The keys' halves are reduced
    apart, so what is said of an interval's keys is a frame around them.
    """
    ends = (F.min("k1"), F.min("k2"), F.max("k1"), F.max("k2"))
    got = keys.groupBy(_interval("k1", "k2", bounds).alias("i")).agg(F.sum("size"), F.count(F.lit(1)), *ends).collect()
    by, below, n_bytes, n_rows = {r[0]: r for r in got}, [], 0, 0
    for i in range(len(bounds)):
        n_bytes, n_rows = n_bytes + (by[i][1] if i in by else 0), n_rows + (by[i][2] if i in by else 0)
        below.append((n_bytes, n_rows))
    number = lambda k: ((k[0] + _HALF) << 64) + k[1] + _HALF
    return below, [(number(by[i][3:5]), number(by[i][5:7])) if i in by else None for i in range(len(bounds) + 1)]


def _stretch(k1: str, k2: str, bucket: str, ends: list[int], parts: int) -> Column:
    """Which of so many equal stretches of its bucket a key lies in: by the first half, or by the second where a bucket has one first half only."""
    wide = [(a >> 64) < (b - 1) >> 64 for a, b in zip(ends[:-1], ends[1:], strict=True)]
    low = [(a >> 64 if w else a & (2 * _HALF - 1)) - _HALF for a, w in zip(ends[:-1], wide, strict=True)]
    span = [((b - 1 >> 64) - (a >> 64) if w else b - a) + 1 for a, b, w in zip(ends[:-1], ends[1:], wide, strict=True)]
    of = lambda values: F.get(F.array(*(F.lit(float(v)) for v in values)), F.col(bucket))
    key = F.when(F.get(F.array(*map(F.lit, wide)), F.col(bucket)), F.col(k1)).otherwise(F.col(k2)).cast("double")
    return F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor((key - of(low)) / of(span) * parts))).cast("int")


def find_splitters(keys: DataFrame, targets: list[tuple[float, float]], low: int, high: int, total: tuple[int, int]) -> list[int]:
    """A boundary for each (bytes below, tolerance): probe, count exactly, narrow the interval, until all are met.

    total: bytes and rows of keys. An interval that holds one row, or has shrunk to one key, can't be split
    further: the edge nearer to the target is taken.
    """
    open_, done = {i: ((low, 0, 0), (high, *total)) for i in range(len(targets))}, {}
    while open_:
        bounds = sorted({lo[0] + (hi[0] - lo[0]) * j // (PROBES + 1) for lo, hi in open_.values() for j in range(PROBES + 2)})
        below, keys_in = _histogram(keys, bounds)
        counted = [(b, *x) for b, x in zip(bounds, below, strict=True)]
        for i, (lo, hi) in list(open_.items()):
            want, slack = targets[i]
            inside = [lo, *(x for x in counted if lo[0] < x[0] < hi[0]), hi]
            right = next(k for k in range(1, len(inside)) if inside[k][1] >= want or k == len(inside) - 1)
            lo, hi = inside[right - 1], inside[right]
            best = min(lo, hi, key=lambda x: abs(x[1] - want))
            if abs(best[1] - want) <= slack or hi[2] - lo[2] <= 1 or hi[0] - lo[0] <= 1:
                done[i] = best[0]
                del open_[i]
            else:  # on to the keys that are really there
                least, most = keys_in[bisect_right(bounds, lo[0])]
                open_[i] = ((max(least, lo[0]), *lo[1:]), (min(most + 1, hi[0]), *hi[1:]))
    return [done[i] for i in range(len(targets))]


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of docs, then size, text_crc32, law, shard, slot, grown_shard.

    The sort key is (hash of the text, doc_id): equal texts are neighbours, and a group of copies is split only
    if it is larger than the tolerance. Each round counts the exact bytes below all candidate boundaries over
    a staged table of keys and sizes, and narrows the intervals; the rows themselves are exchanged once.
    Shards are cut into buckets so that numbering (slot, gapless from 0 in key order) runs in parallel;
    a bucket's first slot comes from exact row counts. Beyond MOST_BUCKETS each bucket is cut into equal stretches of
    the key, so that buckets grow in number, not in size.

    size is the UTF-8 bytes of the text (null: none) plus 1. Columns of docs with a name of the new ones are replaced. Null texts share the empty text's place, a null
    doc_id sorts first. Rows that repeat text and doc_id have one key and can't be split; one such run larger
    than a shard makes shards uneven (some may stay empty). An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key1, key2 = F.xxhash64(text), F.coalesce(F.col("doc_id").cast("long"), F.lit(-_HALF))
    size = (F.octet_length(text) + F.lit(1)).cast("long")
    keys = staged(docs.select(key1.alias("k1"), key2.alias("k2"), size.alias("size")), "shard-keys")
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    per_shard = max(1, min(max(LEAST_BUCKETS, rows // ROWS_PER_BUCKET), MOST_BUCKETS) // n_shards)
    n = n_shards * per_shard
    slack = [tolerance * total / n_shards if i % per_shard == 0 else INNER * total / n for i in range(n)]
    targets = [(total * i / n, slack[i]) for i in range(1, n)]
    bounds = find_splitters(keys, targets, 0, 1 << 128, (total, rows)) if rows else [0] * (n - 1)
    for i in range(1, n - 1):  # two targets inside one heavy key may meet at either edge of it
        bounds[i] = max(bounds[i], bounds[i - 1])
    edge = sorted({b for b in bounds if 0 < b < 1 << 128})
    starts = [0, *(r for _, r in _histogram(keys, edge)[0])]  # rows before each bucket between distinct boundaries
    shard_edge = [bounds[s * per_shard - 1] for s in range(1, n_shards)]
    shard_of = [sum(b <= lo for b in shard_edge) for lo in [0, *edge]]
    first = [starts[next(i for i, s in enumerate(shard_of) if s == shard_of[j])] for j in range(len(shard_of))]
    cut = lambda k1, k2: _interval(k1, k2, edge)
    own = docs.withColumns({"size": size, "text_crc32": F.crc32(text), "__k1": key1, "__k2": key2})
    own = own.withColumn("__bucket", cut("__k1", "__k2"))
    numbers = {
        "law": F.lit("bytes"),
        "shard": F.get(F.array(*map(F.lit, shard_of)), F.col("__bucket")),
        "grown_shard": F.lit(None).cast("int"),
    }
    parts = -(-rows // (ROWS_PER_BUCKET * MOST_BUCKETS))
    if parts <= 1:
        at = F.array(*(F.lit(starts[j] - first[j]).cast("long") for j in range(len(shard_of))))
        order = Window.partitionBy("__bucket").orderBy("__k1", "__k2")
        numbers["slot"] = F.get(at, F.col("__bucket")) + F.row_number().over(order) - 1
    else:
        ends = [0, *edge, 1 << 128]
        own = own.withColumn("__part", _stretch("__k1", "__k2", "__bucket", ends, parts))
        counted = keys.withColumn("__bucket", cut("k1", "k2")).withColumn("__part", _stretch("k1", "k2", "__bucket", ends, parts)).groupBy("__bucket", "__part").count()
        before, at = 0, []
        for bucket, part, n in sorted(map(tuple, counted.collect())):  # a row for about ROWS_PER_BUCKET rows
            at.append((bucket, part, before - first[bucket]))
            before += n
        own = own.join(F.broadcast(docs.sparkSession.createDataFrame(at, "__bucket int, __part int, __at long")), ["__bucket", "__part"])
        order = Window.partitionBy("__bucket", "__part").orderBy("__k1", "__k2")
        numbers["slot"] = F.col("__at") + F.row_number().over(order) - 1
    out = own.withColumns(numbers).drop("__k1", "__k2", "__bucket", "__part", "__at")
    return out.select(*(c for c in docs.columns if c not in NEW), *NEW)
