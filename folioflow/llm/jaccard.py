"""Exact Jaccard join of word shingle sets: size-banded tiles, hashed bitmap signatures, sorted-array intersections.

1. Shingles that are frequent in the corpus are put last in a common order (all others go by their hash).
2. Two sets with a similarity of at least 3/4 share a token among the first n - ceil(3n/4) + 1 of each in that
   order. Sizes fall into bands, each BAND times as wide as the one before. A tile is a token and a band: it holds
   the sets of that band with the token in their first ones, and those of the band below that are large enough
   to be linked with one in it. So sets that can be linked share a tile, and others of very different size don't.
3. Every set is compared with a leader of nearly its size from the tiles that it is in, the one that it meets
   most often (a star). The bit counts of two parity bitmaps bound the overlap from above; pairs that pass are
   intersected exactly, from the texts.
4. Connected components of these links are taken. A tile whose sets now belong to one component is done: no
   further pair in it can change a component. In the others, in TURNS rounds, a set of each component is
   compared with one of the largest, and components are taken again.
5. In tiles that still hold several components, pairs of different ones are compared by their bitmaps, in blocks.
   A pair is sent by the first of the tiles that it shares only, and what passes is intersected exactly.
So every link between sets of different components is found, and a group of many copies costs a comparison
for each copy, not for each pair. Equal sets are one set throughout. Tables are deleted when their last reader
has run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words
from .components import components
from .shared import discard, staged, sweep

SHINGLE = 5
#: Similarity of at least UP / DOWN links two sets.
UP, DOWN = 3, 4
#: Frequent shingles put last: at most so many, each seen at least so often. Whatever they are, results are the same.
FREQUENT, OFTEN = 100_000, 32
SKETCH_BITS = 22
LEAST_BITS = 256
#: A band of sizes ends at BAND times its start.
BAND = 4
#: Sets compared with one leader in a task; sets in a block of a tile.
STAR, BLOCK = 128, 1024
#: Tiles of a set by which it is told whether a pair has met before (the least ones by hash).
MARKS = 8
#: Rounds of stars over components before all pairs of what is left are compared.
TURNS = 2
#: Passes in which tiles are built, each over its share of the tokens.
WAVES = 4
#: Parts of a frequent token's postings.
SALTS = 64
#: Requests for texts up to this count (under 10 MB) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Fingerprints that a task remembers so as not to post a copy again.
SEEN = 200_000


def _sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    shingles, at = words.shingle_hashes(*words.word_hashes(data, offsets), SHINGLE)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = np.sort(shingles[a:b])
        again = own[1:] == own[:-1]
        out.append(np.delete(own, np.flatnonzero(again) + 1) if again.any() else own)
    return out


def _fingerprint(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(own.tobytes()).digest()[:8], "little", signed=True)


def _signature(own: np.ndarray) -> bytes:
    """A bit is the parity of the elements hashed to it, so two signatures differ in at most as many bits as the sets in elements.

    There are at least twice as many bits as elements (a power of two), so large sets' signatures tell as much as
    small ones', and few bits hide a difference.
    """
    width = max(LEAST_BITS, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _folded(bits: np.ndarray, words_: int) -> np.ndarray:
    """Rows of 64-bit words cut down to so many words: the signature that a smaller width would have given."""
    while bits.shape[1] > words_:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _differing(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Differing bits of pairs of signatures, at the smaller width of each pair."""
    size = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)]).reshape(-1, 2)
    out = np.zeros(len(size), np.int64)
    for a, b in np.unique(size, axis=0).tolist():
        mine = np.flatnonzero((size == (a, b)).all(1))
        x, y = (np.frombuffer(b"".join([side[i] for i in mine]), np.uint64).reshape(len(mine), -1) for side in (left, right))
        least = min(x.shape[1], y.shape[1])
        out[mine] = np.bitwise_count(_folded(x, least) ^ _folded(y, least)).sum(1, dtype=np.int64)
    return out


def may_link(n_a, n_b, differing):
    """Whether sets of these sizes whose signatures differ in so many bits can be similar enough."""
    overlap = (n_a + n_b - differing) // 2
    return (DOWN * np.minimum(n_a, n_b) >= UP * np.maximum(n_a, n_b)) & (DOWN * overlap >= UP * (n_a + n_b - overlap))


def _bands(n: int) -> tuple[int, ...]:
    """The bands whose tiles a set of this size is posted to: its own, and the next if a set there can be linked with it."""
    own, start = 0, BAND
    while start <= n:
        own, start = own + 1, start * BAND
    return (own, own + 1) if DOWN * n >= UP * start else (own,)


def _posted(own: np.ndarray, band: int) -> np.ndarray:
    """Tile names of a band's tokens; the lowest bit, which marks frequent tokens, stays."""
    mixed = words.mixed(own + np.uint64((band * 0x9E3779B97F4A7C15 + 2) & 0xFFFFFFFFFFFFFFFE))
    return mixed & ~np.uint64(1) | own & np.uint64(1)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles seen often, counted over all whole texts: each task counts in a sketch and reports what stands out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen, found = np.zeros(1 << SKETCH_BITS, np.uint32), 0, {}
        for batch in batches:
            for _, _, data, offsets in words.chunks(batch.column(0)):
                shingles, _ = words.shingle_hashes(*words.word_hashes(data, offsets), SHINGLE)
                cell = (shingles & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)
                np.add.at(sketch, cell, 1)
                seen += len(cell)
                high = sketch[cell] >= max(8, 4 * (seen >> SKETCH_BITS))
                for token, n in zip(shingles[high].tolist(), sketch[cell[high]].tolist(), strict=True):
                    found[token] = n
                if len(found) > 4 * FREQUENT:
                    found = dict(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT])
        yield pa.RecordBatch.from_arrays([pa.array(np.array([*found], np.uint64).view(np.int64)), pa.array([*found.values()], pa.int64())], ["token", "n"])

    counts = map_arrow(docs.select("text"), count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toArrow()
    return np.sort(top["token"].to_numpy().view(np.uint64))


def signed_sets(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, row (a hash of key and text), sid (fingerprint of the shingle set), n, signature, tokens (names of its tiles; lowest bit: frequent), for each row.

    A copy of a set that the task has seen gets no tokens. A text without words has n = 0.
    """
    box = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = box.value
        mask = np.uint64((1 << 20) - 1)
        maybe = np.zeros(1 << 20, bool)
        maybe[(frequent & mask).astype(np.int64)] = True
        seen: set[int] = set()
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(2)):
                sids, sizes, signatures, tokens = [], [], [], []
                for own in _sets(data, offsets):
                    n, sid = len(own), _fingerprint(own)
                    sids.append(sid)
                    sizes.append(n)
                    signatures.append(_signature(own))
                    if not n or sid in seen:
                        tokens.append(None)
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sid)
                    first = n + (-UP * n // DOWN) + 1
                    last = maybe[(own & mask).astype(np.int64)]
                    if last.any():
                        last[last] = np.isin(own[last], frequent, assume_unique=True)
                    if last.any():
                        own = np.concatenate([own[~last][:first] & ~np.uint64(1), own[last] | np.uint64(1)])[:first]
                    else:
                        own = own[:first] & ~np.uint64(1)
                    tokens.append(np.concatenate([_posted(own, band) for band in _bands(n)]).view(np.int64))
                count = np.array([0 if t is None else len(t) for t in tokens])
                at = np.concatenate([[0], np.cumsum(count)])
                flat = np.concatenate([np.zeros(0, np.int64), *(t for t in tokens if t is not None)])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), lists], [key, "row", "sid", "n", "signature", "tokens"])

    own = docs.select(key, _row(key), "text")
    return map_arrow(own, run, f"{key} {own.schema[key].dataType.simpleString()}, row long, sid long, n long, signature binary, tokens array<long>")


def _tiles(postings: DataFrame) -> DataFrame:
    """(token, sid, leader) of every posting (token, sid, n) whose tile has another set that could be linked with it by size.

    Sizes are cut into stretches whose ends are 3/4 of each other, so linked sets lie in one or in neighbouring ones.
    The leader is the first set of the posting's stretch, so its size fits. A frequent token's tile has several
    parts; none of its postings is left out, as other parts aren't seen.
    """
    cell = F.when(F.col("token").bitwiseAND(1) == 1, F.xxhash64("token", F.pmod("sid", F.lit(SALTS)))).otherwise(F.col("token"))
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DOWN / UP)) + 1e-9)
    dealt = postings.select("token", size.cast("int").alias("size"), "sid").repartition(cell).sortWithinPartitions("token", "size", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fits, lead = np.zeros((0, 3), np.int64), np.zeros(0, bool), np.zeros(0, np.int64)  # the last row, which waits for the next

        def cut(rows: np.ndarray, keep: np.ndarray, lead: np.ndarray) -> pa.RecordBatch:
            keep = keep | ((rows[:, 0] & 1) == 1)
            return pa.RecordBatch.from_arrays([pa.array(rows[keep, 0]), pa.array(rows[keep, 2]), pa.array(lead[keep])], ["token", "sid", "leader"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([rows, np.column_stack([c.to_numpy() for c in batch.columns])])
            rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])]
            same = rows[1:, 0] == rows[:-1, 0]
            star = np.flatnonzero(np.concatenate([[True], ~same | (rows[1:, 1] != rows[:-1, 1])]))
            leads = np.repeat(rows[star, 2], np.diff([*star, len(rows)]))
            if len(lead):
                leads[: star[1] if len(star) > 1 else len(rows)] = lead[0]
            fits = np.concatenate([fits if len(fits) else [False], same & (rows[1:, 1] - rows[:-1, 1] <= 1)])
            yield cut(rows[:-1], fits[:-1] | fits[1:], leads[:-1])
            rows, fits, lead = rows[-1:], fits[-1:], leads[-1:]
        yield cut(rows, fits, lead)

    return map_arrow(dealt, run, "token long, sid long, leader long")


def _pass_signatures(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
    own = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"{DOWN} * least(n_a, n_b) >= {UP} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
                good = may_link(n_a, n_b, _differing(batch.column(4).to_pylist(), batch.column(5).to_pylist()))
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return map_arrow(own.select("a", "b", "n_a", "n_b", "s_a", "s_b"), run, "a long, b long")


def _links(pairs: DataFrame, sets: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """The pairs that are links, by exact intersection of the sets of both texts; b leads a star of a's."""
    stars = pairs.groupBy("b").count().withColumn("parts", F.ceil(F.col("count") / STAR)).select("b", "parts")
    rest = pairs.join(stars, "b").select("b", F.pmod(F.xxhash64("a"), "parts").alias("part"), F.col("a").alias("sid"))
    lead = stars.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("b").alias("sid"))
    requests = staged(rest.unionByName(lead).join(sets.select("sid", "row"), "sid"), "requests")
    few = requests.count() <= BROADCAST_ROWS
    own = docs.select(_row(key), "text")
    found = own.join(F.broadcast(requests) if few else requests, "row")
    dealt = found.select("b", "part", "sid", "text").repartition("b", "part").sortWithinPartitions("b", "part", F.col("sid") != F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, leader = None, None
        for batch in batches:
            b, part, sid = (batch.column(i).to_pylist() for i in (0, 1, 2))
            linked: list[tuple[int, int]] = []
            for a, _, data, offsets in words.chunks(batch.column(3)):
                for i, own in enumerate(_sets(data, offsets), a):
                    if (b[i], part[i]) != star:
                        star, leader = (b[i], part[i]), None
                    if _fingerprint(own) != sid[i]:
                        continue  # another text under the same hash
                    if sid[i] == b[i]:
                        leader = own
                    elif leader is not None:
                        both = len(np.intersect1d(leader, own, assume_unique=True))
                        if DOWN * both >= UP * (len(leader) + len(own) - both):
                            linked.append((sid[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in linked], pa.int64()) for k in (0, 1)], ["a", "b"])

    out = staged(map_arrow(dealt, run, "a long, b long").distinct(), "links")
    discard(requests)
    return out


def _row(key: str):
    """What a row is asked for by: a hash of key and text, so that rows without a key, or with one key, don't all answer."""
    return F.xxhash64(key, "text").alias("row")


def _mixed_tiles(tiles: DataFrame, of: DataFrame) -> DataFrame:
    """(token, sid, component, many) of the tiles whose sets belong to more than one component.

    Tiles of the same sets are one: of their tokens the least stays.
    """
    own = tiles.select("token", "sid").join(of, tiles["sid"] == of["id"], "left").select("token", "sid", F.coalesce("component", "sid").alias("component"))
    kinds = own.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token")
    own = staged(own.join(kinds, "token"), "mixed-tiles")
    mark = [F.sum(F.pmod(F.xxhash64("sid", F.lit(k)), F.lit(1 << 31))) for k in range(3)]  # no overflow below 4e9 sets
    kinds = own.groupBy("token").agg(F.count(F.lit(1)).alias("many"), *(m.alias(f"mark{k}") for k, m in enumerate(mark)))
    kinds = kinds.groupBy("many", "mark0", "mark1", "mark2").agg(F.min("token").alias("token")).select("token", "many")
    out = staged(own.join(kinds, "token"), "mixed-tiles")
    discard(own)
    return out


def _next_stars(mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): of each tile one set b of its largest component, and one set a of each other component.

    Which ones, a hash decides that differs in each turn, so a component that missed one pivot meets another.
    """
    heads = mixed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"), F.min_by("sid", F.xxhash64("sid", F.lit(turn))).alias("a"))
    pivots = heads.groupBy("token").agg(F.max_by("a", F.struct("n", "component")).alias("b"))
    return heads.join(pivots, "token").filter("a <> b").select("a", "b").distinct()


def _unchecked(found: DataFrame, checked: DataFrame) -> DataFrame:
    """The pairs of found that checked doesn't have in either order."""
    either = [F.greatest("a", "b").alias("__x"), F.least("a", "b").alias("__y")]
    return found.select("a", "b", *either).join(checked.select(*either), ["__x", "__y"], "left_anti").select("a", "b")


def _other_pairs(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components in one tile, whose signatures allow a link.

    A tile larger than BLOCK is cut into blocks of sets, and each pair of blocks is a task's work. A pair that
    shares several tiles is sent by the one whose mark is the least of those that both sets have; sets carry
    their MARKS least ones, so that is known unless none of these is shared (then each tile sends the pair).
    """
    mark = F.xxhash64("token").alias("mark")
    marks = mixed.groupBy("sid").agg(F.slice(F.sort_array(F.collect_set(mark)), 1, MARKS).alias("marks"))
    about = sets.select("sid", "n", "signature").join(marks, "sid")
    own = mixed.withColumn("blocks", F.ceil(F.col("many") / BLOCK)).join(about, "sid").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    own = own.select("token", "sid", "component", "n", "signature", "marks", mark, "block", other.alias("other"))
    own = own.select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "n", "sid", "component", "signature", "marks", "mark")
    dealt = own.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "n")

    def pairs(tile: pa.Table) -> np.ndarray:
        n, sid, component = (tile[c].to_numpy() for c in ("n", "sid", "component"))
        first, second = (tile["block"].to_numpy() == tile[c][0].as_py() for c in ("x", "y"))
        raw = tile["signature"].to_pylist()
        mark, lists = tile["mark"][0].as_py(), tile["marks"].combine_chunks()
        count = lists.value_lengths().to_numpy()
        marks = np.full((len(n), MARKS), np.iinfo(np.int64).max)  # in order; free places are greater than all
        marks[np.arange(MARKS) < count[:, None]] = lists.flatten().to_numpy()
        size = np.array([len(x) // 8 for x in raw])
        views: dict[int, np.ndarray] = {}  # width -> the tile's signatures of that width or the next, at that width
        for w in np.unique(size).tolist():
            views[w] = np.zeros((len(n), w), np.uint64)
            for v in np.unique(size[size >= w]).tolist():
                mine = np.flatnonzero(size == v)
                views[w][mine] = _folded(np.frombuffer(b"".join([raw[i] for i in mine]), np.uint64).reshape(len(mine), v), w)
        out = []
        stop = np.searchsorted(n, DOWN * n // UP, "right")
        for i in range(len(n) - 1):
            j = np.arange(i + 1, stop[i])
            j = j[(component[j] != component[i]) & ((first[i] & second[j]) | (second[i] & first[j]))]
            if len(j):
                bits = views[int(size[i])]
                j = j[may_link(n[i], n[j], np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64))]
            if len(j):
                shared = np.isin(marks[j], marks[i, : count[i]])
                least = marks[j, shared.argmax(1)]
                j = j[~shared.any(1) | (least == mark)]
                out.append(np.column_stack([np.maximum(sid[i], sid[j]), np.minimum(sid[i], sid[j])]))
        return np.concatenate(out) if out else np.zeros((0, 2), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def send() -> pa.RecordBatch:
            found = pairs(pa.Table.from_batches(held)) if held else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, k].copy()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in (0, 1, 2)])
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(keys) else []
            for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                if tuple(keys[a]) != name:
                    yield send()
                    held, name = [], tuple(keys[a])
                held.append(batch.slice(a, b - a))
        yield send()

    return map_arrow(dealt, run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id for each row: the least key that can be reached by links, itself included.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a text of one to four words is one shingle; a null, empty
    or blank text has none and links with nothing. Rows with equal sets are linked, repeated rows too. A
    null key is a row of its own kind: it can be reached, but is a component_id only if no other key is. Other
    columns are not read; an empty table gives an empty result.
    """
    signed = staged(signed_sets(docs, key), "sets")
    full = signed.filter("n > 0")
    sets = staged(full.groupBy("sid", "n").agg(F.min(key).alias("least"), F.min("row").alias("row"), F.first("signature").alias("signature")), "distinct-sets")
    rows = staged(signed.select(key, "sid", "n"), "rows")
    postings = full.filter("tokens is not null").select(F.explode("tokens").alias("token"), "sid", "n")
    waves = []
    for k in range(WAVES):  # a wave's postings are on disk at once
        waves.append(staged(_tiles(postings.filter(F.pmod(F.shiftright("token", 1), F.lit(WAVES)) == k)), "tiles"))
        sweep(docs.sparkSession)
    tiles = _all(waves)
    discard(signed)
    often = tiles.filter("sid <> leader").groupBy("sid", "leader").agg(F.count(F.lit(1)).alias("n"))
    pairs = often.groupBy(F.col("sid").alias("a")).agg(F.max_by("leader", F.struct("n", "leader")).alias("b"))
    tried = [staged(_pass_signatures(pairs, sets), "pairs")]
    links = [_links(tried[0], sets, docs, key)]
    of = components(links[0])
    # stars over the components that are left, while they find links; then whatever pairs are left
    for turn in range(TURNS + 1):
        mixed = _mixed_tiles(tiles, of)
        discard(tiles, *waves)
        waves = []
        sweep(docs.sparkSession)
        tiles = mixed  # components only grow: no other tile will be mixed again
        if not mixed.limit(1).count():
            break
        found = _pass_signatures(_next_stars(mixed, turn), sets) if turn < TURNS else _other_pairs(mixed, sets)
        more = staged(_unchecked(found, _all(tried)), "more-pairs")
        if more.limit(1).count():
            tried.append(more)
            links.append(_links(more, sets, docs, key))
            discard(of)
            of = components(_all(links))
    known = sets.join(of, sets["sid"] == of["id"], "left").select("sid", F.coalesce("component", "sid").alias("component"), "least")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    final = staged(known.join(least, "component").select(F.col("sid").alias("__sid"), "component_id"), "classes")
    discard(tiles, sets, of, *tried, *links)
    out = rows.join(final, (rows["sid"] == final["__sid"]) & (rows["n"] > 0), "left")
    return out.select(key, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row_id(docs: DataFrame, key: str):
    """What tells rows apart: the key, null as the greatest, and the text. Never null."""
    return F.struct(F.col(key).isNull().alias("none"), F.coalesce(F.col(key), F.lit("0").cast(docs.schema[key].dataType)).alias("key"), F.md5(F.coalesce("text", F.lit(""))).alias("text"))


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs, with all columns: of each component one row, with the least key. Rows without shingles stay.

    Each row is decided by its key and text, so rows that share a key, or have none, don't share a fate; of rows
    that repeat both, one stays. Null and empty texts have no shingles; other columns keep their names and values,
    whatever they are called; an empty table gives an empty one.
    """
    mark = "__id"
    while mark in docs.columns:
        mark = f"_{mark}"
    rows = docs.withColumn(mark, _row_id(docs, key))
    found = staged(near_duplicates(rows.select(mark, "text"), mark), "row-decisions")
    drop = found.filter(F.col(mark) != F.col("component_id")).select(mark).distinct()
    out = rows.join(drop, mark, "left_anti")
    if found.filter("n_shingles > 0").groupBy(mark).count().filter("count > 1").limit(1).count():
        full = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        out = out.filter(full).dropDuplicates([mark]).unionByName(out.filter(~full))
    return out.select(docs.columns)
