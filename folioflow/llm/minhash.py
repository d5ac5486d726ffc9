"""Near duplicates by b-bit MinHash signatures and a multi-index Hamming join, confirmed on full sets.

1. A set of word shingles gets HASHES minima, of which BITS bits each are kept: its signature. The distance of two
   signatures is the number of places in which they differ. Equal sets are one set throughout.
2. A signature is cut into chunks. If two are at most ERRORS apart, some chunk has no more errors than its share: by
   the pigeonhole principle the shares plus one each add up to ERRORS + 1. For every choice of places that may be in
   error, the chunk's other places are a key. So sets within ERRORS of each other surely share a tile (a key's sets).
3. Every set is compared with the first set of the tile that it shares most with (a star); what the signatures allow
   is intersected exactly, from the texts. Components of these links are taken, and a tile whose sets are of one
   component is done. In the others, for TURNS rounds, a set of each component is compared with one of the largest.
4. In tiles that still hold several components, all pairs of different ones are compared by signature, in blocks; those
   inside the largest are not. A pair is sent by the least key that it shares, and confirmed exactly.
Before texts are fetched for a pair, two parity bitmaps bound the sets' difference from below: a bound, so no link is
lost, and pairs that are similar but not enough cost no text. Texts are fetched only of rows that a bitmap of fixed size
may have been asked for.

So every link within the signature distance between sets of different components is found. At a similarity of 0.85 a
place differs with a chance of 0.15, and more than 24 of 64 differ in 3 of a million such pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words
from .components import components
from .shared import discard, join_groups, staged

SHINGLE = 3
#: Sets link when DOWN * intersection >= UP * union.
UP, DOWN = 85, 100
HASHES, BITS = 64, 8
#: Signatures up to this distance surely meet; errors that a chunk may have.
ERRORS, CHUNK_ERRORS = 24, 1
#: Sets compared with one leader in a task; sets in a block of a tile.
STAR, BLOCK = 128, 1024
#: Rounds of stars over components before all pairs of what is left are compared.
TURNS = 2
#: Bits of the bitmap by which texts that weren't asked for are passed over (8 MB, whatever the input), and of its pages.
ASKED_BITS, PAGE_BITS = 26, 19
LEAST_PARITY = 128

_FACTORS = words.mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_KEY_SHIFT = 40  # a key: which places of which chunk, above the bits of up to five places


def keys_of(hashes: int = HASHES, errors: int = ERRORS, chunk_errors: int = CHUNK_ERRORS) -> list[tuple[int, ...]]:
    """The places of each key: of each chunk, all choices of as many places left out as its share of errors.

    There are as many chunks as give shares of chunk_errors, the last one what is left; the shares plus one each add
    up to errors + 1.
    """
    count = -(-(errors + 1) // (chunk_errors + 1))
    shares = [chunk_errors] * (count - 1) + [errors - (count - 1) * (chunk_errors + 1)]
    out, at = [], 0
    for k, share in enumerate(shares):
        end = at + hashes // count + (k < hashes % count)
        out += [tuple(p for p in range(at, end) if p not in left) for left in combinations(range(at, end), share)]
        at = end
    return out


_KEYS = keys_of()


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(sorted distinct shingle hashes of each text, signature of each; zeros without shingles)."""
    shingles, at = words.shingle_hashes(*words.word_hashes(data, offsets), SHINGLE)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = np.sort(shingles[a:b])
        again = own[1:] == own[:-1]
        out.append(np.delete(own, np.flatnonzero(again) + 1) if again.any() else own)
    signature = np.zeros((len(out), HASHES), np.uint8)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for k, factor in enumerate(_FACTORS):
            least = np.minimum.reduceat(shingles * factor, at[full])
            signature[full, k] = words.mixed(least).astype(np.uint8)  # BITS low bits
    return out, signature


def _fingerprint(own: np.ndarray) -> bytes:
    return hashlib.md5(own.tobytes()).digest()


def may_link(n_a, n_b, differing=0):
    """Whether sets of these sizes, of which so many elements at least are in one only, can be similar enough."""
    overlap = (n_a + n_b - differing) // 2
    return (DOWN * np.minimum(n_a, n_b) >= UP * np.maximum(n_a, n_b)) & (DOWN * overlap >= UP * (n_a + n_b - overlap))


def _parity(own: np.ndarray) -> bytes:
    """A bit is the parity of the elements hashed to it: two sets differ in at least as many elements as their bits.

    There are twice to four times as many bits as elements; bitmaps of two widths meet at the smaller.
    """
    width = max(LEAST_PARITY, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _differing(one: bytes, others: list[bytes]) -> np.ndarray:
    """Differing bits of one bitmap and others."""
    def folded(bits: np.ndarray, words_: int) -> np.ndarray:
        while bits.shape[-1] > words_:
            half = bits.shape[-1] // 2
            bits = bits[..., :half] ^ bits[..., half:]
        return bits

    mine, out = np.frombuffer(one, np.uint64), np.zeros(len(others), np.int64)
    size = np.array([len(x) // 8 for x in others], np.int64)
    for w in np.unique(size).tolist():
        at = np.flatnonzero(size == w)
        theirs = np.frombuffer(b"".join([others[i] for i in at]), np.uint64).reshape(len(at), w)
        least = min(w, len(mine))
        out[at] = np.bitwise_count(folded(theirs, least) ^ folded(mine, least)).sum(1, dtype=np.int64)
    return out


def are_linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DOWN * both >= UP * (len(a) + len(b) - both)


def _matrix(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(len(signatures), HASHES)


def _key_values(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature, a column each."""
    out = np.empty((len(signatures), len(_KEYS)), np.int64)
    wide = signatures.astype(np.int64)
    for k, places in enumerate(_KEYS):
        value = np.full(len(wide), k, np.int64) << _KEY_SHIFT
        for j, p in enumerate(places):
            value |= wide[:, p] << (BITS * j)
        out[:, k] = value
    return out


def _row(key: str):
    """What a row is asked for by: a hash of key and text, so that rows without a key, or with one key, don't all answer."""
    return F.xxhash64(key, "text").alias("row")


def _name(of: str):
    return F.unhex(F.lpad(F.hex(of), 16, "0"))


def signed_sets(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, row (a hash of key and text), print (128-bit fingerprint of the set), n, signature, parity (bitmap) of each row. Without words n is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(2)):
                sets, signature = _sets(data, offsets)
                prints = pa.array([_fingerprint(x) for x in sets], pa.binary())
                signed = pa.array([x.tobytes() for x in signature], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), prints, pa.array([len(x) for x in sets], pa.int64()), signed, pa.array([_parity(x) if len(x) else b"" for x in sets], pa.binary())], [key, "row", "print", "n", "signature", "parity"])

    own = docs.select(key, _row(key), "text")
    return map_arrow(own, run, f"{key} {own.schema[key].dataType.simpleString()}, row long, print binary, n long, signature binary, parity binary")


def tiles_of(sets: DataFrame) -> DataFrame:
    """(key, id, leader) of each set in each tile of two or more; the leader is the tile's least id."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _key_values(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), len(_KEYS)))], ["key", "id"])

    postings = map_arrow(sets.select("id", "signature"), post, "key long, id long")
    dealt = postings.repartition("key").sortWithinPartitions("key", "id")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lead, many = np.zeros((0, 2), np.int64), 0, False  # the last row, its tile's leader, whether it isn't alone

        def cut(rows: np.ndarray, leads: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[keep, 0]), pa.array(rows[keep, 1]), pa.array(leads[keep])], ["key", "id", "leader"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.column_stack([c.to_numpy() for c in batch.columns])])
            same = rows[1:, 0] == rows[:-1, 0]
            heads = np.flatnonzero(np.concatenate([[True], ~same]))
            leads = np.repeat(rows[heads, 1], np.diff([*heads, len(rows)]))
            keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            if len(held):
                leads[: heads[1] if len(heads) > 1 else len(rows)] = lead
                keep[0] |= many
            yield cut(rows[:-1], leads[:-1], keep[:-1])
            held, lead, many = rows[-1:], leads[-1], bool(keep[-1])
        if len(held):
            yield cut(held, np.array([lead]), np.array([many]))

    return map_arrow(dealt, pick, "key long, id long, leader long")


def _stars(tiles: DataFrame) -> DataFrame:
    """Pairs (a, b): each set a with the leader b that it shares most tiles with (of several the greatest)."""
    met = tiles.filter("id <> leader").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("n"))
    # one number for both, so that hash aggregates do: under 64 tiles, and ids below 2 ** 57
    best = met.groupBy("id").agg(F.max(F.shiftleft("n", 57).bitwiseOR(F.col("leader"))).alias("best"))
    return best.select(F.col("id").alias("a"), F.col("best").bitwiseAND((1 << 57) - 1).alias("b"))


def _within(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link; b may be in any number of pairs."""
    pairs = pairs.withColumn("to", _name("b"))
    about = pairs.groupBy("to").agg(F.count(F.lit(1)).alias("size"))
    of = sets.select(_name("id").alias("to"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"), F.col("parity").alias("p_b"))
    both = join_groups(pairs, about.join(of, "to"), "to", "size", pairs.count(), F.col("a"))
    own = both.join(sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"), F.col("parity").alias("p_a")), "a")
    own = own.filter(f"{DOWN} * least(n_a, n_b) >= {UP} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(1) <= ERRORS
                n_a, n_b = (batch.column(i).to_numpy() for i in (4, 5))
                p_a, p_b = (batch.column(i).to_pylist() for i in (6, 7))
                for i in np.flatnonzero(good).tolist():
                    good[i] = may_link(n_a[i], n_b[i], _differing(p_a[i], [p_b[i]])[0])
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return map_arrow(own.select("a", "b", "s_a", "s_b", "n_a", "n_b", "p_a", "p_b"), run, "a long, b long")


def _asked(requests: DataFrame) -> np.ndarray:
    """Bytes of a bitmap with a bit for each row asked for (several rows may share one). Each page of it is made by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            bit = batch.column(0).to_numpy()
            for page in np.unique(bit >> PAGE_BITS).tolist():
                own = pages.setdefault(page, np.zeros(1 << PAGE_BITS, bool))
                own[bit[bit >> PAGE_BITS == page] & ((1 << PAGE_BITS) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array([*pages], pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in pages.values()], pa.binary())], ["page", "bits"])

    bit = F.col("row").bitwiseAND((1 << ASKED_BITS) - 1).alias("bit")
    dealt = requests.select(bit).repartition(F.shiftright("bit", PAGE_BITS))
    out = np.zeros(1 << (ASKED_BITS - 3), np.uint8)
    size = 1 << (PAGE_BITS - 3)
    for page in map_arrow(dealt, run, "page long, bits binary").collect():
        out[page["page"] * size : (page["page"] + 1) * size] = np.frombuffer(page["bits"], np.uint8)
    return out


def _texts(docs: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """row, text of the rows that may have been asked for."""
    box = docs.sparkSession.sparkContext.broadcast(_asked(requests))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(0).to_numpy() & ((1 << ASKED_BITS) - 1)
            yield batch.filter(pa.array((box.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))

    return map_arrow(docs.select(_row(key), "text"), run, "row long, text string")


def _confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """The pairs that are links, by exact intersection of both texts' sets; a star's pairs are dealt STAR to a task's group."""
    stars = pairs.groupBy("b").count().withColumn("parts", F.ceil(F.col("count") / STAR)).select("b", "parts")
    rest = pairs.join(stars, "b").select("b", F.pmod(F.xxhash64("a"), "parts").alias("part"), F.col("a").alias("id"))
    lead = stars.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("b").alias("id"))
    of = sets.select("id", "row", "print")
    requests = staged(rest.unionByName(lead).join(of, "id"), "requests")
    found = _texts(docs, requests, key).join(requests, "row")
    dealt = found.select("b", "part", "id", "print", "text").repartition("b", "part").sortWithinPartitions("b", "part", F.col("id") != F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, leader = None, None
        for batch in batches:
            b, part, ids, prints = (batch.column(i).to_pylist() for i in range(4))
            linked: list[tuple[int, int]] = []
            for a, _, data, offsets in words.chunks(batch.column(4)):
                for i, own in enumerate(_plain_sets(data, offsets), a):
                    if (b[i], part[i]) != star:
                        star, leader = (b[i], part[i]), None
                    if _fingerprint(own) != prints[i]:
                        continue  # another text under the same hash
                    if ids[i] == b[i]:
                        leader = own
                    elif leader is not None and are_linked(leader, own):
                        linked.append((ids[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in linked], pa.int64()) for k in (0, 1)], ["a", "b"])

    out = staged(map_arrow(dealt, run, "a long, b long").distinct(), "links")
    discard(requests)
    return out


def _plain_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    shingles, at = words.shingle_hashes(*words.word_hashes(data, offsets), SHINGLE)
    return (np.unique(shingles[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def _mixed(tiles: DataFrame, of: DataFrame) -> DataFrame:
    """(key, id, component) of the tiles whose sets are of several components; of tiles of the same sets the least key's."""
    own = tiles.select("key", "id").join(of.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mark = [F.sum(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 31))) for k in range(3)]  # no overflow below 4e9 sets
    kinds = own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("many"), *(m.alias(f"mark{k}") for k, m in enumerate(mark)))
    kinds = kinds.filter("lo <> hi").groupBy("many", "mark0", "mark1", "mark2").agg(F.min("key").alias("key")).select("key")
    return staged(own.join(kinds, "key"), "mixed-tiles")


def _heads(mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): of each tile a set b of its largest component, and a set a of each other. A hash that differs in each turn chooses."""
    heads = mixed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("a"))
    pivots = heads.groupBy("key").agg(F.max_by("a", F.struct("n", "component")).alias("b"))
    return heads.join(pivots, "key").filter("a <> b").select("a", "b").distinct()


def _unchecked(found: DataFrame, checked: DataFrame) -> DataFrame:
    """The pairs of found that checked doesn't have in either order."""
    either = [F.greatest("a", "b").alias("__x"), F.least("a", "b").alias("__y")]
    return found.select("a", "b", *either).join(checked.select(*either), ["__x", "__y"], "left_anti").select("a", "b")


def _across(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components that share a tile and whose sizes and signatures allow a link, once each.

    A tile's largest component is its main part, the others its rest. Blocks of the rest (x) are compared with blocks
    of everything (y), so what a tile costs is its rest times its sets, dealt BLOCK by BLOCK.
    """
    sizes = mixed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    about = sizes.groupBy("key").agg(F.sum("n").alias("many"), F.max(F.struct("n", "component")).alias("main"))
    about = about.select("key", F.col("main.component").alias("main"), F.ceil((F.col("many") - F.col("main.n")) / BLOCK).alias("few"), F.ceil(F.col("main.n") / BLOCK).alias("more"))
    own = mixed.join(about, "key").withColumn("aside", F.col("component") != F.col("main"))
    block = F.when(F.col("aside"), F.pmod(F.xxhash64("id"), "few")).otherwise(F.col("few") + F.pmod(F.xxhash64("id"), "more"))
    own = own.withColumn("block", block).join(sets.select("id", "n", "signature", "parity"), "id")
    zero = F.lit(0).cast("long")
    low = F.transform(F.sequence(zero, F.least("block", F.col("few") - 1)), lambda x: F.struct(x.alias("x"), F.col("block").alias("y")))
    high = F.transform(F.sequence("block", F.col("few") + F.col("more") - 1), lambda y: F.struct(F.col("block").alias("x"), y.alias("y")))
    units = F.when(F.col("aside"), F.array_distinct(F.concat(low, high))).otherwise(low)
    own = own.select("key", "id", "component", "n", "signature", "parity", "block", F.explode(units).alias("unit"))
    own = own.select("key", F.col("unit.x").alias("x"), F.col("unit.y").alias("y"), "block", "id", "component", "n", "signature", "parity")
    dealt = own.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def pairs(unit: pa.Table) -> np.ndarray:
        key, x, y = (unit[c][0].as_py() for c in ("key", "x", "y"))
        ids, component, n, block = (unit[c].to_numpy() for c in ("id", "component", "n", "block"))
        bits = _matrix(unit["signature"].combine_chunks())
        keys, parity = _key_values(bits), unit["parity"].to_pylist()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        out = []
        for at, i in enumerate(left.tolist()):
            j = right[at + 1 :] if x == y else right
            j = j[(component[j] != component[i]) & may_link(n[i], n[j])]
            j = j[(bits[j] != bits[i]).sum(1) <= ERRORS]
            if len(j):
                j = j[(keys[j] == keys[i]).argmax(1) == key >> _KEY_SHIFT]
            if len(j):
                j = j[may_link(n[i], n[j], _differing(parity[i], [parity[x] for x in j.tolist()]))]
            if len(j):
                out.append(np.column_stack([np.maximum(ids[i], ids[j]), np.minimum(ids[i], ids[j])]))
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

    return map_arrow(dealt, run, "a long, b long")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id, kept of each row: component_id is the least key that links lead to, itself included.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a text of one or two words is one shingle; a null, empty or blank
    text has none and links with nothing. Rows with equal sets are linked, repeated rows too. kept says that the row's
    key is the component's; rows that repeat that key are all kept. A null key can be reached, but is a component_id
    only if no other key is. Other columns are not read; an empty table gives an empty result.
    """
    signed = staged(signed_sets(docs, key), "signed")
    full = signed.filter("n > 0")
    sets = full.groupBy("print", "n").agg(F.min(key).alias("least"), F.min("row").alias("row"), F.first("signature").alias("signature"), F.first("parity").alias("parity"))
    sets = staged(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    tiles = staged(tiles_of(sets), "tiles")
    tried = [staged(_within(_stars(tiles), sets), "pairs")]
    links = [_confirmed(tried[0], sets, docs, key)]
    of = components(links[0])
    for turn in range(TURNS + 1):
        mixed = _mixed(tiles, of)
        discard(tiles)
        tiles = mixed  # components only grow: no other tile will be mixed again
        if not mixed.limit(1).count():
            break
        found = _within(_heads(mixed, turn), sets) if turn < TURNS else _across(mixed, sets)
        more = staged(_unchecked(found, _all(tried)), "more-pairs")
        if more.limit(1).count():
            tried.append(more)
            links.append(_confirmed(more, sets, docs, key))
            discard(of)
            of = components(_all(links))
    known = sets.join(of.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left").select("print", "n", F.coalesce("component", "id").alias("component"), "least")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = staged(known.join(least, "component").select("print", "n", "component_id"), "classes")
    discard(tiles, sets, of, *tried, *links)
    total = signed.count()
    many = full.groupBy("print").agg(F.count(F.lit(1)).alias("size"))
    groups = classes.join(many, "print").select("print", "component_id", "size")
    out = join_groups(signed.select(key, "print", "n"), groups, "print", "size", total, F.col(key))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key))
    return out.select(key, F.col("n").alias("n_shingles"), component.alias("component_id"), F.col(key).eqNullSafe(component).alias("kept"))
