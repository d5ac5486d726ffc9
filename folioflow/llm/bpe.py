"""Byte-level BPE: boundaries by scans over transition functions, slices through a cached pair merger.

The pre-tokens are the matches of 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|white space before white space or
the end|white space. Each code point becomes a symbol (its class, and what a look ahead of two code points
decides); a symbol is a function on the eight states of an automaton; functions compose associatively, so the
states after all code points come from a blocked scan of table look-ups on whole arrays.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words
from .shared import held, taken

#: Slices whose ids are remembered by a worker; the cache starts anew when it is full.
CACHE = 150_000
#: A code point array of this many is scanned in blocks of this length.
BLOCK = 128

LETTER, NUMBER, OTHER, SHORT, LONG, BLANK_LAST, WHITE_LAST, WHITE = range(8)
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_BLANK, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a new token starts at this code point)."""
    if state in (ONE_LEFT, TWO_LEFT):
        return (NEW if state == ONE_LEFT else ONE_LEFT), False
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    if symbol in (BLANK_LAST, WHITE_LAST):
        return (AFTER_BLANK if symbol == BLANK_LAST else NEW), True
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHER)
    if state in (AFTER_BLANK, run):
        return run, False
    if symbol in (SHORT, LONG):
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    return run, True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(composition table, function x state table, the functions of [symbol, symbol at the start of a text])."""
    plain = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    fresh = [tuple(f[NEW] for _ in range(8)) for f in plain]
    known = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    for f in todo:
        for g in (*plain, *fresh):
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    table = np.array([[known[tuple(g[s] for s in f)] for g in todo] for f in todo], np.uint16)
    return table, np.array(todo, np.uint8), np.array([[known[f] for f in plain], [known[f] for f in fresh]], np.uint16)


COMPOSE, APPLY, FUNCTION = _monoid()
STARTS = np.array([[_step(s, x)[1] for x in range(8)] for s in range(8)])


def _scan(f: np.ndarray) -> np.ndarray:
    """The composition of f[0] .. f[i] for every i."""
    n, m = len(f), len(COMPOSE)
    if n <= BLOCK:
        out, acc = np.empty(n, np.uint16), 0
        for i, x in enumerate(f):
            acc = COMPOSE[acc, x]
            out[i] = acc
        return out
    rows = -(-n // BLOCK)
    grid = np.zeros((rows, BLOCK), np.uint16)
    grid.reshape(-1)[:n] = f
    grid = np.ascontiguousarray(grid.T)
    flat = COMPOSE.reshape(-1)
    for j in range(1, BLOCK):
        grid[j] = flat[grid[j - 1].astype(np.intp) * m + grid[j]]
    before = np.zeros(rows, np.uint16)
    before[1:] = _scan(grid[-1])[:-1]
    return np.ascontiguousarray(flat[before.astype(np.intp) * m + grid].T).reshape(-1)[:n]


class _Classes:
    """LETTER, NUMBER, OTHER or WHITE of every code point, made once for a process."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            kind = {"L": LETTER, "N": NUMBER}
            table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
            # The code points with the property White_Space.
            table[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
            cls.table = table
        return cls.table


def boundaries(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Indices at which pre-tokens start; codes: code points of texts that start at text_starts."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _Classes.get()[codes]
    fresh = np.zeros(n + 2, bool)
    fresh[text_starts[text_starts < n]] = True
    fresh[n:] = True
    white = kind == WHITE
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = ~white[1:] & ~fresh[1:n]
    symbol = np.where(white & solid_next, np.where(codes == 0x20, BLANK_LAST, WHITE_LAST), kind)
    at = np.flatnonzero(codes == 0x27)
    if len(at):
        near = np.concatenate([codes, np.zeros(2, codes.dtype)])
        a, b = near[at + 1], near[at + 2]
        one, two = ~fresh[at + 1], ~fresh[at + 1] & ~fresh[at + 2]
        # The endings s t m d, re ve ll.
        symbol[at[one & np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
        pair = np.zeros(len(at), bool)
        for x, y in ("re", "ve", "ll"):
            pair |= (a == ord(x)) & (b == ord(y))
        symbol[at[two & pair]] = LONG
    after = _scan(FUNCTION[fresh[:n].astype(np.intp), symbol])
    state = np.zeros(n, np.uint8)
    state[1:] = APPLY[after[:-1], NEW]
    state[fresh[:n]] = NEW
    return np.flatnonzero(STARTS[state, symbol])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Pairs:
    """(id, id) -> id of the joined bytes or NONE, for whole arrays: open addressing, under a fifth full."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        found = {(a << 32) | b: i for t, i in ranks.items() for k in range(1, len(t)) if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None}
        self.bits = max(4, (5 * len(found)).bit_length())
        self.keys, self.ids = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.NONE, np.int32)
        keys, ids = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int32, len(found))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.ids[slot[free]] = keys[free], ids[free]
            left = self.keys[slot] != keys
            keys, ids, slot = keys[left], ids[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.intp)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        at = self.keys[slot]
        out = self.ids[slot]
        more = np.flatnonzero((at != keys) & (at >= 0))
        out[at != keys] = self.NONE
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[more]]
            hit = at == keys[more]
            out[more[hit]] = self.ids[slot[more[hit]]]
            more = more[~hit & (at >= 0)]
        return out


class Merger(dict):
    """Slice of bytes -> its ids as int32 bytes. New slices are merged together, one pair of each slice in a round."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE):
        super().__init__()
        self.ranks, self.limit, self.pairs = ranks, limit, _Pairs(ranks)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def learn(self, pieces: list[bytes]) -> None:
        """Afterwards all pieces are keys."""
        new = set(pieces).difference(self)
        if len(self) + len(new) > self.limit:
            self.clear()
            new = set(pieces)
        todo = []
        for piece in new:
            known = self.ranks.get(piece)
            if known is not None:
                self[piece] = known.to_bytes(4, sys.byteorder)
            elif len(piece) >= 100:
                self[piece] = np.array(self._long(piece), np.int32).tobytes()
            else:
                todo.append(piece)
        if todo:
            self._merge(todo)

    def _merge(self, pieces: list[bytes]) -> None:
        """Merge the lowest pair of every slice, leftmost first, until none of its pairs is a token."""
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        done = []
        while len(ids):
            rank = np.full(len(ids), self.pairs.NONE, np.int32)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.pairs.get(ids[:-1], ids[1:]), self.pairs.NONE)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.concatenate([first, [len(ids)]]))
            low = np.minimum.reduceat(rank, first)
            over = np.repeat(low == self.pairs.NONE, size)
            done.append((owner[over], ids[over]))
            hit = np.flatnonzero((rank == np.repeat(low, size)) & ~over)
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])] if len(hit) else hit
            ids[hit] = rank[hit]
            stay = ~over
            stay[hit + 1] = False
            ids, owner = ids[stay], owner[stay]
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        raw, at = ids[order].tobytes(), np.searchsorted(owner[order], np.arange(len(pieces) + 1)) * 4
        at = at.tolist()
        self.update((piece, raw[at[i] : at[i + 1]]) for i, piece in enumerate(pieces))

    def _long(self, piece: bytes) -> list[int]:
        """One slice by a heap over a linked list: n log n for any length."""
        n, get = len(piece), self.ranks.get
        end, following, previous = [*range(1, n + 1)], [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = following[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[i]:
                continue
            alive[j], end[i], following[i] = False, stop, following[j]
            if following[i] < n:
                previous[following[i]] = i
                if (r := get(piece[i : end[following[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[following[i]]))
            if (p := previous[i]) >= 0 and (r := get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = following[i]
        return out


class Codec:
    """Encodes and decodes whole columns by one vocabulary; kept by a worker from task to task."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    @cached_property
    def merge(self) -> Merger:
        """Only encoding needs it: a worker that decodes doesn't build it."""
        return Merger(self.ranks)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, byte offset of each id in its text, first id of each text and the end)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        cuts = lead[boundaries(codes, np.searchsorted(lead, offsets[:-1]))]
        ends = [*cuts[1:].tolist(), len(data)]
        pieces = [raw[a:b] for a, b in zip(cuts.tolist(), ends, strict=True)]
        self.merge.learn(pieces)
        found = list(map(self.merge.__getitem__, pieces))
        ids = np.frombuffer(b"".join(found), np.int32)
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        before = np.zeros(len(found) + 1, np.int64)
        np.cumsum(count, out=before[1:])
        first = before[np.searchsorted(cuts, offsets)]
        n = self.length[ids]
        start = np.cumsum(n) - n
        return ids, (start - np.repeat(offsets[:-1], np.diff(first))).astype(np.int32), first

    def decode(self, ids: np.ndarray, starts: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The bytes of each text: each token is written at its kept offset."""
        n = self.length[ids]
        count = np.diff(first)
        size = np.zeros(len(count), np.int64)
        some = count > 0
        size[some] = starts[first[1:][some] - 1] + n[first[1:][some] - 1]
        base = np.cumsum(size) - size
        where = starts + np.repeat(base, count)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out = np.zeros(int(size.sum()), np.uint8)
        out[np.repeat(where, n) + step] = self.bytes[np.repeat(self.at[ids], n) + step]
        raw = out.tobytes()
        return [raw[a : a + b] for a, b in zip(base.tolist(), size.tolist(), strict=True)]


def _codec(box) -> Codec:
    of, name = box
    return held(name, lambda: Codec(taken(of)))


def _shared(df: DataFrame, ranks: dict[bytes, int]):
    return df.sparkSession.sparkContext.broadcast(ranks), f"codec {hash(frozenset(ranks.items()))}"


def encode(docs: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids array<int>, starts array<int> (byte offset of each token) for each row.

    Null text is an empty one: no ids. Texts of any length are encoded whole; empty tables give no rows; rows
    that repeat are encoded each; other columns are not read. The vocabulary (a file of fixed size) is broadcast.
    """
    box = _shared(docs, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(box)
        for batch in batches:
            for a, b, data, offsets in words.chunks(batch.column(1)):
                ids, starts, first = codec.encode(data, offsets)
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (ids, starts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists], [key, "ids", "starts"])

    own = docs.select(key, text)
    return map_arrow(own, run, f"{own.schema[key].name} {own.schema[key].dataType.simpleString()}, ids array<int>, starts array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """encoded with the column bytes: the text that ids and starts stand for. Null ids decode to nothing."""
    box = _shared(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(box)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids, starts = part.column(1), part.column(2)
                first = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                texts = codec.decode(ids.flatten().to_numpy(), starts.flatten().to_numpy(), first)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, starts, pa.array(texts, pa.binary())], [key, "ids", "starts", "bytes"])

    own = encoded.select(key, "ids", "starts")
    kind = own.schema[key].dataType.simpleString()
    return map_arrow(own, run, f"{key} {kind}, ids array<int>, starts array<int>, bytes binary")


def digest(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(key, F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
