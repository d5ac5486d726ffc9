"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are compared as normalised bytes: letters lower-cased, each run of other ASCII than letters and digits and
of other white space and punctuation one space. CGK walks over a string with shared random bits: a step reads the
current byte and moves on or stays, as the bit for (step, byte) says; strings a few edits apart fall into step
again, so their walks agree in most places and edit distance becomes Hamming distance. A window of an item's
size is embedded by walks that start afresh at each of its words, so the walks of overlapping windows are the same
ones, and drift after an edit doesn't add up. Bytes sampled from a walk are a key of a hash table; each start of a
window has a key in each table. A window is a candidate if enough of its starts share a key with the item at places
that edits can bring about (diagonals, text position - item position, at most the allowed edits apart).
Candidates are verified by their exact edit distance. See Walks for the tables.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from . import words
from .shared import held, taken

#: An item is found where at most this share of its bytes is edited.
EDITS = 0.15
#: Normalised bytes of the shortest item that may be edited; shorter ones are found where they stand as whole words.
Q = 10
#: Bytes of text normalised and walked at once (whole rows), so that arrays stay in a core's cache; starts walked at
#: once; shared keys followed at once; candidates verified at once; bytes of text whose candidates are verified together.
PIECE, STARTS, HITS, BATCH, CHUNK = 1 << 18, 1 << 13, 1 << 20, 4096, 2 << 20
#: An unspaced stretch is walked from every character beyond so many bytes.
UNSPACED = 16


@dataclass(frozen=True)
class Walks:
    """How items from a size on are looked for: steps of a walk, bytes sampled for a key, tables, walks that they share,
    starts that have to agree; and whether walks start at every character or at words only."""

    least: int
    steps: int
    sample: int
    tables: int
    walks: int
    need: tuple[tuple[int, int], ...]  # (size of an item, starts that have to agree from there on)
    every: bool = False


#: A walk moves on at every other step. Long items have many starts, so few walks that outlast a word or two tell
#: enough; short ones are tried from every character, by short walks. Measured recall is in tests/llm/test_decontam.py.
KINDS = (
    Walks(10, 12, 8, 6, 2, ((10, 1),), True),
    Walks(24, 20, 8, 4, 2, ((24, 2),), True),
    Walks(40, 32, 8, 6, 2, ((40, 2),), True),
    Walks(64, 40, 8, 6, 2, ((64, 1), (100, 2), (200, 3))),
)
#: Bytes of a block of an item, by which candidates are verified first; up to FEW of what is left go one by one.
WORD, FEW = 64, 128
#: Bytes of benchmark text handled in one pass; a larger benchmark takes more passes.
BLOCK_BYTES = 4 << 20

_PLAIN = np.array([b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def _fold() -> np.ndarray:
    """Code point -> space for white space, punctuation and controls, else its lower-case letter; where that takes more bytes, the lower-case letter becomes the other."""
    out = np.arange(0x20000, dtype=np.uint32)
    for c in (chr(i) for i in range(128, len(out)) if not 0xD800 <= i < 0xE000):
        low = c.lower()[0]
        kind = unicodedata.category(c)
        if kind[0] in "PZ" or kind == "Cc":
            out[ord(c)] = 32
        elif low != c:
            one, other = (c, low) if len(low.encode()) <= len(c.encode()) else (low, c)
            out[ord(one)] = ord(other)
    return out


_FOLD = _fold()


def _folded(data: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Writes the folded characters beyond ASCII to plain; returns which bytes are left over."""
    over = np.zeros(len(data), bool)
    at = np.flatnonzero(data >= 0xC0)
    size = 2 + (data[at] >= 0xE0).astype(np.int64) + (data[at] >= 0xF0)
    point = data[at].astype(np.uint32) & (0x7F >> size).astype(np.uint32)
    for k in (1, 2, 3):
        more = size > k
        point[more] = point[more] << 6 | (data[at[more] + k] & 0x3F)
    new = np.where(point < len(_FOLD), _FOLD[np.minimum(point, len(_FOLD) - 1)], point)
    changed = new != point
    at, size, new = at[changed], size[changed], new[changed]
    length = 1 + (new >= 0x80).astype(np.int64) + (new >= 0x800) + (new >= 0x10000)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[length]
    plain[at] = lead | new >> (6 * (length - 1)).astype(np.uint32)
    for k in (1, 2, 3):
        more = length > k
        plain[at[more] + k] = 0x80 | new[more] >> (6 * (length[more] - 1 - k)).astype(np.uint32) & 0x3F
        over[at[(size > k) & ~more] + k] = True
    return over


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows (first, end) of about PIECE bytes; a longer row is one of them."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        yield row, end
        row = end


def _normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    plain = _PLAIN[data]
    at = None
    if (data >= 0xC0).any():
        at = np.flatnonzero(~_folded(data, plain))
        plain, offsets = plain[at], np.searchsorted(at, offsets)
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != 32) | (plain[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < len(plain)]] = True
    own = np.flatnonzero(keep)
    return plain[own], np.searchsorted(own, offsets), own if at is None else at[own]


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(normalised bytes, row offsets in them, place of each in data)."""
    out, rows, place, size = [], [np.zeros(1, np.int64)], [], 0
    for r, e in _pieces(offsets):
        a, b = int(offsets[r]), int(offsets[e])
        x, at, own = _normalised(data[a:b], offsets[r : e + 1] - a)
        out.append(x)
        rows.append(at[1:] + size)
        place.append((own + a).astype(np.uint32))  # a chunk is far below 4 GB
        size += len(x)
    if not out:
        return np.zeros(0, np.uint8), rows[0], np.zeros(0, np.uint32)
    return np.concatenate(out), np.concatenate(rows), np.concatenate(place)


def edit_search(item: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of item to any stretch of text, first end of such a stretch); bit-parallel columns."""
    n = len(item)
    full, high = (1 << n) - 1, 1 << (n - 1)
    at: dict[int, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score, best, end = full, 0, n, n, 0
    for j, c in enumerate(text, 1):
        eq = at.get(c, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(across | plus) & full
        down = plus & across
        score += 1 if up & high else -1 if down & high else 0
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score < best:
            best, end = score, j
    return best, end


def least_edits(items: list[bytes], of: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The edit distance of items[of] to the nearest stretch of text[start:end], for many at once: edit_search in words of 64 rows."""
    out = np.zeros(len(of), np.int64)
    sizes = np.array([len(x) for x in items], np.int64)
    one, top, zero = np.uint64(1), np.uint64(63), np.uint64(0)
    words_of = -(-sizes[of] // 64)
    width = 1 << np.ceil(np.log2(np.maximum(words_of, 1))).astype(np.int64)
    for w in np.unique(width).tolist():
        group = np.flatnonzero(width == w)
        group = group[np.argsort(of[group], kind="stable")]
        w = int(words_of[group].max())
        for part in (group[a : a + BATCH] for a in range(0, len(group), BATCH)):
            there, mine = np.unique(of[part], return_inverse=True)
            eq_of = np.zeros((w, len(there), 257), np.uint64)
            n = sizes[there]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            byte = np.frombuffer(b"".join(items[i] for i in there.tolist()), np.uint8)
            np.bitwise_or.at(eq_of, (place >> 6, np.repeat(np.arange(len(n)), n), byte), one << (place & 63).astype(np.uint64))
            eq_of = eq_of.reshape(w, -1)
            last = ((sizes[of[part]] - 1) & 63).astype(np.uint64)
            ends_in = [np.flatnonzero(words_of[part] == k + 1) for k in range(w)]
            plus, minus = np.full((w, len(part)), ~zero), np.zeros((w, len(part)), np.uint64)
            score = sizes[of[part]].copy()
            best = score.copy()
            a, b = starts[part], ends[part]
            for j in range(int((b - a).max(initial=0))):
                code = np.where(a + j < b, text[np.minimum(a + j, len(text) - 1)], np.int64(256)) + mine * 257
                rise = fall = np.zeros(len(part), np.uint64)
                for k in range(w):
                    eq, p, m = eq_of[k][code], plus[k], minus[k]
                    vertical = eq | m
                    eq = eq | fall
                    across = (((eq & p) + p) ^ p) | eq
                    up, down = m | ~(across | p), p & across
                    if len(own := ends_in[k]):
                        score[own] += ((up[own] >> last[own]) & one).astype(np.int64) - ((down[own] >> last[own]) & one).astype(np.int64)
                    up, rise = up << one | rise, up >> top
                    down, fall = down << one | fall, down >> top
                    plus[k], minus[k] = down | ~(vertical | up), up & vertical
                np.minimum(best, score, out=best)
            out[part] = best
    return out


def walk_starts(x: np.ndarray, offsets: np.ndarray, every: bool = False) -> np.ndarray:
    """Places where walks start: words, and each character where a stretch is unspaced; or every character but spaces."""
    word = x != 32
    head = word.copy()
    head[1:] &= ~word[:-1]
    rows = offsets[:-1][offsets[:-1] < len(x)]
    head[rows] = word[rows]
    character = word & ((x & 0xC0) != 0x80)
    if every:
        return np.flatnonzero(character)
    heads = np.flatnonzero(head)
    size = np.diff(np.append(heads, len(x)))
    long = heads[size > UNSPACED]  # with the space after it, or more words' rest: only characters count
    if not len(long):
        return heads
    inside = np.zeros(len(x) + 1, np.int32)
    inside[long + UNSPACED] += 1
    inside[np.append(heads, len(x))[np.searchsorted(heads, long) + 1]] -= 1
    return np.flatnonzero(head | (character & (np.cumsum(inside[:-1]) > 0)))


class Tables:
    """The keys of the items of one kind."""

    def __init__(self, kind: Walks, items: list[bytes], of: np.ndarray, seed: int = 7):
        """of: the numbers of this kind's items."""
        self.kind = kind
        random = np.random.default_rng(seed + kind.least)
        #: walk -> byte -> its random bits, one for each step.
        self.bits_of = random.integers(0, 1 << 62, (kind.walks, 256))
        #: walk -> step -> (table, place in its key) of those that sample it.
        self.plan: list[list[list[tuple[int, int]]]] = [[[] for _ in range(kind.steps)] for _ in range(kind.walks)]
        for t in range(kind.tables):
            for place, step in enumerate(random.choice(kind.steps, kind.sample, replace=False).tolist()):
                self.plan[t % kind.walks][step].append((t, place))
        gap = bytes(kind.steps)
        flat = np.frombuffer(b"".join(items[i] + gap for i in of.tolist()), np.uint8)
        sizes = np.array([len(items[i]) for i in of.tolist()])
        first = np.cumsum(sizes + kind.steps) - sizes - kind.steps
        starts = walk_starts(flat, np.concatenate([first, [len(flat)]]), kind.every)
        starts = starts[flat[starts] != 0]
        own = np.searchsorted(first, starts, "right") - 1
        place = starts - first[own]
        # a walk that outruns its item meets other text there: it counts only where it is the item's first
        good = (place + kind.steps // 2 <= sizes[own]) | (place == 0)
        self.item, self.place, starts = of[own[good]], place[good], starts[good]
        keys = self.keys(flat, starts)
        self.bits = max(16, (32 * len(starts)).bit_length())
        #: For each table: which cells have postings; first posting of each cell and the end; key of each posting, and what it is.
        self.maybe, self.first, self.sorted, self.order = [], [], [], []
        for own in keys:
            cell = self._cell(own)
            order = np.argsort(cell, kind="stable")
            first = np.zeros((1 << self.bits) + 1, np.int32)
            np.cumsum(np.bincount(cell, minlength=1 << self.bits), out=first[1:])
            self.maybe.append(first[1:] > first[:-1])
            self.first.append(first)
            self.sorted.append(own[order])
            self.order.append(order)

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ keys >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.intp)

    def keys(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of keys for each table, a column for each start. x ends with as many bytes as a walk has steps, or more, that no start reaches."""
        sampled = np.zeros((self.kind.tables, len(starts), 8), np.uint8)
        if not len(starts):
            return sampled.view(np.uint64)[:, :, 0]
        first = int(starts[0])
        near = x[first : int(starts[-1]) + self.kind.steps + 1]
        move, byte = np.empty(len(starts), np.int64), np.empty(len(starts), np.uint8)
        for plan, bits_of in zip(self.plan, self.bits_of, strict=True):
            at, bits = starts - first, bits_of[near]
            for step in range(max((s for s, tables in enumerate(plan) if tables), default=-1) + 1):
                if plan[step]:
                    np.take(near, at, out=byte, mode="clip")
                    for t, place in plan[step]:
                        sampled[t, :, place] = byte
                np.take(bits, at, out=move, mode="clip")
                move >>= step
                move &= 1
                at += move
        return sampled.view(np.uint64)[:, :, 0]

    def shared(self, x: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, item, place in it) of starts that share a key, about HITS at once; all of a start come together."""
        for a in range(0, len(starts), STARTS):
            part = starts[a : a + STARTS]
            hits = []
            for key, maybe, first in zip(self.keys(x, part), self.maybe, self.first, strict=True):
                cell = self._cell(key)
                some = np.flatnonzero(maybe[cell])
                cell = cell[some]
                hits.append((some, first[cell], first[cell + 1] - first[cell], key[some]))
            total = np.cumsum(sum((np.bincount(s, many, len(part)) for s, _, many, _ in hits), np.zeros(len(part)))).astype(np.int64)
            edge = 0
            while edge < len(part):
                stop = max(edge + 1, int(np.searchsorted(total, (total[edge - 1] if edge else 0) + HITS, "right")))
                found = []
                for (s, lo, many, key), own, order in zip(hits, self.sorted, self.order, strict=True):
                    mine = slice(*np.searchsorted(s, (edge, stop)))
                    s, lo, many, key = s[mine], lo[mine], many[mine], key[mine]
                    ends = np.cumsum(many)
                    post = np.repeat(lo - (ends - many), many) + np.arange(many.sum())
                    same = own[post] == np.repeat(key, many)  # others only share the cell
                    found.append(np.repeat(s, many)[same] * len(self.item) + order[post[same]])
                found = np.unique(np.concatenate(found))
                if len(found):
                    post = found % len(self.item)
                    yield part[found // len(self.item)], self.item[post], self.place[post]
                edge = stop


class Finder:
    """Finds items in normalised bytes."""

    def __init__(self, items: list[bytes], seed: int = 7):
        self.items = [x for x in items if len(x) >= Q]
        self.of = [i for i, x in enumerate(items) if len(x) >= Q]
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.most = np.array([math.floor(EDITS * len(x)) for x in self.items], np.int64)
        kind = np.searchsorted([k.least for k in KINDS], self.sizes, "right") - 1
        #: Blocks of items: all of them, each one's place in its item; each item's first, and how many it has.
        self.parts = np.maximum(1, -(-self.sizes // WORD))
        cuts = [np.linspace(0, n, p + 1).astype(int).tolist() for n, p in zip(self.sizes.tolist(), self.parts.tolist(), strict=True)]
        self.blocks = [x[a:b] for x, c in zip(self.items, cuts, strict=True) for a, b in zip(c[:-1], c[1:], strict=True)]
        self.block_at = np.array([a for c in cuts for a in c[:-1]], np.int64)
        self.block_size = np.array([len(x) for x in self.blocks], np.int64)
        self.first_block = np.cumsum(self.parts) - self.parts
        #: Starts that have to agree.
        self.need = np.array([[n for at, n in k.need if at <= x][-1] for k, x in zip([KINDS[i] for i in kind], self.sizes, strict=True)], np.int64)
        self.tables = [Tables(k, self.items, np.flatnonzero(kind == i), seed) for i, k in enumerate(KINDS) if (kind == i).any()]
        #: length -> first eight bytes as a number -> items, for those under Q bytes.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, x in enumerate(items):
            if 0 < len(x) < Q:
                self.short.setdefault(len(x), {}).setdefault(int.from_bytes(x[:8], "little"), []).append(i)
        self.own = items

    def _windows(self, x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first diagonal, last diagonal) of windows that enough starts point to."""
        out = [np.zeros((3, 0), np.int64)]
        for r, e in _pieces(offsets):
            a, b = int(offsets[r]), int(offsets[e])
            item, lo, hi = self._near(x[a:b], offsets[r : e + 1] - a)
            out.append(np.array([item, lo + a, hi + a]))
        return tuple(np.concatenate(out, axis=1))

    def _near(self, x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = []
        padded = np.concatenate([x, np.zeros(max((t.kind.steps for t in self.tables), default=0) + 1, np.uint8)])
        for tables in self.tables:
            rest = np.zeros((0, 2), np.int64)
            for start, item, place in tables.shared(padded, walk_starts(x, offsets, tables.kind.every)):
                hits = np.concatenate([rest, np.column_stack([item, start - place])])
                hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
                for _, need in tables.kind.need:
                    near, last = hits[: max(0, len(hits) - need + 1)], hits[need - 1 :]
                    most = self.most[near[:, 0]]
                    good = (self.need[near[:, 0]] == need) & (near[:, 0] == last[:, 0]) & (last[:, 1] - near[:, 1] <= most)
                    item, first, k = near[good, 0], near[good, 1], most[good] + 1
                    out.append(np.unique(np.column_stack([item, first // k]), axis=0))
                # what later starts can still agree with
                rest = hits[(hits[:, 1] >= start[-1] - int((self.sizes + self.most).max())) & (self.need[hits[:, 0]] > 1)]
        item, bin_ = np.unique(np.concatenate(out), axis=0).T if out else np.zeros((2, 0), np.int64)
        # the window's true diagonal is at most the allowed edits from each of its starts' ones
        k = self.most[item]
        return item, bin_ * (k + 1) - k, (bin_ + 1) * (k + 1) + k

    def _whole_words(self, x: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, 0, start, end) of items under Q bytes where they stand as whole words."""
        if not self.short or not len(x):
            return []
        end = np.append(x == 32, True)
        end[offsets] = True
        start = np.concatenate([[True], x[:-1] == 32])
        start[offsets[:-1][offsets[:-1] < len(x)]] = True
        start = np.flatnonzero(start & (x != 32))
        stop = offsets[np.searchsorted(offsets, start, "right")]
        eight = np.ndarray((len(x),), np.dtype("<u8"), np.concatenate([x, np.zeros(8, np.uint8)]), 0, (1,))
        out = []
        for n, known in self.short.items():
            mine = start[start + n <= stop]
            mine = mine[end[mine + n]]
            value = eight[mine] & np.uint64((1 << (8 * min(n, 8))) - 1)
            hit = np.isin(value, np.array([*known], np.uint64))
            for at, v in zip(mine[hit].tolist(), value[hit].tolist(), strict=True):
                row = int(np.searchsorted(offsets, at, "right")) - 1
                out += [(row, i, 0, at, at + n) for i in known[v] if self.own[i] == x[at : at + n].tobytes()]
        return out

    def _candidates(self, x: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, start, end) of stretches that hold an item."""
        if not len(x) or not self.items:
            return []
        item, lo, hi = self._windows(x, offsets)
        first = np.searchsorted(offsets, np.maximum(lo, 0), "right") - 1
        last = np.searchsorted(offsets, np.minimum(hi + self.sizes[item], len(x)), "left") - 1
        many = np.maximum(0, last - first + 1)
        row = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        item, lo, hi = (np.repeat(c, many) for c in (item, lo, hi))
        start, stop = offsets[row], offsets[row + 1]
        fits = np.minimum(hi + self.sizes[item], stop) - np.maximum(lo, start) >= self.sizes[item] - self.most[item]
        row, item, lo, hi, start, stop = (c[fits] for c in (row, item, lo, hi, start, stop))
        # of all edits, a block of an item gets its share at most, or another block does
        parts = self.parts[item]
        of = np.repeat(np.arange(len(item)), parts)
        block = self.first_block[item[of]] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        a = np.minimum(np.maximum(lo[of] + self.block_at[block], start[of]), stop[of])
        b = np.minimum(np.maximum(hi[of] + self.block_at[block] + self.block_size[block], a), stop[of])
        good = np.zeros(len(item), bool)
        good[of[least_edits(self.blocks, block, x, a, b) <= (self.most // self.parts)[item[of]]]] = True
        row, item, lo, hi, start, stop = (c[good] for c in (row, item, lo, hi, start, stop))
        a, b = np.maximum(lo, start), np.minimum(hi + self.sizes[item], stop)
        if len(item) > FEW:
            edits = least_edits(self.items, item, x, a, b)
        else:
            edits = np.array([0 if self.items[i] in (t := x[p:q].tobytes()) else edit_search(self.items[i], t)[0] for i, p, q in zip(item.tolist(), a.tolist(), b.tolist(), strict=True)], np.int64)
        good = edits <= self.most[item]
        return [tuple(f) for f in np.unique(np.column_stack([row, item, a, b])[good], axis=0).tolist()]

    def find(self, x: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, edits, start, end) in x; overlapping finds of one item in a row count once, the best of them."""
        best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        raw = x.tobytes()
        for row, i, lo, hi in self._candidates(x, offsets):
            item, kept = self.items[i], best.setdefault((row, i), [])
            a = raw.find(item, lo, hi)
            edits, b = 0, a + len(item)
            if a < 0:
                text = raw[lo:hi]
                edits, end = edit_search(item, text)
                _, back = edit_search(item[::-1], text[:end][::-1])
                a, b = lo + end - back, lo + end
            if kept and a < kept[-1][2]:
                kept[-1] = min(kept[-1], (edits, a, b))
            else:
                kept.append((edits, a, b))
        return sorted([(row, self.of[i], e, a, b) for (row, i), found in best.items() for e, a, b in found] + self._whole_words(x, offsets))


def _blocks(benchmark: DataFrame) -> Iterator[pa.Table]:
    """The benchmark's items in blocks of about BLOCK_BYTES: what a pass broadcasts is bounded, not the benchmark."""
    own = benchmark.select("item_id", "text").filter("text is not null")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        part = own.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k) if n > 1 else own
        yield part.sort("item_id", "text").toArrow()


def _finder(box, name: str) -> Finder:
    return held(name, lambda: Finder(taken(box)))


def _items(rows: pa.Table | list[dict]) -> list[bytes]:
    out = []
    for r in rows.select(["text"]).to_pylist() if isinstance(rows, pa.Table) else rows:
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        out.append(normalised(raw, np.array([0, len(raw)]))[0].tobytes().strip(b" "))
    return out


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, item_id, edits, span_start, span_end (code points of the text) for each place of a row that holds an item.

    An item is held where at most EDITS of its normalised bytes are edited: candidates come from the tables (see
    KINDS for their recall, the tests for its measure) and are exactly verified. Items under Q normalised bytes are
    found where they stand unedited as whole words. Overlapping finds of one item count once. Null and empty
    texts hold nothing, nor do items that are null or have no letter or digit; items with equal texts are all
    reported, rows that repeat as well. Texts are searched whole, however long; other columns aren't read. An
    empty table gives an empty result. item_id may be of any type. A benchmark beyond BLOCK_BYTES takes one pass
    over docs for each block of items.
    """
    out = None
    for rows in _blocks(benchmark):
        box, name = docs.sparkSession.sparkContext.broadcast(_items(rows)), uuid.uuid4().hex
        ids = rows["item_id"].combine_chunks()

        def run(batches: Iterator[pa.RecordBatch], box=box, name=name, ids=ids) -> Iterator[pa.RecordBatch]:
            finder = _finder(box, name)
            for batch in batches:
                for first, _, data, offsets in words.chunks(batch.column(1), CHUNK):
                    x, rows_at, place = normalised(data, offsets)
                    found = finder.find(x, rows_at)
                    if not found:
                        continue
                    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    row, item, edits, a, b = (np.array(c) for c in zip(*found, strict=True))
                    base = lead[offsets[row]]
                    span = [lead[place[a] + 1] - 1 - base, lead[place[b - 1] + 1] - base]
                    keys = batch.column(0).take(pa.array(row + first))
                    yield pa.RecordBatch.from_arrays([keys, ids.take(pa.array(item)), pa.array(edits, pa.int32()), *(pa.array(s, pa.int64()) for s in span)], [key, "item_id", "edits", "span_start", "span_end"])

        own = docs.select(key, "text")
        kinds = [own.schema[key].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
        one = map_arrow(own, run, f"{key} {kinds[0]}, item_id {kinds[1]}, edits int, span_start long, span_end long")
        out = one if out is None else out.unionByName(one)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs, with all columns, without the rows that hold an item; rows are filtered where they are read, nothing is shuffled.

    Null and empty texts stay, and so does everything if the benchmark is empty; each row is decided by its own
    text, whatever its key. See find_items for what is held.
    """
    at = docs.columns.index("text")
    for rows in _blocks(benchmark):
        box, name = docs.sparkSession.sparkContext.broadcast(_items(rows)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], box=box, name=name) -> Iterator[pa.RecordBatch]:
            finder = _finder(box, name)
            for batch in batches:
                for a, b, data, offsets in words.chunks(batch.column(at), CHUNK):
                    x, rows_at, _ = normalised(data, offsets)
                    clean = np.ones(b - a, bool)
                    clean[[f[0] for f in finder.find(x, rows_at)]] = False
                    yield batch.slice(a, b - a).filter(pa.array(clean))

        docs = map_arrow(docs, run, docs.schema)
    return docs
