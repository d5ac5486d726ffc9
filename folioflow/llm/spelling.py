"""Spelling variants: words one error apart, by forward and backward minimal acyclic automata.

Of a word and one that differs by a single inserted, deleted or replaced code point, either the word's first half
stands unchanged at the other's start or its second half at the other's end. So words are dealt to tasks by halves:
a word goes to where words of its own length and of one more or less look for its first letters, and likewise for
its last ones, spelt backwards. A task builds one minimal automaton of each direction. Its edges add up to a perfect
hash (a word's rank), which leads to the word's count. A search follows the exact half and completes with one error.
A pair that both directions find is reported by the forward one.

Both counting and searching pre-aggregate in tasks; a task of the search holds the words that share halves with
those it looks for, about SHARD of them, and more tasks are used as the vocabulary grows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .shared import discard, staged

#: Runs of [A-Za-zÀ-ÿ] in UTF-8, lower-cased.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Words that a task counts before it passes its counts on.
HELD = 400_000
#: A text over so many bytes is counted run by run, without a list of its runs.
LONG = 1 << 20
#: Rows dealt to a task of the search (a word makes six).
SHARD = 60_000
#: Shortest word in code points, least occurrences.
LETTERS, OFTEN = 5, 3
SLIP = 97


def slipped(run: bytes, h: int) -> bytes:
    """The run as op11's contract has it: without the code point h % length where SLIP divides h."""
    if h % SLIP:
        return run
    own = run.decode()
    at = h % len(own)
    return (own[:at] + own[at + 1 :]).encode()


def count_words(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """word, n of every distinct word of at least LETTERS code points with at least OFTEN occurrences in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([*total], pa.binary()).cast(pa.string()), pa.array([*total.values()], pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text is None:
                    continue
                text = text.lower()  # of bytes: A-Z only
                seed = zlib.crc32(f"{name}:".encode())
                found = _RUN.findall(text) if len(text) < LONG else (m.group() for m in _RUN.finditer(text))
                for own, n in Counter(found).items():
                    if len(own) >= LETTERS:
                        own = slipped(own, zlib.crc32(own, seed))
                        total[own] = total.get(own, 0) + n
                if len(total) > HELD:
                    yield send()
                    total = {}
        yield send()

    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    found = map_arrow(docs.select(name, "text"), run, "word string, n long")
    return found.filter(F.char_length("word") >= LETTERS).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)


class Automaton:
    """The minimal acyclic automaton of sorted distinct strings. An edge is (target, how many strings come before)."""

    def __init__(self, forms: list[str]) -> None:
        edges: list[dict] = [{}]
        final = [False]
        free: list[int] = []
        known: dict[tuple, int] = {}
        path: list[tuple[int, str, int]] = []

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, letter, child = path.pop()
                sign = (final[child], *edges[child].items())
                same = known.setdefault(sign, child)
                if same != child:
                    edges[parent][letter] = same
                    edges[child], final[child] = {}, False
                    free.append(child)

        last = ""
        for form in forms:
            k = 0
            for x, y in zip(last, form):
                if x != y:
                    break
                k += 1
            settle(k)
            at = path[-1][2] if path else 0
            for letter in form[k:]:
                if free:
                    new = free.pop()
                else:
                    new = len(edges)
                    edges.append({})
                    final.append(False)
                edges[at][letter] = new
                path.append((at, letter, new))
                at = new
            final[at] = True
            last = form
        settle(0)
        size = [0] * len(edges)
        for at in [*known.values(), 0]:  # targets come before their sources
            before = int(final[at])
            for letter, to in edges[at].items():
                edges[at][letter] = (to, before)
                before += size[to]
            size[at] = before
        self.edges, self.final, self.size = edges, final, size[0]

    def _rest(self, at: int, form: str, i: int) -> int:
        """What the rest of the form adds to the number, from this state on; -1 if it isn't there."""
        edges, number = self.edges, 0
        while i < len(form):
            hit = edges[at].get(form[i])
            if hit is None:
                return -1
            at, before = hit
            number += before
            i += 1
        return number if self.final[at] else -1

    def number(self, form: str) -> int:
        """The form's rank, or -1."""
        return self._rest(0, form, 0)

    def near(self, form: str, half: int) -> Iterator[tuple[int, str]]:
        """(rank, string) of each string with the same first letters, half of them, and exactly one error behind, once each.

        Of places that give the same string, an insert takes the one behind a run of its letter, a delete a run's last.
        """
        at, number, n = 0, 0, len(form)
        for i in range(half):
            hit = self.edges[at].get(form[i])
            if hit is None:
                return
            at, number = hit[0], number + hit[1]
        for i in range(half, n + 1):
            own = form[i] if i < n else None
            here = self.edges[at]
            for letter, (to, before) in here.items():
                if letter != own:
                    rest = self._rest(to, form, i)
                    if rest >= 0:
                        yield number + before + rest, form[:i] + letter + form[i:]
                    if own is not None:
                        rest = self._rest(to, form, i + 1)
                        if rest >= 0:
                            yield number + before + rest, form[:i] + letter + form[i + 1 :]
            if own is None:
                return
            if i + 1 == n or form[i + 1] != own:
                rest = self._rest(at, form, i + 1)
                if rest >= 0:
                    yield number + rest, form[:i] + form[i + 1 :]
            hit = here.get(own)
            if hit is None:
                return
            at, number = hit[0], number + hit[1]


def _search(back: bool, rows: list[tuple[str, int, bool]]) -> Iterator[tuple]:
    """(word, n, near words found here, largest n among them, the least of these) for the rows (form, n, whether to look for it)."""
    forms, counts = [], []
    for form, own in groupby(rows, lambda r: r[0]):
        forms.append(form)
        counts.append(next(own)[1])
    automaton = Automaton(forms)
    for form, n, asked in rows:
        if not asked:
            continue
        first = len(form) // 2
        half = len(form) - first if back else first
        found, best = 0, None
        for rank, other in automaton.near(form, half):
            if back:
                other = other[::-1]
                if other[:first] == form[::-1][:first]:
                    continue  # the forward search finds it
            found += 1
            mine = (-counts[rank], other)
            best = mine if best is None or mine < best else best
        word = form[::-1] if back else form
        if found or not back:
            yield word, n, found, None if best is None else -best[0], None if best is None else best[1]


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, best_n, best of each row of words (word, n; distinct): how many words are one error away, and
    the one with the largest n (of several the least in code point order)."""
    length = F.char_length("word")
    first = lambda d: F.floor((length + d) / 2).cast("int")
    ways = []
    for d in (-1, 0, 1):  # as what a word of d more letters may be looking for
        ways.append(F.struct(F.lit(False).alias("back"), (length + d).alias("size"), F.substr("word", F.lit(1), first(d)).alias("half"), F.lit(d == 0).alias("asked")))
        last = length + d - first(d)
        ways.append(F.struct(F.lit(True).alias("back"), (length + d).alias("size"), F.substr(F.reverse("word"), F.lit(1), last).alias("half"), F.lit(d == 0).alias("asked")))
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words.count() * 6 // shard))
    rows = words.select("word", "n", F.explode(F.array(*ways)).alias("way")).select("way.*", "word", "n")
    form = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("form")
    dealt = rows.repartition(parts, "back", "size", "half").select("back", form, "n", "asked").sortWithinPartitions("back", "form", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[bool, list] = {False: [], True: []}
        for batch in batches:
            for back, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own[back].append(tuple(row))
        for back, held in own.items():
            out = [*_search(back, held)]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], ["word", "n", "found", "best_n", "best"])

    found = map_arrow(dealt, run, "word string, n long, found long, best_n long, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    out = found.groupBy("word", "n").agg(F.sum("found").alias("n_near"), best.alias("top"))
    return out.select("word", "n", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))


def variant_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words with their counts (word, n).

    A word's form is its near word of largest n (ties: the least in code point order) if that n is at least ratio
    (2 or more) times the word's own; root follows forms to the last, the word itself without one. A form's count is
    at least twice its word's, so chains are short, and each round doubles what is followed.
    """
    words = staged(words, "words")
    near = near_words(words)
    has = F.col("best_n") >= ratio * F.col("n")
    near = staged(near.select("word", "n", "n_near", F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "near-words")
    roots = staged(near.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        up = roots.select(F.col("word").alias("__at"), F.col("root").alias("__up"))
        on = staged(roots.join(up, roots["root"] == up["__at"], "left").select("word", F.coalesce("__up", "root").alias("root"), F.col("__up").isNotNull().alias("moved")), "roots")
        discard(roots)
        roots = on
        if not roots.filter("moved").limit(1).count():
            break
    up = roots.select(F.col("word").alias("__at"), "root")
    out = near.join(up, near["word"] == up["__at"], "left")
    discard(words)
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """variant_groups of the words of all whole texts. A null text has no words, a null key counts as an empty one in
    the slips; repeated rows count again, ties go by code points, other columns are not read, an empty table gives an
    empty result."""
    return variant_groups(count_words(docs, key))
