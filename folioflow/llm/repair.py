"""Conversation structure repair by a lazily determinised weighted automaton.

A conversation's rows are read from the last to the first. The automaton's four states say what has been kept so
far: nothing, a system turn, a user turn, an assistant turn. The least cost to go from each of them is a vector;
less its least entry, it is one state of the determinised automaton. `Table` finds the successor of a state under a
row's symbol (role initial and fault) when it is first asked for and keeps it, with the edit that each of the four
states then takes. Only few vectors exist, so long scans are lookups. The trace runs against the scan, from the first
row on, along tight arcs; among tight arcs the least edit initial goes first, so the audit is the least of the cheapest.

Rows are dealt by range of (conversation, turn), so a conversation of any length is spread over tasks. Rows that are
equal throughout are one row with a count. A task's first and last conversation may go on in its neighbours: for those
it reports the scan from each of the four states' unit vectors, and, in a second look, where each entry leads. Both
are composed on the driver, two rows for each task at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..shipping import map_arrow
from .shared import discard, join_groups, staged

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the next user or assistant turn, which may be kept, reroled or inserted.
NEXT = (USER, USER, ASSISTANT, USER)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
INF = float("inf")
#: Cost to go at the end: START and ASSISTANT may end, the others insert what is missing.
END = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
#: A row that has to go; otherwise a symbol is 2 * "sua".find(initial) + truncated + 1, with another initial as 3.
MUST_GO = 0
_SHIFT = 33  # monotonically_increasing_id: the partition is above these bits


def symbol(initial: str, cut: bool) -> int:
    kind = "sua".find(initial) if initial else -1
    return 1 + 2 * (kind if kind >= 0 else 3) + cut


class Table:
    """The determinised automaton as far as it has been asked for."""

    def __init__(self) -> None:
        self.vectors: list[tuple] = []
        self.rows: list[dict[int, tuple]] = []
        self._ids: dict[tuple, int] = {}

    def state(self, vector: Iterable[float]) -> tuple[int, float]:
        """(id of the normalised vector, what was taken off)."""
        vector = tuple(vector)
        least = min(vector)
        vector = tuple(x - least for x in vector)
        if vector not in self._ids:
            self._ids[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.rows.append({})
        return self._ids[vector], least

    def step(self, after: int, sym: int) -> tuple[int, float, tuple]:
        """(state before the row, weight, for each of the four states its edits, where they lead and their cost)."""
        found = self.rows[after].get(sym)
        if found is None:
            found = self.rows[after][sym] = self._step(self.vectors[after], sym)
        return found

    def _step(self, after: tuple, sym: int) -> tuple[int, float, tuple]:
        arcs: list[list[tuple[str, int, int]]] = []  # of each state those that use the row up: (edit, to, cost)
        for q in range(4):
            own = [("D", q, DELETE)]
            if sym != MUST_GO:
                kind, cut = divmod(sym - 1, 2)
                if kind < 3 and (q == START if kind == 0 else NEXT[q] == (USER, ASSISTANT)[kind - 1]):
                    own.append(("K", (SYSTEM, USER, ASSISTANT)[kind], cut * CUT))
                own.append(("R", NEXT[q], REROLE + cut * CUT))
            arcs.append(own)
        plain = [min(cost + after[to] for _, to, cost in own) for own in arcs]
        go = [min(plain[q], INSERT + plain[NEXT[q]], 2 * INSERT + plain[NEXT[NEXT[q]]]) for q in range(4)]
        taken = []
        for q in range(4):
            if go[q] == INF:
                taken.append(None)
                continue
            edits, at, total = "", q, 0
            while True:
                tight = [("I", NEXT[at], INSERT)] if INSERT + go[NEXT[at]] == go[at] else []
                edit, to, cost = min(tight + [x for x in arcs[at] if x[2] + after[x[1]] == go[at]])
                edits, at, total = edits + edit, to, total + cost
                if edit != "I":
                    break
            taken.append((edits, at, total))
        before, weight = self.state(go)
        return before, weight, tuple(taken)

    def scan(self, symbols: list[int], vector: Iterable[float]) -> tuple[list[int], tuple]:
        """(the state after each row, the costs to go before the first), from the costs to go after the last."""
        at, total = self.state(vector)
        after = [0] * len(symbols)
        for i in range(len(symbols) - 1, -1, -1):
            after[i] = at
            at, weight, _ = self.step(at, symbols[i])
            total += weight
        return after, tuple(x + total for x in self.vectors[at])

    def trace(self, symbols: list[int], after: list[int], q: int) -> tuple[list[tuple[str, int, int]], int]:
        """For each row (edits, entry state, cost), and the state behind the last."""
        out = []
        for sym, at in zip(symbols, after, strict=True):
            edits, to, cost = self.step(at, sym)[2][q]
            out.append((edits, q, cost))
            q = to
        return out, q


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows as op13's contract damages them; a null is one space, in the key too."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    own = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("h")).filter("h <> 0")
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    own = own.select("conv_id", "turn", role, text, F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return own.drop("copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")


_ORDER = ("conv_id", "turn", "role", "digest")


def _symbols(rows: DataFrame) -> DataFrame:
    """pos (the order of all rows), conv_id, turn, role, digest, m (equal rows), initial, blank, again, cut; staged."""
    full = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    own = rows.select("conv_id", "turn", "role", _digest(), (~full).alias("blank"), (~ends).alias("cut"))
    own = own.groupBy(*_ORDER).agg(F.count(F.lit(1)).alias("m"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    own = staged(own.withColumn("same", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.hex(F.col("conv_id").cast("string")), F.lit("-")), F.hex("role"), F.hex("digest"))))), "turns")
    # where a role and text are first seen: null turns come first, so they make the first turn null
    first = own.groupBy("same").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = join_groups(own, first, "same", "n", own.count(), F.col("turn"))
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first"))), F.lit(False)).alias("again")
    own = own.select(*_ORDER, "m", "blank", again, "cut")
    dealt = own.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return staged(dealt.withColumn("pos", F.monotonically_increasing_id()), "symbols")


_READ = ("pos", "conv_id", "turn", "role", "m", "blank", "again", "cut")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], bool]]:
    """(part, its rows of one conversation, whether they are the part's first), of rows that come part by part in order."""
    held: list[tuple] = []
    name, first = None, True
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(len(_READ))), strict=True):
            key = (row[0] >> _SHIFT, row[1])
            if held and key != name:
                yield name[0], held, first
                first = key[0] != name[0]
                held = []
            name = key
            held.append(row)
    if held:
        yield name[0], held, first


def _code(rows: list[tuple]) -> list[int]:
    return [MUST_GO if blank or again else symbol(role[:1], cut) for _, _, _, role, _, blank, again, cut in rows]


def _in_parts(symbols: DataFrame) -> DataFrame:
    part = F.shiftright("pos", _SHIFT)
    return symbols.select(*_READ).repartition(part).sortWithinPartitions("pos")


def _crossing(symbols: DataFrame) -> tuple[dict[int, tuple], dict[int, tuple]]:
    """For parts whose last conversation goes on: (pos where it starts there, the costs to go behind the part). For parts
    whose first conversation began before: (entry state, last initial and last turn before). Two pieces of a part are
    looked at, at most."""
    part = F.shiftright("pos", _SHIFT).alias("part")
    kind = symbols.schema["conv_id"].dataType.simpleString()
    ends = symbols.groupBy(part).agg(F.min_by("conv_id", "pos").alias("head"), F.max_by("conv_id", "pos").alias("tail"), F.min("pos").alias("at")).orderBy("part").collect()
    joins = [i for i in range(1, len(ends)) if ends[i - 1]["tail"] == ends[i]["head"]]
    if not joins:
        return {}, {}
    names = symbols.sparkSession.createDataFrame(sorted({(ends[i]["head"],) for i in joins}, key=str), f"name {kind}")
    rows = symbols.join(F.broadcast(names), symbols["conv_id"].eqNullSafe(names["name"]), "left_semi")
    of = {r["part"]: i for i, r in enumerate(ends)}
    entries = {i for i in joins}

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out = Table(), []
        for at, held, _ in _pieces(batches):
            code = _code(held)
            units = [[0 if q == k else INF for q in range(4)] for k in range(4)]
            costs = [x for unit in units for x in table.scan(code, unit)[1]]
            out.append((at, held[0][0], [float(x) for x in costs], held[-1][3][:1], held[-1][2]))
        yield _batch(out, ("part", "at", "costs", "initial", "turn"), (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.string(), number))

    turn = symbols.schema["turn"].dataType
    number = to_arrow_type(turn)
    found = map_arrow(_in_parts(rows), sketch, f"part long, at long, costs array<double>, initial string, turn {turn.simpleString()}").collect()
    # a part has two crossing pieces at most: its first conversation's, and its last one's
    head = {of[r["part"]]: r for r in found if r["at"] == ends[of[r["part"]]]["at"]}
    tail: dict[int, object] = {}
    for r in found:
        i = of[r["part"]]
        if i not in tail or r["at"] > tail[i]["at"]:
            tail[i] = r
    behind: dict[int, tuple] = {}
    for i in reversed(joins):
        piece = head[i]
        goes_on = i + 1 in entries and tail[i]["at"] == piece["at"]
        right = behind[i] if goes_on else END
        costs = piece["costs"]
        behind[i - 1] = tuple(min(right[k] + costs[4 * k + q] for k in range(4)) for q in range(4))
    by_part = {ends[i]["part"]: (tail[i]["at"], v) for i, v in behind.items()}
    box = symbols.sparkSession.sparkContext.broadcast(by_part)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out = Table(), []
        for at, held, _ in _pieces(batches):
            start, vector = box.value.get(at, (None, END))
            if start == held[0][0]:
                code = _code(held)
                after, go = table.scan(code, vector)
                out.append((at, held[0][0], [table.trace(code, after, q)[1] if go[q] < INF else -1 for q in range(4)]))
        yield _batch(out, ("part", "at", "to"), (pa.int64(), pa.int64(), pa.list_(pa.int64())))

    leads = {of[r["part"]]: r for r in map_arrow(_in_parts(rows), lead, "part long, at long, to array<long>").collect()}
    before: dict[int, tuple] = {}
    for i in joins:
        came_on = i - 1 in entries and leads[i - 1]["at"] == head[i - 1]["at"]
        entry = before[i - 1][0] if came_on else START
        before[i] = (leads[i - 1]["to"][entry], tail[i - 1]["initial"], tail[i - 1]["turn"])
    return by_part, {ends[i]["part"]: v for i, v in before.items()}


def _batch(rows: list[tuple], names: tuple, kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], list(names))


def plan_edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each row of conv_id, turn, role, text (none null but conv_id and turn), staged.

    Columns: conv_id, turn, role, digest (MD5 of the text), pos (order), m (equal rows, of which all but one are
    deleted), entry (state before), edits (initials; those of inserts stand before the row's own, at a conversation's
    end behind it), cost, blank, duplicate, truncated, illegal, numbers (new turn numbers), audit (all edits of a
    task's rows of a conversation, on the last of them).

    Order is by turn, nulls first, then role, then the text's MD5; a null conv_id is one conversation; an empty table
    gives an empty one. Other columns are not read.
    """
    symbols = _symbols(rows)
    box = symbols.sparkSession.sparkContext.broadcast(_crossing(symbols))
    names = ("pos", "entry", "edits", "cost", "blank", "duplicate", "truncated", "illegal", "numbers", "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out = Table(), []
        right, left = box.value
        for part, held, first in _pieces(batches):
            start, vector = right.get(part, (None, END))
            goes_on = start == held[0][0]
            entry, initial, turn = left[part] if first and part in left else (START, None, None)
            code = _code(held)
            after, _ = table.scan(code, vector if goes_on else END)
            edits, q = table.trace(code, after, entry)
            all_edits = []
            for k, ((_, _, now, role, m, blank, again, cut), (edit, at, cost)) in enumerate(zip(held, edits, strict=True)):
                edit, cost = edit + "D" * (m - 1), cost + DELETE * (m - 1)
                if k == len(held) - 1 and not goes_on:
                    edit, cost = edit + END_EDITS[q], cost + INSERT * len(END_EDITS[q])
                all_edits.append(edit)
                mine = role[:1]
                illegal = (m - 1) + (initial is not None and initial + mine not in ("su", "ua", "au"))
                new = now is not None and now != turn
                said = (0 if blank else m - (not again), int(cut and not blank and not again))
                out.append((held[k][0], at, edit, cost, m if blank else 0, *said, illegal, int(new), "".join(all_edits) if k == len(held) - 1 else None))
                initial, turn = mine, now if now is not None else turn
            if len(out) > 20_000:
                yield _batch(out, names, _KINDS)
                out = []
        yield _batch(out, names, _KINDS)

    made = map_arrow(_in_parts(symbols), run, "pos long, entry long, edits string, cost long, blank long, duplicate long, truncated long, illegal long, numbers long, audit string")
    out = staged(symbols.select("pos", *_ORDER, "m").join(made, "pos"), "edits")
    discard(symbols)
    return out


_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())


def apply_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations, a row for each turn: conv_id, pos, k (order), edit, role, text.

    Inserted turns have an empty text; kept ones keep their role, whatever follows its initial.
    """
    texts = rows.select(*(F.col(c).alias(f"__{c}") for c in ("conv_id", "turn", "role")), _digest().alias("__digest"), "text").dropDuplicates([f"__{c}" for c in _ORDER])
    same = [edits[c].eqNullSafe(texts[f"__{c}"]) for c in _ORDER]
    kept = edits.filter(~F.col("edits").rlike("^D+$")).join(texts, same)
    own = kept.select("conv_id", "pos", "entry", "edits", "role", "text")
    # the state after each edit decides the role of inserted and reroled turns
    turn = F.struct(F.lit(None).cast("string").alias("edit"), F.col("entry").cast("int").alias("q"))
    after = F.array(*(F.lit(q) for q in NEXT))
    kind = F.substring("role", 1, 1)
    keep = F.when(kind == "s", SYSTEM).when(kind == "u", USER).otherwise(ASSISTANT)
    letters = F.filter(F.split("edits", ""), lambda x: x.isin("I", "K", "R"))
    # a row has at most two inserts before it and two behind: the array stays that short
    steps = F.aggregate(letters, F.array(turn), lambda seen, e: F.concat(seen, F.array(F.struct(e.alias("edit"), F.when(e == "K", keep).otherwise(F.get(after, F.element_at(seen, -1)["q"])).cast("int").alias("q")))))
    own = own.select("conv_id", "pos", "role", "text", F.posexplode(F.slice(steps, 2, F.size(steps) - 1)).alias("k", "step"))
    role = F.when(F.col("step.edit") == "K", F.col("role")).otherwise(F.when(F.col("step.q") == USER, "user").otherwise("assistant"))
    text = F.when(F.col("step.edit") == "I", "").otherwise(F.col("text"))
    return own.select("conv_id", "pos", "k", F.col("step.edit").alias("edit"), role.alias("role"), text.alias("text"))


def text_digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of `role:text` lines in order. Lines stream through a hasher, none is held, so a
    conversation of any length takes little memory; its digest is one chain, so one task computes it."""
    kind = repaired.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    lines = repaired.select("conv_id", F.concat_ws(":", "role", "text").alias("line"), "pos", "k").repartition("conv_id").sortWithinPartitions("conv_id", "pos", "k").select("conv_id", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, hasher, out = None, None, []
        for batch in batches:
            if len(out) > 20_000:
                yield _batch(out, ("conv_id", "repaired_sha256"), (arrow, pa.string()))
                out = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if hasher is None or conv != name:
                    if hasher is not None:
                        out.append((name, hasher.hexdigest()))
                    name, hasher = conv, hashlib.sha256()
                else:
                    hasher.update(b"\n")
                hasher.update(line.encode())
        if hasher is not None:
            out.append((name, hasher.hexdigest()))
        yield _batch(out, ("conv_id", "repaired_sha256"), (arrow, pa.string()))

    return map_arrow(lines, run, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def summary(conversations: DataFrame, edits: DataFrame, digests: DataFrame) -> DataFrame:
    """A row for each conv_id of conversations: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation without rows after damage, or with nothing left, has zeros, an empty audit and the hash of nothing.
    """
    parts = F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("pos", "audit"))))
    of = edits.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.sum("numbers")).cast("long").alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.concat_ws("", F.transform(parts, lambda x: x["audit"])).alias("audit"),
    )
    of = of.withColumnRenamed("conv_id", "__a")
    sha = digests.withColumnRenamed("conv_id", "__b")
    own = conversations.select("conv_id").distinct()
    own = own.join(of, own["conv_id"].eqNullSafe(of["__a"]), "left")
    own = own.join(sha, own["conv_id"].eqNullSafe(sha["__b"]), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return own.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits of each row, repaired turns) of any table with conv_id, turn, role, text. A null role or text is one space."""
    blank = F.lit(" ")
    own = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    edits = plan_edits(own)
    return edits, apply_edits(own, edits)
