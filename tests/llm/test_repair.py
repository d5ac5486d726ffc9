import hashlib
import random
import re
import zlib
from functools import lru_cache

from folioflow.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def solved(rows):
    """(cost, audit, repaired lines) of (role, initial, gone, cut) rows, by trying every edit at every place."""
    goal = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @lru_cache(None)
    def best(i, q, inserts=0):
        found = [(0, "")] if i == len(rows) and q in (0, 3) else []
        if inserts < 3:
            for kind, to in goal[q].items():
                if kind != "s":
                    cost, rest = best(i, to, inserts + 1)
                    found.append((cost + 2, "I" + rest))
        if i < len(rows):
            role, gone, cut = rows[i]
            cost, rest = best(i + 1, q)
            found.append((cost + 3, "D" + rest))
            if not gone:
                for kind, to in goal[q].items():
                    if role[:1] == kind:
                        cost, rest = best(i + 1, to)
                        found.append((cost + cut, "K" + rest))
                    if kind != "s":
                        cost, rest = best(i + 1, to)
                        found.append((cost + 2 + cut, "R" + rest))
        return min(found, default=(10**9, ""))

    for i in range(len(rows), -1, -1):
        for q in range(4):
            best(i, q)
    return best(0, 0)


def plain(rows):
    """The summary of each conversation of damaged rows, without Spark."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, marked, count = set(), [], dict(blank=0, duplicate=0, truncated=0, illegal=0)
        for _, _, role, text in own:
            blank = not re.search(r"[^\x20\x09-\x0d]", text)
            again = (role, text) in seen
            cut = not blank and not again and not re.search(r"[.!?][\x20\x09-\x0d]*\Z", text)
            seen.add((role, text))
            count["blank"] += blank
            count["duplicate"] += again and not blank
            count["truncated"] += cut
            marked.append((role, blank or again, int(cut)))
        count["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = {r[1] for r in own if r[1] is not None}
        count["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = solved(tuple(marked))
        lines, i = [], 0
        for e in audit:
            if e != "I":
                i += 1
            if e == "K":
                lines.append((own[i - 1][2], own[i - 1][3]))
            elif e != "D":
                last = lines[-1][0][:1] if lines else "s"
                lines.append(("assistant" if last == "u" else "user", "" if e == "I" else own[i - 1][3]))
        said = "\n".join(f"{a}:{b}" for a, b in lines)
        out[conv] = count | dict(cost=cost, audit=audit, repaired_sha256=hashlib.sha256(said.encode()).hexdigest())
    return out


def made(seed, n=250):
    r = random.Random(seed)
    out = []
    for conv in [*range(n), None]:
        for _ in range(r.randint(1, 9)):
            turn = r.choice([None, *range(8)])
            out.append((conv, turn, r.choice(["user", "user", "assistant", "assistant", "system", "tool", "", "usher"]), r.choice(["a.", "b!", "c", " \t", "", "d? ", "e.\n"])))
    return out


def summaries(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    edits, repaired = repair.repair(df)
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in repair.summary(df, edits, repair.text_digests(repaired)).collect()}


def test_against_every_edit_script(spark):
    rows = made(1)
    assert summaries(spark, rows) == plain(rows)


def test_the_automaton_stays_small():
    r = random.Random(2)
    table = repair.Table()
    for _ in range(300):
        code = [r.randint(0, 8) for _ in range(r.randint(0, 40))]
        _, go = table.scan(code, repair.END)
        rows = tuple(("x" if s in (0, 7, 8) else "sua"[(s - 1) // 2], s == 0, (s - 1) % 2 if s else 0) for s in code)
        if len(rows) < 14:
            assert go[0] == solved(rows)[0]
    assert len(table.vectors) < 40


def test_one_conversation_holds_most_rows(spark):
    """It is spread over tasks, and its pieces are put together."""
    r = random.Random(3)
    rows = [(7, t, r.choice(["user", "assistant", "tool"]), r.choice(["x.", "y", f"{t}.", f"{t}?", f"{t}"])) for t in range(700)]
    rows += [(7, None, "system", "first."), (7, 3000, "user", "z.")] + made(4, 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert summaries(spark, rows) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nulls_repeats_and_an_empty_table(spark):
    got = summaries(spark, [(1, 0, None, "x."), (1, 1, "user", None)] + [(2, 5, "user", "same.")] * 3 + [(None, None, "assistant", "y.")])
    assert (got[1]["audit"], got[1]["cost"], got[1]["blank"]) == ("DD", 6, 1)
    assert (got[2]["duplicate"], got[2]["audit"], got[2]["illegal"]) == (2, "KDDI", 2)
    assert got[None]["audit"] == "IK"
    assert summaries(spark, []) == {}


def test_damage_and_long_texts(spark):
    rows = [(c, t, "user", "a.b!c?" + "x" * (200_000 if c == 3 and t == 3 else 1), 9) for c in range(20) for t in range(10)]
    got = repair.damage(spark.createDataFrame(rows, SCHEMA + ", pos int"))
    want = []
    for c, t, role, text, _ in rows:
        h = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        want += [(c, t, role, text)] * {0: 0, 3: 2}.get(h, 1)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_turns_as_rows(spark):
    _, repaired = repair.repair(spark.createDataFrame([(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "user", "u.")], SCHEMA))
    assert [(r.edit, r.role, r.text) for r in repaired.orderBy("pos", "k").collect()] == [("K", "system", "s."), ("I", "user", ""), ("K", "assistant", "a."), ("K", "user", "u."), ("I", "assistant", "")]
