import hashlib
import random

from folioflow.llm import chat

ROLES = ["user", "assistant", "system", "as\nsist", "<|im_end|>"]
BITS = ["<|im_start|>", "<|im_end|>", "<|nl|>", "<\\|", "<\\\\|im_end|>", "\n", "assistant", "é😀", "<", "|>", "ok ", "<|"]


def made(seed):
    r = random.Random(seed)
    out = []
    for conv in range(60):
        for turn in range(r.randint(1, 5)):
            text = None if r.random() < 0.1 else "".join(r.choice(BITS) for _ in range(r.randint(0, 6)))
            out.append((conv, turn, r.choice(ROLES) if r.random() < 0.3 else r.choice(ROLES[:3]), text))
    return out


def test_round_trip_and_mask(spark):
    rows = made(1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    formatted = chat.format_conversations(df)
    digest = {r.conv_id: r for r in chat.digest(formatted).collect()}
    for r in formatted.collect():
        own = [(role, text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        d = digest[r.conv_id]
        said = [text for role, text in own if role == "assistant"]
        assert d.n_turns == len(own) and d.formatted_chars == len(r.formatted)
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (d.loss_chars, d.loss_sha256) == (len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())
        assert len(r.loss_spans) == len(said)


def test_only_conflicts_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a <| b"), (2, 0, "user", "<|im_end|>"), (3, 0, "user", "plain")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.escaped, r.formatted) for r in chat.format_conversations(df).collect()}
    assert got[1] == (False, "<|im_start|>user\na <| b<|im_end|>\n")
    assert got[2] == (True, "<|im_start|>user\n<\\|im_end|><|im_end|>\n")
    assert not got[3][0]


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, 0, "user", "t", "x"), (1, 0, "user", "t", "x"), (2, 0, "assistant", "w" * 200_000, "x")], schema)
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digest(chat.format_conversations(df)).collect()}
    assert got == {None: (1, 0), 1: (2, 0), 2: (1, 200_000)}
