r"""Chat formatting with a grammar round trip, in DataFrame operations only.

Grammar: conversation = turn*; turn = "<|im_start|>" role "\n" body "<|im_end|>" "\n". Neither role nor body
holds a marker, a role holds no line break (written "<|nl|>"). Reading takes one backslash out of each
"<\...|"; escaping puts one into each "<...|", so any text can be written and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _write_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit("\n"), F.lit(BREAK))


def _read_role(role: Column) -> Column:
    return _unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text, head, body>>; the deterministic parser.

    head and body are lengths in code points as written. A piece that the grammar doesn't allow has null fields.
    """
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        rest = F.substr(piece, F.char_length(role) + F.lit(2))
        body = F.substring_index(rest, END, 1)
        good = piece == F.concat(role, F.lit("\n"), body, F.lit(END + "\n"))
        return F.struct(
            F.when(good, _read_role(role)).alias("role"),
            F.when(good, _unescape(body)).alias("text"),
            (F.char_length(role) + F.lit(len(START) + 1)).alias("head"),
            F.char_length(body).alias("body"),
        )

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _render(turns: Column, body) -> Column:
    one = lambda t: F.concat(F.lit(START), _write_role(t["role"]), F.lit("\n"), body(t["text"]), F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def _plain(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conv_id: conv_id, formatted, escaped, turns (read back), loss_spans.

    Texts are first written as they are; if reading doesn't give back the same turns, conflicting texts of that
    conversation are escaped. A conversation that still differs (it can't) raises an error. loss_spans
    are the code point spans (end exclusive) of assistant bodies in formatted.

    Turns sort by turn, then role and text, so ties and shuffled rows give one result; a null turn comes first,
    null role or text is empty, a null conv_id is a conversation of its own; repeated rows are turns of their
    own. One conversation is one string, so it has to fit a task, as any chat sample does. Other columns
    are not read.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("source"))
    conv = conv.withColumn("raw", _render(F.col("source"), lambda x: x))
    conv = conv.withColumn("escaped", ~_plain(parse(F.col("raw"))).eqNullSafe(_plain(F.col("source"))))
    conv = conv.withColumn("formatted", F.when(F.col("escaped"), _render(F.col("source"), _escape)).otherwise(F.col("raw")))
    conv = conv.withColumn("turns", parse(F.col("formatted")))
    same = _plain(F.col("turns")).eqNullSafe(_plain(F.col("source")))
    conv = conv.withColumn("turns", F.when(same, F.col("turns")).otherwise(F.raise_error(F.lit("a conversation can't be read back"))))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + t["head"]
        end = start + t["body"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + F.lit(len(END) + 1)).alias("at"), spans.alias("spans"))

    conv = conv.withColumn("loss_spans", F.aggregate(F.col("turns"), nothing, step, lambda acc: acc["spans"]))
    return conv.select("conv_id", "formatted", "escaped", _plain(F.col("turns")).alias("turns"), "loss_spans")


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from what was written."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    text = F.col("formatted")
    under = F.array_join(
        F.transform("loss_spans", lambda s: _unescape(F.substr(text, s["start"] + F.lit(1), s["end"] - s["start"]))), ""
    )
    out = formatted.withColumns({"__said": said, "__loss": under})
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.col("__said"), 256).alias("turns_sha256"),
        F.char_length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
