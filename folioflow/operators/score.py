"""Questionnaires: answers, points, levels. Points and cut-offs are parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import answer_letters
from ..staging import staged
from . import number
from .check import Policy, findings, gate

QUESTIONS, MULTI_SELECT, LEVELS = 20, (13, 17), ("C1", "C2", "C3", "C4", "C5")


def read_answers(paragraphs: DataFrame, number_pattern: str = r"^\s*([0-9]{1,2})[.、]") -> DataFrame:
    """path, q, choices from paragraphs that begin with a number; the letters that end one are the answer."""
    q = F.nullif(F.regexp_extract("text", number_pattern, 1), F.lit("")).cast("int")
    return paragraphs.select("path", q.alias("q"), answer_letters(F.col("text")).alias("choices")).filter("q is not null")


def answers_from_sheet(cells: DataFrame, first_row: int = 2, questions: int = QUESTIONS) -> DataFrame:
    """path, row, q, choices of an existing answer sheet: column A names the sheet's row, the next columns are the questions in order."""
    own = cells.filter((F.col("row") >= first_row) & F.col("col").between(2, questions + 1))
    return own.select("path", "row", (F.col("col") - 1).alias("q"), answer_letters(F.col("raw")).alias("choices"))


def answer_findings(answers: DataFrame, letters: str = "ABCDE", questions: int = QUESTIONS, multi: tuple = MULTI_SELECT) -> DataFrame:
    """Findings: a file without all questions, an answer missing, invalid, or double where one is asked for."""
    who = F.concat_ws("#", "path", F.col("q").cast("string"))
    outside = F.size(F.array_except("choices", F.array(*map(F.lit, letters)))) > 0
    out = findings(answers, F.size("choices") == 0, who, "answer_missing", "no letter ends the paragraph", "questionnaire")
    out = out.unionByName(findings(answers, outside, who, "answer_invalid", "a letter that is no choice", "questionnaire"))
    out = out.unionByName(findings(answers, (F.size("choices") > 1) & ~F.col("q").isin(list(multi)), who, "answer_double", "one choice is asked for", "questionnaire"))
    count = answers.groupBy("path").agg(F.count_if(F.col("q").between(1, questions)).alias("n"), F.countDistinct("q").alias("d"))
    return out.unionByName(findings(count, (F.col("n") != questions) | (F.col("d") != questions), F.col("path"), "question_count", "not every question exactly once", "questionnaire"))


def level(score, cuts: list[float], levels: tuple = LEVELS):
    """The level of a score: the first cut-off above it, the last level beyond all."""
    out = F.when(score < cuts[0], levels[0])
    for cut, name in zip(cuts[1:], levels[1:], strict=False):
        out = out.when(score < cut, name)
    return out.otherwise(levels[len(cuts)])


def score(answers: DataFrame, points: DataFrame, cuts: list[float], keys: list[str], policy: Policy = Policy.ABORT) -> DataFrame:
    """keys, score, level. points: q, choice, points; an answer's points are those of its choices, added up."""
    each = answers.select(*keys, "q", F.explode("choices").alias("choice")).join(points, ["q", "choice"], "left")
    total = staged(each.groupBy(*keys).agg(F.sum("points").alias("score"), F.count_if(F.col("points").isNull()).alias("__unknown")), "scores")  # the gate reads it first
    gate(findings(total, F.col("__unknown") > 0, F.concat_ws("/", *(F.col(k).cast("string") for k in keys)), "points", "no points for an answer", "score"), policy)
    return total.select(*keys, "score", level(F.col("score"), cuts).alias("level"))


def answer_sheet(answers: DataFrame, keys: list[str], questions: int = QUESTIONS) -> DataFrame:
    """Wide form: a column q1 .. qn with the letters of each answer."""
    text = F.array_join("choices", "")
    return answers.groupBy(*keys).agg(*(F.max(F.when(F.col("q") == k, text)).alias(f"q{k}") for k in range(1, questions + 1)))


def numbered_sheets(rows: DataFrame, keys: list[str], order: list[str], choice: str, questions: int = QUESTIONS) -> DataFrame:
    """keys, sheet (from 1), q, choices: each key's rows in order, dealt to sheets of so many questions; the last may be short."""
    out = number.rank_within(rows, keys, order, "__k")
    k = F.col("__k") - 1
    return out.select(*keys, (F.floor(k / questions) + 1).cast("long").alias("sheet"), (k % questions + 1).cast("int").alias("q"), F.array(choice).alias("choices"))


def score_sheet(answers: DataFrame, points: DataFrame, cuts: list[float], keys: list[str], questions: int = QUESTIONS) -> DataFrame:
    """The whole sheet: keys (column A), answers (to U), total and level (V and W), in that order. Sheets without an answer that scores have no total."""
    total = score(answers, points, cuts, keys)
    return answer_sheet(answers, keys, questions).join(total, keys, "left").select(*keys, *(f"q{k}" for k in range(1, questions + 1)), "score", "level")
