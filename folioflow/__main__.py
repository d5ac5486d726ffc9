"""Command line: python -m folioflow COMMAND ...

list                                        names of the queries
query NAME DATA [--output DIR]              run a query over a folder of Parquet tables
compliance TABLE REFERENCE --base DIR       fill blank natures by name (columns A, C of one workbook; B, D of the other)
answers FOLDER --base DIR                   read questionnaires (.docx) into an answer sheet
settlement LIST EXPORT --base DIR --columns LETTERS --outgoing WORD [--total AMOUNT]
                                            look up a cumulative list in an export, check it in reverse, old and new layout
policy TABLE POLICIES --base DIR --columns LETTERS
                                            fill a policy table by contract number, check that the funding parts add up
merge FOLDER --base DIR [--even]            one print file for each folder of PDFs below FOLDER
texts FOLDER --base DIR                     the text of PDFs, page by page
precheck FOLDER --name PATTERN --ext EXT    findings of a folder of files
intake FOLDER --base DIR                    take in files that are new by content
register FOLDER --rules JSON --base DIR     register the clients below FOLDER: a workbook of clients and persons, with sources
statistics WORKBOOK FOLDER --rules JSON --base DIR [--update]
                                            add the fields of PDFs to a copy of a statistics workbook
trading-a FOLDER --profile NAME --person P --date YYYYMMDD --batch N --base DIR
                                            before stamping: check, register, merge, record the batch
trading-b SCAN --profile NAME --person P --date YYYYMMDD --batch N --base DIR [--number PATTERN] [--run ID]
                                            after stamping: split the scan as the last batch, or that of ID, says
projects FOLDER --rules JSON --base DIR [--first-serial N] [--first-row N]
                                            the application forms below FOLDER as one table, by batch
policies WORKBOOK FOLDER --rules JSON --base DIR
                                            a copy of a policy table filled from PDFs, with a CSV record
score FOLDER|WORKBOOK --points JSON --base DIR
                                            total and level of questionnaires (.docx) or of an answer sheet (.xlsx)

--columns names a list's columns by letters, comma-separated: settlement number, amount, company amount, direction of
LIST, then number and value of EXPORT; policy number, total, parts (one or more) of TABLE, then number and value of POLICIES.
--preview shows the result and writes nothing.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, catalog_desks, catalog_paper, commands
from .operators import check, extract, score
from .plans import desks
from .sinks import print_files
from .sinks.deliver import Run
from .sources import office, seams
from .streaming import intake


QUERIES = catalog.QUERIES | catalog_desks.QUERIES | catalog_paper.QUERIES


def _column_table(spark: SparkSession, path: str, columns: dict[int, str], first_row: int) -> DataFrame:
    cells = office.read_cells(office.files(spark, path))
    return extract.row_block(cells, first_row, columns)


def _deliver(run: Run, outputs: dict[str, DataFrame], found: DataFrame, desk: str, order: dict[str, list[str]] | None = None) -> None:
    if run.dry:
        for name, df in outputs.items():
            print(name)
            df.show(truncate=False)
        found.show(truncate=False)
    print(run.deliver(outputs, found, desks.POLICIES[desk], order=order), "findings", "" if run.dry else run.path(""))


def _letters(text: str) -> list[int]:
    """Column numbers of letters such as A,AC."""
    return [office.split_ref(f"{c.strip().upper()}1")[1] for c in text.split(",")]


def _settlement(spark: SparkSession, a) -> None:
    key, amount, company, direction, other_key, value = _letters(a.columns or "C,D,E,F,AC,A")
    listed = _column_table(spark, a.inputs[0], {key: "contract", amount: "amount", company: "company_amount", direction: "direction"}, a.first_row or 2)
    listed = listed.select(F.col("row").alias("ordinal"), "contract", "direction", "amount", "company_amount")
    export = _column_table(spark, a.inputs[1], {other_key: "contract", value: "value"}, a.first_row or 2)
    old, new, found = desks.settlement(listed, export, "contract", ["value"], "amount", "direction", a.outgoing or [], ["company_amount"], stated=None if a.total is None else F.lit(a.total))
    order = {"old": ["ordinal"], "new": ["ordinal"]}
    _deliver(Run(spark, a.base, "settlement", a.preview, list=a.inputs[0], export=a.inputs[1]), {"old": old, "new": new}, found, "settlement", order)


def _policy(spark: SparkSession, a) -> None:
    key, total, *parts, other_key, value = _letters(a.columns or "A,B,C,D,A,B")
    names = [f"part{k}" for k in range(1, len(parts) + 1)]
    table = _column_table(spark, a.inputs[0], {key: "contract", total: "total"} | dict(zip(parts, names, strict=True)), a.first_row or 2)
    policies = _column_table(spark, a.inputs[1], {other_key: "contract", value: "value"}, a.first_row or 2)
    out, found = desks.policy_fill(table, policies, "contract", ["value"], "total", names)
    _deliver(Run(spark, a.base, "policy", a.preview, table=a.inputs[0], policies=a.inputs[1]), {"filled": out}, found, "policy", {"filled": ["path", "sheet", "row"]})


def _merge(spark: SparkSession, a) -> None:
    found = office.files(spark, a.inputs[0], "*.pdf").withColumn("batch", F.try_element_at(F.split("path", "/"), F.lit(-2)))
    lost = office.unreadable(found, seams.read_text_pdfs(found), "trading")
    good = found.join(lost.select(F.col("entity").alias("path")), "path", "left_anti")
    _deliver(Run(spark, a.base, "trading", a.preview, folder=a.inputs[0]), {"merged": print_files.merged(good, "batch", "path", a.even)}, lost, "trading")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="folioflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["list", "query", "compliance", "answers", "settlement", "policy", "merge", "texts", "precheck", "intake", "register", "statistics", "trading-a", "trading-b", "score", "projects", "policies"])
    p.add_argument("inputs", nargs="*")
    p.add_argument("--output")
    p.add_argument("--base", default="runs")
    p.add_argument("--first-row", type=int)
    p.add_argument("--first-serial", type=int, default=23)
    p.add_argument("--name", default=".+")
    p.add_argument("--ext", action="append")
    p.add_argument("--columns")
    p.add_argument("--outgoing", action="append")
    p.add_argument("--even", action="store_true")
    p.add_argument("--preview", action="store_true")
    p.add_argument("--total")
    p.add_argument("--rules")
    p.add_argument("--points")
    p.add_argument("--update", action="store_true")
    p.add_argument("--profile", choices=list(desks.PROFILES))
    p.add_argument("--person", default="")
    p.add_argument("--date", default=commands.today())
    p.add_argument("--batch", type=int, default=1)
    p.add_argument("--number")
    p.add_argument("--run")
    a = p.parse_args(args)
    if a.command == "list":
        print("\n".join(QUERIES))
        return
    spark = spark or SparkSession.builder.appName("folioflow").getOrCreate()
    if a.command == "query":
        df = QUERIES[a.inputs[0]](spark, a.inputs[1])
        df.write.mode("errorifexists").parquet(a.output) if a.output and not a.preview else df.show(truncate=False)
    elif a.command == "compliance":
        table = _column_table(spark, a.inputs[0], {2: "name", 3: "nature"}, a.first_row or 2)
        reference = _column_table(spark, a.inputs[1], {2: "name", 4: "nature"}, a.first_row or 2)
        out, found = desks.compliance_fill(table, reference)
        _deliver(Run(spark, a.base, "compliance", a.preview, table=a.inputs[0]), {"filled": out}, found, "compliance")
    elif a.command == "answers":
        files = office.files(spark, a.inputs[0], "*.docx", recursive=False)
        paragraphs = office.read_paragraphs(files)
        answers = score.read_answers(paragraphs)
        found = score.answer_findings(answers).unionByName(office.unreadable(files, paragraphs, "questionnaire"))
        _deliver(Run(spark, a.base, "questionnaire", a.preview, folder=a.inputs[0]), {"answers": score.answer_sheet(answers, ["path"])}, found, "questionnaire")
    elif a.command in ("settlement", "policy", "merge"):
        {"settlement": _settlement, "policy": _policy, "merge": _merge}[a.command](spark, a)
    elif a.command in ("register", "statistics", "trading-a", "trading-b", "score", "projects", "policies"):
        run = Run(spark, a.base, a.command, a.preview, person=a.person, profile=a.profile or "", inputs=" ".join(a.inputs))
        if a.command == "register":
            n = commands.register(spark, run, a.inputs[0], a.rules)
        elif a.command == "statistics":
            n = commands.statistics(spark, run, a.inputs[0], a.inputs[1], a.rules, a.update)
        elif a.command == "projects":
            n = commands.projects(spark, run, a.inputs[0], a.rules, a.first_serial, a.first_row or 3)
        elif a.command == "policies":
            n = commands.policies(spark, run, a.inputs[0], a.inputs[1], a.rules)
        elif a.command == "score":
            n = commands.score_files(spark, run, a.inputs[0], a.points)
        elif a.command == "trading-a":
            n = commands.before_stamping(spark, run, a.inputs[0], a.profile, a.person, a.date, a.batch, a.name)
        else:
            n = commands.after_stamping(spark, run, a.inputs[0], a.profile, a.person, a.date, a.batch, a.number, a.run)
        print(n, "findings", "" if a.preview else run.path(""))
    elif a.command == "texts":
        files = office.files(spark, a.inputs[0], "*.pdf")
        pages = seams.read_text_pdfs(files)
        lost = office.unreadable(files, pages, "texts")
        _deliver(Run(spark, a.base, "texts", a.preview, folder=a.inputs[0]), {"pages": pages}, lost, "register", {"pages": ["path", "page_no"]})
    elif a.command == "precheck":
        found = check.file_checks(office.material(office.files(spark, a.inputs[0]), ""), a.name, r"(?i)copy|副本|\([0-9]+\)", a.ext or ["pdf", "docx"])
        found.orderBy("code", "entity").show(truncate=False)
    else:
        intake.take_in(intake.new_files(spark, a.inputs[0]), f"{a.base}/intake", f"{a.base}/intake-state")


if __name__ == "__main__":
    main()
