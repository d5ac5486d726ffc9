"""Whole desk workflows from files to files: registering clients, statistics workbooks, trading before and after stamping.

Rules come as JSON (a file's path), so a new form or another house's columns need no code. What is delivered goes into the
run's own folder by sinks.committed; the gate of the desk's policy comes first, and a preview writes nothing.
"""

from __future__ import annotations

import json
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import check, extract, match, merge, number, readings, region, scan, score, templates
from .operators.check import Policy, gate
from .plans import desks
from .sinks import committed, deliver, print_files
from .sinks.deliver import Run
from .sources import office, places, seams


def _rules(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _column(letters: str) -> int:
    return office.split_ref(f"{letters.upper()}1")[1]


def _finish(run: Run, found: DataFrame, policy: Policy, outputs: dict, records: dict[str, DataFrame]) -> int:
    """Gate, then deliver: outputs (file form -> function that writes into a folder), records (name -> text rows)."""
    run.record("started")
    n = gate(found, policy)
    if not run.dry:
        for name, write in outputs.items():
            write(run.path(name))
        for name, df in records.items():
            df.write.mode("errorifexists").text(run.path(name))
        found.write.mode("errorifexists").json(run.path("findings"))
        run.record("done")
    return n


def _read(pages: DataFrame, patterns: dict) -> tuple[DataFrame, DataFrame]:
    """(path and a column for each field, findings). A field has a pattern, or several in order of trust."""
    rules = [readings.Rule(field, p, rank) for field, own in patterns.items() for rank, p in enumerate([own] if isinstance(own, str) else own, 1)]
    out, doubts = readings.read(pages, rules)
    return extract.pivot_fields(out, ["path"], list(patterns)), doubts


def _cases(found: DataFrame) -> DataFrame:
    """path -> case_id, the folder that the file lies in."""
    return found.select("path", F.try_element_at(F.split("path", "/"), F.lit(-2)).alias("case_id"))


# clients


def register(spark: SparkSession, run: Run, folder: str, rules: str) -> int:
    """The register of the clients whose forms lie below folder, one folder each: a workbook with a sheet of clients and one
    of persons, every value with its source as a comment, blanks marked; records of sources and a list of what is open.

    Rules: anchors {template: [[row, column letters, text]]}; fields [[template, field, sheet or null, row, column
    letters]]; columns (the client sheet's fields in order); persons [{source, template, first_row, columns {letters:
    field}}], the most trusted first; person_columns; ranked (person fields that the most trusted source decides).
    """
    r = _rules(rules)
    found = office.files(spark, folder, "*.xls*")
    cells = office.read_cells(found)
    case = _cases(found)
    anchors = spark.createDataFrame([(t, row, _column(col), text) for t, own in r["anchors"].items() for row, col, text in own], "template string, row int, col int, text string")
    positions = extract.position_rules(spark, [(t, f, s, row, _column(col)) for t, f, s, row, col in r["fields"]])
    picked, lost = templates.fields(cells, anchors, positions)
    chosen, _ = templates.choose(cells, anchors)
    fields = picked.join(case, "path").withColumn("note", F.concat_ws(" ", X.file_name(F.col("path")), "source.sheet", "source.ref"))

    sources: dict[str, DataFrame] = {}
    for p in r["persons"]:
        own = cells.join(chosen.filter(F.col("template") == p["template"]).select("path", "sheet"), ["path", "sheet"])
        block = extract.row_block(own, p["first_row"], {_column(c): f for c, f in p["columns"].items()})
        block = block.join(case, "path")
        sources[p["source"]] = sources[p["source"]].unionByName(block, allowMissingColumns=True) if p["source"] in sources else block
    rest = [c for c in r["person_columns"] if c != "name"]
    persons, clash = merge.merge_sources(sources, ["case_id"], "name", rest, r.get("ranked", []))
    clients, checked, doubts = desks.register(fields, persons, r["columns"], r["person_columns"])
    open_ = lost.unionByName(clash).unionByName(doubts).unionByName(office.unreadable(found, cells, "register"))

    notes = extract.pivot_fields(fields, ["case_id"], r["columns"], value="note")
    of = notes.select(F.col("case_id").alias("__case"), *(F.col(c).alias(f"__note_{c}") for c in r["columns"]))
    clients = clients.join(of, clients["case_id"] == of["__case"], "left")
    first = number.serial(clients, ["case_id"], 1, 2).select(
        F.lit(1).alias("sheet_no"), F.lit("clients").alias("sheet"), F.col("sheet_row").alias("row"), F.array(committed.cell("case_id"), *(committed.cell(c, F.col(f"__note_{c}")) for c in r["columns"])).alias("cells")
    )
    notes_of = [committed.cell(c, None if c == "name" else F.concat_ws(" ", f"{c}_source", f"{c}_status")) for c in r["person_columns"]]
    second = number.serial(checked, ["case_id", "name"], 1, 2).select(F.lit(2).alias("sheet_no"), F.lit("persons").alias("sheet"), F.col("sheet_row").alias("row"), F.array(committed.cell("case_id"), *notes_of).alias("cells"))
    heads = [(1, "clients", ["case_id", *r["columns"]]), (2, "persons", ["case_id", *r["person_columns"]])]
    sheets = first.unionByName(second).unionByName(_heads(spark, heads)).withColumn("workbook", F.lit("register.xlsx"))
    src = fields.select(
        "case_id", F.lit("client").alias("entity"), F.lit(1).alias("ordinal"), "field", "value", "source", F.col("template").alias("basis"), F.lit("read").alias("status")
    )
    records = {"sources": deliver.source_records(src).select(F.to_json(F.struct("case_id", "record")).alias("value")), "pending": deliver.pending_lines(open_)}
    return _finish(run, open_, desks.POLICIES["register"], {"workbook": lambda to: committed.workbooks(sheets, to)}, records)


def _heads(spark: SparkSession, sheets: list[tuple[int, str, list[str]]]) -> DataFrame:
    rows = [(k, name, 1, [(c, None, None) for c in columns]) for k, name, columns in sheets]
    return spark.createDataFrame(rows, f"sheet_no int, sheet string, row int, cells array<{committed.CELL}>")


# projects


def projects(spark: SparkSession, run: Run, folder: str, rules: str, first_serial: int = 23, first_row: int = 3) -> int:
    """The application forms below folder as one table: from first_row and first_serial on, in the order of batches (the two
    digits that end a form's folder) and files; serial, batch, then the rules' columns, every value with its source.

    Rules: anchors and fields as for register; columns (in order). A form without a batch or without a value stays, with a
    finding, and its blank cells are marked.
    """
    r = _rules(rules)
    found = office.files(spark, folder, "*.xls[xm]")
    cells = office.read_cells(found)
    anchors = spark.createDataFrame([(t, row, _column(col), text) for t, own in r["anchors"].items() for row, col, text in own], "template string, row int, col int, text string")
    positions = extract.position_rules(spark, [(t, f, s, row, _column(col)) for t, f, s, row, col in r["fields"]])
    picked, lost = templates.fields(cells, anchors, positions)
    picked = picked.withColumn("note", F.concat_ws(" ", X.file_name(F.col("path")), "source.sheet", "source.ref"))
    forms = places.with_batch(found.select("path")).join(extract.pivot_fields(picked, ["path"], r["columns"]), "path")
    notes = extract.pivot_fields(picked, ["path"], r["columns"], value="note").select(F.col("path").alias("__path"), *(F.col(c).alias(f"__note_{c}") for c in r["columns"]))
    forms = forms.join(notes, forms["path"] == notes["__path"])
    open_ = lost.unionByName(office.unreadable(found, cells, "projects"))
    open_ = open_.unionByName(check.findings(forms, F.col("batch_no").isNull(), X.file_name(F.col("path")), "no_batch", "the folder's name ends in no two digits", "projects", "warn"))
    missing = forms.withColumn("missing", check.missing_fields(r["columns"]))
    open_ = open_.unionByName(check.findings(missing, F.size("missing") > 0, X.file_name(F.col("path")), "incomplete", F.array_join("missing", ","), "projects", "warn"))
    placed = number.serial(forms.withColumn("__batch", F.coalesce("batch_no", F.lit(100))), ["__batch", "path"], first_serial, first_row)
    own = F.array(committed.number_cell("serial"), committed.number_cell("batch_no"), *(committed.cell(c, F.col(f"__note_{c}")) for c in r["columns"]))
    rows = placed.select(F.lit("projects.xlsx").alias("workbook"), F.lit(1).alias("sheet_no"), F.lit("projects").alias("sheet"), F.col("sheet_row").alias("row"), own.alias("cells"))
    src = picked.select(F.col("path").alias("case_id"), F.lit("project").alias("entity"), F.lit(1).alias("ordinal"), "field", "value", "source", F.col("template").alias("basis"), F.lit("read").alias("status"))
    records = {"sources": deliver.source_records(src).select(F.to_json(F.struct("case_id", "record")).alias("value")), "pending": deliver.pending_lines(open_)}
    return _finish(run, open_, desks.POLICIES["register"], {"workbook": lambda to: committed.workbooks(rows, to)}, records)


# policies


def policies(spark: SparkSession, run: Run, table: str, folder: str, rules: str) -> int:
    """A copy of the policy table with what the policies (PDFs) in folder say, and a CSV record of how each row fared.

    Rules: first_row; key [column letters of the table, pattern]; fields {column letters: pattern, or several in order of trust}; total and parts
    (column letters among fields; optional): the funding that must make the total up. A row without exactly one policy,
    or whose parts don't add up, stays as it is; cells that hold something are never written over.
    """
    r = _rules(rules)
    cells = office.read_cells(office.files(spark, table))
    key, pattern = _column(r["key"][0]), r["key"][1]
    names = {letters: f"c{_column(letters)}" for letters in r["fields"]}
    listed = cells.filter((F.col("row") >= r.get("first_row", 2)) & (F.col("col") == key)).select("path", "sheet", "row", F.trim("raw").alias("key"))
    found = office.files(spark, folder, "*.pdf")
    pages = seams.read_text_pdfs(found)
    read, doubts = _read(pages, {"key": pattern} | {names[c]: p for c, p in r["fields"].items()})
    read = read.withColumn("policy", X.file_name(F.col("path"))).drop("path")
    out = match.cardinality_join(listed, read, "key", ["policy", *names.values()])
    status = F.col("match_status")
    if r.get("total"):
        money = lambda c: F.regexp_replace(names[c], ",", "").try_cast("decimal(18,2)")
        parts = [F.coalesce(money(c), F.lit(0).cast("decimal(18,2)")) for c in r["parts"]]
        off = sum(parts[1:], parts[0]) - money(r["total"])
        status = F.when((status == "matched") & (off.isNull() | (off != 0)), "composition").otherwise(status)
    out = out.withColumn("status", status)
    open_ = check.findings(out, F.col("status") != "matched", F.concat_ws(":", "sheet", "row", "key"), "not_filled", F.col("status"), "policy", "warn").unionByName(office.unreadable(found, pages, "policy"))
    unused = match.unmatched(read.filter("key is not null"), listed, "key")
    open_ = open_.unionByName(check.findings(unused, F.lit(True), F.col("policy"), "not_in_table", "no row has its number", "policy", "warn"))
    open_ = open_.unionByName(check.findings(read, F.col("key").isNull(), F.col("policy"), "no_number", "no number found in the text", "policy", "warn"))
    good = out.filter("status = 'matched'")
    writes = [good.select("path", "sheet", "row", F.lit(_column(c)).alias("col"), F.lit(c).alias("field"), F.col(n).alias("value")) for c, n in names.items()]
    grid, taken = region.overlay(cells, reduce(DataFrame.unionByName, writes))
    open_ = open_.unionByName(doubts).unionByName(taken.withColumn("severity", F.lit("warn")))  # what is there stays, so it stops nothing
    record = out.select("sheet", "row", "key", "policy", "status").orderBy("sheet", "row")
    outputs = {"workbook": lambda to: committed.workbooks(as_sheets(grid), to), "check": lambda to: record.write.option("header", "true").csv(to)}
    return _finish(run, open_, desks.POLICIES["policy"], outputs, {"pending": deliver.pending_lines(open_)})


# statistics


def statistics(spark: SparkSession, run: Run, workbook: str, folder: str, rules: str, update: bool = False) -> int:
    """A copy of a statistics workbook with the fields of the PDFs in folder added below its table (or, where a column
    of the rules is the key, written over the row of the same key; only where update allows it).

    Rules: headers {field: heading}, patterns {field: pattern with one group, or several in order of trust}, key (a field, optional). The table is
    found by its headings; what is occupied stops the delivery.
    """
    r = _rules(rules)
    cells = office.read_cells(office.files(spark, workbook))
    headers = region.next_rows(cells, region.find_headers(cells, r["headers"]))
    found = office.files(spark, folder, "*.pdf")
    pages = seams.read_text_pdfs(found)
    read, doubts = _read(pages, r["patterns"])
    names = list(r["patterns"])
    tables = headers.orderBy(F.desc("n_names"), "path", "sheet").limit(1).collect()
    if not tables:
        raise LookupError(f"no table with any of the headings in {workbook}")
    (table,) = tables
    fields = read.select("*", F.lit(table["path"]).alias("__book"), F.lit(table["sheet"]).alias("__sheet"))
    if key := r.get("key"):
        at = cells.filter((F.col("path") == table["path"]) & (F.col("sheet") == table["sheet"]) & (F.col("col") == table["columns"].get(key)))
        at = at.groupBy(X.match_key(F.col("raw")).alias("__key")).agg(F.min("row").alias("__row"))
        fields = fields.join(at, X.match_key(F.col(key)) == F.col("__key"), "left")
    else:
        fields = fields.withColumn("__row", F.lit(None).cast("int"))
    new = number.serial(fields.filter("__row is null"), ["path"], 1, 1).withColumn("ordinal", F.col("serial").cast("int")).drop("serial", "sheet_row")
    rows = new.unionByName(fields.filter("__row is not null").withColumn("ordinal", F.lit(1)))
    long = extract.unpivot_fields(rows, ["__book", "__sheet", "__row", "ordinal"], names)
    planned = long.select(F.col("__book").alias("path"), F.col("__sheet").alias("sheet"), F.col("__row").alias("row"), "ordinal", "field", "value")
    writes, lost = region.placed(planned, headers)
    grid, taken = region.overlay(cells, writes, update)
    open_ = lost.unionByName(taken).unionByName(office.unreadable(found, pages, "statistics"))
    open_ = open_.unionByName(doubts)
    return _finish(run, open_, desks.POLICIES["statistics"], {"workbook": lambda to: committed.workbooks(as_sheets(grid), to)}, {"pending": deliver.pending_lines(open_)})


def as_sheets(grid: DataFrame) -> DataFrame:
    """Rows for committed.workbooks of cells (path, sheet, row, col, value, state); what was written has its state as comment.

    Cells between those that hold something are empty texts, so that they aren't marked as blanks that wait.
    """
    note = F.when(F.col("state").isin("written", "updated"), F.col("state"))
    at = F.map_from_entries(F.collect_list(F.struct("col", F.struct(F.col("value").alias("text"), F.lit(None).cast("double").alias("number"), note.alias("note")))))
    rows = grid.groupBy("path", "sheet", "row").agg(at.alias("at"), F.max("col").alias("last"))
    empty = F.struct(F.lit("").alias("text"), F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("note"))
    cells = F.transform(F.sequence(F.lit(1), F.col("last")), lambda c: F.coalesce(F.try_element_at("at", c), empty))
    names = grid.groupBy("path").agg(F.array_sort(F.collect_set("sheet")).alias("sheets"))
    out = rows.join(names, "path").withColumn("sheet_no", F.array_position("sheets", F.col("sheet")).cast("int"))
    return out.select(X.file_name(F.col("path")).alias("workbook"), "sheet_no", "sheet", "row", cells.alias("cells"))


# questionnaires


def score_files(spark: SparkSession, run: Run, path: str, points: str) -> int:
    """Answers, total and level of questionnaires: of a folder of .docx, or of a workbook that holds answers already (column A
    the name, B to U the answers). A defect stops the batch before anything is scored.

    Points: points {question: {letter: points}}, cuts (of the total, in order).
    """
    r = _rules(points)
    table = spark.createDataFrame([(int(q), c, int(n)) for q, own in r["points"].items() for c, n in own.items()], "q int, choice string, points long")
    if path.lower().endswith((".xlsx", ".xlsm")):
        cells = office.read_cells(office.files(spark, path))
        answers = score.answers_from_sheet(cells)
        named = cells.filter("col = 1 and row >= 2").select("path", "row", F.col("raw").alias("name"))
        answers = answers.join(named, ["path", "row"]).select(F.concat_ws("#", X.file_name(F.col("path")), "name").alias("path"), "q", "choices")
        found = score.answer_findings(answers)
    else:
        files = office.files(spark, path, "*.docx", recursive=False)
        paragraphs = office.read_paragraphs(files)
        answers = score.read_answers(paragraphs).withColumn("path", X.file_name(F.col("path")))
        found = score.answer_findings(answers).unionByName(office.unreadable(files, paragraphs, "questionnaire"))
    run.record("started")
    gate(found, desks.POLICIES["questionnaire"])  # an answer that isn't one must not be scored
    sheet = number.serial(score.score_sheet(answers, table, r["cuts"], ["path"]), ["path"], 1, 2)
    cells = F.array(committed.cell("path"), *(committed.cell(f"q{k}") for k in range(1, score.QUESTIONS + 1)), committed.number_cell("score"), committed.cell("level"))
    rows = sheet.select(F.lit(1).alias("sheet_no"), F.lit("answers").alias("sheet"), F.col("sheet_row").alias("row"), cells.alias("cells"))
    heads = _heads(spark, [(1, "answers", ["path", *(str(k) for k in range(1, score.QUESTIONS + 1)), "total", "level"])])
    book = rows.unionByName(heads).withColumn("workbook", F.lit("scores.xlsx"))
    return _finish(run, found, desks.POLICIES["questionnaire"], {"workbook": lambda to: committed.workbooks(book, to)}, {})


# trading


def before_stamping(spark: SparkSession, run: Run, folder: str, profile: str, person: str, day: str, batch: int, name: str = ".+") -> int:
    """Phase A: the files of a folder are checked, registered (23 a page), merged with the profile's padding, and the batch is
    recorded: names, order, contents and page counts. Any finding stops it."""
    p = desks.PROFILES[profile]
    found = office.files(spark, folder, "*.pdf", recursive=False)
    material = office.material(found, run.id)
    bad = check.file_checks(material, name, r"(?i)copy|副本|\([0-9]+\)", ["pdf"], "trading")
    pages = seams.read_text_pdfs(found)
    bad = bad.unionByName(office.unreadable(found, pages, "trading"))
    n = pages.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("pages"))
    items = number.serial(material.join(n, "path"), ["name"], 1, 2).withColumn("ordinal", F.col("serial").cast("int"))
    if p.pages_each:
        bad = bad.unionByName(check.findings(items, F.col("pages") != p.pages_each, F.col("name"), "item_pages", f"{p.pages_each} pages are expected", "trading"))
    items = items.withColumn("batch_id", F.lit(run.id))
    plan = desks.merge_plan(items, p, ["batch_id"])
    lines = number.paginate(plan.select("batch_id", "ordinal", "name", "pages"), ["ordinal"])
    rows = lines.select(F.lit("register.xlsx").alias("workbook"), F.col("page_no").alias("sheet_no"), F.concat(F.lit("page "), "page_no").alias("sheet"), F.col("line_no").alias("row"), F.array(committed.number_cell("ordinal"), committed.cell("name"), committed.number_cell("pages")).alias("cells"))
    item = F.struct("ordinal", "name", "sha256", F.col("pages").cast("int").alias("pages"), F.col("page_from").cast("int").alias("page_from"), F.col("page_to").cast("int").alias("page_to"))
    record = plan.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("items")).select(
        "batch_id", F.lit(person).alias("person"), F.lit(profile).alias("kind"), F.lit(datetime.strptime(day, "%Y%m%d").date()).alias("task_date"), F.lit(batch).alias("batch_no"), "items"
    )
    merged = print_files.merged(found.withColumn("batch_id", F.lit(run.id)), "batch_id", "path", p.even).select(F.lit("merged.pdf").alias("name"), "content")
    outputs = {"register": lambda to: committed.workbooks(rows, to), "print": lambda to: committed.files(merged, to)}
    return _finish(run, bad, Policy.ABORT, outputs, {"batch": deliver.batch_record(record).select(F.col("record").alias("value"))})


def last_batch(spark: SparkSession, base: str, person: str, profile: str) -> str | None:
    """The id of the last finished phase A of a person and material; what phase B carries on from unless told otherwise."""
    runs = deliver.done_runs(spark, base, "trading-a").filter((F.col("params")["person"] == person) & (F.col("params")["profile"] == profile))
    found = runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1).collect()
    return found[0]["run_id"] if found else None


def after_stamping(spark: SparkSession, run: Run, scan_path: str, profile: str, person: str, day: str, batch: int, number_pattern: str | None = None, of: str | None = None) -> int:
    """Phase B: the stamped scan is split as the batch of phase A says, each part named as its item. Person, material, day and
    batch number must be the record's, page counts and, where a pattern reads numbers off the pages, borders must agree."""
    p = desks.PROFILES[profile]
    of = of or last_batch(spark, run.base, person, profile)
    if of is None:
        raise LookupError(f"no finished batch of {person}, {profile}")
    record = places.read_batches(spark, f"{run.base}/trading-a/{of}/batch")
    want = spark.createDataFrame([(person, profile, datetime.strptime(day, "%Y%m%d").date(), batch)], "person string, kind string, task_date date, batch_no int")
    keys = ["person", "kind", "task_date", "batch_no"]
    other = record.join(match.same_batch(record, want, keys).select("batch_id"), "batch_id", "left_anti")
    bad = check.findings(other, F.lit(True), F.col("batch_id"), "other_batch", "person, material, day or number differ", "trading")
    items = record.select("batch_id", F.explode("items").alias("i")).select("batch_id", "i.*").drop("page_from", "page_to")
    pages = seams.read_text_pdfs(office.files(spark, scan_path)).withColumn("batch_id", F.lit(of)).withColumn("page", F.col("page_no").cast("long"))
    _, uneven = desks.split_plan(pages.select("batch_id", "page"), items, p, ["batch_id"])
    bad = bad.unionByName(uneven)
    if number_pattern:
        own = pages.select("batch_id", "page", X.captured(F.col("text"), number_pattern).alias("read"))
        on, islands = scan.islands(own, ["batch_id"], "page", "read")
        bad = bad.unionByName(scan.boundary_findings(on, islands, ["batch_id"], "page", p.pages_each)) if p.pages_each else bad
    plan = desks.merge_plan(items, p, ["batch_id"])
    scans = office.files(spark, scan_path).select(F.lit(of).alias("batch_id"), "content")
    parts = print_files.split(scans, plan, "batch_id").select("name", "content")
    zipped = parts.select(F.lit("scans.zip").alias("archive"), "name", "content")
    return _finish(run, bad, desks.POLICIES["holdings" if profile == "holdings" else "trading"], {"parts": lambda to: committed.files(parts, to), "zip": lambda to: committed.zips(zipped, to)}, {})


def today() -> str:
    return f"{date.today():%Y%m%d}"
