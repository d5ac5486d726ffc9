r"""Secrets by pattern and by character Markov models, in DataFrame operations only.

Base kinds, each leftmost and non-overlapping: assign, access, hex. The model kind, markov: a run of characters
that keys are made of is a secret if a Markov model of random strings explains it better than one of
ordinary identifiers, by MARGIN in log-likelihood and PER_CHARACTER for each character. A run that isn't one as a whole
is cut at /, = and -, and its parts are judged. There is a model of random strings for each alphabet that keys are
written in, and a run is held against that of the narrowest one that it fits. All models are trained from labelled samples.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "markov")

#: What the models judge: a run, and a part of one.
RUN, PART = r"[A-Za-z0-9+/_=-]{16,}", r"[A-Za-z0-9+_]{16,}"
MARGIN, PER_CHARACTER = 5.0, 0.25
#: Alphabets of random strings, the narrowest first: name, pattern of a run in it, its characters (base 64 fits any run).
ALPHABETS = (("digits", "^[0-9]+$", "0123456789"), ("hex", "^[0-9a-f]+$", "0123456789abcdef"), ("lower", "^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"), ("upper", "^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             ("capitals", "^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), ("small", "^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"), ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
#: Documents drawn for the identifiers and found secrets, random strings made, and what is added to a count.
SAMPLE_DOCS, RANDOM_STRINGS, SMOOTHING = 5_000, 3_000, 0.2
#: Characters that a run can have, from + to z, as numbers from 1; 0 is what comes before the first, and any other.
FIRST, WIDTH = 42, 81
#: Elements of a block of a running sum.
BLOCK = 256
SPAN = "struct<start:int,end:int,text:string>"
#: Marks around matches; a text's own characters of this kind are replaced by the third, code point for code point.
OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where body uses it inside another function."""
    return F.transform(F.array(value), body)[0]


def running(counts: Column) -> Column:
    """The sum of all elements before each one. Sums are made in blocks: an aggregate copies what it holds at each step."""

    def sums(items: Column, count: Callable[[Column], Column]) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("before"), F.lit(0).alias("sum"))
        step = lambda acc, x: F.struct(F.concat(acc["before"], F.array(acc["sum"])).alias("before"), (acc["sum"] + count(x)).alias("sum"))
        return F.aggregate(items, start, step)

    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(counts), F.lit(1)), F.lit(BLOCK)), lambda i: sums(F.slice(counts, i, BLOCK), lambda x: x))
    joined = lambda s: F.zip_with(s, sums(s, lambda x: x["sum"])["before"], lambda x, first: F.transform(x["before"], lambda n: n + first))
    return F.flatten(_let(blocks, joined))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of the leftmost non-overlapping matches, in code points, end exclusive.

    Matches are marked in place and the text is split at the marks: the pieces' lengths add up to positions.
    """
    safe = F.when(text.rlike(f"[{OPEN}{CLOSE}]"), F.translate(text, OPEN + CLOSE, OTHER * 2)).otherwise(text)
    pieces = F.split(F.regexp_replace(safe, pattern, f"{OPEN}$0{CLOSE}"), OPEN, -1)
    size = lambda piece: F.char_length(piece) - F.when(piece.contains(CLOSE), 1).otherwise(0)

    def span(piece: Column, start: Column) -> Column:
        match = F.substring_index(piece, CLOSE, 1)
        one = F.struct(start.alias("start"), (start + F.char_length(match)).alias("end"), match.alias("text"))
        return F.when(piece.contains(CLOSE), one)

    spans = _let(pieces, lambda p: F.zip_with(p, _let(F.transform(p, size), running), span))
    found = F.filter(spans, lambda x: x.isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def apart(runs: Column, base: Column) -> Column:
    """The runs (disjoint, by start) that no base span overlaps: as many spans start before a run's end as end up to its start.

    Starts and ends of both are sorted once, and counted by running sums.
    """
    events = lambda spans, edge, kind: F.transform(spans, lambda m: F.struct(m[edge].alias("at"), F.lit(kind).alias("kind")))
    # in this order at one place
    marks = events(runs, "end", 0), events(base, "start", 1), events(base, "end", 2), events(runs, "start", 3)

    def counted(events: Column) -> Column:
        def before(of: int, there: int) -> Column:
            """At each event of the kind there: events of the other kind that came before."""
            sums = _let(F.transform(events, lambda e: (e["kind"] == of).cast("int")), running)
            seen = F.zip_with(events, sums, lambda e, n: F.when(e["kind"] == there, n))
            return F.filter(seen, lambda n: n.isNotNull())

        alone = F.zip_with(before(1, 0), before(2, 3), lambda started, ended: started == ended)
        kept = F.zip_with(runs, alone, lambda m, yes: F.when(yes, m))
        return F.filter(kept, lambda m: m.isNotNull())

    return _let(F.array_sort(F.concat(*marks)), counted)


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array<struct<start, end, text>>, failing matches dropped."""
    long = lambda m: F.char_length(F.regexp_extract(m["text"], ASSIGN, 2)) >= ASSIGN_LEAST
    return {"assign": F.filter(matches(text, ASSIGN), long), "access": matches(text, ACCESS), "hex": matches(text, HEX)}


def cell(before: str, character: str) -> int:
    """Where a pair of neighbours stands in a model's table; before is empty at a run's beginning."""
    code = lambda c: ord(c) - FIRST if c and 0 < ord(c) - FIRST < WIDTH else 0
    return code(before) * WIDTH + code(character)


def _codes(text: Column) -> Column:
    """The characters of a text as numbers; the text is walked once."""
    return F.transform(F.split(text, ""), lambda c: F.when((F.ascii(c) > FIRST) & (F.ascii(c) < FIRST + WIDTH), F.ascii(c) - FIRST).otherwise(0))


def _bigrams(samples: DataFrame) -> DataFrame:
    """kind, text -> a row (kind, cell) for each pair of neighbouring characters, the first one's neighbour being 0."""
    codes = _codes(F.col("text"))
    before = F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.size(codes) - 1))
    cells = F.zip_with(before, codes, lambda a, b: a * WIDTH + b)
    return samples.filter("text <> ''").select("kind", F.explode(cells).alias("cell"))


def train(samples: DataFrame) -> list[float]:
    """For each alphabet a table of log p(next | character, random in it) - log p(next | character, ordinary), one behind the other.

    samples: kind (ordinary or an alphabet's name), text. The counts have 81 * 81 cells a kind at most. An alphabet
    without samples (numbers are no keys) has a table of zeros: nothing in it is likely. Counts are probabilities within a kind, so it doesn't
    matter how many samples there are of each.
    """
    names = [name for name, _, _ in ALPHABETS]
    counts = {kind: [0.0] * (WIDTH * WIDTH) for kind in ("ordinary", *names)}
    for r in _bigrams(samples).groupBy("kind", "cell").count().collect():
        counts[r.kind][r.cell] += float(r["count"])

    def logs(own: list[float], used: set[int]) -> list[float]:
        out = [0.0] * (WIDTH * WIDTH)
        for a in range(WIDTH):
            total = sum(own[a * WIDTH : (a + 1) * WIDTH]) + SMOOTHING * len(used)
            for b in used:
                out[a * WIDTH + b] = math.log((own[a * WIDTH + b] + SMOOTHING) / total)
        return out

    every = {cell("", c) for c in ALPHABETS[-1][2] + "_=-"}
    ordinary = logs(counts["ordinary"], every)
    out: list[float] = []
    for name, _, characters in ALPHABETS:
        used = every if name == "base64" else {cell("", c) for c in characters}
        mine = logs(counts[name], used) if any(counts[name]) else [0.0] * (WIDTH * WIDTH)
        out += [x - y if x else 0.0 for x, y in zip(mine, ordinary, strict=True)]
    return out


def labelled_samples(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """kind, text: random strings, and values of base finds, by alphabet; ordinary identifiers.

    From about SAMPLE_DOCS documents, drawn by a hash of key: words of five letters or more outside of what the base
    patterns find are identifiers, alone, with a capital or in capitals, and joined with their neighbour, as names in
    programs are; so are numbers. Found values count for the narrowest alphabet that they fit. Random strings in every
    alphabet come from hashes of numbers.
    """
    spark = docs.sparkSession
    n = max(docs.count(), 1)
    share = F.pmod(F.xxhash64(key), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, SAMPLE_DOCS / n))
    drawn = docs.select("text").filter(F.col("text").isNotNull() & share)
    any_base = f"{ASSIGN}|{ACCESS}|{HEX}"
    found = drawn.select(F.explode(F.flatten(F.array(F.regexp_extract_all("text", F.lit(ASSIGN), 2), F.regexp_extract_all("text", F.lit(ACCESS), 0), F.regexp_extract_all("text", F.lit(HEX), 0)))).alias("text"))
    kind = _by_alphabet(F.col("text"), [F.lit(name) for name, _, _ in ALPHABETS])
    found = found.filter((F.char_length("text") >= 12) & F.col("text").rlike("[0-9]")).select(kind.alias("kind"), "text").filter("kind <> 'digits'")
    words = F.regexp_extract_all(F.regexp_replace("text", any_base, " "), F.lit("[A-Za-z]{5,}|[0-9]{5,}"), 0)
    ways = lambda x, y: F.array(
        x, F.initcap(x), F.upper(x), F.concat(F.lower(x), F.lit("_"), F.lower(y), F.lit("_"), F.char_length(x).cast("string")),
        F.concat(F.lower(x), F.initcap(y), (F.char_length(x) * F.char_length(y)).cast("string")), F.concat(F.upper(x), F.lit("_"), F.upper(y)), F.concat(F.lower(x), F.lit("-"), F.lower(y), F.lit("/"), F.lower(x)),
    )
    plain = _let(words, lambda w: F.flatten(F.zip_with(w, F.concat(F.slice(w, 2, F.size(w)), F.slice(w, 1, F.least(F.size(w), F.lit(1)))), ways)))
    plain = drawn.select(F.lit("ordinary").alias("kind"), F.explode(plain).alias("text"))
    made = spark.range(RANDOM_STRINGS).select(F.explode(F.array(*(F.struct(F.lit(name).alias("kind"), _random(F.col("id"), characters).alias("text")) for name, _, characters in ALPHABETS if name != "digits"))).alias("s")).select("s.*")
    return found.unionByName(plain).unionByName(made)


def _random(seed: Column, characters: str) -> Column:
    """A string of 32 characters off a hash of the seed, each as likely as another."""
    draw = lambda i: F.substr(F.lit(characters), F.pmod(F.xxhash64(seed, i, F.lit(len(characters))), F.lit(len(characters))).cast("int") + 1, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(32)), draw), "")


def _by_alphabet(run: Column, values: list[Column]) -> Column:
    """The value of the narrowest alphabet that the run fits."""
    out = F.when(run.rlike(ALPHABETS[0][1]), values[0])
    for (_, pattern, _), value in zip(ALPHABETS[1:-1], values[1:], strict=False):
        out = out.when(run.rlike(pattern), value)
    return out.otherwise(values[-1])


def log_ratio(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string under the random and the ordinary model: positive where it looks random."""
    table = F.split(F.lit(",".join(f"{x:.3f}" for x in model)), ",").cast("array<double>")  # folded to a constant
    at = _by_alphabet(run, [F.lit(k * WIDTH * WIDTH) for k in range(len(ALPHABETS))])
    first = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def total(base: Column) -> Column:
        step = lambda acc, code: F.struct(code.alias("before"), (acc["sum"] + F.get(table, base + acc["before"] * WIDTH + code)).alias("sum"))
        return F.aggregate(_codes(run), first, step, lambda acc: acc["sum"])

    return F.when(run == "", 0.0).otherwise(_let(at, total))


def likely(spans: Column, model: list[float]) -> Column:
    """Those of the spans whose text looks random."""
    return F.filter(spans, lambda m: log_ratio(m["text"], model) >= F.greatest(F.lit(MARGIN), F.char_length(m["text"]) * PER_CHARACTER))


def scan(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """docs with the column secrets: array<struct<start, kind, end>> by start, then kind as in KINDS (kind is its place there).

    Positions are code points of the whole text, end exclusive. Base spans are all kept; a markov span is added
    where a run's log ratio is MARGIN and PER_CHARACTER times its length or more and no base span overlaps it, and of
    other runs where that holds for a part. Null and empty texts have none. Rows that repeat are scanned each; an empty
    table gives no rows. A column named secrets is replaced, other columns stay. The work grows with a text's length,
    whatever its runs and matches.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    base = base_spans(own)
    out = docs.withColumns({f"__{k}": c for k, c in base.items()})
    shape = lambda k: F.transform(f"__{k}", lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(k)).alias("kind"), m["end"].alias("end")))
    out = out.withColumn("__base", F.concat(*(shape(k) for k in base)))
    out = out.withColumn("__run", F.when(own.rlike(RUN), matches(own, RUN)).otherwise(none))
    out = out.withColumn("__good", F.when(F.size("__run") > 0, likely(F.col("__run"), model)).otherwise(none))
    out = out.withColumn("__whole", F.when((F.size("__good") > 0) & (F.size("__base") > 0), apart(F.col("__good"), F.col("__base"))).otherwise(F.col("__good")))
    # parts of the runs that aren't secrets as a whole, or overlap what the patterns found
    cut = F.col("__run").isNotNull() & F.exists("__run", lambda m: m["text"].rlike("[/=-]"))
    out = out.withColumn("__part", F.when(cut, likely(matches(own, PART), model)).otherwise(none))
    taken = F.concat("__base", F.transform("__whole", lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"))))
    out = out.withColumn("__left", F.when(F.size("__part") > 0, apart(F.col("__part"), taken)).otherwise(none))
    out = out.withColumn("__markov", F.concat("__whole", "__left"))
    out = out.withColumn("secrets", F.array_sort(F.concat("__base", shape("markov"))))
    return out.drop(*(f"__{k}" for k in (*base, "base", "run", "good", "whole", "part", "left", "markov")))


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    count = lambda i: F.size(F.filter("secrets", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    return scanned.select(key, *(count(i) for i in range(3)), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"))
