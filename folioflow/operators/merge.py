"""Records of the same entity from several sources, merged field by field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, match_key
from . import check


def merge_sources(sources: dict[str, DataFrame], keys: list[str], name: str, fields: list[str], ranked: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(one row for each case and name, findings) of any number of sources, the first being the most trusted.

    A full outer merge of all sources at once: their rows are put under each other and every field's state is kept in
    one aggregate, so a key in many documents is combined before the shuffle. Names meet without white space and case;
    the first source's spelling stays. Of each field come its value, <field>_source and <field>_status: missing, single
    (one source has it), agreed (several, the same), conflict (different values: blank, and a finding) or ranked (a
    field in ranked: the most trusted source's value stands, a finding too). A row without a name, or with a blank in a
    key, meets nothing: it is a finding. n_sources says how many sources know the name. keys are strings.
    """
    def own(k: int, df: DataFrame) -> DataFrame:
        have = [blank_to_null(F.col(f)).alias(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
        return df.select(*keys, blank_to_null(F.col(name)).alias(name), F.lit(k).alias("__rank"), *have)

    rows = reduce(DataFrame.unionByName, (own(k, df) for k, df in enumerate(sources.values())))
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*keys, name]))
    labels = F.array(*map(F.lit, sources))
    state = [F.min(F.struct("__rank", name)).alias("__name"), F.count_distinct("__rank").alias("n_sources")]
    for f in fields:
        of = F.when(F.col(f).isNotNull(), F.struct("__rank", f))
        state += [F.min(of).alias(f"__{f}"), F.min(f).alias(f"__low_{f}"), F.max(f).alias(f"__high_{f}"), F.max(F.when(F.col(f).isNotNull(), F.col("__rank"))).alias(f"__last_{f}")]
    out = rows.filter(known).groupBy(*keys, match_key(F.col(name)).alias("__key")).agg(*state)
    columns, found = [], []
    who = F.concat_ws("/", *keys, name)
    for f in fields:
        differs = F.col(f"__low_{f}") != F.col(f"__high_{f}")
        status = F.when(F.col(f"__low_{f}").isNull(), "missing").when(differs, F.lit("ranked" if f in ranked else "conflict")).when(F.col(f"__last_{f}") > F.col(f"__{f}.__rank"), "agreed").otherwise("single")
        stands = F.lit(True) if f in ranked else ~differs
        columns += [F.when(stands, F.col(f"__{f}")[f]).alias(f), F.when(stands, F.get(labels, F.col(f"__{f}.__rank"))).alias(f"{f}_source"), status.alias(f"{f}_status")]
    out = out.select(*keys, F.col(f"__name.{name}").alias(name), "n_sources", *columns)
    for f in fields:
        found.append(check.findings(out, F.col(f"{f}_status").isin("conflict", "ranked"), who, f"{f}_{'ranked' if f in ranked else 'conflict'}", "sources differ", "register", "warn"))
    found.append(check.findings(rows, ~known, F.concat_ws("/", *keys, F.get(labels, F.col("__rank"))), "no_name", "a case or a name is blank", "register", "warn"))
    return out, reduce(DataFrame.unionByName, found)
