"""The registered queries: against DuckDB where SQL can say them, the pipeline against a plain version."""

import hashlib
import re

import duckdb
import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from folioflow.llm import decontam, langid, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_same_as_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    run = con.execute(queries.ORACLES[name])
    there = [d[0] for d in run.description]
    assert sorted(there) == cols
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(str(tuple(r[there.index(c)] for c in cols)) for r in run.fetchall())


def test_pipeline_against_a_plain_version(spark):
    out = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in table.collect()}
    model = langid.train(table.filter("crc32(cast(doc_id as string)) % 4 <> 2"))
    names, sure, known = langid.Scorer(model).predict(list(docs.values()))
    docs = {i: t for (i, t), s, k in zip(docs.items(), sure, known) if k and s >= 0.3}
    first = {}
    for i in sorted(docs):
        first.setdefault(hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", docs[i]).encode()).digest(), i)
    docs = {i: docs[i] for i in first.values()}
    from test_jaccard import brute

    near = brute(list(docs.items()))
    docs = {i: t for i, t in docs.items() if near[i][1] == i}
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = decontam._items([{"text": t} for t in bench])
    for i, t in list(docs.items()):
        plain = decontam._items([{"text": t}])[0]
        if any(decontam.edit_search(x, plain)[0] <= decontam.EDITS * len(x) for x in items):
            del docs[i]
    ranks = {k: v for k, v in corpus_pipeline.bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)).items()}
    peer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert out == {i: peer.encode_ordinary(t) for i, t in docs.items()}
