"""The stages against plain versions of them, on the smallest tables."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_near_copies import brute_force as near_of
from test_secrets import brute_force as secrets_of
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lorekiln.llm import lang_id, queries
from lorekiln.sources.shared import Workspace

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def redacted(text):
    out, at = [], 0
    for begin, _, end in secrets_of(text)[1]:
        if begin >= at:
            out += [text[at:begin], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_stages(spark):
    work = Workspace(spark, "test-pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    state = {r.doc_id: r.text for r in docs.collect()}
    model = lang_id.fit(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = work.keep(stage(spark, docs, DATA), name)
        if name == "language_id":
            state = {k: t for k, t in state.items() if not lang_id.classify(t, model)[2]}
        elif name == "exact_dedup":
            first = {}
            for k in sorted(state):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", state[k]), k)
            state = {k: state[k] for k in first.values()}
        elif name == "simhash_dedup":
            ids = sorted(state)
            component, _ = near_of([(k, state[k]) for k in ids])
            state = {k: state[k] for k in set(component)}
        elif name == "secret_scan":
            state = {k: redacted(t) for k, t in state.items()}
        else:
            tokenizer, pieces = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), defaultdict(list)
            for r in docs.collect():
                pieces[r.doc_id].append(r)
            assert set(pieces) == set(state)
            for k, text in state.items():
                ids = [i for r in sorted(pieces[k], key=lambda r: r.start) for i in np.frombuffer(r.ids, "<u4").tolist()]
                assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
            continue
        assert docs.columns == COLUMNS
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == state and len(rows) == len(state)
        assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    wanted = con.sql(queries.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    order = [wanted.columns.index(c) for c in columns]
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == sorted((tuple(r[k] for k in order) for r in wanted.fetchall()), key=repr)


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
