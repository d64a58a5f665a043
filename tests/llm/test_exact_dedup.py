from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from lorekiln.llm import exact_dedup

ROWS = [
    (5, "a  b\n", "x"), (2, "a b ", "y"), (9, "a b", "z"), (3, None, "n"), (4, "", "n"), (7, "long " * 40_000, "l"), (8, "long " * 40_000, "l"),
    (1, "ä", "u"), (1, "ä", "u"), (None, "a b", "q"), (None, "alone", "q"), (11, "ü\x0b\x0c v", "u"), (12, "ü v", "u"), (13, "ü v", "u"),
]
SCHEMA = "doc_id long, text string, key string"


def brute_force(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(norm(row[1]), []).append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


def test_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert found(exact_dedup.exact_dedup(df)) == brute_force(ROWS)


def test_colliding_hashes_are_told_apart(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    weak = exact_dedup.exact_dedup(df, hash128=lambda t: (F.length(t) % 2).cast("string"))
    assert found(weak) == brute_force(ROWS)


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    assert exact_dedup.drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_copies_keeps_one_of_each_with_all_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    wanted = [(i, k) for i, _, _, k, _ in brute_force(ROWS) if k]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in wanted), key=repr)


def test_hot_text(spark):
    rows = [(k, "same" if k % 3 == 0 else f"t{k}", "") for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(exact_dedup.exact_dedup(df)) == brute_force(rows)
