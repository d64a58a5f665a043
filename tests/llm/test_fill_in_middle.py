from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lorekiln.llm import fill_in_middle as fim
from lorekiln.llm.queries import QUERIES

SPACE = r"[\x20\x09-\x0D]"
PATTERN = rf"{SPACE}*[^\x20\x09-\x0D]+|{SPACE}+"

TEXTS = [
    None, "", " ", "one", "  two words\n", "a <P> b", "x<S>", "<M>", "< P> <", "P> <S", "ä ö ü \U0001f600 \U0001f600x", "\t\x0b\x0c\r\n", "word " * 30_000,
    " " * 50_000 + "x" + " " * 50_000, "<" * 50, "S><S ><M", "the end of <", "same", "same",
]


def brute_force(doc_id, text):
    text = text or ""
    units = re.findall(PATTERN, text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k if k % 7 else None, t) for k, t in enumerate(TEXTS * 12)]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, form string")
    return fim.rearrange(docs).withColumn("restored", fim.restored(F.col("fim.output"), F.col("fim.form"))).collect()


def test_is_what_lists_of_units_give(found):
    forms = set()
    for row in found:
        wanted = brute_force(row.doc_id, row.text)
        assert tuple(row.fim) == wanted
        assert row.form == "kept"
        forms.add(row.fim.form)
    assert forms == {"plain", "psm", "spm"}


def test_restores_every_text(found):
    assert all(row.restored == (row.text or "") for row in found)


def test_cuts_after_any_units():
    text = " ab  c\nd  "
    units = re.findall(PATTERN, text)
    for a in range(len(units) + 1):
        for b in range(len(units) + 1):
            n, low, high = fim.cuts(text, a + 5 * (len(units) + 1), b)
            assert (n, text[:low], text[low:high]) == (len(units), "".join(units[: min(a, b)]), "".join(units[min(a, b) : max(a, b)]))


def test_other_plans_and_empty_tables(spark):
    plan = fim.Plan(rearranged=100, suffix_first=0, seed=7, markers=("[a]", "(b)", "{c}"))
    docs = spark.createDataFrame([(1, "some words here"), (2, "has (b) in it"), (3, "more of them, <P>")], "doc_id long, text string")
    out = fim.rearrange(docs, plan=plan).withColumn("back", fim.restored(F.col("fim.output"), F.col("fim.form"), plan)).collect()
    assert [r.fim.form for r in out] == ["psm", "plain", "psm"]
    assert all(r.back == r.text for r in out)
    assert fim.rearrange(docs.limit(0)).count() == 0


def test_query_is_brute_force(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = {}
    for k, t in rows:
        n, form, p, m, output = brute_force(k, t)
        wanted[k] = (n, form, p, m, sha(output), sha(t or ""))
    got = QUERIES["op13_fill_in_middle"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted
