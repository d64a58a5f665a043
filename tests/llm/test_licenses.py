from __future__ import annotations

import random
import re

import pytest

from lorekiln.llm import licenses
from lorekiln.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def named_brute_force(text):
    """(n_words, places, labels) of the fixed phrases."""
    words = words_of(text)
    places = [(at, label) for label, phrase in PHRASES.items() for at in range(len(words)) if words[at : at + len(phrase)] == phrase]
    return len(words), sorted(p for p, _ in places), sorted({label for _, label in places})


def votes_brute_force(text):
    """(label, start, end) of all other templates, by dictionaries and loops."""
    words, out = words_of(text), []
    for template in licenses.TEXTS:
        wanted, k = words_of(template.text), min(4, len(words_of(template.text)))
        grams: dict = {}
        for t in range(len(wanted) - k + 1):
            grams.setdefault(tuple(wanted[t : t + k]), []).append(t)
        diagonals: dict = {}
        for w in range(len(words) - k + 1):
            for t in grams.get(tuple(words[w : w + k]), []):
                diagonals.setdefault(w - t, []).append((w, t))
        groups, last = [], None
        for d in sorted(diagonals):
            if last is None or d - last > 5:
                groups.append([])
            groups[-1] += diagonals[d]
            last = d
        for hits in groups:
            covered = {t + j for _, t in hits for j in range(k)}
            own = {w + j for w, _ in hits for j in range(k)}
            start, end = min(own), max(own) + 1
            if len(covered) >= template.least * len(wanted) and len(own) >= (end - start) / 2:
                out.append((template.label, start, end, len(covered) / len(wanted)))
    return sorted(out)


def changed(rng, text, share):
    words = text.split()
    for k in range(len(words)):
        if rng.random() < share:
            words[k] = rng.choice(["", "other", words[k] + " more"])
    return " ".join(words)


def corpus():
    rng = random.Random(11)
    prose = "the of a copy license public general and to in software mit this is with any kind or".split()
    rows = [None, "", "MIT License", "mit\nlicense mit, LICENSE; MIT license", "mit-licenses", "GNU General Public License, version 3", "general public\tLicense Apache License",
            "MİT License", "mit ä license", "ſomeLicense mit license", "Licensed under CC BY-NC 4.0.", "licensed under cc by", " ".join(["mit license"] * 3000),
            " ".join(rng.choice(prose) for _ in range(5000))]
    for template in licenses.TEXTS:
        for share in (0, 0.03, 0.1, 0.4):
            before = " ".join(rng.choice(prose) for _ in range(rng.randint(0, 1500)))
            rows.append(f"{before} {changed(rng, template.text, share)} {before[:300]} {changed(rng, template.text.upper(), share)}")
    return rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("licenses")
    rows = [(k, t, "x") for k, t in enumerate(corpus())]
    spark.createDataFrame(rows, "doc_id long, text string, n_words string").write.parquet(f"{folder}/documents.parquet")
    return str(folder), {k: t for k, t, _ in rows}


def test_spans_are_brute_force(spark, table):
    folder, texts = table
    found = licenses.find_licenses(spark.read.parquet(f"{folder}/documents.parquet"))
    ids = {r.row: r.id for r in found.documents.collect()}
    got: dict = {k: [] for k in texts}
    for r in found.spans.filter("not named").collect():
        got[ids[r.row]].append((r.label, r.start, r.end, r.score))
    assert {k: sorted(v) for k, v in got.items()} == {k: votes_brute_force(t) for k, t in texts.items()}
    assert {v[0] for spans in got.values() for v in spans} == {t.label for t in licenses.TEXTS}


def test_query_is_brute_force(spark, table):
    folder, texts = table
    got = QUERIES["op12_license_scan"](spark, folder)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == set(texts)
    for k, text in texts.items():
        n, places, labels = named_brute_force(text)
        more = votes_brute_force(text)
        score = max([1.0] * bool(places) + [s for *_, s in more], default=0.0)
        wanted = (k, n, len(places), places[0] if places else None, places[-1] if places else None, ",".join(labels), ",".join(sorted({*labels, *(m[0] for m in more)})), score)
        assert tuple(rows[k]) == wanted


def test_null_and_repeated_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "MIT License"), (None, "MIT License"), (1, "none"), (1, None)], "doc_id long, text string")
    found = licenses.find_licenses(docs)
    assert sorted((r.id or -1, r.n_words) for r in found.documents.collect()) == [(-1, 2), (-1, 2), (1, 0), (1, 1)]
    assert found.spans.count() == 2
    empty = licenses.find_licenses(docs.limit(0))
    assert (empty.documents.count(), empty.spans.count()) == (0, 0)


def test_other_templates(spark):
    own = (licenses.Template("ours", "all rights reserved by us", 1.0, True), licenses.Template("theirs", "no rights at all are granted by them to anyone else"))
    docs = spark.createDataFrame([(1, "All rights reserved by us, and no rights at all are granted by them."), (2, "all rights reserved by them")], "doc_id long, text string")
    found = licenses.find_licenses(docs, templates=own)
    assert sorted((r.label, r.start, r.end) for r in found.spans.collect()) == [("ours", 0, 5), ("theirs", 6, 14)]
