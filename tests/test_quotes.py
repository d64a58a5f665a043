"""Quotes with changes anywhere, against a look at every window of every document."""

from __future__ import annotations

import random
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest

from lorekiln.functions.similarity import fuzzy_match
from lorekiln.operators import links, quotes
from lorekiln.plans import queries_quotes
from lorekiln.sources import shared

WORDS = [f"word{k:02d}" for k in range(40)]
QUOTE = " ".join(WORDS)


def key(text):
    return re.sub(r"[ \t\n\r\f\x0b]+", " ", text.replace("\xa0", " ").replace("ё", "е").replace("Ё", "Е").lower()).strip()


def close(quote, window):
    counts = Counter(quote)
    counts.subtract(window)  # characters without a partner are not matched, whatever the order
    return sum(abs(c) for c in counts.values()) <= 0.13 * len(quote) and SequenceMatcher(None, quote, window).ratio() >= 0.94


def brute_force(quote, text):
    """The rule by definition: every twelfth of a window is tried, no bound, no candidates."""
    raw, text = (quote or "").strip(" \t\n\r\f\x0b"), text or ""
    if not raw or "..." in raw or "…" in raw:
        return None
    if raw in text:
        return "exact"
    q, body = key(raw), key(text)
    if q in body:
        return "normalized_exact"
    n = len(q)
    near = 32 <= n <= min(500, len(body)) and any(close(q, body[at : at + n]) for at in range(0, len(body) - n + 1, max(1, n // 12)))
    return "fuzzy" if near else None


def changed(rng, quote, every, kinds="sid"):
    out = []
    for k, c in enumerate(quote):
        if k % every == every // 2:
            kind = rng.choice(kinds)
            out.append({"s": rng.choice("xyz"), "i": c + rng.choice("xyz"), "d": ""}[kind])
        else:
            out.append(c)
    return "".join(out)


def corpus():
    rng = random.Random(4)
    letters = "abcdefghij"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 12))) for _ in range(300)] + ["the", "of", "and"] * 40
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    asked = [prose(rng.choice([6, 9, 14, 25, 45])) for _ in range(9)] + ["ab", "Abc!", "the of", "a", " ", None, "one ... two", "stitched… here", "Q" * 600, "aaaa " * 20, prose(90)]
    docs = [None, "", prose(50), "aaaa " * 200, "Q" * 700, "x the  OF y"]
    for quote in asked:
        for every in (17, 20, 24, 31, 60):
            body = changed(rng, quote or "", every, rng.choice(["s", "sid", "id"]))
            docs.append(f"{prose(rng.randint(0, 60))}, {body} {prose(rng.randint(0, 30))}")
        docs.append(f"{prose(rng.randint(0, 700))} {quote}. {prose(3)}")
        docs.append(f"{prose(20)} {(quote or '').upper()}  {prose(3)}")
    return asked, docs


@pytest.mark.parametrize("fuzzy", [True, False])
def test_all_pairs_are_brute_force(spark, fuzzy):
    asked, bodies = corpus()
    q = spark.createDataFrame(list(enumerate(asked)), "item_id long, quote string")
    d = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    got = {(r[0], r[1]): r[2] for r in quotes.find_quotes(q, "item_id", "quote", d, "doc_id", "text", fuzzy).collect()}
    wanted = {(i, j): s for i, quote in enumerate(asked) for j, body in enumerate(bodies) if (s := brute_force(quote, body)) and (fuzzy or s != "fuzzy")}
    assert got == wanted
    assert {"exact", "normalized_exact"} | ({"fuzzy"} if fuzzy else set()) == set(wanted.values())


@pytest.mark.parametrize("shape", [(20, 8), (18, 9), (14, 12), (10, 8)])
def test_a_letter_changed_in_every_third_word_is_found(spark, shape):
    """No three words of quote and text are the same in a row."""
    rng = random.Random(shape[0])
    rows, bodies = [], []
    for k in range(12):
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(shape[1])) for _ in range(shape[0])]
        rows.append((k, " ".join(words)))
        for at in range(1, len(words), 3):
            words[at] = words[at][:3] + "Z" + words[at][4:]
        bodies.append((k, " ".join(words) + " and behind"))
    q, d = spark.createDataFrame(rows, "item_id long, quote string"), spark.createDataFrame(bodies, "doc_id long, text string")
    found = quotes.find_quotes(q, "item_id", "quote", d, "doc_id", "text")
    assert sorted(map(tuple, found.collect())) == [(k, k, "fuzzy") for k in range(12) if brute_force(rows[k][1], bodies[k][1])]
    assert found.count() == 12


def test_fuzzy_quotes_are_found_at_every_place(spark, tmp_path):
    """Whatever the place where the only close window begins, also between twelfths of the quote."""
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    asked = [(k, letters(n)) for k, n in enumerate((32, 47, 120, 190))]
    bodies = []
    for k, quote in asked:
        loose = int(len(quote) * 0.06 + 1e-6)
        for at in range(0, 40, 3):
            changed_at = {1 + (j * len(quote)) // loose for j in range(loose)}  # all that may be changed is
            body = "".join("Z" if j in changed_at else c for j, c in enumerate(quote))
            bodies.append((k * 100 + at, letters(at) + body + letters(rng.randint(0, 30))))
    q, d = spark.createDataFrame(asked, "item_id long, text string"), spark.createDataFrame(bodies, "doc_id long, text string")
    q.write.parquet(f"{tmp_path}/benchmark.parquet")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    every = lambda quote, body: any(close(quote, body[at : at + len(quote)]) for at in range(len(body) - len(quote) + 1))
    wanted = {(k, j, "fuzzy") for k, quote in asked for j, body in bodies if every(quote, key(body))}
    assert {(k, k * 100 + at, "fuzzy") for k, _ in asked for at in range(0, 40, 3)} <= wanted
    assert set(map(tuple, queries_quotes.sim_quote_fuzzy(spark, str(tmp_path)).collect())) == wanted


def test_no_quotes_and_no_documents(spark):
    q, d = spark.createDataFrame([(1, "a quote")], "item_id long, quote string"), spark.createDataFrame([(1, "a quote")], "doc_id long, text string")
    for one, other in ((q.limit(0), d), (q, d.limit(0)), (q.limit(0), d.limit(0))):
        found = quotes.find_quotes(one, "item_id", "quote", other, "doc_id", "text")
        assert (found.columns, found.count()) == (["item_id", "doc_id", "quote_status"], 0)


def plain(quote, body):
    size = len(quote)
    return any(SequenceMatcher(None, quote, body[at : at + size]).ratio() >= 0.94 for at in range(0, len(body) - size + 1, max(1, size // 12)))


def test_long_quotes_are_not_matched_by_their_beginning():
    long_quote = "a sentence about things " * 21
    assert len(long_quote) > 500 and not fuzzy_match(long_quote, long_quote[:500] + "another end" * 9)
    assert not fuzzy_match("longer than the text", "longer than")
    for cut in range(0, 60, 7):
        body = "x" * cut + QUOTE[cut:] + " tail"
        assert fuzzy_match(QUOTE, body) == plain(QUOTE, body)


def test_quote_hits_of_texts_and_short_quotes(spark):
    quotes = spark.createDataFrame([(1, "one two three four five"), (2, "three"), (3, "one two three four six"), (4, "")], "item_id long, quote string")
    docs = spark.createDataFrame([(10, "Zero one two three four five."), (11, "three"), (12, None)], "doc_id long, text string")
    assert sorted(map(tuple, links.quote_hits(quotes, "item_id", "quote", docs, "doc_id", "text").collect())) == [(1, 10), (2, 10), (2, 11)]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master, applicationId = "local-cluster[2,1,1024]", "x"

    with pytest.raises(ValueError, match="share"):
        shared.shared_root(Session())


def test_plain_quotes_are_found_by_chunks_at_every_place(spark, monkeypatch):
    """Without a row for every character of the texts; places before, over and behind the end of a piece."""
    rng = random.Random(7)
    letters = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    asked = list(enumerate(letters(n) for n in (1, 2, 3, 4, 5, 9, 10, 11, 31, 32, 62, 63, 64, 120, 700)))
    bodies = [(k * 100 + shift, letters(quotes.PIECE - len(quote) // 2 - shift) + quote + letters(shift)) for k, quote in asked for shift in range(0, 34, 3)]
    monkeypatch.setattr(quotes, "_runs", None)
    q, d = spark.createDataFrame(asked, "item_id long, quote string"), spark.createDataFrame(bodies, "doc_id long, text string")
    found = quotes.find_quotes(q, "item_id", "quote", d, "doc_id", "text", fuzzy=False)
    assert {(r[0], r[1]) for r in found.collect()} == {(k, j) for k, quote in asked for j, body in bodies if quote in body}


def test_fuzzy_quotes_make_the_runs_of_the_texts_once(spark, monkeypatch):
    made, runs = [], quotes._runs
    monkeypatch.setattr(quotes, "_runs", lambda keys, key_col, text_col, sizes: made.append(text_col) or runs(keys, key_col, text_col, sizes))
    q, d = spark.createDataFrame([(1, QUOTE[:150])], "item_id long, quote string"), spark.createDataFrame([(1, QUOTE[:150].replace("07", "77"))], "doc_id long, text string")
    uses = []
    monkeypatch.setattr(quotes, "_keys", lambda asked, places, sizes, keys=quotes._keys: uses.append(places.columns) or keys(asked, places, sizes))
    assert [tuple(r) for r in quotes.find_quotes(q, "item_id", "quote", d, "doc_id", "text").collect()] == [(1, 1, "fuzzy")]
    assert made.count("__body") == 1 and len(uses) == 1
    # the table that keys are counted in has a row per chunk
    assert quotes._chunks(d.selectExpr("doc_id as __doc_id", "text as __body"), [8]).count() == 150 // 8
