"""Hits of tags in their documents, against loops over blocks and patterns."""

from __future__ import annotations

import html
import random
import re
import unicodedata

from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators import matching

GREEK = {"α": "альфа", "Α": "альфа", "β": "бета", "Β": "бета", "γ": "гамма", "Γ": "гамма", "δ": "дельта", "Δ": "дельта"}
QUOTES = "\"'«»“”„‟‘’‚‛`"


def norm(value):
    """A label key, step by step."""

    def bare(text):
        text = text.strip().strip(QUOTES + " ")
        while len(text) > 1 and text[0] + text[-1] in ("()", "[]", "{}") and text[1:-1].strip():
            text = text[1:-1].strip()
        return text

    text = unicodedata.normalize("NFKC", html.unescape(value or ""))
    for letter, name in GREEK.items():
        text = text.replace(letter, name)
    text = bare(re.sub("[‐-―−]", "-", text)).lower().replace("ё", "е")
    text = re.sub(r"\s+", " ", re.sub(r"\s*/\s*", "/", re.sub(r"\s*-\s*", "-", text))).strip()
    return bare(re.sub(r"[\s.,:;]+$", "", text))


LABELS = [
    None, "", " x ", "«Альфа»", "«A» – B", "гепатит (острый)", "(whole (label))", "[ (nested) ]", "( )", "((", "{a]", "β-каротин", "Α и Ω", "A ‒ B / C", "ends. , ;:",
    "''quoted''", "\"(both)\"", "(\"both\")", "Ёж", "a&amp;b", "ﬁne", "multi   space\nline", "-", "...", "(a) и (b)", "“x", "q)", "([{deep}])", "(«in»)", "тест №5", "A\xa0B", "-x-", "(.)",
]


def test_labels_are_normalized_step_by_step(spark):
    df = spark.createDataFrame([(v,) for v in LABELS], "v string")
    assert [r[0] for r in df.select(T.normalize_label(F.col("v"))).collect()] == [norm(v) for v in LABELS]


def test_numbers_of_variants(spark):
    wanted = {
        "coenzyme q10": "coenzyme q10", "препарат 500": "препарат", "витамин d 3": "витамин d", "витамин 12": "витамин 12", "витамин b12": "витамин b12",
        "il-6 тест 2": "il-6 тест 2", "covid-19 test 3": "covid-19 test 3", "name12": "name12", "имя 12а": "имя", "12": "12", "- 5": "- 5", "b12 100": "b12 100", "two words 7": "two words",
    }
    df = spark.createDataFrame([(v,) for v in wanted], "v string")
    assert {r[0]: r[1] for r in df.select("v", T.strip_numeric_variant(F.col("v"))).collect()} == wanted


def stands_in(text, term, short=False):
    if not text or not term or (len(re.sub(r"\W", "", term)) < 3 and not short):
        return None
    before = r"(?<!\w)" if term[0].isalnum() else ""
    after = r"(?!\w)" if term[-1].isalnum() else ""
    found = re.search(before + re.escape(term) + after, text)
    return found and found.start()


def brute_force(aliases, links, docs, blocks, quotes, limit):
    terms: dict = {}
    for tag, alias, canonical in aliases:
        if tag is not None and norm(alias):
            own = terms.setdefault(tag, {})
            own[norm(alias)] = own.get(norm(alias), False) or bool(canonical)
    order = {tag: sorted(own, key=lambda t: (not own[t], -len(t), t)) for tag, own in terms.items()}
    weight = lambda t: len(re.sub(r"\W", "", t))
    pairs: dict = {}
    for tag, doc, mention, sole in links:
        pair = pairs.setdefault((tag, doc), [set(), False])
        pair[0].add(mention)
        pair[1] = pair[1] or sole
    out = []
    for (tag, doc), (mentions, sole) in pairs.items():
        own = {k: t for d, k, t in blocks if d == doc and (t or "").strip()}
        if not own:
            continue
        filled, norms, hits = sorted(own), {k: norm(t) for k, t in own.items()}, []
        for k in filled:
            meant = sorted(m for m, q in quotes if m in mentions and len(norm(q)) >= 8 and norm(q) in norms[k])
            if meant:
                hits.append((tag, doc, "quote_match", "high", [k], sorted(set(meant)), [], False))
            found = [t for t in order.get(tag, []) if stands_in(norms[k], t) is not None]
            if found:
                strong = any(terms[tag][t] or weight(t) >= 5 for t in found)
                hits.append((tag, doc, "alias_match", "high" if strong else "medium", [k], [], found[:10], False))
        name, length = next(((n, size) for d, n, size in docs if d == doc), (None, 0))
        short = sole and (length or 0) <= limit
        found = [t for t in order.get(tag, []) if stands_in(norm(name), t, short=True) is not None]
        if not hits and found:
            strong = any(terms[tag][t] or weight(t) >= 5 for t in found)
            hits = [(tag, doc, "title_match", "medium" if strong else "low", filled if short else filled[:1], [], found[:10], not strong)]
        if not hits and short:
            hits = [(tag, doc, "short_doc_fallback", "medium", filled, sorted(mentions), [], False)]
        out += hits or [(tag, doc, "mention_only_fallback", "low", filled[:1], sorted(mentions), [], True)]
    return sorted(out)


def tables(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "of", "the", "x1", "c++", "il-6", "b", "под", "Ёж", "_id", "long-word", "q10", "(note)", "a/b"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    aliases = [(f"t{rng.randint(0, 5)}", rng.choice([text(1), text(2), text(3), text(4), "++", "_id_", "", None, "b"]), rng.choice([True, False, None])) for _ in range(60)]
    docs = [(f"d{k}", rng.choice([None, "", text(2), text(5), "++ b"]), rng.choice([10, 100, None])) for k in range(30)]
    blocks = [(f"d{rng.randint(0, 32)}", k, rng.choice([text(3), text(12), text(30).upper(), "", " ", None, "«" + text(4) + "»"])) for k in range(160)]
    links = [(f"t{rng.randint(0, 6)}", f"d{rng.randint(0, 33)}", f"m{rng.randint(0, 40)}", rng.random() < 0.5) for _ in range(120)]
    quotes = [(f"m{rng.randint(0, 40)}", rng.choice([text(1), text(2), text(4), " of the ", "ma of the al", None, rng.choice(blocks)[2]])) for _ in range(120)]
    return aliases, links, docs, blocks, quotes


def found(spark, aliases, links, docs, blocks, quotes, limit=50):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    hits = matching.find_match_hits(
        matching.alias_terms(frame(aliases, "tag string, alias string, canonical boolean"), "tag", "alias", "canonical"),
        frame(links, "tag string, doc string, mention string, sole boolean"), frame(docs, "doc string, name string, length long"),
        frame(blocks, "doc string, block_index int, text string"), frame(quotes, "mention string, quote string"), limit,
    )
    return hits


def test_hits_are_brute_force(spark):
    seen = set()
    for seed in (1, 2):
        rows = tables(seed)
        got = sorted(tuple(r)[:8] for r in found(spark, *rows).collect())
        assert got == brute_force(*rows, 50)
        seen |= {(r[2], r[3]) for r in got}
    assert {m for m, _ in seen} == set(matching.METHODS)


def test_more_than_ten_aliases_keep_their_order(spark):
    names = [f"name {chr(97 + k)}{'x' * (k % 4)}" for k in range(14)]
    rows = ([("t", n, k == 13) for k, n in enumerate(names)], [("t", "d", "m", False)], [("d", None, 9)], [("d", 0, ", ".join(names))], [])
    (hit,) = found(spark, *rows).collect()
    assert tuple(hit)[:8] == brute_force(*rows, 50)[0]
    assert len(hit.matched_aliases) == 10 and hit.matched_aliases[0] == names[13]


def test_places_of_terms(spark):
    rows = [("il-6", "an il-6, il-60", 3), ("il-6", "il-60", None), ("c++", "in c++11", 3), ("a b", "xa b, a b", 6), (r"\E", r"x \E y", 2), ("_x", "a_x", 1), ("(q", "f(q)", 1), ("x", "", None)]
    df = spark.createDataFrame(rows, "term string, text string, at int")
    got = [r[0] for r in df.select(matching.place_of(F.col("term"), F.col("text"))).collect()]
    assert got == [at for *_, at in rows] == [stands_in(text, term, short=True) for term, text, _ in rows]


def test_empty_tables(spark):
    rows = ([("t", "a name", True)], [("t", "d", "m", True)], [("d", "n", 1)], [("d", 0, "a name")], [("m", "a longer quote")])
    for empty in (0, 3, 4):
        own = list(rows)
        own[empty] = []
        assert sorted(tuple(r)[:8] for r in found(spark, *own).collect()) == brute_force(*own, 50)


def test_equal_quotes_and_titles_are_normalized_once(spark, monkeypatch):
    rows = {}
    keep = matching.Workspace.keep
    monkeypatch.setattr(matching.Workspace, "keep", lambda self, df, table: rows.setdefault(table, keep(self, df, table)))
    mentions = [(f"t{k}", "d", f"m{k}", False) for k in range(20)]
    own = ([("t0", "some title", True)], mentions, [("d", "Some Title", 9)], [("d", 0, "no such words")], [(m, "an equal quote") for *_, m, _ in mentions])
    assert sorted(tuple(r)[:8] for r in found(spark, *own).collect()) == brute_force(*own, 50)
    assert (rows["quotes"].count(), rows["titles"].count()) == (1, 1)


def test_texts_that_need_no_forms_keep_them(spark):
    stays = re.compile(f"[{T.UNCHANGED}]")
    plain = [c for c in map(chr, range(0x3000)) if stays.fullmatch(c)]
    assert all(unicodedata.normalize("NFKC", html.unescape(a + b)) == a + b for a in plain for b in plain)
    odd = ["niño", "niño", "½ «año»", "Ё́", "a…", "Ⅳ", "“q”", "й", "й", "x‑y", "Ω Ω"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    assert [r[0] for r in df.select(T.normalize_label(F.col("v"))).collect()] == [norm(v) for v in odd]
