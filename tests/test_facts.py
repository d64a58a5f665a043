"""Fact groups against a fold over all claims, and the prefix scan against sums over lists."""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators import facts
from lorekiln.operators.ranges import Ranges, Running


def key(value):
    text = unicodedata.normalize("NFKC", value or "").replace("\xa0", " ").replace("ё", "е").replace("Ё", "е")
    text = re.sub(r"\s+", " ", re.sub("[‐-—−]", "-", text).lower()).strip()
    return text.strip(" \t\r\n.,;:!?()[]{}\"'")


def similar(later, first):
    if not later or not first:
        return False
    numbers = lambda t: {n.replace(",", ".") for n in re.findall(r"\d+(?:[.,]\d+)?", t)}
    if numbers(later) and numbers(first) and numbers(later) != numbers(first):
        return False
    if SequenceMatcher(None, later, first).ratio() >= 0.88:
        return True
    words = lambda t: set(re.findall("[0-9A-Za-zА-Яа-яЁё%.,+-]+", t))
    a, b = words(later), words(first)
    return bool(a and b) and len(a & b) / len(a | b) >= 0.82


def brute_force(rows, most):
    """id -> (first id of its group, overflow), by the rule as it is told."""
    buckets: dict = {}
    for tag, kind, number, claim, quote, doc in rows:
        buckets.setdefault((tag or "", kind or ""), []).append((key(claim), key(quote), doc or "", str(number), number))
    out, of_tag = {}, Counter()
    for (tag, _), items in sorted(buckets.items()):
        groups: list = []
        for item in sorted(items):
            for group in groups:
                same = any((item[0] and item[0] == o[0]) or (item[1] and item[1] == o[1]) for o in group)
                if same or similar(item[0], group[0][0]):
                    group.append(item)
                    break
            else:
                groups.append([item])
        for group in groups:
            for item in group:
                out[item[4]] = (group[0][4], of_tag[tag] >= most)
            of_tag[tag] += 1
    return out


def drawn(seed, n):
    rng = random.Random(seed)
    stems = ["the dose is 5 mg per day", "the dose is 6 mg per day", "a long sentence about the effects of the drug on older people", "short", "abc", "ab", "x", "", None,
             "one two three four five six seven eight nine ten", "доза 5 мг в день — всегда", "Ёлка", "(in brackets)", "y " * 120]
    rows = []
    for k in range(n):
        claim = rng.choice(stems)
        if claim and rng.random() < 0.7:
            at = rng.randrange(len(claim))
            claim = claim[:at] + rng.choice(["", "x", " more ", "7", "e"]) + claim[at + rng.randint(0, 2) :]
        quote = rng.choice([None, "", f"quote {rng.randint(0, n // 3)}", "Quote 1."])
        rows.append((rng.choice(["t", "u", None]), rng.choice(["a", "b"]), k, claim, quote, rng.choice(["d1", "d2", None])))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 2000), (2, 7), (3, 3)])
def test_groups_are_a_fold_whatever_the_blocks(spark, seed, block):
    rows = drawn(seed, 130)
    df = spark.createDataFrame(rows, "tag string, kind string, id long, claim string, quote string, doc string")
    got = facts.fact_groups(df, "tag", "kind", "id", "claim", "quote", "doc", most=6, block=block).collect()
    wanted = brute_force(rows, 6)
    assert {r.id: (r.group, r.overflow) for r in got} == wanted
    assert len(got) == len(rows) and any(o for _, o in wanted.values())


def test_many_small_buckets_are_decided_together(spark, monkeypatch):
    """Also where a batch ends within a bucket; no group of its own is made for any of them."""
    rng = random.Random(11)
    rows = [(f"tag {k}", rng.choice("ab"), f"{k}:{j}", rng.choice(["the dose is 5 mg", "the dose is 5 mg.", "another thing", None, ""]), rng.choice([None, "q", f"q{k}"]), "d") for k in range(150) for j in range(rng.choice([1, 1, 1, 2, 5, 30]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "tag string, kind string, id string, claim string, quote string, doc string")
    grouped = type(df.groupBy("tag")).applyInArrow
    monkeypatch.setattr(type(df.groupBy("tag")), "applyInArrow", lambda *a, **k: pytest.fail("a group per bucket"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = facts.fact_groups(df, "tag", "kind", "id", "claim", "quote", "doc", most=1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        monkeypatch.setattr(type(df.groupBy("tag")), "applyInArrow", grouped)
    assert {r.id: (r.group, r.overflow) for r in got} == brute_force(rows, 1) and len(got) == len(rows)


def test_no_claims(spark):
    df = spark.createDataFrame([], "tag string, kind string, id long, claim string, quote string, doc string")
    assert facts.fact_groups(df, "tag", "kind", "id", "claim", "quote", "doc").count() == 0


def test_claim_keys(spark):
    values = [None, "", " The  Dose, 5 mg. ", "«Ёж» — ﬁne!", "(a) [b]", "...", "x\xa0y", "A–B\n c;"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(T.claim_key(F.col("v"))).collect()] == [key(v) for v in values]


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_running_numbers_of_groups_in_many_ranges(spark, partitions):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randint(0, 300), k, rng.choice([None, 1, 2, 50])) for k in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, o int, id int, n int")
        scan = Ranges(df, ["g"], [F.col("o").desc(), "id"])
        scan.add(place=Running("count", before=True), total=Running("sum", F.col("n")), most=Running("max", F.col("n"), before=True))
        got = {r.id: (r.place, r.total, r.most) for r in scan.add(twice=Running("sum", F.col("place"))).result().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted, seen = {}, {}
    for g, _, k, n in sorted(rows, key=lambda r: (-r[1], r[2])):
        place, total, most = seen.get(g, (0, 0, None))
        total += n or 0
        wanted[k] = (place, total, most)
        seen[g] = (place + 1, total, n if most is None else max(most, n or 0))
    assert got == wanted


def test_few_claims_are_matched_character_by_character(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(400)]
    lines = [" ".join(rng.choices(words, k=60)) for _ in range(150)]
    lines += [line.replace(line.split()[3], "changed", 1) for line in lines[::10]] + [line[::-1] for line in lines[:5]]
    made = []
    monkeypatch.setattr(facts, "SequenceMatcher", lambda *a: made.append(a) or SequenceMatcher(*a))
    units = [({"node": k, "claim": c, "words": set(facts.WORDS.findall(c)), "numbers": set()}, "", None, None) for k, c in enumerate(lines)]
    got = list(facts.first_fit(iter(units)))
    wanted: list = []
    for k, line in enumerate(lines):
        wanted.append(next((f for f in range(k) if wanted[f] == f and similar(line, lines[f])), k))
    assert got == wanted and len(set(got)) < len(lines)
    assert len(made) < 200  # all firsts, one by one, are more than 10 000


def test_later_blocks_meet_firsts_without_pairs(spark, monkeypatch):
    """Claims of one alphabet share runs everywhere; bounds over all firsts of a block leave few to be matched."""
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(200)]
    lines = [" ".join(rng.choices(words, k=40)) for _ in range(60)]
    lines += [line.replace(line.split()[7], "changed", 1) for line in lines[::4]]
    rows = [("t", "k", k, line, None, "d") for k, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "tag string, kind string, id long, claim string, quote string, doc string")
    got = facts.fact_groups(df, "tag", "kind", "id", "claim", "quote", "doc", block=25).collect()
    assert {r.id: (r.group, r.overflow) for r in got} == brute_force(rows, 200)
    assert len({r.group for r in got}) < len(rows)
    claims = [{"node": k, "claim": line, "words": set(facts.WORDS.findall(line)), "numbers": set()} for k, line in enumerate(lines)]
    made = []
    monkeypatch.setattr(facts, "SequenceMatcher", lambda *a: made.append(a) or SequenceMatcher(*a))
    table = facts.pa.Table.from_pylist([c | {"words": sorted(c["words"]), "numbers": []} for c in claims], facts.pa.schema([("node", "int64"), ("claim", "string"), ("words", facts.pa.list_(facts.pa.string())), ("numbers", facts.pa.list_(facts.pa.string()))]))
    found = facts._near(table.slice(0, 60), table.slice(60))
    wanted = [(60 + k, next((f for f in range(60) if similar(lines[60 + k], lines[f])), None)) for k in range(15)]
    assert list(zip(found["node"].to_pylist(), found["base"].to_pylist(), strict=True)) == wanted
    assert len(made) < 60  # of 900 pairs
