from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F
from test_matching import norm

from lorekiln.operators import catalogue as C


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_collisions_are_told_apart_whatever_the_order(spark):
    names = [f"name {k}" for k in range(60)] * 2
    wanted: dict = {}
    for name in sorted(set(names)):
        same = wanted.setdefault(sha(name)[:1], [])
        same.append(name)
    wanted = {name: f"x_{d}" + (f"_{k + 1}" if k else "") for d, some in wanted.items() for k, name in enumerate(some)}
    for seed in (1, 2):
        random.Random(seed).shuffle(names)
        df = spark.createDataFrame([(n,) for n in names], "name string").repartition(3 + seed)
        found = C.hashed_ids(df, F.col("name"), F.lit("x_"), 1, "id").collect()
        assert len(found) == 120 and {r.name: r.id for r in found} == wanted
    assert {r.name: r.id for r in C.hashed_ids(df, F.col("name"), F.lit("x_"), 16, "id").collect()} == {n: "x_" + sha(n)[:16] for n in names}


def test_ids_of_tags(spark):
    df = spark.createDataFrame([("disease", "«Гастрит»", None, ["b", "a", "b"]), ("drug", "X ", "Y", [])], "t string, ru string, la string, norms array<string>")
    found = {r.t: r.tag_id for r in C.tag_ids(df, "t", ["ru", "la"], "norms").collect()}
    assert found == {"disease": "disease_" + sha("disease\nгастрит\n\na\nb")[:10], "drug": "drug_" + sha("drug\nx\ny")[:10]}


def brute_force(candidates, counts, blocked):
    best: dict = {}
    for tag, kind, alias, latin, source, place in candidates:
        alias = (alias or "").strip()
        if not norm(alias):
            continue
        rank = C.SOURCES.index(source) if source in C.SOURCES else 99
        key = (tag, kind, norm(alias))
        best[key] = min(best.get(key, (100,)), (rank, len(alias), place, alias, latin or "", source))
    active: dict = {}
    for (tag, kind, n), row in best.items():
        if (tag, n) not in blocked:
            for value in {n, norm(row[4])} - {""}:
                active.setdefault((kind, value), set()).add(tag)
    out = {}
    for (tag, kind, n), row in best.items():
        torn, held = len(active.get((kind, n), ())) > 1, (tag, n) in blocked
        reasons = ["alias_conflict"] * torn + ["blocked_active_substance_candidate"] * held
        status = "blocked_active_substance_candidate" if held else "active"
        out[tag, kind, n] = ("al_" + sha(f"{tag}\n{kind}\n{n}")[:16], row[3], row[4], row[5], status, *counts.get((tag, n), (0, 0)), torn, torn or held, reasons)
    return out


def test_aliases_are_brute_force(spark):
    rng = random.Random(4)
    names = ["Alpha", "alpha ", "«Alpha»", "Beta (x)", "beta  (x)", "γ-ray", "гамма-ray", "", None, "..", "Delta", "delta."]
    candidates = [(f"t{rng.randint(0, 5)}", rng.choice("ab"), rng.choice(names), rng.choice([None, "", "Latin", "alpha"]), rng.choice([*C.SOURCES, "other"]), k) for k in range(150)]
    counts = {("t1", "alpha"): (3, 2), ("t2", "delta"): (9, 4)}
    blocked = {("t1", "delta"), ("t3", "alpha")}
    frame = spark.createDataFrame
    rows = C.alias_rows(
        frame(candidates, "tag string, entity_type string, alias string, alias_latin string, source string, place int"),
        frame([(*k, *v) for k, v in counts.items()], "tag string, alias_norm string, mention_count int, document_count int"), frame(sorted(blocked) * 2, "tag string, alias_norm string"),
    )
    got = {(r.tag, r.entity_type, r.alias_norm): (r.alias_id, r.alias, r.alias_latin, r.alias_source, r.alias_status, r.mention_count, r.document_count, r.conflict, r.needs_review, r.review_reasons)
           for r in rows.collect()}
    assert got == brute_force(candidates, counts, blocked)
    assert rows.count() == len(got) and any(v[7] for v in got.values())
    members = frame([("t0",), ("t9",), ("t9",)], "tag string")
    assert [r.tag for r in C.uncovered(members, rows).collect()] == ["t9"]
    assert C.alias_rows(frame([], "tag string, entity_type string, alias string, alias_latin string, source string, place int"),
                        frame([], "tag string, alias_norm string, mention_count int, document_count int"), frame([], "tag string, alias_norm string")).count() == 0
