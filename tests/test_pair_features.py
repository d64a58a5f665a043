from __future__ import annotations

import random
import re
from difflib import SequenceMatcher

from test_abbreviations import NODES, brute_force, describe
from test_matching import norm

from lorekiln.operators import pair_features as P

SCHEMA = (
    "id long, label string, aliases array<string>, entity_type string, latin string, product_key string, documents array<string>, risk_flags array<string>, mentions_count int, context_only_count int"
)


def nodes_of():
    rng = random.Random(6)
    more = [(50, "острый гепатит a", ["гепатит"]), (51, "острый гепатит b", ["гепатит", "рак"]), (52, "рак", []), (53, "опухоль", ["рак"]), (54, "Берлиприл", []), (55, "берлиприл", ["x"])]
    kinds = ["disease", "diagnostic_method", "drug_trade_name", "other"]
    flags = ["quote_not_found", "low_confidence", "has_specificity_modifier", "unrelated"]
    return [
        (k, label, aliases, {5: "disease", 6: "drug_trade_name"}.get(k // 10 + k // 54, rng.choice(kinds)), rng.choice([None, "", "ecg", "Long latin name", "elisa"]),
         "p1" if k >= 54 else rng.choice([None, "", "p1"]), rng.sample(["d1", "d2", "d3", "d4"], rng.randint(0, 4)),
         rng.sample(flags, rng.randint(0, 2)), 3, rng.choice([0, 3]))
        for k, label, aliases in NODES + more
    ]


def expected(a, b):
    """Score and reasons by adding them up one by one."""
    score, clean, weak, risks = 0.0, set(), set(), set()
    (_, la, aa, kind, lat_a, prod_a, docs_a, flags_a, m_a, c_a), (_, lb, ab, kind_b, lat_b, prod_b, docs_b, flags_b, m_b, c_b) = a, b
    (labels_a, _, _), (labels_b, _, _) = describe(la, aa), describe(lb, ab)
    general = lambda kind, labels: {x for x in labels if x in P.GENERIC.get(kind, ())}
    matched, generic = labels_a & labels_b, general(kind, labels_a) | general(kind_b, labels_b)
    short = lambda v: 1 <= len(re.sub(r"[\W_]", "", v)) <= 4

    def add(name, value, where):
        nonlocal score
        score += value
        where.add(name)

    if norm(la) and norm(la) == norm(lb):
        add("primary_label_exact_match", 0.8, clean)
    elif matched - generic:
        add("canonical_alias_exact_match", 0.65, clean)
    elif matched:
        add("generic_alias_exact_match", 0.18, weak)
        risks.add("generic_alias_conflict")
    x, y = norm(lat_a), norm(lat_b)
    if (x and x == y) or (x and x in labels_b) or (y and y in labels_a):
        add(*(("shared_latin_candidate_non_short", 0.45, clean) if not short(x) and not short(y) else ("shared_latin_candidate_short", 0.15, weak)))
    verdict, inner = brute_force((la, aa), (lb, ab))[2:]
    if verdict == "ambiguous":
        add("ambiguous_abbreviation_match", 0.12, weak)
        risks.add("ambiguous_abbreviation")
    elif verdict != "none":
        add(*(("known_safe_abbreviation_match", 0.45, clean) if verdict == "clean" else ("generated_acronym_match", 0.10, weak)))
    if inner:
        add("explicit_parenthetical_alias_match", 0.40, clean)
    if kind in P.PRODUCTS and prod_a and prod_a == prod_b:
        add("product_variant_match", 0.45, clean)
    ta, tb = set(re.findall(r"\w+", norm(la))), set(re.findall(r"\w+", norm(lb)))
    if ta and tb and len(ta & tb) / len(ta | tb) >= 0.75:
        add("high_token_similarity", 0.25, weak)
    ratio = SequenceMatcher(None, norm(la), norm(lb)).ratio()
    if ratio >= 0.92 and not generic:
        add("high_sequence_similarity_without_scope_conflict", 0.20, clean)
    elif ratio >= 0.88:
        add("high_sequence_similarity", 0.20, weak)
    elif ratio >= 0.78:
        add("moderate_sequence_similarity", 0.12, weak)
    if together := len(set(docs_a) & set(docs_b)):
        add("same_document_cooccurrence", min(0.15, 0.05 + together * 0.02), weak)
    for name, value, holds in (
        ("both_context_only", 0.15, c_a == m_a and c_b == m_b), ("quote_issue", 0.10, "quote_not_found" in flags_a + flags_b), ("low_confidence", 0.15, "low_confidence" in flags_a + flags_b),
        ("disease_modifier_mismatch", 0.30, kind == "disease" and bool((set(flags_a) ^ set(flags_b)) & set(P.MODIFIERS))),
    ):
        if holds:
            score -= value
            risks.add(name)
    return round(max(0.0, min(1.0, score)), 6), sorted(clean), sorted(weak), sorted(risks)


def test_all_pairs_are_added_up_alike(spark):
    nodes = {n[0]: n for n in nodes_of()}
    rows = [(a, b) for a in nodes for b in nodes if a < b]
    found = P.scored(spark.createDataFrame(rows, "left_id long, right_id long"), P.featured(spark.createDataFrame(list(nodes.values()), SCHEMA)))
    got = {(r.left_id, r.right_id): (r.score, r.clean_reasons, r.weak_reasons, r.risk_reasons) for r in found.collect()}
    wanted = {(a, b): expected(nodes[a], nodes[b]) for a, b in rows}
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in wanted.items()}
    assert all(abs(got[k][0] - wanted[k][0]) <= 2e-6 for k in wanted)
    seen = {reason for v in wanted.values() for reason in v[1] + v[2]}
    assert set(P.SCORES) - seen <= {"moderate_sequence_similarity", "high_sequence_similarity", "shared_latin_candidate_short"}
