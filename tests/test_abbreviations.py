from __future__ import annotations

import random
import re

from lorekiln.operators import abbreviations as A

from test_matching import norm

NODES = [
    (1, "Магнитно-резонансная томография", ["МРТ"]), (2, "МРТ", []), (3, "компьютерная томография", None), (4, "КТ", ["кт органов"]), (5, "Enzyme-linked immunosorbent assay (ELISA)", []),
    (6, "elisa", []), (7, "World Health Organization", []), (8, "WHO", []), (9, "wide heart organ", []), (10, "Болезнь (Синдром Дауна)", [None, ""]), (11, "синдром дауна", []),
    (12, None, None), (13, "A of B", ["x (AB)"]), (14, "ab", []), (15, "Вирус папилломы человека", []), (16, "ВПЧ-инфекция", ["впч"]), (17, "one two three four five six seven", []), (18, "ottffss", []),
    (19, "электрокардиограмма", []), (20, "ЭКГ (экг)", []), (21, "электрокардиография", []),
]


def describe(label, aliases):
    written = [v for v in [label, *(aliases or [])] if v is not None]
    labels = {norm(v) for v in written} - {""}
    inner = {norm(m) for v in written for m in re.findall(r"\(([^)]+)\)", v)} - {""}
    forms: dict = {}
    for value in inner:
        forms.setdefault(value, set()).add("explicit_parenthetical")
    for value in labels:
        if value in A.KNOWN:
            forms.setdefault(A.KNOWN[value], set()).add("known_dictionary")
        if 1 <= len(re.sub(r"[\W_]", "", value)) <= 4:
            forms.setdefault(value, set()).add("explicit_alias")
        parts = [w for w in re.findall(r"\w+", value) if w not in A.SKIPPED]
        if 2 <= len(parts) <= 6:
            forms.setdefault("".join(p[0] for p in parts), set()).add("generated_acronym")
    return labels, inner, forms


def brute_force(left, right):
    (ll, li, lf), (rl, ri, rf) = describe(*left), describe(*right)
    found, sources = set(), set()
    for forms, labels, inner in ((lf, rl, ri), (rf, ll, li)):
        for form in set(forms) & labels:
            found.add(form)
            sources |= forms[form] | ({"explicit_parenthetical"} if form in inner else set()) | ({"explicit_alias"} if len(re.sub(r"[\W_]", "", form)) <= 4 else set())
    for form in set(lf) & set(rf):
        found.add(form)
        sources |= lf[form] | rf[form]
    several = bool(found & set(A.AMBIGUOUS))
    clean = bool(sources & set(A.STRONG)) and not (several and sources <= set(A.WEAK))
    verdict = "none" if not found else "clean" if clean else "ambiguous" if several else "weak"
    return sorted(found), sorted(sources), verdict, bool(li & rl or ri & ll)


def test_all_pairs_are_brute_force(spark):
    nodes = {n: (label, aliases) for n, label, aliases in NODES}
    rows = [(a, b) for a in nodes for b in nodes if a < b]
    random.Random(1).shuffle(rows)
    described = A.described(spark.createDataFrame(NODES, "id long, label string, aliases array<string>"), "id", "label", "aliases")
    got = A.judged(spark.createDataFrame(rows, "left_id long, right_id long"), described)
    assert got.columns == ["right_id", "left_id", "abbreviations", "sources", "abbreviation_match", "parenthetical_match"]
    found = {(r.left_id, r.right_id): (r.abbreviations, r.sources, r.abbreviation_match, r.parenthetical_match) for r in got.collect()}
    assert found == {(a, b): brute_force(nodes[a], nodes[b]) for a, b in rows}
    assert {f[2] for f in found.values()} == {"none", "clean", "ambiguous", "weak"}
    assert found[1, 2][2] == "clean" and found[7, 8][2] == "clean" and found[7, 9][2] == "weak" and found[10, 11][3]


def test_index_counts_nodes_of_a_form(spark):
    described = A.described(spark.createDataFrame(NODES, "id long, label string, aliases array<string>"), "id", "label", "aliases")
    index = {r.form: (r.nodes_count, r.long_nodes_count) for r in A.form_index(described).collect()}
    assert index["who"] == (3, 2) and index["elisa"] == (1, 1)


def test_no_nodes(spark):
    described = A.described(spark.createDataFrame([], "id long, label string, aliases array<string>"), "id", "label", "aliases")
    assert described.count() == 0 and A.form_index(described).count() == 0
