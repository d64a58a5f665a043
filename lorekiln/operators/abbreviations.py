"""Abbreviations and aliases in parentheses as evidence that two labelled nodes are one.

Each node becomes a row with its label keys and its short forms, and an index leads from short forms to the
nodes that have them as a label or a form. Pairs are judged by expressions over both rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import text as T

#: Abbreviations of several meanings, and those of known names.
AMBIGUOUS = ("кт", "мрт", "узи", "пцр", "ифа", "экг", "ээг", "мскт", "окт")
KNOWN = {
    "иммуноферментный анализ": "ифа",
    "enzyme-linked immunosorbent assay": "elisa",
    "полимеразная цепная реакция": "пцр",
    "магнитно-резонансная томография": "мрт",
    "компьютерная томография": "кт",
    "ультразвуковое исследование": "узи",
    "электрокардиография": "экг",
    "электрокардиограмма": "экг",
    "электроэнцефалография": "ээг",
    "вирус папилломы человека": "впч",
}
#: Words that acronyms skip, letters of a short label and of an acronym at most.
SKIPPED = ("и", "или", "с", "со", "по", "для", "на", "of", "and", "the", "with")
SHORT, LONGEST = 4, 6
STRONG = ("explicit_parenthetical", "explicit_alias", "known_dictionary")
WEAK = ("generated_acronym", "known_dictionary")

FORMS = "array<struct<form:string,source:string>>"


def _words(label: Column) -> Column:
    return F.regexp_extract_all(label, F.lit(T.WORD), F.lit(0))


def acronym(label: Column) -> Column:
    """First letters of a key's words but for the skipped ones; empty for fewer than two."""
    first = F.transform(F.filter(_words(label), lambda w: ~w.isin(*SKIPPED)), lambda w: F.left(w, F.lit(1)))
    return F.when(F.size(first) < 2, "").otherwise(F.array_join(first, ""))


def is_short(label: Column) -> Column:
    return F.length(F.regexp_replace(label, r"[^\p{L}\p{N}]", "")).between(1, SHORT)


def in_parentheses(raw: Column) -> Column:
    """What stands in parentheses anywhere in the labels as they are written."""
    return F.array_distinct(F.flatten(F.transform(raw, lambda r: F.regexp_extract_all(r, F.lit(r"\(([^)]+)\)"), F.lit(1)))))


def described(nodes: DataFrame, node: str, label: str, aliases: str) -> DataFrame:
    """(node, labels, forms, parenthetical): keys of a node's label and aliases, its short forms with
    where they come from, and its aliases in parentheses. Null labels and aliases are none."""
    written = F.filter(F.concat(F.array(F.col(label)), F.coalesce(F.col(aliases), F.array().cast("array<string>"))), lambda a: a.isNotNull())
    rows = nodes.select(F.col(node).alias("node"), F.posexplode_outer(F.concat(written, in_parentheses(written))).alias("k", "text"), F.size(written).alias("labels_count"))
    # Keys are worked out row by row, as some need more than an expression.
    rows = rows.select("node", (F.col("k") >= F.col("labels_count")).alias("inner"), T.normalize_label(F.col("text")).alias("key"))
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def form(value: Column, source: str, holds: Column) -> Column:
        return F.when(holds & (value != ""), F.struct(value.alias("form"), F.lit(source).alias("source")))

    key, own = F.col("key"), F.coalesce(~F.col("inner"), F.lit(False))
    made = acronym(key)
    found = F.array(
        form(key, "explicit_parenthetical", ~own), form(F.coalesce(F.try_element_at(known, key), F.lit("")), "known_dictionary", own),
        form(key, "explicit_alias", own & is_short(key)), form(made, "generated_acronym", own & (F.length(made) <= LONGEST)),
    )
    rows = rows.withColumn("found", F.filter(found, lambda f: f.isNotNull()))
    return rows.groupBy("node").agg(
        F.array_sort(F.collect_set(F.when(own & (key != ""), key))).alias("labels"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).cast(FORMS).alias("forms"),
        F.array_sort(F.collect_set(F.when(~own & (key != ""), key))).alias("parenthetical"),
    )


def form_index(described_nodes: DataFrame) -> DataFrame:
    """(form, nodes_count, long_nodes_count): in how many nodes a short form stands, and how many of these
    have a longer label that it may be short for."""
    forms = described_nodes.select("node", "labels", F.explode("forms").alias("f")).select("node", F.col("f.form").alias("form"), F.exists("labels", lambda x: F.length(x) > LONGEST).alias("long"))
    return forms.distinct().groupBy("form").agg(F.count("*").alias("nodes_count"), F.count_if("long").alias("long_nodes_count"))


def judged(pairs: DataFrame, nodes: DataFrame, left: str = "left_id", right: str = "right_id") -> DataFrame:
    """``pairs`` with abbreviations, sources, abbreviation_match (``none``, ``clean``, ``ambiguous`` or
    ``weak``) and parenthetical_match; ``nodes`` as of :func:`described`."""
    for side, key in (("l", left), ("r", right)):
        own = nodes.select(F.col("node").alias(key), F.col("labels").alias(f"__{side}_labels"), F.col("forms").alias(f"__{side}_forms"), F.col("parenthetical").alias(f"__{side}_inner"))
        pairs = pairs.join(own, key)

    def forms(side: str, inside: Column) -> Column:
        """Short forms of a side that the other side has, too, with their sources."""
        return F.filter(f"__{side}_forms", lambda f: F.array_contains(inside, f["form"]))

    def label_sources(side: str, met: Column) -> Column:
        """Sources of forms that are labels of this side."""
        def of(f: Column) -> Column:
            inner = F.when(F.array_contains(f"__{side}_inner", f["form"]), F.lit("explicit_parenthetical"))
            return F.array(inner, F.when(is_short(f["form"]), F.lit("explicit_alias")))

        return F.array_compact(F.flatten(F.transform(met, of)))

    names = {side: F.transform(f"__{side}_forms", lambda f: f["form"]) for side in "lr"}
    in_labels = {"l": forms("l", F.col("__r_labels")), "r": forms("r", F.col("__l_labels"))}
    shared = {"l": forms("l", names["r"]), "r": forms("r", names["l"])}
    met = reduce(F.concat, [in_labels["l"], in_labels["r"], shared["l"], shared["r"]])
    sources = reduce(F.concat, [F.transform(met, lambda f: f["source"]), label_sources("r", in_labels["l"]), label_sources("l", in_labels["r"])])
    found = pairs.withColumn("abbreviations", F.array_sort(F.array_distinct(F.transform(met, lambda f: f["form"])))).withColumn("sources", F.array_sort(F.array_distinct(sources)))
    several = F.exists("abbreviations", lambda a: a.isin(*AMBIGUOUS))
    clean = F.exists("sources", lambda s: s.isin(*STRONG)) & ~(several & F.forall("sources", lambda s: s.isin(*WEAK)))
    verdict = F.when(F.size("abbreviations") == 0, "none").when(clean, "clean").when(several, "ambiguous").otherwise("weak")
    inner = F.arrays_overlap("__l_inner", "__r_labels") | F.arrays_overlap("__r_inner", "__l_labels")
    found = found.withColumn("abbreviation_match", verdict).withColumn("parenthetical_match", F.coalesce(inner, F.lit(False)))
    return found.drop(*[f"__{side}_{name}" for side in "lr" for name in ("labels", "forms", "inner")])
