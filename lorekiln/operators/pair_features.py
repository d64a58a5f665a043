"""What speaks for and against two nodes being one, as a score with its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.operators import abbreviations as A

#: Labels that say little of a node of their type, and types whose variants are one product.
GENERIC = {
    "diagnostic_method": (
        "магнитно-резонансная томография",
        "мрт",
        "компьютерная томография",
        "кт",
        "ультразвуковое исследование",
        "узи",
        "биопсия",
        "рентгенография",
        "анализ крови",
        "анализ мочи",
        "генетическое тестирование",
    ),
    "procedure": (
        "вакцинация",
        "вакцинация против",
        "трансплантация",
        "операция",
        "терапия",
    ),
    "disease": ("полип", "опухоль", "рак", "синдром", "болезнь", "порок", "дефект"),
}
PRODUCTS = ("drug_trade_name", "supplement")
MODIFIERS = ("has_specificity_modifier", "contains_specificity_modifier")
#: Thresholds of similarity, and what each reason and risk counts.
HIGH_TOKENS, VERY_HIGH_RATIO, HIGH_RATIO, MODERATE_RATIO = 0.75, 0.92, 0.88, 0.78
SCORES = {
    "primary_label_exact_match": 0.80,
    "canonical_alias_exact_match": 0.65,
    "generic_alias_exact_match": 0.18,
    "shared_latin_candidate_non_short": 0.45,
    "shared_latin_candidate_short": 0.15,
    "ambiguous_abbreviation_match": 0.12,
    "known_safe_abbreviation_match": 0.45,
    "generated_acronym_match": 0.10,
    "explicit_parenthetical_alias_match": 0.40,
    "product_variant_match": 0.45,
    "high_token_similarity": 0.25,
    "high_sequence_similarity_without_scope_conflict": 0.20,
    "high_sequence_similarity": 0.20,
    "moderate_sequence_similarity": 0.12,
}
PENALTIES = {"both_context_only": 0.15, "quote_issue": 0.10, "low_confidence": 0.15, "disease_modifier_mismatch": 0.30}
CLEAN = (
    "primary_label_exact_match",
    "canonical_alias_exact_match",
    "shared_latin_candidate_non_short",
    "known_safe_abbreviation_match",
    "explicit_parenthetical_alias_match",
    "product_variant_match",
    "high_sequence_similarity_without_scope_conflict",
)

#: Columns of a node besides ``id``, ``label`` and ``aliases``.
OWN = ("entity_type", "latin", "product_key", "documents", "risk_flags", "mentions_count", "context_only_count")


def featured(nodes: DataFrame) -> DataFrame:
    """Nodes with what pairs are judged by. ``nodes``: id, label, aliases and :data:`OWN`."""
    described = A.described(nodes, "id", "label", "aliases")
    keys = nodes.select(
        F.col("id").alias("node"), "entity_type", T.normalize_label(F.col("label")).alias("key"), T.normalize_label(F.col("latin")).alias("latin"), "product_key", "documents",
        F.coalesce("risk_flags", F.array().cast("array<string>")).alias("risk_flags"), (F.col("context_only_count") == F.col("mentions_count")).alias("context_only"),
    )
    generic = F.array().cast("array<string>")
    for kind, labels in GENERIC.items():
        generic = F.when(F.col("entity_type") == kind, F.array_intersect("labels", F.array(*map(F.lit, labels)))).otherwise(generic)
    found = described.join(keys, "node").withColumn("generic", generic)
    return found.withColumn("tokens", T.tokens(F.col("key")))


def scored(pairs: DataFrame, nodes: DataFrame, left: str = "left_id", right: str = "right_id") -> DataFrame:
    """``pairs`` with score, clean_reasons, weak_reasons, risk_reasons, token_similarity and
    sequence_similarity (0 where it is under 0.78); ``nodes`` as of :func:`featured`."""
    names = ["entity_type", "key", "latin", "labels", "generic", "tokens", "product_key", "documents", "risk_flags", "context_only"]
    found = A.judged(pairs.select(left, right), nodes, left, right)
    for side, key in (("l", left), ("r", right)):
        found = found.join(nodes.select(F.col("node").alias(key), *[F.col(n).alias(f"{side}_{n}") for n in names]), key)
    le, ri = (lambda n: F.col(f"l_{n}")), (lambda n: F.col(f"r_{n}"))
    found = found.withColumn("token_similarity", S.token_jaccard(le("tokens"), ri("tokens")))
    found = found.withColumn("sequence_similarity", S.ratio(le("key"), ri("key"), MODERATE_RATIO))

    matched = F.array_intersect(le("labels"), ri("labels"))
    own = F.size(F.array_except(matched, F.array_union(le("generic"), ri("generic")))) > 0
    primary = (le("key") != "") & (le("key") == ri("key"))
    in_other = lambda one, other: (one("latin") != "") & F.array_contains(other("labels"), one("latin"))
    latin = ((le("latin") != "") & (le("latin") == ri("latin"))) | in_other(le, ri) | in_other(ri, le)
    long_latin = ~A.is_short(le("latin")) & ~A.is_short(ri("latin"))
    verdict, ratio = F.col("abbreviation_match"), F.col("sequence_similarity")
    generic_pair = (F.size(le("generic")) > 0) | (F.size(ri("generic")) > 0)
    very_high = (ratio >= VERY_HIGH_RATIO) & ~generic_pair
    product = le("entity_type").isin(*PRODUCTS) & F.coalesce((le("product_key") != "") & (le("product_key") == ri("product_key")), F.lit(False))
    holds = {
        "primary_label_exact_match": primary,
        "canonical_alias_exact_match": ~primary & own,
        "generic_alias_exact_match": ~primary & (F.size(matched) > 0) & ~own,
        "shared_latin_candidate_non_short": latin & long_latin,
        "shared_latin_candidate_short": latin & ~long_latin,
        "ambiguous_abbreviation_match": verdict == "ambiguous",
        "known_safe_abbreviation_match": verdict == "clean",
        "generated_acronym_match": verdict == "weak",
        "explicit_parenthetical_alias_match": F.col("parenthetical_match"),
        "product_variant_match": product,
        "high_token_similarity": F.col("token_similarity") >= HIGH_TOKENS,
        "high_sequence_similarity_without_scope_conflict": very_high,
        "high_sequence_similarity": ~very_high & (ratio >= HIGH_RATIO),
        "moderate_sequence_similarity": (ratio >= MODERATE_RATIO) & (ratio < HIGH_RATIO),
    }
    flagged = lambda name: F.array_contains(le("risk_flags"), name) | F.array_contains(ri("risk_flags"), name)
    apart = F.array_union(F.array_except(le("risk_flags"), ri("risk_flags")), F.array_except(ri("risk_flags"), le("risk_flags")))
    risks = {
        "both_context_only": F.coalesce(le("context_only") & ri("context_only"), F.lit(False)),
        "quote_issue": flagged("quote_not_found"),
        "low_confidence": flagged("low_confidence"),
        "disease_modifier_mismatch": F.coalesce(le("entity_type") == "disease", F.lit(False)) & F.arrays_overlap(apart, F.array(*map(F.lit, MODIFIERS))),
    }
    together = F.size(F.array_intersect(F.coalesce(le("documents"), F.array().cast("array<string>")), F.coalesce(ri("documents"), F.array().cast("array<string>"))))
    total = F.when(together > 0, F.least(F.lit(0.15), 0.05 + together * 0.02)).otherwise(0.0)
    for name, value in SCORES.items():
        total = total + F.when(holds[name], value).otherwise(0.0)
    for name, value in PENALTIES.items():
        total = total - F.when(risks[name], value).otherwise(0.0)
    weak = {name: rule for name, rule in holds.items() if name not in CLEAN} | {"same_document_cooccurrence": together > 0}
    noted = risks | {"generic_alias_conflict": holds["generic_alias_exact_match"], "ambiguous_abbreviation": holds["ambiguous_abbreviation_match"]}
    out: dict[str, Column] = {
        "score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 6), "clean_reasons": T.flags(**{n: holds[n] for n in CLEAN}),
        "weak_reasons": T.flags(**weak), "risk_reasons": T.flags(**noted),
    }
    return found.select(left, right, *[c.alias(n) for n, c in out.items()], "token_similarity", "sequence_similarity", "abbreviations", "sources")
