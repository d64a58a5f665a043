"""Similarities and quote checks; cheap bounds first, character matching last."""

from __future__ import annotations

from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types

from lorekiln.functions import text as T

#: Fixed thresholds of the fuzzy quote check.
FUZZY_LEAST, FUZZY_RATIO, FUZZY_LONGEST = 32, 0.94, 500


def token_jaccard(left: Column, right: Column) -> Column:
    """Of arrays of distinct tokens; 0 where both are empty."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(left, right)) / union)


def ratio_bound(left: Column, right: Column) -> Column:
    """No matching ratio is above this."""
    total = F.length(left) + F.length(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * F.least(F.length(left), F.length(right)) / total)


#: Characters of two texts up to which their longest common subsequence is a cheaper bound than the ratio itself.
LCS_LONGEST = 3000


def places(text: str) -> dict[str, int]:
    """The places of each character, as bits."""
    masks: dict[str, int] = {}
    for k, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << k
    return masks


def common_in_order(masks: dict[str, int], size: int, other: str, least: float = 0) -> int:
    """Length of the longest common subsequence of ``other`` and a text of ``size`` characters with these
    :func:`places`; below ``least`` some number that is no smaller, but also below it. No matching ratio
    has more characters matched."""
    whole = (1 << size) - 1
    rest = whole
    for at in range(0, len(other), 32):
        for c in other[at : at + 32]:
            met = rest & masks.get(c, 0)
            rest = ((rest + met) | (rest - met)) & whole
        if (most := size - rest.bit_count() + max(0, len(other) - at - 32)) < least:
            return most
    return size - rest.bit_count()


@F.arrow_udf(types.DoubleType())
def _ratio(left: pa.Array, right: pa.Array) -> pa.Array:
    pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
    return pa.array([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in pairs], pa.float64())


def ratio(left: Column, right: Column, least: float) -> Column:
    """The matching ratio where it can reach ``least``; elsewhere 0."""
    able = ratio_bound(left, right) >= least
    return F.when(able, _ratio(F.when(able, left), F.when(able, right))).otherwise(0.0)


def fuzzy_match(quote: str, body: str, first: int = 0, step: int = 1) -> bool:
    """Whether a window of the quote's length is close enough to it. Windows begin at every place, or at
    every ``step``-th one of a text that ``body`` continues from its place ``first``. Quotes longer than
    ``FUZZY_LONGEST`` or than the text match nothing."""
    size = len(quote)
    if not quote or size > min(FUZZY_LONGEST, len(body)):
        return False
    least = next(m for m in range(size + 1) if 2.0 * m / (2 * size) >= FUZZY_RATIO)  # characters matched
    masks = places(quote)
    lacking = {c: mask.bit_count() for c, mask in masks.items()}  # of the quote's characters, less the window's
    shared = 0  # characters in common, whatever their order
    for end, c in enumerate(body):
        if end >= size:
            gone = body[end - size]
            lacking[gone] += 1
            shared -= lacking[gone] > 0
        left = lacking.get(c, 0)
        shared += left > 0
        lacking[c] = left - 1
        at = end - size + 1
        if shared >= least and at >= 0 and (first + at) % step == 0:
            window = body[at : end + 1]
            if common_in_order(masks, size, window, least) >= least and SequenceMatcher(None, quote, window).ratio() >= FUZZY_RATIO:
                return True
    return False


@F.arrow_udf(types.BooleanType())
def fuzzy_found(quotes: pa.Array, parts: pa.Array, first: pa.Array, step: pa.Array) -> pa.Array:
    """:func:`fuzzy_match`; null where there is no quote or no part of a text."""
    rows = zip(quotes.to_pylist(), parts.to_pylist(), first.to_pylist(), step.to_pylist(), strict=True)
    return pa.array([None if row[0] is None or row[1] is None else fuzzy_match(*row) for row in rows], pa.bool_())


def has_ellipsis(quote: Column) -> Column:
    return F.contains(quote, F.lit("...")) | F.contains(quote, F.lit("…"))


def quote_status(quote: Column, body: Column, fuzzy: bool = False) -> Column:
    """exact, normalized_exact, fuzzy or not_found. Punctuation counts; a quote with an ellipsis
    is stitched together and never found."""
    raw = F.regexp_replace(T.text_or_empty(quote), f"^{T.SPACES}|{T.SPACES}$", "")
    key, place = T.quote_key(quote), T.quote_key(body)
    none = (raw == "") | has_ellipsis(raw)
    known = F.when(none, "not_found").when(F.contains(T.text_or_empty(body), raw), "exact").when((key != "") & F.contains(place, key), "normalized_exact")
    if not fuzzy:
        return known.otherwise("not_found")
    rest = known.isNull() & (F.length(key) >= FUZZY_LEAST)
    return F.coalesce(known, F.when(fuzzy_found(F.when(rest, key), F.when(rest, place), F.lit(0), F.lit(1)), "fuzzy"), F.lit("not_found"))


def label_match(primary: tuple[Column, Column], aliases: tuple[Column, Column], generic: Column) -> Column:
    """What two labelled nodes share: the primary label, an alias, only generic aliases, or none."""
    shared = F.array_intersect(*aliases)
    own = F.size(F.array_except(shared, generic)) > 0
    return F.when(primary[0] == primary[1], "primary").when(own, "alias").when(F.size(shared) > 0, "generic_only").otherwise("none")


def rolled_up(statuses: Column) -> Column:
    """One status for the quotes of a row."""
    every = lambda *names: F.forall(statuses, lambda s: s.isin(*names))
    none = F.coalesce(F.size(statuses), F.lit(0)) <= 0
    whole = F.when(none | every("not_found"), "not_found").when(every("exact"), "exact").when(every("exact", "normalized_exact"), "normalized_exact")
    return whole.when(F.exists(statuses, lambda s: s == "not_found"), "partly_found").otherwise("fuzzy")


def title_close(left: Column, right: Column, least: float = 0.74) -> Column:
    """One title contains the other, or their matching ratio is high enough."""
    a, b = T.match_key(left), T.match_key(right)
    inside = ((a != "") & F.contains(b, a)) | ((b != "") & F.contains(a, b))
    open_a, open_b = F.when(~inside, a), F.when(~inside, b)
    return inside | (F.coalesce(ratio(open_a, open_b, least), F.lit(0.0)) >= least)
