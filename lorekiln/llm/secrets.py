"""Secret scan in native column expressions.

Named patterns come first; candidates without a name are found by Shannon entropy over a
sliding window, one threshold per character class, kept up to date by incremental counts.
An allow-list suppresses entropy findings that are no secrets; it never touches named ones.
Work is linear in a text's length and in its number of matches, but for small blocks.

Defined results
    null and empty texts have no spans; spans count code points, ends are exclusive.
    a text of any length is scanned whole; equal rows get equal results.
    a column that has the name of an output column is replaced by it in ``find_secrets``,
    where both names can be chosen; ``redact`` keeps all columns, whatever their names.
    an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the named kinds. Short runs of hex digits can be left out of the
#: pattern, as a run is matched whole; short values of an assignment can't, as what
#: they use up is not searched again.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

#: Characters of a window.
WINDOW = 20
#: Runs that are scanned for entropy: hex digits of either case, and the whole alphabet.
HEX_RUN = r"[0-9a-fA-F]{20,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


@dataclass(frozen=True)
class EntropyClass:
    """A run that matches all of ``needs`` is scanned with this threshold, in bits."""

    kind: str
    needs: tuple[str, ...]
    bits: float


#: Hex runs, alone or inside other text.
HEX_CLASS = EntropyClass("entropy_hex", ("[0-9]", "[a-fA-F]"), 3.05)
#: Other candidates go to the first class whose needs they meet; the last one takes the rest,
#: which are letters alone or digits alone: only windows of nearly all distinct letters count.
CLASSES = (
    EntropyClass("entropy_mixed", ("[a-z]", "[A-Z]", "[0-9]"), 3.75),
    EntropyClass("entropy_single_case", ("[A-Za-z]", "[0-9]"), 3.65),
    EntropyClass("entropy_letters", (), 4.0),
)
#: Candidates of hex digits alone belong to :data:`HEX_CLASS`.
NOT_HEX = "[^0-9a-fA-F]"

#: Candidates that are no secrets: UUIDs, words with a number, paths and chains of words.
#: Repeats are possessive, so that no text is too long for the matcher's stack.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]++[-_]?[0-9]{1,4}$",
    r"^/?(?:[A-Za-z]++|[0-9]++)(?:[/_-]++(?:[A-Za-z]++|[0-9]++))++/?$",
)
#: Placeholders; a span of which they make up an eighth or more is no secret.
PLACEHOLDER = r"(?i)example|placeholder|changeme|abcdefgh|12345678|x{6,}|0{6,}"
PLACEHOLDER_SHARE = 8

KINDS = ("assign", "access", "hex", HEX_CLASS.kind, *(c.kind for c in CLASSES))
#: Entropies are compared as whole numbers in these units, so that sums don't drift.
UNIT = 1 << 20
#: Matches whose positions are added up one by one; windows of one fold; characters of a chunk.
BLOCK, FOLDED, CHUNK = 128, 4096, 1024
#: Counts of the alphabet's characters, five bits each, in whole numbers of 60 bits.
COUNT_BITS, PER_WORD = 5, 12
WORDS = -(-len(ALPHABET) // PER_WORD)

SPANS = "array<struct<start:int,rank:int,end:int>>"
MATCHES = "array<struct<start:int,word:string>>"


def _numbers(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _up_to(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (array<int>), the fold of those before it, from 0. Blocks are
    folded first, so that a value meets few others."""

    def total(some: Column) -> Column:
        return F.aggregate(some, F.lit(0), fold)

    def with_blocks(values: Column) -> Column:
        begins = F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK))
        blocks = F.transform(begins, lambda at: total(F.slice(values, at + 1, F.lit(BLOCK))))
        before = _let(blocks, lambda blocks: F.transform(blocks, lambda _, k: total(F.slice(blocks, F.lit(1), k))))

        def one(before: Column) -> Column:
            def at(_: Column, k: Column) -> Column:
                within = F.pmod(k, F.lit(BLOCK))
                return fold(F.get(before, F.call_function("div", k, F.lit(BLOCK)).cast("int")), total(F.slice(values, k - within + 1, within)))

            return F.transform(values, at)

        return _let(before, one)

    return _let(values, lambda v: F.when(F.size(v) > 0, with_blocks(v)).otherwise(F.array().cast("array<int>")))


def _positions(text: Column, pattern: str) -> Column:
    """array<struct<start, word>> of the leftmost, non-overlapping matches.

    A match starts after all gaps and matches before it; both come from the same pattern.
    """
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(
        words,
        F.split(text, pattern, -1),
        lambda word, gap: F.struct(word.alias("word"), F.length(gap).alias("gap"), (F.length(gap) + F.length(word)).alias("step")),
    )

    def placed(pairs: Column) -> Column:
        before = _up_to(F.transform(pairs, lambda p: p["step"]), lambda a, b: a + b)
        return F.zip_with(pairs, before, lambda p, at: F.struct((at + p["gap"]).alias("start"), p["word"].alias("word")))

    found = _let(F.filter(both, lambda p: p["word"].isNotNull()), placed)
    return F.when(F.regexp_like(text, F.lit(pattern)), found.cast(MATCHES)).otherwise(F.lit(None).cast(MATCHES))


def _spans(found: Column, kind: str, keep) -> Column:
    rank = KINDS.index(kind)
    spans = F.transform(
        F.filter(found, keep),
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + F.length(m["word"])).alias("end")
        ),
    )
    return F.coalesce(spans, F.array().cast(SPANS))


def _moves(codes: Column) -> Column:
    """What comes in and goes out at each step: the whole number that counts the character
    and its unit there; nothing goes out of the first window."""
    units = _numbers([1 << COUNT_BITS * k for k in range(PER_WORD)])

    def place(code: Column, name: str) -> list[Column]:
        word = F.call_function("div", code, F.lit(PER_WORD)).cast("int")
        return [word.alias(f"{name}_word"), F.get(units, F.pmod(code, F.lit(PER_WORD))).alias(f"{name}_unit")]

    def move(code: Column, at: Column) -> Column:
        gone = F.get(codes, at - WINDOW)
        return F.struct(*place(code, "in"), *place(gone, "out"), code.eqNullSafe(gone).alias("same"))

    return F.transform(codes, move)


def _hot_runs(moves: Column, most: Column) -> Column:
    """array<struct<begin, end>>: maximal runs of windows whose sum is ``most`` or less.

    The state holds a count per character of the alphabet and the sum of n * log2(n) over
    these counts; a step lets one character in and one out. The window's entropy is
    log2(w) - sum / w, so it is high where the sum is low.
    """
    w = WINDOW
    weight = [round(n * math.log2(n) * UNIT) if n else 0 for n in range(w + 2)]
    gain = _numbers([weight[n + 1] - weight[n] for n in range(w + 1)])
    init = F.expr(
        f"named_struct('at', 0, 'counts', array_repeat(0L, {WORDS}), 'sum', 0L, 'begin', -1, 'end', -1,"
        " 'found', cast(array() as array<struct<begin:int,end:int>>))"
    )

    def closed(state: Column) -> Column:
        run = F.array(F.struct(state["begin"].alias("begin"), state["end"].alias("end")))
        return F.when(state["end"] >= 0, F.concat(state["found"], run)).otherwise(state["found"])

    def step(state: Column, move: Column) -> Column:
        def count(name: str) -> Column:
            return F.call_function("div", F.get(state["counts"], move[f"{name}_word"]), move[f"{name}_unit"]).bitwiseAND(31).cast("int")

        def counted(held: Column, k: Column) -> Column:
            return held + F.when(move["in_word"] == k, move["in_unit"]).otherwise(0) - F.when(move["out_word"] == k, move["out_unit"]).otherwise(0)

        lost = F.coalesce(F.get(gain, count("out") - 1), F.lit(0))
        total = state["sum"] + F.when(move["same"], F.lit(0)).otherwise(F.get(gain, count("in")) - lost)

        def moved(total: Column) -> Column:
            begin, end = state["at"] + 1 - w, state["at"] + 1
            hot, fresh = (begin >= 0) & (total <= most), state["end"] < begin
            return F.struct(
                (state["at"] + 1).alias("at"),
                F.transform(state["counts"], counted).alias("counts"),
                total.alias("sum"),
                F.when(hot & fresh, begin).otherwise(state["begin"]).alias("begin"),
                F.when(hot, end).otherwise(state["end"]).alias("end"),
                F.when(hot & fresh, closed(state)).otherwise(state["found"]).alias("found"),
            )

        return _let(total, moved)

    return F.aggregate(moves, init, step, closed)


def _entropy_spans(word: Column, start: Column, rank: Column, most: Column) -> Column:
    """Runs of hot windows of one candidate, as spans; long candidates are folded in parts
    that share a window less one character."""

    def part(codes: Column, at: Column) -> Column:
        runs = _hot_runs(_let(F.slice(codes, at + 1, F.lit(FOLDED + WINDOW - 1)), _moves), most)
        return F.transform(runs, lambda r: F.struct((start + at + r["begin"]).alias("start"), (start + at + r["end"]).alias("end")))

    def joined(runs: Column) -> Column:
        """Runs that touch where parts meet are one."""
        first = F.filter(runs, lambda r, k: (k == 0) | (F.get(runs, k - 1)["end"] < r["start"]))
        last = F.filter(runs, lambda r, k: (k == F.size(runs) - 1) | (F.get(runs, k + 1)["start"] > r["end"]))
        return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), rank.alias("rank"), b["end"].alias("end")))

    codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    begins = F.sequence(F.lit(0), F.length(word) - WINDOW, F.lit(FOLDED))
    runs = _let(codes, lambda codes: F.flatten(F.transform(begins, lambda at: part(codes, at))))
    return _let(runs, joined)


def _most(bits: float) -> int:
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * UNIT)


def _fits(word: Column, needs: tuple[str, ...]) -> Column:
    fits = F.lit(True)
    for pattern in needs:
        fits = fits & word.rlike(pattern)
    return fits


def _unnamed(found: Column, fits: Callable[[Column], Column], classes: tuple[EntropyClass, ...]) -> Column:
    """Spans of all candidates, by the first of ``classes`` that each one meets."""
    empty = F.array().cast(SPANS)
    ranks, limits = _numbers([KINDS.index(c.kind) for c in classes]).cast("array<int>"), _numbers([_most(c.bits) for c in classes])

    def scan(m: Column) -> Column:
        word = m["word"]
        which = F.lit(len(classes) - 1)
        for k in range(len(classes) - 2, -1, -1):
            which = F.when(_fits(word, classes[k].needs), F.lit(k)).otherwise(which)

        def real(span: Column) -> Column:
            own = F.substring(word, span["start"] - m["start"] + 1, span["end"] - span["start"])
            return (F.length(own) - F.length(F.regexp_replace(own, PLACEHOLDER, ""))) * PLACEHOLDER_SHARE < F.length(own)

        spans = _let(which, lambda k: _entropy_spans(word, m["start"], F.get(ranks, k), F.get(limits, k)))
        return F.when(fits(word), F.filter(spans, real)).otherwise(empty)

    return F.coalesce(F.flatten(F.transform(found, scan)), empty)


def _not_allowed(word: Column) -> Column:
    listed = F.lit(False)
    for pattern in ALLOWED:
        listed = listed | word.rlike(pattern)
    return word.rlike(NOT_HEX) & ~listed


def find_secrets(docs: DataFrame, text_col: str = "text", named: str = "named", secrets: str = "secrets") -> DataFrame:
    """``docs`` with two columns, array<struct<start, rank, end>> in order.

    ``rank`` indexes :data:`KINDS`; ``named`` holds the spans of the named patterns,
    ``secrets`` those and the entropy findings.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(
        _spans(_positions(text, ASSIGN), "assign", lambda m: F.length(F.regexp_extract(m["word"], ASSIGN, 2)) >= ASSIGN_LEAST),
        _spans(_positions(text, ACCESS), "access", lambda m: F.lit(True)),
        _spans(_positions(text, HEX), "hex", lambda m: F.lit(True)),
    )
    by_entropy = F.concat(
        _unnamed(_positions(text, HEX_RUN), lambda word: _fits(word, HEX_CLASS.needs), (HEX_CLASS,)),
        _unnamed(_positions(text, CANDIDATE), _not_allowed, CLASSES),
    )
    more = _fresh(docs, "more")
    found = docs.withColumns({named: F.array_sort(base), more: by_entropy})
    return found.withColumn(secrets, F.array_sort(F.concat(named, more))).drop(more)


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def _cut(chunks: Column, begin: Column, end: Column) -> Column:
    """Characters of a text from its chunks; only the chunks at both ends are searched."""
    first, last = (F.call_function("div", at, F.lit(CHUNK)).cast("int") for at in (begin, end))
    inside = F.substring(F.get(chunks, first), F.pmod(begin, F.lit(CHUNK)) + 1, end - begin)
    across = F.concat(
        F.substring(F.get(chunks, first), F.pmod(begin, F.lit(CHUNK)) + 1, F.lit(CHUNK)),
        F.array_join(F.slice(chunks, first + 2, last - first - 1), ""),
        F.coalesce(F.substring(F.get(chunks, last), F.lit(1), F.pmod(end, F.lit(CHUNK))), F.lit("")),
    )
    return F.when(begin >= end, F.lit("")).when(first == last, inside).otherwise(across)


def _masked(text: Column, spans: Column, mask: str) -> Column:
    def pieces(chunks: Column, spans: Column, reached: Column) -> Column:
        before = F.zip_with(
            spans, reached,
            lambda s, at: F.when(s["start"] >= at, F.concat(_cut(chunks, at, s["start"]), F.lit(mask))).otherwise(F.lit("")),
        )
        tail = _cut(chunks, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(before, ""), tail)

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    reached = _up_to(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return _let(chunks, lambda chunks: _let(reached, lambda reached: pieces(chunks, spans, reached)))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of ``secrets`` replaced by ``mask``; overlapping spans get
    one mask. ``length_col`` then counts the code points of a changed text. Other columns
    stay as they were; null texts stay null."""
    named, secrets, masked = (_fresh(docs, name) for name in ("named", "secrets", "masked"))
    found = find_secrets(docs, text_col, named, secrets)
    changed = F.size(secrets) > 0
    out = found.withColumn(masked, F.when(changed, _masked(F.col(text_col), F.col(secrets), mask)))
    if length_col:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(changed, F.length(masked).cast(kind)).otherwise(F.col(length_col)))
    return out.withColumn(text_col, F.coalesce(masked, text_col)).select(docs.columns)
