"""Documents rearranged for fill-in-the-middle training.

A text's units are words with the white space before them, and white space at its end. A
seeded hash of the id chooses whether a document is rearranged, in which order, and after
which units it is cut. The matcher passes over a text twice: once to count its units, once to
advance a lazy iterator over the matches to both cuts. No list of units is ever held, so memory
is that of the text alone. Output and restored text are column expressions over the two cuts.

Defined results
    null texts count as empty, null ids as the empty text; an empty text stays plain.
    a text that holds a marker stays plain, so markers in the output are never ambiguous.
    repeated rows get equal results; rows with equal ids are cut by the same hash.
    an empty table gives an empty result. All columns stay, but one that has the name of the
    output column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from lorekiln.functions.batches import small_batches

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Plan:
    """Share of documents that are rearranged and of those that begin with the suffix, in per
    cent; the seed; markers before prefix, suffix and middle."""

    rearranged: int = 50
    suffix_first: int = 80
    seed: int = 42
    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """(units, end of the prefix, end of the middle); the cuts come after ``first`` and ``second``
    units, modulo their number plus one, in either order."""
    units = sum(1 for _ in UNIT.finditer(text))
    low, high = sorted((first % (units + 1), second % (units + 1)))
    matches = UNIT.finditer(text)
    begin = _end_of(matches, low, 0)
    return units, begin, _end_of(matches, high - low, begin)


def _end_of(matches: Iterable[re.Match], ahead: int, now: int) -> int:
    """End of the match that comes ``ahead`` matches later; ``now`` where that is none."""
    return next(islice(matches, ahead - 1, None)).end() if ahead else now


_CUT = types.StructType().add("n", types.LongType()).add("low", types.IntegerType()).add("high", types.IntegerType())


@F.arrow_udf(_CUT)
def _cut(texts: pa.Array, first: pa.Array, second: pa.Array, plain: pa.Array) -> pa.Array:
    found = []
    for text, a, b, whole in zip(texts, first, second, plain, strict=True):
        text = text.as_py()
        found.append((sum(1 for _ in UNIT.finditer(text)), None, None) if whole.as_py() else cuts(text, a.as_py(), b.as_py()))
    n, low, high = zip(*found, strict=True) if found else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["n", "low", "high"])


def _hashes(row_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan(), out: str = "fim") -> DataFrame:
    """``docs`` with a struct: n (units), form (``plain``, ``psm`` or ``spm``), prefix_chars and
    middle_chars (code points, null if plain), output."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    first, second, chance, order = _hashes(F.col(id_col), plan.seed)
    plain = (text == "") | (chance % 100 >= plan.rearranged)
    for marker in plan.markers:
        plain = plain | F.contains(text, F.lit(marker))
    cut = docs.withColumn(out, _cut(text, first, second, plain))
    n, low, high = (F.col(f"{out}.{name}") for name in ("n", "low", "high"))
    prefix, middle, suffix = F.left(text, low), F.substring(text, low + 1, high - low), F.substring(text, high + 1, F.length(text) - high)
    p, s, m = map(F.lit, plan.markers)
    form = F.when(low.isNull(), "plain").when(order % 100 < plan.suffix_first, "spm").otherwise("psm")
    output = F.when(low.isNull(), text).when(order % 100 < plan.suffix_first, F.concat(s, suffix, p, prefix, m, middle))
    output = output.otherwise(F.concat(p, prefix, s, suffix, m, middle))
    return cut.withColumn(
        out,
        F.struct(
            n.alias("n"), form.alias("form"), low.cast("bigint").alias("prefix_chars"), (high - low).cast("bigint").alias("middle_chars"),
            output.alias("output"),
        ),
    )


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text that :func:`rearrange` got, from its output and form alone."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in plan.markers), -1)
    one, two, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
