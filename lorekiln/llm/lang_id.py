"""Language identification by compression.

Each language has a raw-content Zstandard dictionary cut from labelled texts. The letters of
a whole text, in lower case, are compressed with each, in pieces, so that the dictionary and
not the text's own beginning is what later pieces refer to. The smallest sum names the
language, and a narrow margin to the second smallest rejects the text.

Defined results
    null texts and texts without a letter are ``und``, with score 0, and rejected.
    equal sizes: the language with more labelled texts, then the first in alphabetical order.
    without labelled texts every text is ``und``; an empty table gives an empty result.
    other columns are left alone; one with the name of the result, ``out``, is replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import small_batches

UNDETERMINED = "und"
#: Pieces of labelled texts that a language's dictionary is made of, and their characters at most:
#: this bounds what the driver gathers and every task receives. Pieces come from anywhere in any text.
SAMPLE_PIECES, PIECE_CHARACTERS = 120, 2000
LEVEL = 9
#: Bytes compressed at a time.
PIECE = 1000
#: Relative gain over the second smallest size below which a text is rejected.
MARGIN = 0.003

RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
_OTHER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """A dictionary per language; languages with more labelled texts come first."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", pieces: int = SAMPLE_PIECES) -> Model:
    """Dictionaries from ``pieces`` distinct pieces of each language's texts, those with the least
    hashes; a language that has fewer gives all of them. Texts are cut at white space into pieces of
    :data:`PIECE_CHARACTERS` at most and copies are folded before anything is gathered, so neither long
    texts nor copies take the place of others."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    most = PIECE_CHARACTERS
    cut = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{most}}}(?!\S)|.{{1,{most}}}"), F.lit(0))
    parts = rows.select("lang", F.explode(cut).alias("piece")).filter(F.col("piece").rlike(r"\p{L}"))
    parts = parts.withColumn("place", F.pmod(F.xxhash64("piece", F.lit("sample")), F.lit(1 << 40)))
    distinct = {r["lang"]: r["n"] for r in parts.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()}
    share = {lang: 1.0 if n <= 4 * pieces else 2 * pieces / n for lang, n in distinct.items()}
    texts: dict[str, list[str]] = {lang: [] for lang in counts}
    while share:
        reach = F.create_map(*[F.lit(x) for lang, part in share.items() for x in (lang, int(part * (1 << 40)))])
        near = parts.filter(F.col("place") < F.try_element_at(reach, "lang"))
        picked = near.groupBy("lang", "place").agg(F.min("piece").alias("piece")).collect()
        found: dict[str, list] = {lang: [] for lang in share}
        for row in picked:
            found[row["lang"]].append((row["place"], row["piece"]))
        texts |= {lang: [piece for _, piece in sorted(some)[:pieces]] for lang, some in found.items()}
        # The count of distinct pieces is an estimate: where it was far too large, look again.
        share = {lang: min(1.0, 4 * part) for lang, part in share.items() if len(found[lang]) < pieces and part < 1.0}
    languages = tuple(sorted(texts, key=lambda lang: (-counts[lang], lang)))
    return Model(languages, tuple(letters(" ".join(texts[lang])).encode() for lang in languages))


def letters(text: str) -> str:
    """Words in lower case, a space between them."""
    return _OTHER.sub(" ", text.lower()).strip()


@cache
def _compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    found = []
    for data in dictionaries:
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        found.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False))
    return found


def classify(text: str | None, model: Model) -> tuple[str, float, bool]:
    """(language, margin, rejected)."""
    words = letters(text or "")
    if not model.languages or not any(map(str.isalpha, words)):
        return UNDETERMINED, 0.0, True
    data = words.encode()
    pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
    sizes = sorted((sum(len(c.compress(p)) for p in pieces), k) for k, c in enumerate(_compressors(model.dictionaries)))
    if len(sizes) == 1:
        return model.languages[0], 1.0, False
    margin = 1 - sizes[0][0] / sizes[1][0]
    return model.languages[sizes[0][1]], margin, margin < MARGIN


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with ``out``: struct<lang, score, rejected>."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        rows = [classify(text.as_py(), shared.value) for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array(column, kind.type) for column, kind in zip(list(zip(*rows, strict=True)) or [()] * 3, RESULT, strict=True)],
            fields=list(RESULT),
        )

    return docs.withColumn(out, predict(F.col(text_col)))
