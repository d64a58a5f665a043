"""Where quotes stand in documents: exact, normalized_exact or fuzzy.

A fuzzy match is a window of the quote's length, n, of which at least 94 % can be matched in order.
So at most e = 6 % of n characters are left over on either side. A left-over character of the quote
spoils at most q of its runs of q characters, one of the window at most q - 1 more: all but
e * (2q - 1) runs stand in the window unchanged, each shifted by e characters at most. This bound
needs no word and no run at a fixed place to be the same.

The rarest runs of a quote, by a count at every q-th place of the texts, are its keys, so many that
some of them always stay; runs that stand everywhere are left out, and what remains of them is counted
per quote, document and band of shifts. Only bands with enough keys are looked at, in the part of the
text that they point to.

Quotes that are only looked for as they are need less: a text is cut into chunks of q characters, of which
(n - q + 1) / q, rounded down, lie in any window of n. All of these are runs of the quote, at one shift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.sources.shared import Workspace

#: Characters of a run: with 6, every fuzzy quote has some that stay; long quotes also with 8, which are rarer.
RUN, LONG_RUN = 6, 8
#: Characters of a chunk: the largest with a whole chunk in every place of the quote.
CHUNKS = (32, 16, 8, 6, 5, 4, 3, 2, 1)
#: Characters of a piece of text whose runs are made at a time: a multiple of all sizes.
PIECE = 4320
#: Keys besides those that a fuzzy match may lose: so many have to stay.
SPARE = 6
#: So many runs of quotes are broadcast (some 30 MB); more are shuffled.
BROADCAST_RUNS = 1_000_000


def _chunks(body: DataFrame, sizes: list[int]) -> DataFrame:
    """(__doc_id, at, run): hashes of all chunks of ``sizes`` characters, with sizes and places."""
    pieces = F.regexp_extract_all("__body", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    cut = body.select("__doc_id", F.posexplode(pieces).alias("__piece", "__text"))
    rows = [F.struct(F.lit(size).alias("size"), F.regexp_extract_all("__text", F.lit(f"(?s).{{{size}}}"), F.lit(0)).alias("runs")) for size in sizes]
    found = cut.select("__doc_id", "__piece", F.inline(F.array(*rows))).select("__doc_id", "__piece", "size", F.posexplode("runs").alias("__k", "__run"))
    return found.select("__doc_id", (F.col("__piece") * PIECE + F.col("__k") * F.col("size")).alias("at"), F.xxhash64("size", "__run").alias("run"))


def _runs(keys: DataFrame, key_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """(key, at, size, run): hashes of all runs of ``sizes`` characters, with places and sizes."""
    longest = max(sizes)
    pieces = F.regexp_extract_all(text_col, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    cut = keys.select(key_col, pieces.alias("__pieces"))
    ends = F.transform("__pieces", lambda p, k: F.concat(p, F.left(F.coalesce(F.get("__pieces", k + 1), F.lit("")), F.lit(longest - 1))))
    cut = cut.select(key_col, F.posexplode(ends).alias("__piece", "__text"))
    # Runs one after another, once from each of the first ``size`` places on.
    rows = [
        F.struct(F.lit(size).alias("size"), F.lit(shift).alias("shift"),
                 F.regexp_extract_all(F.substring("__text", shift + 1, PIECE + longest), F.lit(f"(?s).{{{size}}}"), F.lit(0)).alias("runs"))
        for size in sizes for shift in range(size)
    ]
    found = cut.select(key_col, "__piece", F.inline(F.array(*rows)))
    found = found.select(key_col, "__piece", "size", "shift", F.posexplode("runs").alias("__k", "run"))
    found = found.withColumn("__at", F.col("__k") * F.col("size") + F.col("shift")).filter(F.col("__at") < PIECE)
    return found.select(key_col, (F.col("__piece") * PIECE + F.col("__at")).alias("at"), "size", F.xxhash64("size", "run").alias("run"))


def small(df: DataFrame) -> DataFrame:
    """Broadcast behind a look at its size."""
    return F.broadcast(df) if df.count() <= BROADCAST_RUNS else df


def find_quotes(quotes: DataFrame, quote_id: str, quote: str, docs: DataFrame, doc_id: str, text: str, fuzzy: bool = True, twelfths: bool = True) -> DataFrame:
    """(quote id, document id, quote_status) of all quotes that stand in a document. Empty ones and
    those with an ellipsis stand nowhere; ids are unique on both sides. With ``twelfths`` a fuzzy match
    begins at a multiple of a twelfth of the quote's length, as in the reference; else at any place."""
    work = Workspace(quotes.sparkSession, "quotes")
    raw = F.trim(F.regexp_replace(T.text_or_empty(F.col(quote)), f"^{T.SPACES}|{T.SPACES}$", ""))
    asked = quotes.select(F.col(quote_id).alias("__quote_id"), raw.alias("raw"), T.quote_key(F.col(quote)).alias("key"))
    asked = asked.filter((F.col("raw") != "") & ~S.has_ellipsis(F.col("raw"))).withColumn("n", F.length("key")).filter("n > 0")
    loose = F.when(F.col("n").between(S.FUZZY_LEAST, S.FUZZY_LONGEST) & F.lit(fuzzy), F.floor(F.col("n") * (1 - S.FUZZY_RATIO) + 1e-6)).otherwise(0)
    asked = asked.withColumn("loose", loose.cast("int"))
    asked = work.keep(asked, "asked")
    body = docs.select(F.col(doc_id).alias("__doc_id"), T.quote_key(F.col(text)).alias("__body"))
    found = _plain_bands(work, asked.filter("loose = 0"), body)
    if fuzzy:
        found = found.unionByName(_fuzzy_bands(work, asked.filter("loose > 0"), body))
    return _status(found, asked, docs, doc_id, text, fuzzy, twelfths).select(F.col("__quote_id").alias(quote_id), F.col("__doc_id").alias(doc_id), "quote_status")


def _sizes(asked: DataFrame) -> list[int]:
    """Sizes in use, a few at most."""
    return sorted(r[0] for r in asked.select("size").distinct().collect()) or [RUN]


def _plain_bands(work: Workspace, asked: DataFrame, body: DataFrame) -> DataFrame:
    """(quote id, document id, band 0) where all whole chunks of a place of the quote stand."""
    size = F.coalesce(*[F.when(F.col("n") >= 2 * size - 1, size) for size in CHUNKS])
    asked = asked.withColumn("size", size).withColumn("needed", F.floor((F.col("n") - F.col("size") + 1) / F.col("size")))
    keys = asked.select("__quote_id", "key", "size", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size"))).alias("place"))
    keys = keys.select(F.xxhash64("size", F.substring("key", F.col("place") + 1, F.col("size"))).alias("run"), "__quote_id", "place")
    hits = _chunks(body, _sizes(asked)).join(small(work.keep(keys, "plain-keys")), "run")
    found = hits.groupBy("__quote_id", "__doc_id", (F.col("at") - F.col("place")).alias("shift")).agg(F.count("*").alias("kept"))
    found = found.join(small(asked.select("__quote_id", "needed")), "__quote_id").filter("kept >= needed")
    return work.keep(found.select("__quote_id", "__doc_id", F.lit(0).alias("band")).distinct(), "plain-bands")


def _fuzzy_bands(work: Workspace, asked: DataFrame, body: DataFrame) -> DataFrame:
    """(quote id, document id, band) of bands of shifts with enough of the quote's keys."""
    fits = F.col("n") - LONG_RUN + 1 - F.col("loose") * (2 * LONG_RUN - 1) >= SPARE
    asked = asked.withColumn("size", F.when(fits, LONG_RUN).otherwise(RUN)).withColumn("lost", F.col("loose") * (2 * F.col("size") - 1))
    asked = asked.withColumn("needed", F.least(F.col("n") - F.col("size") + 1 - F.col("lost"), F.lit(SPARE)))
    sizes = _sizes(asked)
    keys = work.keep(_keys(asked, _chunks(body, sizes), sizes), "keys")
    hits = _runs(body, "__doc_id", "__body", sizes).join(small(keys), "run")
    bands = F.floor((F.col("at") - F.col("place")) / (2 * F.col("loose") + 1)).cast("int")
    hits = hits.select("__quote_id", "__doc_id", F.explode(F.array(bands, bands - 1)).alias("band"))
    # Hits are no fewer than the different keys among them.
    found = hits.groupBy("__quote_id", "__doc_id", "band").agg(F.count("*").alias("kept")).join(small(asked.select("__quote_id", "needed")), "__quote_id")
    return work.keep(found.filter("kept >= needed").select("__quote_id", "__doc_id", "band"), "bands")


def _keys(asked: DataFrame, chunks: DataFrame, sizes: list[int]) -> DataFrame:
    """(run, quote id, place, loose): the rarest runs of each quote, as many as may be lost and some
    more. Any choice of them finds the same; it follows the chunks of the texts."""
    own = _runs(asked.select("__quote_id", "key"), "__quote_id", "key", sizes).withColumnRenamed("at", "place")
    own = own.join(asked.select("__quote_id", "loose", "size", "lost", "needed"), ["__quote_id", "size"])
    counted = chunks.join(small(own.select("run").distinct()), "run").groupBy("run").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("__quote_id").orderBy(F.coalesce("times", F.lit(0)), "place", "run"))
    ranked = own.join(counted, "run", "left").withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= F.col("lost") + F.col("needed")).select("run", "__quote_id", "place", "loose")


def _status(bands: DataFrame, asked: DataFrame, docs: DataFrame, doc_id: str, text: str, fuzzy: bool, twelfths: bool) -> DataFrame:
    body = docs.select(F.col(doc_id).alias("__doc_id"), T.text_or_empty(F.col(text)).alias("__text"))
    body = body.join(small(bands.select("__doc_id").distinct()), "__doc_id", "left_semi")
    rows = bands.join(asked, "__quote_id").join(body, "__doc_id").withColumn("__body", T.quote_key(F.col("__text")))
    plain = F.when(F.contains("__text", "raw"), 0).when(F.contains("__body", "key"), 1)
    width = 2 * F.col("loose") + 1
    first = F.greatest(F.lit(0), F.col("band") * width - F.col("loose"))
    count = (F.col("band") + 2) * width + F.col("loose") - first + 1
    near = F.substring("__body", first + 1, count + F.col("n") - 1)
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 12)) if twelfths else F.lit(1)
    rows = rows.select("__quote_id", "__doc_id", "key", plain.alias("plain"), first.alias("first"), step.alias("step"), F.when(plain.isNull() & (F.col("loose") > 0), near).alias("near"))
    rows = rows.withColumn("fuzzy", S.fuzzy_found(F.col("key"), F.col("near"), F.col("first"), F.col("step")) if fuzzy else F.lit(False))
    rank = F.coalesce("plain", F.when(F.col("fuzzy"), 2))
    best = rows.groupBy("__quote_id", "__doc_id").agg(F.min(rank).alias("rank")).filter("rank is not null")
    return best.withColumn("quote_status", F.get(F.array(*map(F.lit, ("exact", "normalized_exact", "fuzzy"))), F.col("rank")))
