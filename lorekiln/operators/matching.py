"""Which blocks of its documents a tag is found in: quotes, aliases, titles, or none of them.

Aliases may have several words and stand at word boundaries. A phrase is looked up by the rarest pair of
its neighbouring words, or by its only word: that and the document are the key of the join, so a
phrase meets only blocks of its tag's own documents that have the pair, however common its words are.
Quotes are found alike by the rarest of their inner pairs. Only what meets is compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators.quotes import small
from lorekiln.sources.shared import Workspace

#: Order of methods and qualities, and lengths.
METHODS = ("quote_match", "alias_match", "title_match", "short_doc_fallback", "mention_only_fallback")
QUALITIES = ("high", "medium", "low")
LEAST_QUOTE, LEAST_ALIAS, LONG_ALIAS, MOST_ALIASES = 8, 3, 5, 10
SHORT_DOCUMENT = 12000
WORD_CHARACTER = r"[\p{L}\p{N}_]"
LETTER_OR_DIGIT = r"[\p{L}\p{N}]"


def alias_terms(aliases: DataFrame, tag: str, alias: str, canonical: str) -> DataFrame:
    """(tag, term, canonical, compact): each normalized alias of a tag once; it is canonical if any
    of its rows is. ``compact`` counts its word characters."""
    term = T.normalize_label(F.col(alias))
    rows = aliases.select(F.col(tag).alias("tag"), term.alias("term"), F.coalesce(F.col(canonical), F.lit(False)).alias("canonical"))
    once = rows.filter("tag is not null and term <> ''").groupBy("tag", "term").agg(F.bool_or("canonical").alias("canonical"))
    return once.withColumn("compact", F.length(F.regexp_replace("term", r"[^\p{L}\p{N}_]", "")))


def _pattern(term: Column) -> Column:
    """The term as it is, with boundaries where it begins or ends in a letter or digit."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    before = F.when(term.rlike(f"^{LETTER_OR_DIGIT}"), rf"(?<!{WORD_CHARACTER})").otherwise("")
    after = F.when(term.rlike(rf"{LETTER_OR_DIGIT}\z"), rf"(?!{WORD_CHARACTER})").otherwise("")
    return F.concat(before, quoted, after)


def place_of(term: Column, text: Column) -> Column:
    """Characters before the first place where a term stands in a text, or null."""
    return F.nullif(F.call_function("regexp_instr", text, _pattern(term)) - 1, F.lit(-1))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(T.WORD), F.lit(0))


def _whole_words(term: Column) -> Column:
    """Words of a term that are whole words of any text it stands in: an edge that begins or ends in
    an underscore has no boundary."""
    words = _words(term)
    skip = F.when(F.left(term, F.lit(1)) == "_", 1).otherwise(0)
    drop = skip + F.when(F.right(term, F.lit(1)) == "_", 1).otherwise(0)
    return F.slice(words, skip + 1, F.greatest(F.size(words) - drop, F.lit(0)))


def _inner_words(quote: Column) -> Column:
    """All words but those at the edges, which may be parts of longer ones in a text."""
    words = _words(quote)
    return F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))


def _singles(words: Column) -> Column:
    """Hashes of words. Equal hashes of other words only make candidates: what meets is compared whole."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _pairs(words: Column) -> Column:
    """Hashes of neighbouring words."""
    return F.transform(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda w, k: F.xxhash64(F.get(words, k), w))


def _phrase_keys(words: Column) -> Column:
    """What a phrase of these words can be looked up by."""
    return F.array_distinct(F.when(F.size(words) > 1, _pairs(words)).otherwise(_singles(words)))


def _text_keys(words: Column) -> Column:
    """What phrases in a text of these words are looked up by."""
    return F.array_distinct(F.concat(_singles(words), _pairs(words)))


def _with_rarest(phrases: DataFrame, words: Column, counted: DataFrame) -> DataFrame:
    """``phrases`` with ``rarest``, the one of their keys that the fewest blocks have, by ``counted``
    (word, times); null for phrases without words."""
    keyed = phrases.withColumn("__words", T.let(words, _phrase_keys))
    used = keyed.select("__words", F.explode("__words").alias("word")).distinct()
    times = F.coalesce("times", F.lit(0))
    best = used.join(counted, "word", "left").groupBy("__words").agg(F.min(F.struct(times.alias("times"), "word")).alias("best"))
    return keyed.join(best.select("__words", F.col("best.word").alias("rarest")), "__words", "left").drop("__words")


def _listed(column: Column) -> Column:
    return F.array_sort(F.collect_set(column))


def find_match_hits(
    terms: DataFrame, links: DataFrame, docs: DataFrame, blocks: DataFrame, quotes: DataFrame, short_document: int = SHORT_DOCUMENT
) -> DataFrame:
    """Hits of every linked (tag, doc) whose document has a block with text.

    ``terms`` as of :func:`alias_terms`; ``links``: tag, doc, mention, sole (whether the tag is the
    document's only candidate); ``docs``: doc, name, length; ``blocks``: doc, block_index, text;
    ``quotes``: mention, quote. Result: tag, doc, method, quality, block_indexes, mention_ids,
    matched_aliases, needs_review, review_reasons. Blocks with quotes and blocks with aliases
    are hits of their own; only without any the title counts, then a short document whose only
    candidate the tag is, and at last the first block.
    """
    work = Workspace(links.sparkSession, "match-hits")
    links = links.select("tag", "doc", F.col("mention").cast("string").alias("mention"), "sole").filter("tag is not null and doc is not null")
    links = work.keep(links, "links")
    pairs = links.groupBy("tag", "doc").agg(_listed(F.col("mention")).alias("mentions"), F.bool_or("sole").alias("sole"))
    rows = blocks.filter(F.col("text").rlike(r"[^ \t\n\r\f\x0B]")).filter("block_index is not null")
    rows = rows.join(small(links.select("doc").distinct()), "doc", "left_semi")
    places = work.keep(rows.select("doc", "block_index", T.normalize_label(F.col("text")).alias("norm")), "blocks")
    words = places.select("doc", "block_index", F.explode(T.let(_words(F.col("norm")), _text_keys)).alias("word"))
    # Equal quotes of many mentions are normalized and looked up once.
    quotes = quotes.filter("mention is not null").select(F.col("mention").cast("string").alias("mention"), "quote")
    wanted = quotes.select("quote").distinct().withColumn("wanted", T.normalize_label(F.trim(F.col("quote"))))
    wanted = work.keep(wanted.filter(F.length("wanted") >= LEAST_QUOTE), "quotes")
    terms = work.keep(terms, "all-terms")
    # Only keys of phrases leave their blocks. They are taken from the texts once, and counted there.
    used = terms.select(F.explode(T.let(_whole_words(F.col("term")), _phrase_keys)).alias("word"))
    used = used.union(wanted.select(F.explode(T.let(_inner_words(F.col("wanted")), _phrase_keys)).alias("word")))
    words = work.keep(words.join(small(work.keep(used.distinct(), "used")), "word"), "words")
    counted = work.keep(words.groupBy("word").agg(F.count("*").alias("times")), "counted")
    keyed = work.keep(_with_rarest(terms, _whole_words(F.col("term")), counted), "terms")
    wanted = work.keep(_with_rarest(wanted, _inner_words(F.col("wanted")), counted), "wanted")
    asked = work.keep(quotes.join(small(wanted), "quote").select("mention", "wanted", "rarest").distinct(), "asked")
    rarest = work.keep(keyed.select(F.col("rarest").alias("word")).union(wanted.select("rarest")).filter("word is not null").distinct(), "rarest")
    words = words.join(small(rarest), "word")
    filled = places.groupBy("doc").agg(F.array_sort(F.collect_list("block_index")).alias("filled"))
    pairs = work.keep(pairs.join(filled, "doc"), "pairs")
    met = work.keep(_met(links, pairs, asked, keyed, places, words), "met")
    quoted = met.filter("mention is not null").groupBy("tag", "doc", "block_index").agg(_listed(F.col("mention")).alias("mentions"))
    quoted = work.keep(_hit(quoted, "quote_match", F.lit("high"), F.array("block_index"), F.col("mentions")), "quote-hits")
    named = _matched(met.filter("mention is null"), ["tag", "doc", "block_index"], ("high", "medium"))
    named = work.keep(_hit(named, "alias_match", F.col("quality"), F.array("block_index"), aliases=F.col("aliases")), "alias-hits")
    found = quoted.select("tag", "doc").union(named.select("tag", "doc")).distinct()
    others = work.keep(pairs.join(found, ["tag", "doc"], "left_anti").join(docs.select("doc", "length"), "doc", "left"), "others")
    # A title is normalized once, not once per tag.
    titles = docs.select("doc", "name").join(small(others.select("doc").distinct()), "doc", "left_semi")
    titles = work.keep(titles.select("doc", T.normalize_label(F.col("name")).alias("title")).filter("title <> ''"), "titles")
    titled = work.keep(_titles(others, titles, keyed, rarest, short_document), "title-hits")
    rest = _fallbacks(others.join(titled.select("tag", "doc"), ["tag", "doc"], "left_anti"), short_document)
    return quoted.unionByName(named).unionByName(titled).unionByName(rest)


def _hit(rows: DataFrame, method: str, quality: Column, indexes: Column, mentions: Column | None = None, aliases: Column | None = None, reason: Column | None = None) -> DataFrame:
    none = F.array().cast("array<string>")
    reasons = none if reason is None else F.when(reason.isNull(), none).otherwise(F.array(reason))
    return rows.select(
        "tag", "doc", F.lit(method).alias("method"), quality.alias("quality"), indexes.alias("block_indexes"), (none if mentions is None else mentions).alias("mention_ids"),
        (none if aliases is None else aliases).alias("matched_aliases"), (F.size(reasons) > 0).alias("needs_review"), reasons.alias("review_reasons"),
    )


def _met(links: DataFrame, pairs: DataFrame, quotes: DataFrame, terms: DataFrame, places: DataFrame, words: DataFrame) -> DataFrame:
    """(tag, doc, block_index, term, canonical, compact, mention): quotes of a tag's mentions, which have
    a mention, and its aliases in the blocks where they stand. Texts are joined once, to both."""
    own = links.select("tag", "doc", "mention").distinct().join(quotes, "mention")
    own = own.select("tag", "doc", F.col("wanted").alias("term"), F.lit(False).alias("canonical"), F.lit(0).alias("compact"), "mention", "rarest")
    named = pairs.select("tag", "doc").join(terms.filter(F.col("compact") >= LEAST_ALIAS), "tag")
    named = named.select("tag", "doc", "term", "canonical", "compact", F.lit(None).cast("string").alias("mention"), "rarest")
    asked = own.unionByName(named)
    by_word = asked.filter("rarest is not null").withColumnRenamed("rarest", "word").join(words, ["doc", "word"]).drop("word").join(places, ["doc", "block_index"])
    wordless = asked.filter("rarest is null").drop("rarest").join(places, "doc")  # quotes of one or two words
    stands = F.when(F.col("mention").isNotNull(), F.lit(True)).otherwise(place_of(F.col("term"), F.col("norm")).isNotNull())
    return by_word.unionByName(wordless).filter(F.contains("norm", "term") & stands).drop("norm")


def _matched(rows: DataFrame, keys: list[str], quality: tuple[str, str]) -> DataFrame:
    """The aliases in a text in their tag's order, and what they are worth together."""
    order = F.struct((~F.col("canonical")).alias("other"), (-F.length("term")).alias("length"), "term")
    listed = F.transform(F.slice(F.array_sort(F.collect_set(order)), F.lit(1), F.lit(MOST_ALIASES)), lambda a: a["term"])
    strong = F.bool_or(F.col("canonical") | (F.col("compact") >= LONG_ALIAS))
    return rows.groupBy(*keys).agg(F.when(strong, quality[0]).otherwise(quality[1]).alias("quality"), listed.alias("aliases"))


def _titles(others: DataFrame, titles: DataFrame, terms: DataFrame, rarest: DataFrame, short_document: int) -> DataFrame:
    pairs = others.select("tag", "doc").distinct()
    keys = titles.select("doc", F.explode(T.let(_words(F.col("title")), _text_keys)).alias("word")).join(small(rarest), "word").distinct()
    met = pairs.join(keys.withColumnRenamed("word", "rarest"), "doc").join(terms, ["tag", "rarest"]).drop("rarest")
    wordless = pairs.join(terms.filter("rarest is null").drop("rarest"), "tag")
    met = met.unionByName(wordless).join(titles, "doc")
    found = met.filter(F.contains("title", "term") & place_of(F.col("term"), F.col("title")).isNotNull())
    hits = _matched(found, ["tag", "doc"], ("medium", "low")).join(others, ["tag", "doc"])
    reason = F.when(F.col("quality") == "low", "title_match_short_or_ambiguous_alias")
    return _hit(hits, "title_match", F.col("quality"), _blocks_of(short_document), aliases=F.col("aliases"), reason=reason)


def _is_short(short_document: int) -> Column:
    return F.coalesce("sole", F.lit(False)) & (F.coalesce("length", F.lit(0)) <= short_document)


def _blocks_of(short_document: int) -> Column:
    """All blocks of a short document whose only candidate the tag is, else the first one."""
    return F.when(_is_short(short_document), F.col("filled")).otherwise(F.slice("filled", 1, 1))


def _fallbacks(rest: DataFrame, short_document: int) -> DataFrame:
    short, mentions = _is_short(short_document), F.transform("mentions", lambda m: m.cast("string"))
    whole = _hit(rest.filter(short), METHODS[3], F.lit("medium"), F.col("filled"), mentions)
    reason = F.lit("mention_only_fallback_no_quote_alias_or_title_match")
    return whole.unionByName(_hit(rest.filter(~short), METHODS[4], F.lit("low"), F.slice("filled", 1, 1), mentions, reason=reason))


def in_order() -> list[Column]:
    """Sort key of a document's hits: method, quality, first block."""
    rank = lambda names, c: F.array_position(F.array(*map(F.lit, names)), F.col(c))
    return [rank(METHODS, "method"), rank(QUALITIES, "quality"), F.array_min("block_indexes")]
