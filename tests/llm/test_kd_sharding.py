from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lorekiln.llm import kd_sharding

SCHEMA = "doc_id long, text string, lang string, source string, shard int, size string"


def rows_of(n, seed=3):
    rng = random.Random(seed)
    return [(k, "ä" * rng.randrange(400), rng.choice(["en", "de", None]), "hot" if k % 3 else f"s{k % 20}", 0, "x") for k in range(n)]


def check(spark, rows, shards):
    found = kd_sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=shards).collect()
    texts = {k: (t or "").encode() for k, t, *_ in rows}
    assert len(found) == len(rows)
    weight, slots = Counter(), defaultdict(list)
    for r in found:
        assert r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert 0 <= r.shard < shards
        weight[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight


def test_bytes_are_near_equal(spark):
    weight = check(spark, rows_of(3000), 10)
    mean = sum(weight.values()) / 10
    assert len(weight) == 10 and max(weight.values()) < 1.02 * mean and min(weight.values()) > 0.98 * mean


def test_equal_metadata_is_split_too(spark):
    weight = check(spark, [(k, "same text", "en", "hot", 0, "x") for k in range(1400)], 7)
    assert len(weight) == 7 and max(weight.values()) - min(weight.values()) < 0.03 * sum(weight.values()) / 7


def test_along_the_widest_dimension(spark):
    rows = [(k, "x" * (1000 if k % 2 else 10), "en", "s", 0, "x") for k in range(600)]
    found = kd_sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=2).collect()
    assert all(r.shard == 1 for r in found if r["size"] < 100) or all(r.shard == 0 for r in found if r["size"] < 100)


def test_few_repeated_and_no_rows(spark):
    check(spark, [(1, None, None, None, 0, "x"), (2, "a" * 100_000, "en", "s", 0, "x")], 40)
    twice = kd_sharding.shard(spark.createDataFrame([(1, "a", "en", "s", 0, "x")] * 3, SCHEMA), shards=2).collect()
    assert len(twice) == 3
    assert kd_sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_a_text_column(spark):
    df = spark.createDataFrame([(k, "t" * k) for k in range(50)], "doc_id long, text string")
    assert kd_sharding.shard(df, shards=5).count() == 50


def quantiles(values, shares):
    values = sorted(values)
    return [values[max(0, math.ceil(p * len(values)) - 1)] for p in shares]


def plain_tree(rows, first, n, out):
    """A plain k-d tree over (id, size, values, tie)."""
    if n == 1 or not rows:
        out.update((r[0], first) for r in rows)
        return
    spreads = [quantiles([r[2][k] for r in rows], kd_sharding.SPREAD) for k in range(len(rows[0][2]))]
    widths = [high - low for low, high in spreads]
    dim = widths.index(max(widths))
    key = lambda r: (r[2][dim], r[3])
    want, sums = sum(r[1] for r in rows) * (n // 2) / n, Counter()
    for r in rows:
        sums[key(r)] += r[1]
    upto, bound = 0, None
    for k in sorted(sums):
        upto += sums[k]
        if upto >= want:
            bound = (k, upto - want <= want - (upto - sums[k]))  # whether the key itself goes left
            break
    left = [r for r in rows if key(r) < bound[0] or (key(r) == bound[0] and bound[1])]
    plain_tree(left, first, n // 2, out)
    plain_tree([r for r in rows if r not in left], first + n // 2, n - n // 2, out)


def test_matches_a_plain_tree(spark):
    rows = [*rows_of(700), (9000, "z" * 200_000, "en", "s1", 0, "x"), (9001, None, None, None, 0, "x")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    dimensions = list(kd_sharding.document_dimensions(df).values())
    raw = df.select(
        F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"), (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long").alias("size"),
        F.lit(0).alias("crc"), *[d.cast("double").alias(f"raw{k}") for k, d in enumerate(dimensions)],
    )
    scaled = [(r.id, r["size"], tuple(r["values"]), r.tie) for r in kd_sharding._scaled(raw, len(dimensions)).collect()]
    wanted = {}
    plain_tree(scaled, 0, 12, wanted)
    assert {r.doc_id: r.shard for r in kd_sharding.shard(df, shards=12).collect()} == wanted


def test_an_outlier_does_not_make_its_dimension_the_widest(spark):
    rows = [(k, "x" * (100 + k % 50), "en" if k % 2 else "de", "s", 0, "x") for k in range(400)] + [(999, "x" * 3000, "en", "s", 0, "x")]
    found = {r.doc_id: r.shard for r in kd_sharding.shard(spark.createDataFrame(rows, SCHEMA), shards=2).collect()}
    langs = [{rows[k][2] for k in range(400) if found[k] == shard} for shard in (0, 1)]
    assert min(map(len, langs)) == 1


def test_target_bytes(spark):
    rows = rows_of(1000)
    found = kd_sharding.shard(spark.createDataFrame(rows, SCHEMA), target_bytes=30_000).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    total = sum(r.n for r in found)
    assert len(found) == -(-total // 30_000) and max(r.n for r in found) < 31_000
