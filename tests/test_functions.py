from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("  Vitamin   D3. ", "vitamin d3"),
        ("«A» – B", "a»-b"),
        ("Anti - HIV / AIDS;", "anti-hiv/aids"),
        ('"quoted"', "quoted"),
        ("Ёлка", "елка"),
        (None, ""),
        ("", ""),
    ],
)
def test_normalize_basic(spark, value, wanted):
    assert one(spark, value, T.normalize_basic) == wanted


def test_normalize_label_resolves_entities_and_forms(spark):
    assert one(spark, "Caf&eacute; ﬁne", T.normalize_label) == "café fine"
    assert one(spark, "plain", T.normalize_label) == "plain"
    assert one(spark, None, T.normalize_label) == ""


@pytest.mark.parametrize(("value", "wanted"), [("supplier 000000012", "supplier"), ("coenzyme q10", "coenzyme q10"), ("il-6", "il-6"), ("12", "12"), ("vitamin b 12", "vitamin b")])
def test_strip_numeric_variant(spark, value, wanted):
    assert one(spark, value, T.strip_numeric_variant) == wanted


def test_tokens_and_numbers(spark):
    assert one(spark, "B a b, 1,5 and 2.0", T.tokens) == ["0", "1", "2", "5", "a", "and", "b"]
    assert one(spark, "1,5 1.5 30", T.numbers) == ["1.5", "30"]
    assert one(spark, None, T.tokens) == []


def test_flags_are_sorted_and_skip_null_rules(spark):
    rules = lambda x: T.flags(b=x == "v", a=F.length(x) == 1, c=F.lit(None).cast("boolean"))
    assert one(spark, "v", rules) == ["a", "b"]


def test_safe_filename(spark):
    assert one(spark, "../a b?.txt", T.safe_filename) == "a_b_.txt"
    assert one(spark, "///", T.safe_filename) == "untitled"


def test_html_blocks(spark):
    page = "<html><script>var t='<p>no</p>'</script><h1>A &amp; B</h1><p>x <b>y</b></p><p> </p></html>"
    assert [tuple(b) for b in one(spark, page, T.html_blocks)] == [("h1", "A & B"), ("p", "x y")]
    assert one(spark, None, T.html_blocks) == []


def test_quote_status(spark):
    text = "The quick brown fox jumps over the lazy dog near the old river bank today."
    rows = [
        ("quick brown fox", "exact"),
        ("QUICK  brown   fox", "normalized_exact"),
        ("quick, brown fox", "not_found"),
        ("quick ... fox", "not_found"),
        ("the quick brown fox jumps over the lasy dog near the old river", "fuzzy"),
        ("nothing of that kind stands here, and it is long enough", "not_found"),
        ("", "not_found"),
    ]
    df = spark.createDataFrame([(q, text) for q, _ in rows], "q string, t string")
    found = df.select(S.quote_status(F.col("q"), F.col("t"), fuzzy=True)).collect()
    assert [r[0] for r in found] == [s for _, s in rows]


def test_ratio_is_zero_below_its_bound(spark):
    df = spark.createDataFrame([("abcd", "abcd"), ("ab", "abcdefgh"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(S.ratio(F.col("a"), F.col("b"), 0.8)).collect()] == [1.0, 0.0, 0.0]
