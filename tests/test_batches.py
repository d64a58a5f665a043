"""Arrow functions hold the Python objects of a slice, not of a whole batch."""

from __future__ import annotations

import pyarrow as pa
import pytest

import __spark_entry__
from lorekiln.functions import batches


def test_slices_are_bounded_and_whole():
    texts = ["x" * 1_000_000 + str(k) for k in range(20)] + [None, "", "y" * 9_000_000, "z"]
    seen = []

    def work(some):
        seen.append(sum(len(t or "") for t in some))
        return [None if t is None else len(t) for t in some]

    assert batches.by_slices(pa.array(texts), work, pa.int64()).to_pylist() == [None if t is None else len(t) for t in texts]
    assert max(n for n in seen if n != 9_000_000) <= batches.SLICE_BYTES and len(seen) >= 6
    assert batches.by_slices(pa.array([], pa.string()), work, pa.int64()).to_pylist() == []


@pytest.mark.parametrize("name", ["gen_rich_text_parse", "gen_rich_blocks", "gen_page_blocks_full"])
def test_batches_of_long_texts_are_small(spark, name):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(key)) <= batches.BATCH_ROWS

