"""Labels by documents: repeated, missing and single ids."""

from __future__ import annotations

import re

from lorekiln.plans import queries_text


def test_repeated_and_missing_ids(spark, tmp_path, monkeypatch):
    rows = [(1, "Ab cd\nab ab"), (1, "ab\nef"), (2, "cd cd"), (None, "ab gh\n\nab"), (3, None), (4, ""), (5, "- Ab_1, ёж 12")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted: dict = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            for word in set(re.findall(r"\w+", line.lower())):
                own = wanted.setdefault(word, [set(), 0])
                own[1] += 1
                if doc is not None:
                    own[0].add(doc)
    found = queries_text.flagship(spark, str(tmp_path))
    got = [tuple(r) for r in found.collect()]
    assert got == sorted(((w, len(d), n) for w, (d, n) in wanted.items()), key=lambda r: (-r[1], r[0]))
    # Words of documents with one row are not grouped by document.
    monkeypatch.setattr(queries_text.F, "countDistinct", lambda *c: queries_text.F.lit(0))
    one = tmp_path / "one"
    spark.createDataFrame([(1, "a b\nb"), (2, "b")], "doc_id long, text string").write.parquet(f"{one}/documents.parquet")
    assert [tuple(r) for r in queries_text.flagship(spark, str(one)).collect()] == [("b", 2, 3), ("a", 1, 1)]
