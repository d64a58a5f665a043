from __future__ import annotations

from lorekiln.plans import catalogue


def test_stub_extraction_reads_the_middle(spark, tmp_path):
    ends = "word " * 900
    rows = [(1, f"{ends}Middleton here {ends}"), (2, f"{ends}Centreville here {ends}"), (3, "Short Text"), (4, ""), (5, None), (6, "x" * 3998 + " Boundary " + "y" * 9000 + " Short Short")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.QUERIES["udf_stub_extraction"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.entity_index, r.surface) for r in found) == [(1, 0, "Middleton"), (2, 0, "Centreville"), (3, 0, "Short"), (3, 1, "Text"), (6, 0, "Boundary"), (6, 1, "Short")]
    keys = {r.doc_id: r.request_key for r in found if r.entity_index == 0}
    assert keys[1] != keys[2]
