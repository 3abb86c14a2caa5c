"""Rows without an id take no links from the documents they repeat."""

from shapekit.llm import shingle_join


def test_null_copy_of_a_document_with_a_near_copy(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near = text + " end"
    rows = [(None, text), (7, text), (9, near), (None, near), (-4, "x " + near), (3, "some other words that stand alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.component_id) for r in shingle_join.jaccard_components(spark, docs).collect()), key=str)
    assert got == sorted([(None, None), (7, -4), (9, -4), (None, None), (-4, -4), (3, 3)], key=str)
    kept = sorted((r.doc_id for r in shingle_join.without_near_copies(spark, docs).collect()), key=str)
    assert kept == sorted([None, None, -4, 3], key=str)
