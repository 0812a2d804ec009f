"""Callers' columns that have the names of operators' own ones."""

from tidemark.llm import pii, quality


def test_spans_keep_columns(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now", 3, "x"), (2, None, 4, "y")], "doc_id long, text string, __c int, __B string")
    found = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    assert (found[1]["__c"], found[1]["__B"], len(found[1]["__spans"])) == (3, "x", 1) and found[2]["__spans"] == []


def test_quality_filter_keeps_columns(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, "en", "s", 5, 6), (2, "short", "en", "s", 7, 8)], "doc_id long, text string, lang string, source string, __q int, __Q_ int")
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, text, "en", "s", 5, 6)]
