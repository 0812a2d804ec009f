"""Benchmark items with ids of any type, documents with columns of any name."""

from tidemark.llm import decontaminate

ITEM = " ".join(f"w{i}" for i in range(20))


def test_own_columns_and_ids(spark):
    docs = spark.createDataFrame([(1, f"before {ITEM} after", 7, "x"), (2, "clean text", 8, "y"), (3, None, 9, None)], "doc_id long, text string, __leaks int, __LEAKS_ string")
    items = spark.createDataFrame([("a-1", ITEM), (None, ITEM), ("b", None)], "item_id string, text string")
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [(2, "clean text", 8, "y"), (3, None, 9, None)]
    found = decontaminate.leaks(docs, items).collect()
    assert sorted((r.doc_id, str(r.item_id), r.first_word, r.n_words) for r in found) == [(1, "None", 1, 20), (1, "a-1", 1, 20)]


def test_tables_without_rows(spark):
    docs = spark.createDataFrame([(1, ITEM, 2)], "doc_id long, text string, __leaks int")
    items = spark.createDataFrame([], "item_id string, text string")
    assert [tuple(r) for r in decontaminate.without_leaks(docs, items).collect()] == [(1, ITEM, 2)]
    assert decontaminate.without_leaks(docs.limit(0), items).collect() == []
