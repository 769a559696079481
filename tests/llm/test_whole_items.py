"""Decontamination finds every item of one or two shingles."""

from __future__ import annotations

from helioflow.llm import decontam


def test_short_items_in_long_documents(spark):
    n = 3000
    words = [f"w{i}" for i in range(40 * n)]
    items = [(i, " ".join(words[40 * i + i % 7 : 40 * i + i % 7 + 5 + i % 2])) for i in range(n)] + [(n, "no such words are there"), (n + 1, "w0 w1 w2 w3 w5")]
    docs = spark.createDataFrame([(1, "first text"), (2, " ".join(words)), (3, items[8][1] + " end")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contained_items(docs, bench).collect()}
    assert found == {(2, i) for i in range(n)} | {(3, 8)}
