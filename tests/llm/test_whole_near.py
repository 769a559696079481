"""Near-dedup of whole rows where ids are null or shared."""

from __future__ import annotations

from helioflow.llm import simhash

TEXTS = [
    "the quick brown fox jumps over the lazy dog near the river bank",
    "solar forecasts need fresh satellite frames and weather model runs",
    "a recipe for bread asks for flour water salt yeast and much time",
    "old maps of the harbour show three piers and a lighthouse on rocks",
]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    left = simhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    return sorted(((r["doc_id"], r["text"], r["n"]) for r in left.collect()), key=str)


def test_rows_without_id(spark):
    """Each clean text stays once; a null id gives way to an id in its own component only."""
    rows = [(None, t, i) for i, t in enumerate(TEXTS)] + [(None, TEXTS[1], 1), (7, TEXTS[0], 8), (9, TEXTS[0], 9), (None, None, 10), (None, "", 10)]
    found = kept(spark, rows)
    assert [r for r in found if r[1]] == sorted([(7, TEXTS[0], 8), *((None, t, i) for i, t in enumerate(TEXTS) if i)], key=str)
    assert len(found) == 5 and sum(not r[1] for r in found) == 1


def test_one_id_with_several_texts(spark):
    rows = [(5, TEXTS[0], 0), (5, TEXTS[1], 1), (5, TEXTS[1], 1), (2**62 + 1, TEXTS[2], 2), (None, TEXTS[3], 3), (6, TEXTS[1], 4)]
    assert kept(spark, rows) == sorted([rows[0], rows[1], rows[3], rows[4]], key=str)


def test_empty(spark):
    assert kept(spark, []) == []
