"""Shards of the packing: equal rows are spread, and both passes number their sequences apart."""

from __future__ import annotations

from collections import defaultdict

from helioflow.llm import packing, queries


def test_equal_rows_are_dealt_to_many_shards(spark, monkeypatch):
    """500 rows without id and text are one another's copies: no shard gets many more of them than its share."""

    def sizes(capacity):
        return lambda rows: rows.assign(sequence_id=rows["shard"], offset=0, fill=capacity)

    monkeypatch.setattr(packing, "_packer", sizes)
    docs = spark.createDataFrame([(None, None)] * 500 + [(i, f"word {i}") for i in range(200)], "doc_id long, text string")
    shards = packing.pack_sequences(docs, queries.tokenizer_path(), shard_pieces=50).groupBy("sequence_id").count().collect()
    assert len(shards) == 14 and max(r["count"] for r in shards) < 100


def test_sequences_of_both_passes_are_apart(spark):
    """With shards of a few pieces most bins are packed again; offsets are gapless in every sequence."""
    docs = spark.createDataFrame([(i, " ".join(["tower"] * (i % 90))) for i in range(900)] + [(None, None)] * 100, "doc_id long, text string")
    rows = packing.pack_sequences(docs, queries.tokenizer_path(), capacity=256, shard_pieces=20).collect()
    assert len(rows) == 1000
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
