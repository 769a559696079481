"""The whole pipeline against plain versions of its stages, one after the other."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_contracts import lower, plain_fingerprint, plain_simhash
from test_whole_lines import plain_line_dedup
from tokenizers import Tokenizer

import corpus_pipeline
from helioflow.llm import langid, queries
from helioflow.llm.common import read, stored

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Ids that no double holds, null ids, repeated rows, texts without words, a benchmark item in a long text.
ODD = [
    (2**53 + 1, "an odd text with an id that no double holds, and with enough words to be read", None, None, None),
    (2**60 + 3, None, "en", "s", 0), (2**60 + 5, "", "en", "s", 0), (None, "a row that has no id at all but a few words", None, "s", 1), (None, "another row without any id", "en", "s", 1),
    (2**61, "12 34 !!", "en", "s", 1), (2**62, "the same line twice\nthe same line twice\nand one more", "en", "s", 1), (2**62, "the same line twice\nthe same line twice\nand one more", "en", "s", 1),
    (2**62 + 9, "long words " * 9000 + " {item} " + "more words " * 9000, "en", "s", 1),
]


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    bench = read(spark, sf_dir, "benchmark")
    item = bench.where("item_id is not null").orderBy("item_id").first()["text"]
    odd = spark.createDataFrame([(i, t and t.replace("{item}", item), *rest) for i, t, *rest in ODD], COLUMNS)
    read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd).write.parquet(f"{path}/documents.parquet")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_stages(spark, folder):
    docs = read(spark, folder, "documents")
    model, rows = langid.fit(docs), [(r["doc_id"], r["text"]) for r in docs.collect()]
    known = [x[0] != "und" and x[1] >= langid.LEAST_SHARE for x in langid.predict(model, [t for _, t in rows])]
    rows = [r for r, k in zip(rows, known, strict=True) if k]
    yield rows
    rows = plain_line_dedup(rows)
    yield rows
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    groups = defaultdict(list)
    for (doc, text), (_, fp, least) in zip(rows, plain_simhash(prints), strict=True):
        groups[least if least is not None else fp].append((doc is None, doc or 0, text, doc))
    rows = [(g[3], g[2]) for g in (min(x) for x in groups.values())]
    yield rows
    grams = lambda t: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := re.findall(r"[^\x20\x09-\x0D]+", lower(t))) else set()
    items = [grams(r["text"]) for r in read(spark, folder, "benchmark").where("item_id is not null").collect()]
    leaked = lambda t: any(b and len((own := grams(t)) & b) >= 0.8 * len(b) for b in items)
    yield [(d, t) for d, t in rows if d is None or not leaked(t)]


def test_pipeline(spark, folder):
    docs = read(spark, folder, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "near-dedup", "decontamination", "packing"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for (name, stage), wanted in zip(corpus_pipeline.STAGES[:-1], plain_stages(spark, folder), strict=True):
        before = docs.count()
        docs = stored(stage(spark, docs, folder))
        assert docs.dtypes == [tuple(c.split()) if "long" not in c else (c.split()[0], "bigint") for c in COLUMNS.split(", ")], name
        found = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=key)
        assert found == sorted(wanted, key=key), name
        assert name == "line dedup" or len(found) < before
    assert docs.where("lang is null").count() == 0
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = []
    for doc, text in wanted:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces += [(doc, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())) for k in range(0, len(ids), 4096)]
    found = [tuple(r)[:5] for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(found, key=str) == sorted(pieces, key=str)


def test_pipeline_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        read(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_without_benchmark_items(spark, folder, tmp_path):
    read(spark, folder, "documents").limit(20).write.parquet(f"{tmp_path}/documents.parquet")
    read(spark, folder, "benchmark").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert 0 < corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() <= 20
