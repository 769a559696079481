"""Labels and scores of licence scans against a plain version that tries every start."""

from __future__ import annotations

import math
import re

from helioflow.llm import licenses
from helioflow.llm.common import read

ODD = [
    None, "", "Released under the MIT License.", licenses.MIT, "Copyright (c) someone\n" + licenses.MIT.replace("obtaining", "receiving"),
    licenses.MIT[: len(licenses.MIT) // 2], licenses.MIT[len(licenses.MIT) // 2 :], "x " * 40 + licenses.BSD.replace("are permitted", "is permitted"),
    "redistribution and use in source and binary forms with or without modification is permitted", licenses.GPL.format(name="General", version=3),
    licenses.GPL.format(name="General", version=2).upper(), licenses.GPL.format(name="Lesser General", version="2.1"), licenses.ISC, licenses.APACHE,
    "Licensed under the Apache License, Version 2.0 and also the MIT License; released under the MIT License", "general public license", "version 3 general public license",
    licenses.MPL + " " + licenses.UNLICENSE, "permission is hereby granted", "the the the mit license the the", "source and binary forms " * 50, "public license mozilla",
    "under the mit license", "license version 2 0 apache license", licenses.APACHE.replace("Apache License", "Apache Licence"), "Licensed under CC BY-SA 4.0. Licensed under CC BY-NC 4.0.",
]


def words_of(text):
    return re.findall(licenses.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(texts):
    split = [words_of(t) for t in texts]
    docs_with = lambda w: sum(w in s for s in sets)
    sets = [set(s) for s in split]
    idf = {w: math.log((len(texts) + 1) / (docs_with(w) + 1)) + 0.01 for w in licenses.VOCABULARY}
    out = []
    for words in split:
        at = lambda i: words[i] if 0 <= i < len(words) else None  # noqa: B023, E731
        phrase_at = lambda p, i: all(at(i + j) == w for j, w in enumerate(p.split()))  # noqa: B023, E731
        base = {label for p, label in licenses.BASE.items() if any(phrase_at(p, i) for i in range(len(words)))}
        labels, best = set(base), 0.0
        for label, text, must in licenses.TEMPLATES:
            parts = words_of(text)
            total = sum(idf[w] for w in parts)
            for start in range(-len(parts), len(words)) if set(must.split()) <= set(words) else ():
                share = sum(idf[w] for j, w in enumerate(parts) if at(start + j) == w) / total
                if share >= licenses.LEAST_SHARE and any(phrase_at(must, start + o) for o in range(len(parts) - len(must.split()) + 1)):
                    labels.add(label)
                    best = max(best, min(share, 1.0))
        out.append((",".join(sorted(labels)), 1.0 if base else best))
    return out


def test_labels_and_scores(spark, sf_dir):
    texts = ODD + [r["text"] for r in read(spark, sf_dir, "documents").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    wanted = plain(texts)
    for i, (labels, score) in enumerate(wanted):
        assert found[i]["labels"] == labels, (i, texts[i])
        assert math.isclose(found[i]["score"], score, abs_tol=1e-9), (i, texts[i])
    of = lambda text: wanted[texts.index(text)][0]
    assert of(licenses.MIT) == "mit" and of(ODD[4]) == "mit" and of(ODD[8]) == "bsd" and of(licenses.APACHE) == "apache-2.0" and of("permission is hereby granted") == ""
    assert len({w[0] for w in wanted}) > 12


def test_a_word_of_no_document_switches_nothing_off(spark):
    """No document has "obtaining" or "are": the templates match all the same."""
    texts = [f"text number {i} about the weather" for i in range(20)] + [ODD[4], ODD[8]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(22)] == [""] * 20 + ["mit", "bsd"]
