"""License scans with a positional index of rare words, as DataFrame expressions.

The index is the table of templates: for each word of a licence text its positions in it. A first
pass counts in how many documents each licence word occurs. A document then looks up, for each
template, those of the template's words that it has itself, by decreasing rarity. Where one of them
stands in the document, the relative position says where the template would start; the other
words' postings are intersected at that start. The share of the template's rarity found there is
the match; a label also needs the template's mandatory phrase within it. Words are looked up until
those that are left could not make a match by themselves, so no match is lost. Every step happens in
the document's own row: nothing is shuffled but the counts of the few hundred licence words.
"""

from __future__ import annotations

import re
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are counted, and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Licence texts (fixed values).
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public
License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""
#: Label, licence wording, mandatory phrase.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2"),
    ("apache-2.0", APACHE, "apache license version 2"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", MIT, "permission is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy", "permission is hereby granted"),
    ("isc", ISC, "with or without fee"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "source and binary forms"),
    ("bsd", BSD, "source and binary forms"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "general public license version 3"),
    ("gpl-3.0", GPL.format(name="General", version=3), "version 3 of the license"),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2", "general public license version 2"),
    ("gpl-2.0", GPL.format(name="General", version=2), "version 2 of the license"),
    ("lgpl", "Licensed under the GNU Lesser General Public License", "lesser general public license"),
    ("lgpl", GPL.format(name="Lesser General", version="2.1"), "lesser general public license"),
    ("agpl-3.0", GPL.format(name="Affero General", version=3), "affero general public license"),
    ("mpl-2.0", MPL, "mozilla public license"),
    ("unlicense", UNLICENSE, "into the public domain"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by 4"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    ("cc0", "Released under CC0 1.0 Universal public domain dedication", "cc0 1 0"),
    ("reserved", "Copyright All rights reserved", "rights reserved"),
]
#: The least share of a template's rarity at one relative position.
LEAST_SHARE = 0.6



def plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


VOCABULARY = sorted({w for _, *texts in TEMPLATES for t in texts for w in plain_words(t)} | {w for p in BASE for w in p.split()})


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null text: none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _rows(docs: DataFrame) -> DataFrame:
    """The one pass over the texts, stored: ``doc_id, n_words``, the licence words that occur, and
    the words in order if all those of some phrase occur (no label is possible otherwise)."""
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    seen = split.withColumn("seen", F.array_distinct(F.filter("words", lambda w: w.isin(VOCABULARY))))
    phrases = sorted({p for _, _, p in TEMPLATES} | set(BASE))
    possible = reduce(lambda a, b: a | b, [F.size(F.array_intersect("seen", F.lit(sorted(set(p.split()))))) == len(set(p.split())) for p in phrases])
    none = F.array().cast("array<string>")
    return stored(seen.select("doc_id", F.size("words").cast("long").alias("n_words"), "seen", F.when(possible, F.col("words")).otherwise(none).alias("words")))


def rarity(rows: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every licence word, from all documents; a few dozen numbers."""
    counts = {r["w"]: r["n"] for r in rows.select(F.explode("seen").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    total = rows.count()
    return {w: log((total + 1) / (counts.get(w, 0) + 1)) + 0.01 for w in VOCABULARY}


def _all_at(phrase: list[str], start: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.get("words", start + j) == w, F.lit(False)) for j, w in enumerate(phrase)])


def _phrase_places(phrase: str, idf: dict[str, float]) -> Column:
    """Starts of all places where the phrase's words stand consecutively, by its rarest word."""
    parts = phrase.split()
    rarest = max(range(len(parts)), key=lambda j: (idf[parts[j]], -j))
    at = F.filter("hits", lambda x: x["w"] == parts[rarest])
    return F.filter(F.transform(at, lambda x: x["i"] - rarest), lambda s: (s >= 0) & _all_at(parts, s))


def _postings(parts: list[str], idf: dict[str, float]) -> Column:
    """The template's distinct words, the rarest first, each with its positions and what they weigh."""
    at: dict[str, list[int]] = {}
    for j, w in enumerate(parts):
        at.setdefault(w, []).append(j)
    ordered = sorted(at, key=lambda w: (-idf[w], w))
    return F.array(*(F.struct(F.lit(w).alias("w"), F.lit(idf[w] * len(at[w])).alias("weight"), F.lit(at[w]).alias("at")) for w in ordered))


def _share(template: str, must: str, idf: dict[str, float]) -> Column:
    """The largest share of the template's rarity at one start, if it is enough and has the phrase; else 0."""
    parts, phrase = plain_words(template), must.split()
    weights, n = [idf[w] for w in parts], len(parts)
    total = sum(weights)
    postings = _postings(parts, idf)
    own = F.filter(postings, lambda p: F.array_contains("seen", p["w"]))
    none = F.filter(postings, lambda p: F.lit(False))
    # A word is looked up unless it and the less rare ones could not make a match by themselves.
    state = F.struct(F.aggregate(own, F.lit(0.0), lambda a, p: a + p["weight"]).alias("rest"), none.alias("chosen"))
    chosen = F.aggregate(
        own,
        state,
        lambda a, p: F.struct(
            (a["rest"] - p["weight"]).alias("rest"),
            F.when(a["rest"] >= LEAST_SHARE * total - 1e-6, F.concat(a["chosen"], F.array(p))).otherwise(a["chosen"]).alias("chosen"),
        ),
        lambda a: a["chosen"],
    )
    places = lambda p: F.filter("hits", lambda h: h["w"] == p["w"])
    starts = F.transform(chosen, lambda p: F.flatten(F.transform(places(p), lambda h: F.transform(p["at"], lambda j: h["i"] - j))))
    words = F.lit(parts)

    def share(start: Column) -> Column:
        found = F.transform(F.lit(weights), lambda x, j: F.when((start + j >= 0) & (F.get("words", start + j) == F.get(words, j)), x).otherwise(0.0))
        return F.aggregate(found, F.lit(0.0), lambda a, x: a + x) / total

    def has_phrase(start: Column) -> Column:
        return F.exists(F.sequence(F.lit(0), F.lit(n - len(phrase))), lambda o: (start + o >= 0) & _all_at(phrase, start + o))

    tried = F.transform(F.array_distinct(F.flatten(starts)), lambda s: F.struct(share(s).alias("share"), s.alias("start")))
    good = F.filter(tried, lambda m: (m["share"] >= LEAST_SHARE) & has_phrase(m["start"]))
    return F.least(F.coalesce(F.array_max(F.transform(good, lambda m: m["share"])), F.lit(0.0)), F.lit(1.0))


def scan(docs: DataFrame) -> DataFrame:
    """Licences of every row's whole text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``: places
    of base phrases (their number, and smallest and largest start), labels sorted and joined by
    commas, and the best template's share of rarity (1 if a base phrase occurs). Null and empty
    texts have no word, label or score. Equally rare words: in alphabetical order. Repeated rows and
    null ids keep their rows. Empty input: no rows. Other columns are not read.
    """
    rows = _rows(docs)
    idf = rarity(rows)
    placed = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(VOCABULARY))
    found = rows.withColumn("hits", placed)
    some = F.size("hits") > 0
    base = {f"base_{k}": F.when(some, _phrase_places(p, idf)).otherwise(F.array().cast("array<int>")) for k, p in enumerate(BASE)}
    shares = {f"share_{k}": F.when(some, _share(t, must, idf)).otherwise(0.0) for k, (_, t, must) in enumerate(TEMPLATES)}
    found = found.withColumns(base | shares)
    places = F.concat(*base)
    base_labels = [F.when(F.size(f"base_{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]
    own = [F.when(F.col(f"share_{k}") > 0, F.lit(label)) for k, (label, _, _) in enumerate(TEMPLATES)]
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))), ",")
    best = F.greatest(*shares)
    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(base_labels + own).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(best).alias("score"),
    )
