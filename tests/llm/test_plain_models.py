"""Site posteriors, weak supervision and language spans against plain single-machine versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from helioflow.llm import langid, site_quality, weak_rules
from helioflow.llm.common import read


def plain_posteriors(rows):
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    out = [list(r[:3]) + list(r[3:]) for r in rows]
    for t in (3, 4):
        mean = min(1 - 1e-6, max(1e-6, sum(r[t] for r in rows) / len(rows)))
        hosts, paths = defaultdict(list), defaultdict(list)
        for r in rows:
            hosts[r[1]].append(r[t])
            paths[r[1], r[2]].append(r[t])

        def strength(groups):
            """``groups``: number, sum and prior mean of each group of two and more."""
            groups = [g for g in groups if g[0] > 1]
            if not groups:
                return 1e6
            n = sum(g[0] for g in groups)
            between = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups)
            within = sum(g[0] * g[2] * (1 - g[2]) for g in groups)
            excess = (between - len(groups) * within / n) / n
            return 1e6 if excess <= 0 else min(1e6, max(1.0, within / n / excess - 1))

        host_k = strength([(len(x), sum(x), mean) for x in hosts.values()])
        shrunk = {h: (sum(x) + host_k * mean) / (len(x) + host_k) for h, x in hosts.items()}
        path_k = strength([(len(x), sum(x), shrunk[h]) for (h, _), x in paths.items()])
        for r, o in zip(rows, out, strict=True):
            x, y = hosts[r[1]], paths[r[1], r[2]]
            host = (sum(x) - r[t] + host_k * mean) / (len(x) - 1 + host_k)
            path = (sum(y) - r[t] + path_k * host) / (len(y) - 1 + path_k)
            o += [host, path, 1 / (1 + math.exp(-(logit(r[t]) + logit(path) - logit(mean))))]
    return out


@pytest.mark.parametrize("seed, spread", [(1, 0.4), (2, 0.0), (3, 0.15)])
def test_site_posteriors(spark, seed, spread):
    rng = random.Random(seed)
    level = {h: min(0.95, max(0.05, 0.6 + rng.uniform(-spread, spread))) for h in [*"abcdefgh", None]}
    rows = []
    for i in range(400):
        host = rng.choice(list(level))
        rows.append((2**60 + i, host, rng.choice(["x", "y", None]), min(0.999, max(0.001, rng.gauss(level[host], 0.1))), rng.random() ** 4))
    rows.append((None, "alone", "x", 0.7, 0.1))
    frame = spark.createDataFrame(rows, "doc_id long, host string, path string, good double, toxic double")
    names = ["doc_id", "host", "path", "doc_good", "doc_toxic", "good_host", "good_path", "p_good", "toxic_host", "toxic_path", "p_toxic"]
    found = {r["doc_id"]: r for r in site_quality.posteriors(frame).select(*names).collect()}
    assert len(found) == len(rows)
    for row in plain_posteriors(rows):
        assert list(found[row[0]])[:3] == row[:3]
        assert list(found[row[0]])[3:] == pytest.approx(row[3:], rel=1e-9, abs=1e-12)


def test_weak_supervision(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()] + [(2**60 + 3, None), (None, "a b"), (7_000_001, "x " * 99), (7_000_001, "x " * 99)]
    share = lambda part, of: part / max(of, 1)
    vote = lambda good, bad: -1 if bad else 1 if good else 0

    def votes(text):
        text = text or ""
        words = re.findall(r"[^ \t\n\x0b\f\r]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^ \t\n\x0b\f\r]", x)]
        count = lambda chars: sum(text.count(c) for c in chars)
        n, chars = len(words), sum(map(len, words))
        grams = Counter(zip(words, words[1:], words[2:], strict=False))
        twice = {j for i in range(n - 2) if grams[words[i], words[i + 1], words[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        dups, upper, marks, digits, symbols = len(lines) - len(set(lines)), count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count("!?"), count("0123456789"), count("#*$%&|<>")
        size = share(chars, n)
        failed = n < 50 or 100 * len(twice) > 50 * n
        return failed, (
            vote(n >= 100, n < 50), vote(3 <= size <= 10, not 2 <= size <= 14), vote(share(symbols, n) < 0.02, share(symbols, n) > 0.1),
            vote(dups == 0 and len(lines) > 2, share(dups, len(lines)) > 0.3), vote(share(len(twice), n) < 0.1, share(len(twice), n) > 0.3),
            vote(share(upper, chars) < 0.15, share(upper, chars) > 0.4), vote(share(marks, n) < 0.1, share(marks, n) > 0.3), vote(share(digits, chars) < 0.1, share(digits, chars) > 0.3),
        )

    each = [votes(t) for _, t in rows]
    prior, accuracy = 0.7, [0.8] * 8
    chance = lambda v: 1 / (1 + math.exp(-math.log(prior / (1 - prior)) - sum(x * math.log(a / (1 - a)) for x, a in zip(v, accuracy, strict=True))))
    for _ in range(weak_rules.STEPS):
        p = [chance(v) for _, v in each]
        right = [sum(q if v[k] == 1 else 1 - q for q, (_, v) in zip(p, each, strict=True) if v[k]) for k in range(8)]
        voted = [sum(v[k] != 0 for _, v in each) for k in range(8)]
        prior = min(0.95, max(0.05, sum(p) / len(p)))
        accuracy = [min(0.99, max(weak_rules.LEAST_ACCURACY, (r + 0.8 * weak_rules.PRIOR_VOTES) / (n + weak_rules.PRIOR_VOTES))) for r, n in zip(right, voted, strict=True)]
    wanted = sorted((str(d), failed, round(chance(v), 9), not failed and chance(v) >= 0.5) for (d, _), (failed, v) in zip(rows, each, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r["doc_id"]), r["base_failed"], round(r["p_good"], 9), r["kept"]) for r in weak_rules.judged(docs).collect())
    assert [(*a[:2], a[3]) for a in found] == [(*b[:2], b[3]) for b in wanted]
    assert [a[2] for a in found] == pytest.approx([b[2] for b in wanted], abs=1e-6)


def plain_language(model, text):
    """Words, their scores and the best path, one word at a time."""
    letters = lambda c: c.isalpha() and ord(c) < langid.CODES
    words = _runs(text or "", letters)
    if not words or not model.langs:
        return langid.UNKNOWN, 0.0
    script = lambda c: langid.SCRIPT_NAMES.index([s for start, s in zip(langid.SCRIPT_STARTS, langid.SCRIPTS, strict=True) if start <= ord(c)][-1])
    low = lambda c: ord(c.lower()) if len(c.lower()) == 1 else ord(c)
    table = []
    for w in words:
        codes = [0, *map(low, w), 0]
        score = [float(model.allowed[script(w[0])][k]) for k in range(len(model.langs))]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            mixed = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
            bucket = ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17
            score = [s + float(model.scores[k][bucket]) for k, s in enumerate(score)]
        table.append(score)
    langs = range(len(model.langs))
    best, back = table[0], []
    for score in table[1:]:
        top = max(langs, key=lambda k: (best[k], -k))
        came = [k if best[k] >= best[top] - langid.PENALTY else top for k in langs]
        back.append(came)
        best = [max(best[k], best[top] - langid.PENALTY) + score[k] for k in langs]
    label = [max(langs, key=lambda k: (best[k], -k))]
    for came in reversed(back):
        label.append(came[label[-1]])
    sizes = Counter()
    for w, k in zip(words, reversed(label), strict=True):
        sizes[k] += len(w)
    top = max(langs, key=lambda k: (sizes[k], -k))
    return model.langs[top], sizes[top] / sum(sizes.values())


def _runs(text, letters):
    out, own = [], ""
    for c in text + " ":
        if letters(c):
            own += c
        elif own:
            out.append(own)
            own = ""
    return out


def test_language_by_plain_viterbi(spark, sf_dir):
    table = read(spark, sf_dir, "documents")
    model = langid.fit(table)
    texts = {r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect() if len(r["text"] or "") < 3000}
    by_lang = {r["lang"]: r["text"][:400] for r in table.where("lang is not null and length(text) > 400").collect()}
    texts |= {2**53 + 1: " ".join(by_lang.values()), 2**60 + 3: None, 3**37: "12 !?", 3**36: "\U00030000\U00031234", 3**35: "İ ǅ ß漢字かな한국 слово"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_spans(docs, model).collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        lang, score = plain_language(model, text)
        assert found[doc][0] == lang and math.isclose(found[doc][1], score, abs_tol=1e-9), doc
    assert found[3**36][0] != "und"


def test_known_language(spark):
    rows = [(1, "some plain words in here", "en", "a"), (2, None, "en", "a"), (3, "12 34 !", None, "a"), (None, "some plain words in here", None, "b"), (4, "", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, own string")
    train = spark.createDataFrame([(i, "some plain words in here", "en") for i in range(9)], "doc_id long, text string, lang string")
    kept = langid.known_language(docs, langid.fit(train))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, rows[0][1], "en", "a"), (None, rows[0][1], "en", "b")]
    nothing = langid.fit(docs.limit(0))  # no language is known: texts with letters stay as they are
    assert sorted(map(tuple, langid.known_language(docs, nothing).collect()), key=str) == [(1, rows[0][1], "en", "a"), (None, rows[0][1], None, "b")]
    assert langid.known_language(docs.limit(0), nothing).count() == 0
