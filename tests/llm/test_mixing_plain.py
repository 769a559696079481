"""LM scores against a plain loop over the bits of each text."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from helioflow.llm import mixing
from helioflow.llm.common import read


def plain_codes(codes, words, escape):
    """log2-free cost of the codes of one text, bit by bit."""
    weights = {}
    for g in range(mixing.DEPTHS * mixing.STATES**2):
        s1, s2 = g // mixing.DEPTHS % mixing.STATES, g // mixing.DEPTHS // mixing.STATES
        weights[g] = [*mixing.START, mixing.START_1[s1], mixing.START_2[s2]]
    path = lambda w: [(int(codes.nodes[i]), int(codes.turns[i])) for i in range(codes.first[min(w, escape)], codes.first[min(w, escape)] + codes.length[min(w, escape)])]
    nodes = defaultdict(lambda: [0, 0])
    followed, streak = {}, Counter()
    cost, gradient = 0.0, defaultdict(lambda: [0.0] * 5)
    for t, w in enumerate(words):
        if t % mixing.BLOCK == 0:
            for g, step in gradient.items():
                weights[g] = [a + b for a, b in zip(weights[g], step, strict=True)]
            gradient.clear()
        one, two = (words[t - 1] if t else -1), (words[t - 2] if t > 1 else -1)
        contexts = [(1, one), (2, one, two)]
        known = [followed.get(c) for c in contexts]
        state = [0 if k is None else 1 + min(streak[c], mixing.STATES - 2) for k, c in zip(known, contexts, strict=True)]
        foretold = [path(k) if k is not None else [] for k in known]
        with_path = [k is not None for k in known]
        for d, (node, bit) in enumerate(path(w)):
            p = 1 / (1 + math.exp(-float(codes.odds[node])))
            zero, ones = nodes[node]
            x = [float(codes.odds[node])] + [math.log((ones + k * p) / (zero + k * (1 - p))) for k in mixing.PRIORS]
            gate = min(d // 4, mixing.DEPTHS - 1)
            for c in (0, 1):
                x.append((1 if foretold[c][d][1] else -1) if with_path[c] else 0)
                gate += state[c] * mixing.DEPTHS * mixing.STATES**c if with_path[c] else 0
            z = sum(a * b for a, b in zip(weights[gate], x, strict=True))
            q = 1 / (1 + math.exp(-z))
            cost += math.log(q if bit else 1 - q)
            for j in range(5):
                gradient[gate][j] += mixing.TEXT_RATE * (bit - q) * x[j]
            nodes[node][bit] += 1
            with_path = [a and foretold[c][d][1] == bit for c, a in enumerate(with_path)]
        for c, k in zip(contexts, known, strict=True):
            streak[c] = streak[c] + 1 if k == w else 0
            followed[c] = w
    return cost


def plain_repeats(words):
    cost, seen, again = 0.0, Counter(), 0
    for t, w in enumerate(words):
        p = (again + 0.2) / (t + 2)
        if seen[w]:
            cost += math.log(p) + math.log(seen[w] / t)
            again += 1
        elif t:
            cost += math.log(1 - p)
        seen[w] += 1
    return cost


@pytest.mark.parametrize("head", [mixing.HEAD_WORDS, 300])
def test_scores_follow_the_bits(spark, sf_dir, monkeypatch, head):
    monkeypatch.setattr(mixing, "HEAD_WORDS", head)
    rows = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 20_000][:120] + [(2**53 + 1, None), (None, "a b a b a b zzz a b zzz qq zzz"), (2**60 + 3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where("doc_id is null or crc32(cast(doc_id as string)) % 7 <> 2")
    corpus = mixing.fit(mixing.vocabulary(train))
    counts = Counter(w for r in train.collect() for w in mixing.tokens(r["text"]))
    assert len(corpus.head) <= head
    escape = len(corpus.head)
    found = {r["doc_id"]: r["score"] for r in mixing.scores(docs).collect()}
    for doc, text in rows:
        own = mixing.tokens(text)
        numbers, others = {}, []
        for w in own:
            numbers.setdefault(w, corpus.head.get(w, escape + len(numbers)))
        words = [numbers[w] for w in own]
        others = [w for w in own if w not in corpus.head]
        cost = plain_codes(corpus.codes, words, escape) + plain_repeats(others)
        new = sorted(set(others))
        if new:
            cost += corpus.new_word(np.array([counts[w] for w in new], float), corpus.speller.chances(new)).sum()
        assert math.isclose(found[doc], cost / math.log(10), rel_tol=1e-4, abs_tol=1e-4), doc


def test_order_counts():
    """Words in an order met before cost less than the same words in another."""
    codes = mixing.prefix_codes(np.array([5, 4, 3, 3, 2, 2, 1, 1, 6]))
    again = np.array([0, 1, 2, 3, 4, 5] * 8)
    other = np.array(sum((np.random.default_rng(k).permutation(6).tolist() for k in range(8)), []))
    costs = mixing.code_costs(codes, np.concatenate([again, other]), np.repeat([0, 1], len(again)), 2)
    assert costs[0] > 0.6 * costs[1]
    alone = mixing.code_costs(codes, other, np.zeros(len(other), int), 1)
    assert math.isclose(alone[0], costs[1], rel_tol=1e-5)


def test_prefix_codes():
    rng = np.random.default_rng(7)
    for counts in (rng.integers(1, 1000, 50), np.array([1]), np.array([3, 3]), 2 ** np.arange(40), np.ones(33, int)):
        codes = mixing.prefix_codes(counts)
        assert len(counts) == 1 or math.isclose(sum(2.0 ** -codes.length), 1)
        weight = np.maximum(counts, max(1.0, counts.sum() / 2**30))
        heap = list(weight.astype(float))
        heapq.heapify(heap)
        best = 0.0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            best += both
            heapq.heappush(heap, both)
        assert math.isclose((weight * codes.length).sum(), best)
        seen = {tuple(codes.turns[f : f + n]) for f, n in zip(codes.first, codes.length, strict=True)}
        assert len(seen) == len(counts) and codes.length.max(initial=0) <= mixing.CODE_BITS


def test_chances_of_the_next_word_add_up():
    """After any beginning, the next words' chances, the escape's included, add up to one."""
    codes = mixing.prefix_codes(np.array([9, 7, 5, 3, 2, 1, 4]))
    begin = [0, 1, 0, 1, 2, 6, 0, 1, 0]
    total = 0.0
    for w in range(7):
        texts = [begin, [*begin, w]]
        costs = mixing.code_costs(codes, np.array(sum(texts, [])), np.repeat([0, 1], [len(t) for t in texts]), 2)
        total += math.exp(costs[1] - costs[0])
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_batches_and_partitions_change_nothing(spark, sf_dir, monkeypatch):
    """What the mixer learns depends on the words alone."""
    docs = read(spark, sf_dir, "documents")
    monkeypatch.setattr(mixing, "LEARNT_TOGETHER", 2000)
    found = []
    for batch, parts in (("10000", 4), ("300", 13)):
        with_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            found.append({r["doc_id"]: r["score"] for r in mixing.scores(docs.repartition(parts)).collect()})
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_batch)
    assert max(abs(found[0][k] - v) / max(1.0, abs(v)) for k, v in found[1].items()) < 1e-5
