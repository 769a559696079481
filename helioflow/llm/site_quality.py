"""Document quality by hierarchical empirical Bayes: classifier evidence, host and path posteriors.

A logistic classifier on a few style measures and learnt word evidence gives each document a
probability of good quality and one of toxicity. For each host, and each path under a host, the
documents' probabilities are summed; a host's posterior mean shrinks toward the global mean, a
path's toward its host's, with strengths found by the method of moments. A document's evidence is
then moved by the log odds of its path against the global ones, its own share left out, so that
sparse sites change nothing.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import parts, stored, within_share

#: The classifiers are fit on about so many labelled documents, picked by a hash of their id.
LABEL_SAMPLE = 8_000
BUCKETS = 1 << 16
TARGETS = ("good", "toxic")
#: A word is evidence if its log-likelihood ratio is above this.
LEAST_RATIO = 20.0
EXTRA = 3  # word evidence: sum of the signs against, sum for, the strongest for, of each target
STYLE = 11


def _words(text: str) -> Counter[str]:
    return Counter(text.lower().split())


def _bucket(word: str) -> int:
    return zlib.crc32(word.strip(".,;:!?\"'()").encode("utf-8", "replace")) & (BUCKETS - 1)


def style(text: str, words: Counter[str]) -> list[float]:
    """Measures that don't depend on a language, each in a small range."""
    n, chars = sum(words.values()), len(text)
    if not n:
        return [0.0] * STYLE
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(map(text.count, "#*$%&|<>"))
    return [
        min(3.0, np.log10(n + 1)), min(1.0, symbols / n), len(words) / n, max(words.values()) / n, 1 - len(set(lines)) / len(lines),
        min(1.0, sum(map(text.count, "!?")) / n), sum(map(str.isupper, text)) / chars, min(1.0, sum(map(text.count, "0123456789")) / chars),
        min(3.0, sum(map(len, words)) / len(words) / 8), float(n < 50), min(1.0, text.count("|") / n),
    ]


@dataclass
class Classifier:
    """``evidence``: targets x buckets, a word's log odds where it is significant, else 0; ``weights``: targets x measures."""

    evidence: np.ndarray
    weights: np.ndarray | None = None

    def measures(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(TARGETS) * EXTRA + STYLE + 1))
        for row, text in zip(out, texts, strict=True):
            words = _words(text)
            if words:
                odds = self.evidence[:, np.fromiter({_bucket(w) for w in words}, np.int64)]
                row[: len(TARGETS) * EXTRA] = np.concatenate([np.minimum(odds, 0).sum(1) / 10, np.maximum(odds, 0).sum(1) / 10, odds.max(1, initial=0) / 4]).clip(-3, 3)
            row[len(TARGETS) * EXTRA : -1] = style(text, words)
            row[-1] = 1
        return out

    def chances(self, texts: list[str]) -> np.ndarray:
        """texts x targets."""
        return 1 / (1 + np.exp(-np.clip(self.measures(texts) @ self.weights.T, -12, 12)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = LABEL_SAMPLE) -> Classifier:
    """Fit on a bounded sample of the labelled documents; rows without text or a label are left out.

    The driver gets counts by bucket and the sample's measures, a few numbers a document.
    """
    usable = labels.select("doc_id", *(F.col(c).cast("int").alias(c) for c in ("quality", "toxic"))).dropna()
    picked = usable.where(within_share(min(1.0, sample_docs / max(1, usable.count())), "doc_id"))
    # `picked` holds about sample_docs rows of three numbers, whatever the size of the tables.
    sample = stored(docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(picked), "doc_id"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((4, BUCKETS + 1), np.int64)
        for rows in frames:
            for text, quality, toxic in zip(rows["text"], rows["quality"], rows["toxic"], strict=True):
                own = np.fromiter({BUCKETS, *map(_bucket, _words(text))}, np.int64)
                n[int(quality > 0), own] += 1
                n[2 + int(toxic > 0), own] += 1
        used = np.flatnonzero(n.any(0))
        yield pd.DataFrame({"slot": used, **{f"n{k}": n[k, used] for k in range(4)}})

    columns = [f"n{k}" for k in range(4)]
    counts = sample.mapInPandas(counted, "slot int, " + ", ".join(f"{c} long" for c in columns)).groupBy("slot").agg(*(F.sum(c).alias(c) for c in columns)).toPandas()
    n = np.zeros((4, BUCKETS + 1))
    n[:, counts["slot"].to_numpy()] = counts[columns].to_numpy().T
    evidence = []
    for no, yes in ((n[0], n[1]), (n[2], n[3])):
        total_no, total_yes = max(no[-1], 1), max(yes[-1], 1)
        odds = np.log((yes + 0.5) / (total_yes + 1)) - np.log((no + 0.5) / (total_no + 1))
        both = np.maximum(yes + no, 1)
        expected = both * total_yes / (total_yes + total_no), both * total_no / (total_yes + total_no)
        ratio = 2 * sum(n * np.log(np.maximum(n, 1e-9) / e) for n, e in zip((yes, no), expected, strict=True))
        evidence.append(np.where(ratio > LEAST_RATIO, odds, 0)[:-1])
    model = Classifier(np.array(evidence))

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            yield pd.DataFrame({"x": list(model.measures(rows["text"].tolist())), "quality": rows["quality"], "toxic": rows["toxic"]})

    found = sample.mapInPandas(measured, "x array<double>, quality int, toxic int").toPandas()
    x = np.array(found["x"].tolist()).reshape(-1, len(TARGETS) * EXTRA + STYLE + 1)
    model.weights = np.stack([_logistic(x, (found[c] > 0).to_numpy(float)) for c in ("quality", "toxic")])
    return model


def evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, host, path, good, toxic`` for every row that has ``doc_id, host, path, text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: pa.Array) -> pa.Array:
        found = [shared.value.chances([t or "" for t in part]) for part in parts(texts)]
        p = np.concatenate(found) if found else np.zeros((0, len(TARGETS)))
        return pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(len(TARGETS))], names=list(TARGETS))

    # Not to be run again for each field that is read.
    chances = F.arrow_udf(scored, "good double, toxic double").asNondeterministic()
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("host", "path")), chances(F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", "host", "path", "p.good", "p.toxic")


def _strength(groups: DataFrame, n: str, total: str, mean: str | float) -> float:
    """By the method of moments: how many documents a prior is worth, from the spread of group means."""
    m = F.col(mean) if isinstance(mean, str) else F.lit(mean)
    row = groups.where(F.col(n) > 1).agg(
        F.sum(F.col(n) * F.pow(F.col(total) / F.col(n) - m, 2)).alias("between"), F.count("*").alias("groups"), F.sum(n).alias("n"), F.sum(F.col(n) * m * (1 - m)).alias("binomial")
    ).first()
    if not row["groups"] or not row["n"]:
        return 1e6
    excess = (row["between"] - row["groups"] * row["binomial"] / row["n"]) / row["n"]
    return 1e6 if excess <= 0 else min(1e6, max(1.0, row["binomial"] / row["n"] / excess - 1))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def posteriors(parts: DataFrame) -> DataFrame:
    """Combine evidence (stored, from ``evidence``) with host and path posteriors."""
    paths = parts.groupBy("host", "path").agg(F.count("*").alias("n"), *(F.sum(t).alias(t) for t in TARGETS))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *(F.sum(t).alias(f"host_{t}") for t in TARGETS))
    every = parts.agg(F.count("*").alias("n"), *(F.sum(t).alias(t) for t in TARGETS)).first()
    sites = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    out = parts.join(sites.withColumnsRenamed({"host": "h", "path": "p", "good": "sum_good", "toxic": "sum_toxic"}), F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    columns = []
    for t in TARGETS:
        mean = min(1 - 1e-6, max(1e-6, (every[t] or 0) / max(1, every["n"])))
        host_k = _strength(hosts, "host_n", f"host_{t}", mean)
        shrunk = (F.col(f"host_{t}") + host_k * mean) / (F.col("host_n") + host_k)
        path_k = _strength(sites.withColumn("shrunk", shrunk), "n", t, "shrunk")
        host = (F.col(f"host_{t}") - F.col(t) + host_k * mean) / (F.col("host_n") - 1 + host_k)
        path = (F.col(f"sum_{t}") - F.col(t) + path_k * host) / (F.col("n") - 1 + path_k)
        z = _logit(F.col(t)) + _logit(path) - _logit(F.lit(mean))
        columns += [host.alias(f"{t}_host"), path.alias(f"{t}_path"), (1 / (1 + F.exp(-z))).alias(f"p_{t}")]
    return out.select("doc_id", "host", "path", F.col("good").alias("doc_good"), F.col("toxic").alias("doc_toxic"), *columns)


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, least_good: float = 0.5, most_toxic: float = 0.5) -> DataFrame:
    """``doc_id, host, path``, the evidence, the shrunk host and path means, ``p_good, p_toxic, kept``
    for every row of ``docs``.

    Null text counts as empty, a null host or path is a site of its own, rows with a repeated or
    null id keep their rows. No labels: all evidence is even. Empty input: no rows. Other columns
    are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    parts = stored(evidence(plain, fit(plain, labels)))
    kept = (F.col("p_good") >= least_good) & (F.col("p_toxic") < most_toxic)
    return posteriors(parts).withColumn("kept", kept)
