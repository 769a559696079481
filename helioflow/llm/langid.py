"""Language identification of mixed text: scripts, per-word scores, Viterbi with a switching penalty.

Each word's script narrows the languages that it may be in; hashed character trigrams score the word
in each of them; a Viterbi pass over the words, in which a change of language costs ``PENALTY``,
labels spans. A document's language is the one with the most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import held_out, parts, slices, unused, within_share

#: About so many documents of each language are learnt from, picked by a hash of their id.
TRAIN_DOCS = 1_500
BUCKETS = 1 << 15
#: Natural logarithms: the cost of a change of language between two words.
PENALTY = 8.0
#: A script belongs to a language if at least this share of the language's letters are in it.
SCRIPT_SHARE = 0.02
#: Bytes of text that a worker labels at a time, to bound its memory.
PART = 250_000
#: The languages with the most documents that are learnt, if there are more.
MAX_LANGS = 250
UNKNOWN = "und"
#: A document's language is known if at least this share of its letters are in it.
LEAST_SHARE = 0.4
#: No letter has a code point from here on.
CODES = 0x33000
#: First code points of Unicode ranges (fixed values), and the script of each range.
SCRIPT_STARTS = [
    0x0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00, 0xA80, 0xB00, 0xB80, 0xC00, 0xC80, 0xD00, 0xD80, 0xE00,
    0xE80, 0xF00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1400, 0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400,
    0xA000, 0xAC00, 0xD800, 0x20000,
]
SCRIPTS = [
    "latin", "other", "greek", "cyrillic", "armenian", "hebrew", "arabic", "other", "devanagari", "bengali", "gurmukhi", "gujarati", "oriya", "tamil",
    "telugu", "kannada", "malayalam", "sinhala", "thai", "lao", "tibetan", "burmese", "georgian", "hangul", "ethiopic", "other", "khmer", "mongolian",
    "latin", "greek", "other", "kana", "kana", "other", "han", "other", "hangul", "other", "han",
]
SCRIPT_NAMES = sorted(set(SCRIPTS))

_tables: dict[str, np.ndarray] = {}


def _lookup() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case (of one code point), its script."""
    if not _tables:
        every = [chr(c) for c in range(CODES)]
        _tables["letter"] = np.array([c.isalpha() for c in every])
        _tables["lower"] = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in every], np.uint32)
        ranges = np.searchsorted(SCRIPT_STARTS, np.arange(CODES), "right") - 1
        _tables["script"] = np.array([SCRIPT_NAMES.index(s) for s in SCRIPTS], np.uint8)[ranges]
    return _tables["letter"], _tables["lower"], _tables["script"]


@dataclass
class Words:
    """The words of a batch: runs of letters. Places are code points in the batch's joined text."""

    doc: np.ndarray  # the row of each word
    start: np.ndarray
    size: np.ndarray
    script: np.ndarray
    letters: np.ndarray  # trigram bucket of each letter
    first: np.ndarray  # each word's first place in letters
    base: np.ndarray  # where each row's text begins


def words_of(texts: list[str]) -> Words:
    letter, lower, script = _lookup()
    joined = "\n".join(texts) + "\n"
    points = np.minimum(np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32), CODES - 1)
    is_letter = letter[points]
    chars = np.where(is_letter, lower[points], 0).astype(np.uint32)
    at = np.flatnonzero(is_letter)
    before = np.where(at > 0, chars[at - 1], 0)
    mixed = before * np.uint32(0x9E3779B1) ^ chars[at] * np.uint32(0x85EBCA77) ^ chars[at + 1] * np.uint32(0xC2B2AE3D)
    buckets = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)
    first = np.flatnonzero(before == 0)
    sizes = np.diff(np.append(first, len(at)))
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    ends = np.cumsum(lengths)
    start = at[first]
    return Words(np.searchsorted(ends, start, "right"), start, sizes, script[points[start]], buckets, first, ends - lengths)


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # languages x buckets, log probabilities
    allowed: np.ndarray  # scripts x languages, 0 or a large negative number


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from at most about ``train_docs`` rows of each language; text and lang only.

    What comes to the driver is bounded: a share, buckets and scripts for each language. The
    sample is taken where the texts are read, so that no text is shuffled.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out("doc_id", 4))
    most = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    sizes = {r["lang"]: r["n"] for r in most.collect()}
    shares = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_docs / n))))
    share = shares[F.col("lang")] if sizes else F.lit(0.0)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in slices(frames, "text", PART):
            for lang, own in rows.groupby("lang"):
                words = words_of(own["text"].tolist())
                for kind, n in (("gram", np.bincount(words.letters, minlength=BUCKETS)), ("script", np.bincount(words.script, words.size))):
                    slots = np.flatnonzero(n)
                    yield pd.DataFrame({"lang": lang, "kind": kind, "slot": slots, "n": n[slots].astype(np.int64)})

    sample = known.where(within_share(share, "doc_id")).select("lang", "text")
    counts = (
        sample.mapInPandas(counted, "lang string, kind string, slot int, n long").groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas()
    )
    langs = sorted(counts["lang"].unique())
    grams = np.zeros((len(langs), BUCKETS))
    scripts = np.zeros((len(SCRIPT_NAMES), len(langs)))
    for k, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        for kind, table in (("gram", grams[k]), ("script", scripts[:, k])):
            part = own[own["kind"] == kind]
            table[part["slot"].to_numpy()] = part["n"].to_numpy()
    scores = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * BUCKETS))
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    uses |= ~uses.any(1, keepdims=True)  # a script of no language narrows nothing
    return Model(langs, scores.astype(np.float32), np.where(uses, 0, -1e4).astype(np.float32))


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word. ``scores``: words x languages, of sequences one after another
    with ``counts`` words. All sequences advance together, longest first."""
    n, m = scores.shape
    begin = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    begin, counts = begin[order], counts[order]
    alive = np.searchsorted(-counts, -np.arange(1, (counts.max() if len(counts) else 0) + 1), "right")
    best = np.zeros((len(counts), m), np.float32)
    came = np.zeros((n, m), np.uint8)
    own = np.arange(m, dtype=np.uint8)
    for t, k in enumerate(alive):
        now = best[:k]
        top = now.argmax(1)
        switched = now[np.arange(k), top][:, None] - (penalty if t else 0)
        at = begin[:k] + t
        stay = now >= switched
        came[at] = np.where(stay, own, top[:, None].astype(np.uint8))
        best[:k] = np.maximum(now, switched) + scores[at]
    label = best.argmax(1)
    out = np.zeros(n, np.uint8)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        out[at] = label[:k]
        label[:k] = came[at, label[:k]]
    return out


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, its share of the letters, spans) of each text; a span: first place, end, language."""
    words = words_of([t or "" for t in texts])
    n = len(texts)
    if not len(words.first) or not model.langs:
        return [(UNKNOWN, 0.0, [])] * n
    scores = np.stack([np.add.reduceat(s[words.letters], words.first) for s in model.scores], axis=1)
    scores += model.allowed[words.script]
    label = viterbi(scores, np.bincount(words.doc, minlength=n))
    sizes = np.zeros((n, len(model.langs)))
    np.add.at(sizes, (words.doc, label), words.size)
    total = sizes.sum(1)
    best = sizes.argmax(1)
    fresh = np.flatnonzero(np.append(True, (np.diff(words.doc) != 0) | (np.diff(label) != 0)))
    last = np.append(fresh[1:], len(label)) - 1
    spans: list[list[tuple[int, int, str]]] = [[] for _ in range(n)]
    for i, j in zip(fresh, last, strict=True):
        d = words.doc[i]
        begin = words.base[d]
        spans[d].append((int(words.start[i] - begin), int(words.start[j] + words.size[j] - begin), model.langs[label[i]]))
    return [(model.langs[best[d]], float(sizes[d, best[d]] / total[d]), spans[d]) if total[d] else (UNKNOWN, 0.0, []) for d in range(n)]


def language_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for every row of ``docs``, from its whole text alone.

    ``score`` is the share of the letters that are in ``lang_pred``; ``spans`` an array of
    ``start, end, lang`` in code points. A null text, or one without letters: ``und``, 0 and no
    span; so are all if there was nothing to learn from. Equal shares: the first language in
    order. Repeated rows and null ids keep their rows. Empty input: no rows. Other columns are
    not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def labelled(texts: pa.Array) -> pa.Array:
        found = [x for part in parts(texts, PART) for x in predict(shared.value, part)]
        spans = [[{"start": a, "end": b, "lang": lang} for a, b, lang in x[2]] for x in found]
        columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(spans, pa.list_(span))]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "spans"])

    # Not to be run again for each field that is read.
    label = F.arrow_udf(labelled, "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>").asNondeterministic()
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), label(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", "found.*")


def known_language(docs: DataFrame, model: Model, least_share: float = LEAST_SHARE) -> DataFrame:
    """``docs`` without the rows that have no language, and with ``lang`` set where it was null.

    A row stays if at least ``least_share`` of its letters are in one language; null texts and
    texts without letters go. If there was nothing to learn from, all texts with a letter stay and
    ``lang`` is left alone. Each row is judged by its own text, repeated rows alike; all other
    columns pass unchanged, whatever their names. Empty input: no rows. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(texts: pa.Array) -> pa.Array:
        langs: list[str | None] = []
        for part in parts(texts, PART):
            if shared.value.langs:
                langs += [lang if lang != UNKNOWN and share >= least_share else None for lang, share, _ in predict(shared.value, part)]
            else:
                letters = np.bincount((words := words_of([t or "" for t in part])).doc, words.size, len(part))
                langs += [UNKNOWN if n else None for n in letters]
        return pa.array(langs, pa.string())

    own = unused(docs.columns)
    found = docs.withColumn(own, F.arrow_udf(judged, "string").asNondeterministic()(F.col("text").cast("string"))).where(F.col(own).isNotNull())
    lang = F.coalesce(F.col("lang"), F.when(F.col(own) != UNKNOWN, F.col(own)))
    return found.withColumn("lang", lang).drop(own)
