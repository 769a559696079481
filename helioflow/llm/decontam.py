"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size: class ``2^j`` holds items of up to that many shingles and more
than half of it. For each class a document is read through windows as long as its items, so that a
short item meets a set of its own size even inside a very long document; an item at containment
0.8 then has a Jaccard similarity of about 0.3 or more with some window. ``PERMUTATIONS`` minima
of one row each miss such a window with a probability below 0.001. Windows whose minimum equals
an item's are candidates; exact containment over the whole document decides. Items of one or two
shingles would be missed more often: their shingles are looked up directly, without windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import cut, parts, stored, strings, unused

SHINGLE = 5
THRESHOLD = 0.8
PERMUTATIONS = 24
#: Shingles of a block; windows begin at every block.
BLOCK = 4
#: Items of up to so many shingles are class ``EXACT``: each shingle is a key.
FEW = 2
EXACT = 0
#: Bits of the filter that goes to the tasks for each key of an item, and the filter's largest
#: size, as powers of two: 32 bits a key, 32 MB. Beyond that size more is emitted; joins decide.
KEY_BITS, MOST_BITS = 5, 28

_MULTIPLIERS = [xxhash.xxh64_intdigest(b"permutation", k) | 1 for k in range(PERMUTATIONS)]
_PLACES = [xxhash.xxh64_intdigest(b"place", k) | 1 for k in range(4)]


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's runs of five words (fewer words: one run; no word: none), repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for j in range(width):  # order matters: each place has a multiplier of its own
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[j : j + len(total)]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def size_class(n: int) -> int:
    """The smallest power of two, 4 at least, that is not below ``n``."""
    return max(BLOCK, 1 << (n - 1).bit_length())


def _key(size: int, k: int, values: np.ndarray) -> np.ndarray:
    """One long for class, permutation and minimum."""
    return (values ^ np.uint64(xxhash.xxh64_intdigest(f"{size}/{k}".encode()))).view(np.int64)


def _place(keys: np.ndarray, k: int, log: int) -> np.ndarray:
    """One of the bits, of 2 to the power of ``log``, that stand for each key."""
    return keys.view(np.uint64) * np.uint64(_PLACES[k]) >> np.uint64(64 - log)


class KeyFilter:
    """A Bloom filter of keys: may hold a key that isn't there, never lacks one."""

    def __init__(self, log: int, words: np.ndarray) -> None:
        self.log, self.words = log, words

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Where ``keys`` may be of the filter."""
        at = np.arange(len(keys))
        for k in range(len(_PLACES)):
            place = _place(keys if k == 0 else keys[at], k, self.log)
            has = self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)
            at = at[has.astype(bool)]
        return at


def key_filter(keys: DataFrame) -> KeyFilter:
    """Of a table's long column ``h``; made by a grouped sum of bits, and bounded in size."""
    log = min(MOST_BITS, max(10, keys.count().bit_length() + KEY_BITS))

    def places(h: pa.Array) -> pa.Array:
        own = h.to_numpy(zero_copy_only=False)
        each = np.stack([_place(own, k, log) for k in range(len(_PLACES))], axis=1).astype(np.int64).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(_PLACES)), pa.array(each))

    place = keys.select(F.explode(F.arrow_udf(places, "array<bigint>").asNondeterministic()("h")).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (log - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return KeyFilter(log, words)


def _item(texts: pa.Array) -> pa.Array:
    """Size class, keys and distinct shingles of each item; null for a text without words."""
    rows = []
    for text in strings(texts):
        found = np.unique(shingle_hashes(text))
        if not len(found):
            rows.append(None)
        elif len(found) <= FEW:
            rows.append({"size": EXACT, "keys": _key(EXACT, 0, found), "shingles": found.view(np.int64)})
        else:
            size = size_class(len(found))
            keys = np.concatenate([_key(size, k, (found * np.uint64(m)).min(keepdims=True)) for k, m in enumerate(_MULTIPLIERS)])
            rows.append({"size": size, "keys": keys, "shingles": found.view(np.int64)})
    longs = pa.list_(pa.int64())
    return pa.array(rows, pa.struct([("size", pa.int32()), ("keys", longs), ("shingles", longs)]))


def _scan(sizes: list[int], keys: KeyFilter, shingles: KeyFilter) -> Callable[[pa.Array], pa.Array]:
    """For texts: candidate keys, and if there are any, the shingles to verify; else null."""

    def windows(docs: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the document, keys) of every window whose minimum, or shingle that, may be an item's."""
        hashes = np.concatenate([h for _, h in docs])
        counts = np.array([-(-len(h) // BLOCK) for _, h in docs])
        owner = np.repeat(np.arange(len(docs)), counts)
        ends = np.cumsum([len(h) for _, h in docs])
        begins = ends - [len(h) for _, h in docs]
        first = np.cumsum(counts) - counts
        starts = begins[owner] + BLOCK * (np.arange(len(owner)) - first[owner])
        last = (first + counts)[owner]  # the end of the document's blocks
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        at = np.arange(len(owner))

        def ahead(values: np.ndarray, by: int) -> np.ndarray:
            moved = np.full_like(values, top)
            moved[: max(0, len(values) - by)] = values[by:]
            moved[at + by >= last] = top
            return moved

        if EXACT in sizes:
            found = _key(EXACT, 0, hashes)
            if len(hit := keys.hits(found)):
                yield np.searchsorted(ends, hit, "right"), found[hit]
        for k, m in enumerate(_MULTIPLIERS if max(sizes) > EXACT else []):
            one = np.minimum.reduceat(hashes * np.uint64(m), starts)
            run, width = one, 1
            for size in range(2, 1 + max(sizes).bit_length()):
                span = 1 << size
                while width < span // BLOCK:
                    run = np.minimum(run, ahead(run, width))
                    width *= 2
                if span not in sizes:
                    continue
                whole = np.minimum(run, ahead(one, width))
                found = _key(span, k, whole)
                if len(hit := keys.hits(found)):
                    yield owner[hit], found[hit]

    def scan(texts: pa.Array) -> pa.Array:
        out: list[dict | None] = []
        for part in parts(texts, 4_000_000):
            docs = [(at, h) for at, text in enumerate(part) if len(h := shingle_hashes(text))]
            own: dict[int, set[int]] = {}
            for at, found in windows(docs) if docs else ():
                for i, key in zip(at.tolist(), found.tolist(), strict=True):
                    own.setdefault(i, set()).add(key)
            rows: list[dict | None] = [None] * len(part)
            for i, found in own.items():
                at, h = docs[i]
                h = np.unique(h).view(np.int64)
                rows[at] = {"keys": list(found), "shingles": h[shingles.hits(h)]}
            out += rows
        return pa.array(out, pa.struct([("keys", pa.list_(pa.int64())), ("shingles", pa.list_(pa.int64()))]))

    return scan


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of document and test item with exact containment of ``threshold`` or more.

    Containment: the share of the item's distinct five-word shingles that occur anywhere in the
    whole document. Words are lower-cased (A-Z) and split on ASCII white space; an item of fewer
    words is one shingle, and so is a document. Returns ``doc_id, item_id, n_shared, n_shingles,
    containment``. Null or blank texts contain nothing and are in nothing; rows with a null id
    give no pair; rows with the same id are one document or item; other columns are not read.
    Empty input: no rows.
    """
    shape = "size int, keys array<bigint>, shingles array<bigint>"
    each = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.arrow_udf(_item, shape).asNondeterministic()(F.col("text").cast("string")).alias("x"))
    items = stored(each.where("item_id is not null and x is not null").select("item_id", "x.*"))
    probes = items.select("item_id", F.explode("keys").alias("h")).distinct()
    shingles = items.select("item_id", F.explode("shingles").alias("h")).distinct()
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # powers of two: a few dozen at most
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    if not sizes:
        plain = plain.limit(0)
    scan = _scan(sizes or [BLOCK], key_filter(probes.select("h").distinct()), key_filter(shingles.select("h").distinct()))
    met = plain.select("doc_id", F.arrow_udf(scan, "keys array<bigint>, shingles array<bigint>").asNondeterministic()("text").alias("x"))
    found = stored(met.where("x is not null").select("doc_id", "x.*"))
    candidates = found.select("doc_id", F.explode("keys").alias("h")).join(probes, "h").select("doc_id", "item_id").distinct()
    overlap = (
        found.select("doc_id", F.explode("shingles").alias("h")).distinct().join(shingles, "h").groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    )
    totals = shingles.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return (
        overlap.join(candidates, ["doc_id", "item_id"])
        .join(totals, "item_id")
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .where(F.col("containment") >= threshold)
        .select("doc_id", "item_id", "n_shared", "n_shingles", "containment")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain a test item.

    All rows with such an id go, since rows with one id are one document; rows without an id stay.
    All columns pass unchanged, whatever their names. Empty tables: nothing goes.
    """
    own = unused(docs.columns)
    bad = cut(contained_items(docs, benchmark, threshold).select(F.col("doc_id").alias(own)).distinct())
    return docs.join(bad, F.col("doc_id").cast("long") == F.col(own), "left_anti").select(*docs.columns)
