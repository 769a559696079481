"""SimHash near-duplicates: fingerprints, and meet-in-the-middle ball hashing to link them.

Two fingerprints link at ``RADIUS`` (3) or fewer differing bits. Everything works on distinct
fingerprints, so copies cost nothing, and the links that meet in one bucket form a star, so a
bucket of n fingerprints gives n edges, not n squared.

1. Screen. Of two fingerprints within 3 bits, one 32-bit half is within 1 bit, half the radius.
   Each fingerprint emits, for both halves, all 33 variants of that half; it stays if its own
   half is also a variant of another fingerprint. This only removes the isolated ones.
2. Balls. The rest emit 64-bit variants, shuffled on the variant. Distances 1 and 3 join odd to
   even bit counts, so only odd ones emit two-bit variants; and of three bits two lie in the
   same half, so two-bit variants stay within a half, and the screen must have met the fingerprint's
   other half, which is then within 1 bit. Members within one bit of a variant are
   within 2 of each other, and within 3 of members two bits away: all link to the smallest of
   the former, with no loss and no false link.
3. Components of these stars.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.llm.common import cut, strings, unused
from helioflow.llm.components import connected_components

RADIUS = 3
SHINGLE = 3


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a text's 3-word shingles, repeats included; 0 if no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    n = len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, n)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprint(text: Column) -> Column:
    """The 64 bits as a signed long; only the text goes through Python."""

    def found(texts: pa.Array) -> pa.Array:
        return pa.array(np.fromiter(map(fingerprint, strings(texts)), np.uint64, len(texts)).view(np.int64))

    return F.arrow_udf(found, "long")(text.cast("string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``, a row for each row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _fingerprint(F.col("text")).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _variants(fingerprints: DataFrame, masks: list[int], close: bool) -> DataFrame:
    """Each fingerprint under each mask."""
    each = fingerprints.select("fp", F.explode(F.lit(masks)).alias("mask"))
    return each.select("fp", F.lit(close).alias("close"), F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))


def near_links(distinct_fp: DataFrame) -> DataFrame:
    """Star edges ``a, b`` that connect exactly the fingerprints within 3 bits of each other."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    upper = F.lit(1 << 32)
    flips = F.lit([0] + [1 << i for i in range(32)])
    variants = F.concat(
        F.transform(flips, lambda m: low.bitwiseXOR(m.cast("long"))),
        F.transform(flips, lambda m: high.bitwiseXOR(m.cast("long")) + upper),
    )
    met = distinct_fp.select(F.explode(variants).alias("key")).groupBy("key").count().where("count > 1").select("key")
    own = distinct_fp.select("fp", F.explode(F.array(low, high + upper)).alias("key")).join(met, "key")
    near = cut(own.groupBy("fp").agg(F.bool_or(F.col("key") < upper).alias("low_met"), F.bool_or(F.col("key") >= upper).alias("high_met")))
    ones = [_signed(1 << i) for i in range(64)]
    low_twos, high_twos = ([_signed(1 << i | 1 << j) for i, j in combinations(half, 2)] for half in (range(32), range(32, 64)))
    odd = near.where("bit_count(fp) % 2 = 1")
    balls = _variants(near, [0, *ones], True)
    balls = balls.unionByName(_variants(odd.where("high_met"), low_twos, False)).unionByName(_variants(odd.where("low_met"), high_twos, False))
    hub = F.min(F.when(F.col("close"), F.col("fp"))).over(Window.partitionBy("variant"))
    return balls.select(F.col("fp").alias("a"), hub.alias("b")).where("a <> b").distinct()


def _rooted(first: DataFrame) -> DataFrame:
    """``first``, a row for each distinct ``fp``, with the ``root`` of its component."""
    comps = connected_components(near_links(first.select("fp")))
    # A fingerprint without links is its own component.
    return first.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(*first.columns, F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest doc_id that links
    reach, the row's own included. Null, empty and blank texts have fingerprint zero and link
    like any other. Rows with a null doc_id keep their row and count for links; the component is
    null only if no row in it has an id. Repeated rows stay repeated. Empty input: no rows. Other
    columns of ``docs`` are not read.
    """
    prints = cut(fingerprints(docs))
    first = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    rooted = _rooted(first)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = cut(rooted.join(least, "root").select("fp", "component_id"))
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the smallest doc_id.

    Rows with a null doc_id come after those with one. Ties (equal doc_id), and components without
    any id, keep the row with the smallest hash of its text; rows equal in both are copies of which
    one stays. All columns pass unchanged.
    """
    names = docs.columns
    none, number, hashed = own = [unused(names, like) for like in ("none", "number", "hashed")]
    ids, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    marked = docs.withColumns({none: ids.isNull(), number: F.coalesce(ids, F.lit(0)), hashed: F.xxhash64(text)})
    prints = cut(marked.select(*own, _fingerprint(text).alias("fp")))
    first = cut(prints.groupBy("fp").agg(F.min(F.struct(*own)).alias("first")))
    kept = cut(_rooted(first).groupBy("root").agg(F.min("first").alias("first")).select("first.*"))
    repeated = cut(prints.groupBy(*own).count().where("count > 1").select(*own).join(kept, own, "left_semi"))
    if repeated.isEmpty():
        return marked.join(kept, own, "left_semi").select(*names)
    single = marked.join(kept.join(repeated, own, "left_anti"), own, "left_semi")
    several = marked.join(repeated, own, "left_semi").dropDuplicates(own)
    return single.unionByName(several).select(*names)
