"""Hard negatives by bounds along spanning trees of anchors.

For unit or other vectors, the score of a candidate x with an anchor c differs from that with another anchor
p by <c - p, x>, which is |c - p| times |x| at most. Anchors are put into blocks of at most ``BLOCK``, like
with like; a block has a minimum spanning tree. A task meets one block of anchors and one of candidates: the
root's scores are computed, and down the tree each anchor's scores are bounded from its parent's scores or
bounds. Only candidates whose bounds overlap the window that the anchor still needs are scored.

1. Positives: candidates of the anchor's label, whose window is open above and begins at the least of the
   best ``n_positives`` met so far.
2. Negatives: candidates of other labels; the positives' scores give the windows.

A block of anchors is sent to each block of candidates, so that the table of candidates moves
once; what comes back is a few rows for each anchor and task, of which windows keep the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.llm.common import stored

#: Anchors of a tree, anchors that go to a task, and candidates that go there.
BLOCK, ANCHORS, CANDIDATES = 256, 4096, 4096
#: Where more than this share of the candidates overlaps, all are scored by one matrix product.
DENSE = 0.2


def spanning_tree(points: np.ndarray) -> list[tuple[int, int, float]]:
    """A minimum spanning tree as ``(node, parent, length)`` from the root, node 0 (parent -1), on; parents come first."""
    n = len(points)
    square = (points * points).sum(axis=1)
    nearest, parent, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    tree, at = [], 0
    nearest[0] = 0.0
    for _ in range(n):
        at = int(np.argmin(np.where(left, nearest, np.inf)))
        left[at] = False
        tree.append((at, int(parent[at]), float(np.linalg.norm(points[at] - points[parent[at]])) if parent[at] >= 0 else 0.0))
        far = np.sqrt(np.maximum(square + square[at] - 2 * (points @ points[at]), 0))
        closer = left & (far < nearest)
        nearest[closer], parent[closer] = far[closer], at
    return tree


def windowed(
    anchors: np.ndarray, tree: list[tuple[int, int, float]], cands: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor ``(anchor, places, scores)``: the candidates that may score within [low, high], and their scores.

    ``low`` is read when its anchor's turn comes, so a caller may raise it meanwhile.
    """
    size = np.sqrt((cands * cands).sum(axis=1)) * (1 + 1e-9)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(anchors))
    sample = slice(None, None, max(1, len(cands) // 64))
    for node, parent, length in tree:
        places, dense = None, parent < 0
        if not dense:
            below, above = bounds[parent]
            reach = length * size
            near = (above[sample] + reach[sample] >= low[node]) & (below[sample] - reach[sample] <= high[node])
            dense = near.mean() > DENSE
        if dense:
            scores = cands @ anchors[node]
            own = (scores, scores)
            places = np.flatnonzero((scores >= low[node]) & (scores <= high[node]))
            found = scores[places]
        else:
            below, above = below - reach - 1e-6, above + reach + 1e-6
            places = np.flatnonzero((above >= low[node]) & (below <= high[node]))
            found = cands[places] @ anchors[node]
            below[places] = above[places] = found
            own = (below, above)
        if children[node]:
            bounds[node] = own
        if parent >= 0:
            children[parent] -= 1
            if not children[parent]:
                del bounds[parent]
        yield node, places, found


def _whole(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """The places of the first ``n`` by score, then smaller id."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        kept = np.flatnonzero(scores >= least)
        return kept[np.lexsort((ids[kept], -scores[kept]))[:n]]
    return np.lexsort((ids, -scores))[:n]


def _trees(rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """Each block of anchors of a task with the candidates of its dimension."""
    for _, same in rows.groupby("dim", sort=False):
        cands = same[~same["anchor"]]
        if cands.empty:
            continue
        for _, own in same[same["anchor"]].groupby("block", sort=False):
            yield own.reset_index(drop=True), cands


def _positives(rows: pd.DataFrame, n: int) -> Iterator[tuple[int, int, int]]:
    """``anchor_id, positive_id, score`` of anchors and candidates of one label."""
    for own, near in _trees(rows):
        points, cands, ids, names = _whole(own["q"]), _whole(near["q"]), near["id"].to_numpy(), own["id"].to_numpy()
        tree, low, high = spanning_tree(points), np.full(len(points), -np.inf), np.full(len(points), np.inf)
        # The first candidates give a threshold, so that bounds can cut the others.
        for at, places, scores in windowed(points, tree, cands[: 16 * n], low, high):
            scores = scores[ids[places] != names[at]]
            if len(scores) >= n:
                low[at] = np.partition(scores, len(scores) - n)[len(scores) - n]
        for at, places, scores in windowed(points, tree, cands, low, high):
            other = ids[places] != names[at]
            places, scores = places[other], scores[other]
            for k in _best(ids[places], scores, n):
                yield int(names[at]), int(ids[places[k]]), int(scores[k])


def _negatives(rows: pd.DataFrame, n: int, share: tuple[int, int]) -> Iterator[tuple[int, int, int, int, int]]:
    """``anchor_id, positive_id, negative_id, positive_score, negative_score`` of one pair of blocks."""
    for own, x in _trees(rows):
        points, cands, ids, labels = _whole(own["q"]), _whole(x["q"]), x["id"].to_numpy(), x["label"].to_numpy()
        lows = [-(-share[0] * np.asarray(s, np.int64) // 100) for s in own["scores"]]
        highs = [share[1] * np.asarray(s, np.int64) // 100 for s in own["scores"]]
        low, high = (np.array([f(v) for v in both], np.float64) for f, both in ((min, lows), (max, highs)))
        for at, places, scores in windowed(points, spanning_tree(points), cands, low, high):
            other = labels[places] != own.at[at, "label"]
            places, scores = places[other], scores[other]
            for positive, score, least, most in zip(own.at[at, "positives"], own.at[at, "scores"], lows[at], highs[at], strict=True):
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                for k in _best(ids[places[inside]], scores[inside], n):
                    yield int(own.at[at, "id"]), int(positive), int(ids[places[inside[k]]]), int(score), int(scores[inside[k]])


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``id, label, dim, q``: the rows that take part, with floor(256 * x) of each component as bytes of doubles."""
    x = F.col("embedding")
    finite = lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False))  # noqa: E731  NaN is above infinity
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, finite))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.transform(x, lambda v: F.floor(256 * v.cast("double")).cast("double")).alias("v"))

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return v.map(lambda a: np.asarray(a, np.float64).tobytes())

    rows = stored(rows.select("id", "label", F.size("v").alias("dim"), packed("v").alias("q")))
    repeated = rows.groupBy("id").count().where("count > 1").select("id")
    if repeated.isEmpty():
        return rows
    one = rows.groupBy("id").agg(F.min(F.struct("label", "dim", "q")).alias("r")).select("id", "r.*")
    return stored(one)


def _blocks(anchors: DataFrame) -> tuple[DataFrame, int]:
    """``anchors`` with ``part``, of about ``ANCHORS``, and ``block``, of at most ``BLOCK`` of them; and how many parts.

    Like comes to like: they are sorted by label and the signs of their components, and cut by count.
    """

    @F.pandas_udf("string")
    def signs(q: pd.Series) -> pd.Series:
        return q.map(lambda b: "".join("01"[int(v >= 0)] for v in np.frombuffer(b, np.float64)[:64]))

    marked = stored(anchors.withColumn("signs", signs("q")))
    parts = -(-marked.count() // ANCHORS) or 1
    order = ["label", "signs", "id"]
    dealt = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return stored(dealt.withColumn("part", F.spark_partition_id()).withColumn("block", F.floor(at % (1 << 33) / BLOCK)).drop("signs")), parts


def hard_negatives(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, share: tuple[int, int] = (50, 95)) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels within a window of the positive's score.

    ``vectors`` has ``vec_id, embedding, label``; rows with a null among these, or a null or non-finite component, take no
    part; of rows with one vec_id the smallest (label, vector) does. ``is_anchor`` is a condition on ``id``.
    Components become whole numbers, floor(256 * x); a score is the inner product, exact while sums of
    products are below 2^53; vectors of different length have none. Higher scores first, ties by smaller
    vec_id. Positives are the first ``n_positives`` other rows of the label; negatives the first ``n_negatives`` rows of other
    labels whose score is from ``share[0]`` to ``share[1]`` per cent of the positive's, ends included. Fewer,
    if there are fewer; an anchor without any has no row. Empty input: no rows. Other columns are not read.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    rows = whole_vectors(vectors)
    anchors, parts = _blocks(rows.where(is_anchor))
    # The same label: anchors meet the chunks of their label, whose number follows the label's rows.
    chunks = rows.groupBy("label").agg(F.ceil(F.count("*") / CANDIDATES).alias("chunks"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    names = ["id", "label", "dim", "q", "block", "anchor", "part", "chunk"]
    mine = anchors.join(chunks, "label").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).withColumn("anchor", F.lit(True)).select(*names)
    met = rows.join(chunks, "label").withColumn("chunk", chunk).join(anchors.select("label", "part").distinct(), "label")
    met = met.withColumns({"block": F.lit(None).cast("long"), "anchor": F.lit(False)}).select(*names)

    def positives(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_positives(group, n_positives), columns=["id", "positive", "score"])

    found = mine.unionByName(met).groupBy("part", "label", "chunk").applyInPandas(positives, "id long, positive long, score long")
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "positive"))
    found = found.withColumn("rank", first).where(F.col("rank") <= n_positives)
    pairs = F.array_sort(F.collect_list(F.struct("rank", "positive", "score")))
    wanted = found.groupBy("id").agg(pairs.alias("p")).select("id", F.col("p.positive").alias("positives"), F.col("p.score").alias("scores"))
    asks = stored(anchors.join(wanted, "id"))

    n_chunks = -(-rows.count() // CANDIDATES) or 1
    lists = {"positives": F.lit(None).cast("array<long>"), "scores": F.lit(None).cast("array<long>")}
    mine = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long")))).withColumn("anchor", F.lit(True))
    met = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(n_chunks).cast("long"))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = met.withColumns({"block": F.lit(None).cast("long"), "anchor": F.lit(False)} | lists)
    names += list(lists)

    def negatives(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_negatives(group, n_negatives, share), columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    out = mine.select(*names).unionByName(met.select(*names)).groupBy("part", "chunk").applyInPandas(
        negatives, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= n_negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
