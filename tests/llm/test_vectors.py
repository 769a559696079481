"""Cover trees and hard negatives against all pairs, on the small table and on odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helioflow.llm import cover_tree, hard_negatives
from helioflow.llm.common import read

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, p string, n long, node string, id long, q string, score double, anchor string, block int"


def odd_rows(rng):
    """Near copies around a few centres, ties, copies, scaled copies, and rows that link with nothing."""
    rows = []
    for label, (groups, size, spread) in enumerate([(3, 60, 0.02), (40, 3, 0.024), (1, 150, 0.03), (2, 40, 0.001)]):
        for centre in rng.normal(size=(groups, 16)):
            centre /= np.linalg.norm(centre)
            rows += [(centre + rng.normal(size=16) * spread, label) for _ in range(size)]
    rows += [(rng.normal(size=16), 5) for _ in range(80)] + [(np.ones(16) * k, 6) for k in (1, 1, 2, 3, 0.1, 1e-200, 1e200)] + [(-np.ones(16), 6), (np.ones(3), 6)]
    rows = [(10 + i * 7 % 4999, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    one = [1.0] * 16
    rows += [(9001, None, 6), (9002, [], 6), (9003, [0.0] * 16, 6), (9004, [NAN] + one[1:], 6), (9005, [INF] + one[1:], 6), (9006, [None] + one[1:], 6), (9007, one, None), (9008, one, 7)]
    rows += [(None, one, 6), (None, one, 8), (None, one, None), rows[3], rows[3], rows[500], (2**60 + 1, one, 6), (-(2**62) - 1, rows[4][1], 0)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows(np.random.default_rng(5))


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z", 0.5, "a", 3) for r in rows], SCHEMA).repartition(3).cache()


def plain_near(rows, threshold=0.98):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in good}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    links = {i: [j for j in good if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in good}
    out, root = [], {}
    for i in good:
        if i not in root:
            seen, todo = {i}, [i]
            while todo:
                todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
            least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
            root |= dict.fromkeys(seen, least)
    for i, (own, *_) in enumerate(rows):
        component = root.get(i, own)
        out.append((own, len(links.get(i, [])), component, component is None or own == component))
    return out


def ordered(found):
    return sorted(found, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("leaf", [cover_tree.LEAF, 16])
def test_near_duplicates(vectors, rows, leaf):
    """Small leaves bring the upper levels in: nodes that are split again, and pairs of nodes that are all links."""
    wanted = ordered(plain_near(rows))
    assert ordered(map(tuple, cover_tree.near_duplicates(vectors, leaf=leaf).collect())) == wanted
    assert any(n > 100 for _, n, *_ in wanted) and any(own != c and c is not None for own, _, c, _ in wanted)


def test_near_duplicates_of_small_table(spark, sf_dir):
    table = read(spark, sf_dir, "embeddings")
    near = table.select((F.col("vec_id") + 100_000).alias("vec_id"), F.transform("embedding", lambda x, i: (x + F.when(i == F.lit(3), 0.1).otherwise(0.0)).cast("float")).alias("embedding"), "label")
    both = table.unionByName(near)
    wanted = plain_near([tuple(r) for r in both.collect()])
    assert ordered(map(tuple, cover_tree.near_duplicates(both, leaf=64).collect())) == ordered(wanted)
    assert sum(n for _, n, *_ in wanted) > 500


def test_no_vectors(vectors):
    assert cover_tree.near_duplicates(vectors.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(vectors.limit(0), F.col("id") % 5 == 0).count() == 0


def test_leaf_tree_is_a_cover_tree():
    """Nested centres, all points within the level's radius of their centre, centres of one parent farther apart than that."""
    rng = np.random.default_rng(3)
    x = np.concatenate([c + rng.normal(size=(30, 8)) * 0.05 for c in rng.normal(size=(6, 8))] + [rng.normal(size=(20, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    path = cover_tree.leaf_tree(x)
    for level in range(1, cover_tree.LAST_IN_LEAF + 1):
        own = path[:, level - 1]
        assert (own[own] == own).all() and (np.linalg.norm(x - x[own], axis=1) <= cover_tree.radius_of(level) + 1e-9).all()
        above = path[:, level - 2] if level > 1 else np.zeros(len(x), int)
        assert (above[own] == above).all()
        for top in np.unique(above):
            centres = np.unique(own[above == top])
            assert top in centres
            far = np.linalg.norm(x[centres][:, None] - x[centres][None], axis=2)[~np.eye(len(centres), dtype=bool)]
            assert (far > cover_tree.radius_of(level)).all()


def plain_negatives(rows, anchor, n_positives=5, n_negatives=3):
    own = {}
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            q = tuple(math.floor(256 * x) for x in v)
            own[i] = min(own.get(i, (label, len(q), q)), (label, len(q), q))
    out = set()
    for a, (label, n, q) in own.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, other[2], strict=True)), i, other[0]) for i, other in own.items() if i != a and other[1] == n)
        for s, p, _ in [x for x in scored if x[2] == label][:n_positives]:
            fit = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:n_negatives]
            out |= {(a, p, k + 1, i, -s, -m) for k, (m, i, _) in enumerate(fit)}
    return out


def test_hard_negatives(spark, rows, monkeypatch):
    """Blocks of a few rows, so that anchors and candidates meet in many tasks; labels that overlap in space."""
    kept = [(i, v, label % 3 if label is not None else None, *["x", 1, "y", 2, "z", 0.5, "a", 3]) for i, v, label in rows if not v or max(abs(x) for x in v if x is not None and x == x) < 1e9 or INF in v]
    kept += [(20_000 + i, [1.0, 0.5 * (i % 4)] * 8, i % 2, *["x", 1, "y", 2, "z", 0.5, "a", 3]) for i in range(40)]  # ties
    wanted = plain_negatives([r[:3] for r in kept], lambda i: i % 5 == 0)
    for block, anchors, cands in ((256, 4096, 4096), (8, 32, 48)):
        for name, n in (("BLOCK", block), ("ANCHORS", anchors), ("CANDIDATES", cands)):
            monkeypatch.setattr(hard_negatives, name, n)
        found = hard_negatives.hard_negatives(spark.createDataFrame(kept, SCHEMA), F.col("id") % 5 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 200


def test_bounds_spare_scores():
    """Anchors close to each other: most candidates are never scored for the children, and none that overlaps is left out."""
    rng = np.random.default_rng(1)
    cands = rng.normal(size=(2000, 32))
    anchors = rng.normal(size=32) + rng.normal(size=(50, 32)) * 0.01
    scores = anchors @ cands.T
    low = np.sort(scores, axis=1)[:, -20]
    looked = 0
    tree = hard_negatives.spanning_tree(anchors)
    assert {n for n, _, _ in tree} == set(range(50)) and all(p in {n for n, _, _ in tree[:k]} for k, (_, p, _) in enumerate(tree) if p >= 0)
    for at, places, found in hard_negatives.windowed(anchors, tree, cands, low, np.full(50, np.inf)):
        assert set(np.flatnonzero(scores[at] >= low[at])) <= set(places)
        assert np.allclose(found, scores[at][places])
        looked += len(places)
    assert looked < 0.1 * scores.size
