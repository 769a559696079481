"""Near-duplicate vectors: cover trees, and their dual traversal for all pairs within a distance.

Unit vectors of cosine ``threshold`` or more are at most sqrt(2 - 2 * threshold) apart. The vectors of a label
are a cover tree: level l has radius 2^(1 - l), a node's centre is a centre of the next level too, other centres
are farther apart than that level's radius, and each node keeps the radius that its points really take. The
dual traversal begins with (root, root) and opens pairs of nodes. A pair whose centres are farther apart than the
limit and both radii has no link; one whose centres and radii together are within the limit is all links,
which are counted without being made; what is left at the bottom is decided by the cosine.

1. Equal vectors are one point.
2. Upper levels, as joins: a node of more than ``LEAF`` points takes centres from a sample of its points, thinned by
   the next radius at which there are two or more; points go to the nearest. Those farther from it than the radius stay
   nodes of the upper level, to be split again. The points of a node are dealt to many tasks.
3. Lower levels: a leaf's tree is made in one task and its points carry their centres along.
4. The traversal over the upper nodes is a join for each level; each pair of leaves that is left meets in a task,
   which traverses both trees and returns degrees and a spanning forest of the links.

In data without near copies the first levels hold each point alone, so that leaves meet leaves as in blocks of all pairs:
no bound by the triangle inequality can do better where all distances are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioflow.functions.tables import small
from helioflow.llm.common import cut, stored, within_share
from helioflow.llm.components import connected_components

THRESHOLD = 0.98
#: Points of a leaf; centres of a node; the last levels of upper nodes and of leaves.
LEAF, CENTRES, LAST, LAST_IN_LEAF = 2048, 64, 12, 5
#: Distances are off by less than this.
SLACK = 1e-6


def radius_of(level: int) -> float:
    return 2.0 ** (1 - level)


def _unit(raw: pd.Series, kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of the largest doubles overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all unit vectors of two sets."""
    d = a @ b.T
    d *= -2
    d += 2
    return np.sqrt(np.maximum(d, 0, out=d), out=d)


def net(x: np.ndarray, radius: float, most: int | None = None) -> list[int]:
    """Places of centres, in order: each farther than the radius from those before it; the first is place 0."""
    near, found = np.full(len(x), np.inf), []
    every = _apart(x, x) if len(x) <= LEAF else None
    for i in range(len(x)):
        if near[i] > radius:
            found.append(i)
            if most is not None and len(found) == most:
                break
            np.minimum(near, _apart(x, x[i : i + 1])[:, 0] if every is None else every[i], out=near)
    return found


def leaf_tree(x: np.ndarray) -> np.ndarray:
    """For each point its centres' places at the levels from 1 to ``LAST_IN_LEAF``."""
    path, parent = np.zeros((len(x), LAST_IN_LEAF), np.int32), np.zeros(len(x), np.int32)
    for level in range(1, LAST_IN_LEAF + 1):
        own = np.empty(len(x), np.int32)
        for top in np.unique(parent):
            inside = np.flatnonzero(parent == top)
            inside = np.concatenate([[top], inside[inside != top]])
            if len(inside) == 1:
                own[inside] = top
                continue
            centres = net(x[inside], radius_of(level))
            own[inside] = inside[centres][_apart(x[inside], x[inside[centres]]).argmin(axis=1)]
            own[inside[centres]] = inside[centres]
        path[:, level - 1] = parent = own
    return path


class Leaf:
    """A leaf's points with their tree. Level 0 is the points themselves, the lowest one."""

    def __init__(self, rows: pd.DataFrame, kind: str) -> None:
        rows = rows.sort_values("pos")
        self.p, self.n, self.x = rows["p"].to_numpy(), rows["n"].to_numpy(), _unit(rows["raw"], kind)
        path = np.stack(rows["path"].to_numpy())
        self.centres, self.radius, self.weight, self.size, self.members, self.children = [], [], [], [], [], []
        for level in range(LAST_IN_LEAF + 1):
            of = path[:, level] if level < LAST_IN_LEAF else np.arange(len(path), dtype=np.int32)
            centres, node = np.unique(of, return_inverse=True)
            far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.x, self.x[of]), 0)) if level < LAST_IN_LEAF else np.zeros(len(path))
            radius = np.zeros(len(centres))
            np.maximum.at(radius, node, far)
            order = np.argsort(node, kind="stable")
            if level:
                up = self._node[centres]
                by = np.argsort(up, kind="stable")
                self.children.append((by, np.searchsorted(up[by], np.arange(len(self.centres[-1]) + 1))))
            self._node = node
            self.centres.append(centres)
            self.radius.append(radius)
            self.weight.append(np.bincount(node, self.n, len(centres)).astype(np.int64))
            self.size.append(np.bincount(node, minlength=len(centres)))
            self.members.append((order, np.searchsorted(node[order], np.arange(len(centres) + 1))))


def _opened(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the pairs (i, j)."""
    na, nb = a[1][i + 1] - a[1][i], b[1][j + 1] - b[1][j]
    each = np.repeat(np.arange(len(i)), na * nb)
    k = np.arange(len(each)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    return a[0][a[1][i[each]] + k // nb[each]], b[0][b[1][j[each]] + k % nb[each]]


def dual(a: Leaf, b: Leaf, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Degrees of both leaves' points from links between them (or within one: ``a is b``), and links (places in a, in b) that connect them."""
    limit, same, links = np.sqrt(2 - 2 * threshold), a is b, []
    deg_a, deg_b = np.zeros(len(a.p), np.int64), np.zeros(len(b.p), np.int64)

    def linked(x: np.ndarray, y: np.ndarray) -> None:
        """Links between points."""
        if same:
            x, y = x[x != y], y[x != y]
        np.add.at(deg_a, x, b.n[y])
        np.add.at(deg_b, y, a.n[x])
        links.append((x, y))

    def parted(level: int, pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        rest = []
        for i, j, d in pairs:
            reach = a.radius[level][i] + b.radius[level][j]
            if same:
                d = np.where(i == j, 0, d)
            open_ = d <= limit + reach + SLACK
            i, j, d, reach = i[open_], j[open_], d[open_], reach[open_]
            whole = d + reach <= limit - SLACK
            single = whole & (a.size[level][i] == 1) & (b.size[level][j] == 1)
            linked(a.centres[level][i[single]], b.centres[level][j[single]])
            rest.append((i[~whole], j[~whole]))
            whole &= ~single
            for x, y in zip(i[whole], j[whole], strict=True):
                ma, mb = (t.members[level][0][t.members[level][1][z] : t.members[level][1][z + 1]] for t, z in ((a, x), (b, y)))
                if same and x == y:
                    deg_a[ma] += a.weight[level][x] - a.n[ma]
                    links.append((ma, np.full(len(ma), a.centres[level][x])))
                    continue
                deg_a[ma] += b.weight[level][y]
                deg_b[mb] += a.weight[level][x]
                links.append((ma, np.full(len(ma), b.centres[level][y])))
                links.append((np.full(len(mb), a.centres[level][x]), mb))
        return tuple(np.concatenate(side) if rest else np.zeros(0, np.int64) for side in zip(*rest, strict=True)) if rest else (np.zeros(0, np.int64),) * 2

    def first() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ca, cb = a.x[a.centres[0]], b.x[b.centres[0]]
        for at in range(0, len(ca), 256):
            d = _apart(ca[at : at + 256], cb)
            reach = a.radius[0][at : at + 256, None] + b.radius[0][None]
            i, j = np.nonzero(d <= limit + reach + SLACK)
            d = d[i, j]
            i = i + at
            yield (i[i <= j], j[i <= j], d[i <= j]) if same else (i, j, d)

    def below(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ka, kb = a.children[level - 1], b.children[level - 1]
        made = np.cumsum((ka[1][i + 1] - ka[1][i]) * (kb[1][j + 1] - kb[1][j]))
        for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(made // 50_000)) + 1) if len(i) else []:
            x, y = _opened(ka, kb, i[part], j[part])
            if same:
                # A node opened with itself gives each pair of its children once.
                twice = np.repeat(i[part] == j[part], (ka[1][i[part] + 1] - ka[1][i[part]]) * (kb[1][j[part] + 1] - kb[1][j[part]])) & (x > y)
                x, y = x[~twice], y[~twice]
            cos = np.einsum("ij,ij->i", a.x[a.centres[level][x]], b.x[b.centres[level][y]])
            if level == LAST_IN_LEAF:
                linked(x[cos >= threshold], y[cos >= threshold])
            else:
                yield x, y, np.sqrt(np.maximum(2 - 2 * cos, 0))

    i, j = parted(0, first())
    for level in range(1, LAST_IN_LEAF + 1):
        i, j = parted(level, below(level, i, j))
    return deg_a, deg_b, links


def _forest(links: list[tuple[np.ndarray, np.ndarray]], p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between points ``p`` as links of each to its component's root: no more than there are points."""
    a, b = (np.concatenate(side) for side in zip(*links, strict=True))
    root = np.arange(len(p))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new[new]]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(p)))
    return p[moved], p[root[moved]]


def points_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Rows ``vec_id, p`` (``p`` null where a vector links with nothing), distinct points ``p, space, n, raw``, and the bytes' kind."""
    x = F.col("embedding")
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8"
    finite = lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False))  # noqa: E731  NaN is above infinity
    good = F.coalesce(F.col("label").isNotNull() & F.forall(x, finite) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), x, F.when(good, F.xxhash64("label", x)).alias("p"))

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return v.map(lambda a: np.asarray(a, kind).tobytes())

    points = rows.where("p is not null").groupBy("p").agg(F.count("*").alias("n"), F.first(F.struct("label", "embedding")).alias("v"))
    space = F.concat_ws("/", "v.label", F.size("v.embedding").cast("string"))
    return rows.select("vec_id", "p"), stored(points.select("p", space.alias("space"), "n", packed("v.embedding").alias("raw"))), kind


def _split(points: DataFrame, big: DataFrame, kind: str, leaf: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """One more level under the nodes ``big``: their points with new nodes, and those nodes' centres."""
    # Nodes are few beside their points: small tables of them are broadcast, so that a large node's points stay spread.
    drawn = points.join(small(big.select("node", "m", "level", "centre")), "node").where((F.col("p") == F.col("centre")) | within_share(4 * CENTRES / F.col("m"), "p", F.lit(turn)))

    def centres(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(other=rows["p"] != rows["centre"]).sort_values(["other", "p"])
        x, node, m, level = _unit(rows["raw"], kind), *rows.iloc[0][["node", "m", "level"]]
        most = int(min(CENTRES, -(-2 * m // leaf)))
        for level in range(int(level) + 1, LAST + 1):  # noqa: B020
            found = net(x, radius_of(level), most)
            if len(found) > 1:
                break
        return pd.DataFrame({"node": node, "p": rows["p"].to_numpy()[found], "raw": rows["raw"].to_numpy()[found], "level": level, "k": range(len(found))})

    chosen = stored(drawn.groupBy("node").applyInPandas(centres, "node string, p long, raw binary, level int, k int"))
    chunks = big.select("node", F.col("level").alias("upper"), F.ceil(F.col("m") / (4 * leaf)).alias("chunks"))
    dealt = points.drop("far").join(small(chunks), "node").withColumn("chunk", F.pmod(F.xxhash64("p"), F.col("chunks"))).drop("chunks").withColumns({"k": F.lit(None).cast("int"), "level": F.lit(None).cast("int")})
    copied = chosen.join(chunks, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    copied = copied.withColumns({"n": F.lit(None).cast("long"), "space": F.lit(None).cast("string"), "nodes": F.lit(None).cast("array<string>")})

    def nearest(rows: pd.DataFrame) -> pd.DataFrame:
        c, own = rows[rows["k"].notna()].sort_values("k"), rows[rows["k"].isna()]
        if own.empty:
            return pd.DataFrame(columns=["p", "space", "n", "raw", "node", "nodes", "far"])
        level, d = int(c["level"].iloc[0]), _apart(_unit(own["raw"], kind), _unit(c["raw"], kind))
        k = d.argmin(axis=1)
        far = d[np.arange(len(k)), k]
        node = [f"{a}.{b}" + ("" if f <= radius_of(level) else f"+{u}") for a, b, f, u in zip(own["node"], k, far, own["upper"], strict=True)]
        return pd.DataFrame({
            "p": own["p"], "space": own["space"], "n": own["n"].astype("int64"), "raw": own["raw"], "node": node, "nodes": [[*a, b] for a, b in zip(own["nodes"], node, strict=True)], "far": far,
        })

    moved = dealt.unionByName(copied).groupBy("node", "chunk").applyInPandas(nearest, "p long, space string, n long, raw binary, node string, nodes array<string>, far double")
    return stored(moved), chosen


def upper_tree(points: DataFrame, kind: str, leaf: int, limit: float) -> tuple[DataFrame, DataFrame]:
    """Points with their leaf ``node`` and ``nodes`` from the root down; nodes ``node, parent, centre, raw, radius, m, w, leaf``."""
    done, turn = [], 0
    now = points.withColumns({"node": F.col("space"), "nodes": F.array("space"), "far": F.lit(2.0)})
    size = [F.count("*").alias("m"), F.sum("n").alias("w"), F.max("far").alias("radius")]
    heads = cut(now.groupBy("node").agg(*size, F.min("p").alias("centre")).withColumns({"level": F.lit(0), "parent": F.lit(None).cast("string")}))
    roots = heads.join(points.select(F.col("p").alias("centre"), "raw"), "centre")
    nodes = []
    while True:
        split = (F.col("m") > leaf) & (F.col("level") < LAST) & (F.col("radius") > limit / 4)
        nodes.append(roots.withColumn("leaf", ~split))
        big = heads.where(split)
        done.append(now.join(small(big.select("node")), "node", "left_anti"))
        if big.isEmpty():
            break
        turn += 1
        now, chosen = _split(now.join(small(big.select("node")), "node", "left_semi"), big, kind, leaf, turn)
        mark = F.regexp_extract("node", r"^(.*)\.(\d+)(\+(\d+))?$", 1), F.regexp_extract("node", r"^(.*)\.(\d+)(\+(\d+))?$", 2).cast("int"), F.regexp_extract("node", r"^(.*)\.(\d+)(\+(\d+))?$", 4)
        fresh = now.groupBy("node").agg(*size, F.min("p").alias("least")).withColumns({"parent": mark[0], "k": mark[1], "upper": mark[2]})
        of = chosen.select(F.col("node").alias("parent"), "k", F.col("p").alias("centre"), "raw", F.col("level").alias("own"))
        roots = cut(fresh.join(of, ["parent", "k"]).withColumn("level", F.when(F.col("upper") == "", F.col("own")).otherwise(F.col("upper").cast("int"))))
        # A node of those left over is split from a point of its own.
        heads = roots.select("node", "m", "w", "radius", "level", "parent", F.when(F.col("upper") == "", F.col("centre")).otherwise(F.col("least")).alias("centre"))
        roots = roots.select(*nodes[0].drop("leaf").columns)
    names = ["node", "parent", "centre", "raw", "radius", "m", "w", "leaf"]
    every = nodes[0].select(names)
    for more in nodes[1:]:
        every = every.unionByName(more.select(names))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more.select(out.columns))
    return stored(out.drop("far")), stored(every)


def _distance(kind: str) -> Column:
    @F.pandas_udf("double")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        d = pd.Series(0.0, a.index)
        for at in a.index.groupby(a.str.len()).values():  # spaces of different dimension
            d[at] = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", _unit(a[at], kind), _unit(b[at], kind)), 0))
        return d

    return apart("raw_a", "raw_b")


def node_pairs(nodes: DataFrame, kind: str, limit: float) -> tuple[DataFrame, DataFrame]:
    """The traversal over upper nodes: pairs ``a, b`` of leaves to be looked into, and pairs of nodes that are all links."""
    own = nodes.where("leaf").select(F.col("node").alias("parent"), "node", "centre", "raw", "radius", "w", "leaf")
    under = cut(nodes.where("parent is not null").select(own.columns).unionByName(own))
    side = lambda x: under.select(*(F.col(c).alias(f"{c}_{x}" if c != "parent" else x) for c in under.columns))
    pairs = nodes.where("parent is null").select(F.col("node").alias("a"), F.col("node").alias("b"))
    leaves, whole = [], []
    while True:
        met = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("a") != F.col("b")) | (F.col("node_a") <= F.col("node_b")))
        self = F.col("node_a") == F.col("node_b")
        met = met.withColumn("d", F.when(self, 0.0).otherwise(_distance(kind))).withColumn("reach", F.col("radius_a") + F.col("radius_b")).drop("raw_a", "raw_b")
        met = cut(met.where(F.col("d") <= limit + SLACK + F.col("reach")).withColumn("whole", F.col("d") + F.col("reach") <= limit - SLACK))
        whole.append(met.where("whole").select(*(f"{c}_{x}" for x in "ab" for c in ("node", "centre", "w"))))
        both = F.col("leaf_a") & F.col("leaf_b")
        leaves.append(met.where(~F.col("whole") & both).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
        pairs = met.where(~F.col("whole") & ~both).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        if pairs.isEmpty():
            break
    join = lambda parts: parts[0] if len(parts) == 1 else join([parts[0].unionByName(parts[1]), *parts[2:]])
    return join(leaves), join(whole)


def near_links(points: DataFrame, kind: str, threshold: float, leaf: int) -> tuple[DataFrame, DataFrame]:
    """``p, n`` of links (copies of a point's partners counted, not its own), and edges ``a, b`` that connect what links connect."""
    limit = float(np.sqrt(2 - 2 * threshold))
    placed, nodes = upper_tree(points, kind, leaf, limit)
    pairs, whole = node_pairs(nodes, kind, limit)
    # A leaf of one direction can be larger than a task's share: it is dealt by hash.
    chunks = nodes.where("leaf").select("node", F.ceil(F.col("m") / leaf).alias("chunks"))
    dealt = placed.join(small(chunks), "node").withColumn("cell", F.concat_ws("#", "node", F.pmod(F.xxhash64("p"), F.col("chunks")).cast("string")))

    def trees(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("p").reset_index(drop=True)
        return rows[["cell", "p", "n", "raw"]].assign(pos=range(len(rows)), path=list(leaf_tree(_unit(rows["raw"], kind))))

    cells = stored(dealt.select("cell", "p", "n", "raw").groupBy("cell").applyInPandas(trees, "cell string, p long, n long, raw binary, pos int, path array<int>"))
    of = chunks.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: F.concat_ws("#", "node", k.cast("string"))))).select("node", "cell")
    asked = pairs.join(of.withColumnsRenamed({"node": "a", "cell": "x"}), "a").join(of.withColumnsRenamed({"node": "b", "cell": "y"}), "b").where((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y"))).select("x", "y")
    asked = cut(asked)
    # Both cells' points go to their pair's task.
    ends = asked.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("cell"))

    def met(rows: pd.DataFrame) -> pd.DataFrame:
        a = Leaf(rows[rows["cell"] == rows["x"]], kind)
        b = a if rows["x"].iloc[0] == rows["y"].iloc[0] else Leaf(rows[rows["cell"] == rows["y"]], kind)
        deg_a, deg_b, links = dual(a, b, threshold)
        p, deg = (a.p, deg_a + deg_b) if a is b else (np.concatenate([a.p, b.p]), np.concatenate([deg_a, deg_b]))
        links = [(i, j if a is b else j + len(a.p)) for i, j in links]
        u, v = _forest(links, p) if links else (p[:0], p[:0])
        hit = np.flatnonzero(deg)
        return pd.concat([pd.DataFrame({"a": p[hit], "b": p[hit], "n": deg[hit]}), pd.DataFrame({"a": u, "b": v, "n": 0})])

    found = stored(cells.join(ends, "cell").groupBy("x", "y").applyInPandas(met, "a long, b long, n long"))
    # Nodes that are all links: counted for their points, which link to the other's centre.
    self = F.col("node_a") == F.col("node_b")
    one = whole.select(F.col("node_a").alias("node"), F.col("centre_b").alias("centre"), F.col("w_b").alias("w"), self.alias("self"))
    two = whole.where(~self).select(F.col("node_b").alias("node"), F.col("centre_a").alias("centre"), F.col("w_a").alias("w"), F.lit(False).alias("self"))
    wholes = cut(one.unionByName(two))
    members = placed.select("p", "n", F.explode("nodes").alias("node")).join(small(wholes.select("node").distinct()), "node", "left_semi")
    totals = wholes.groupBy("node").agg(F.sum("w").alias("w"), F.bool_or("self").alias("self"))
    more = members.join(small(totals), "node").select("p", (F.col("w") - F.when(F.col("self"), F.col("n")).otherwise(0)).alias("n"))
    degrees = found.where("a = b").select(F.col("a").alias("p"), "n").unionByName(more).groupBy("p").agg(F.sum("n").alias("n"))
    # One edge from each point to a centre of a node that is all links with its own, and of these centres among themselves.
    first = wholes.groupBy("node").agg(F.min("centre").alias("hub"))
    hubs = wholes.join(first, "node").select(F.col("centre").alias("a"), F.col("hub").alias("b"), "node")
    inside = members.join(small(first), "node").select(F.col("p").alias("a"), F.col("hub").alias("b"))
    across = hubs.select("a", "b")
    return degrees, found.where("a <> b").select("a", "b").unionByName(inside).unionByName(across)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding, label``).

    Two rows link if their labels are equal and the cosine of their vectors, in double precision, is ``threshold`` or
    more; vectors of different length don't. Rows whose label or vector is null, or whose vector is empty, zero, or
    holds a null or non-finite component, link with nothing. ``n_links`` counts the other rows that a row links
    with; ``component_id`` is the smallest vec_id that links reach, its own included; ``kept``: it is the row's own, or
    there is none. Rows with a null vec_id count as others do. Repeated rows are rows of their own, which link. Other
    columns are not read. Empty input: no rows.
    """
    rows, points, kind = points_of(vectors)
    degrees, edges = near_links(points, kind, threshold, leaf)
    classes = connected_components(edges)
    known = rows.where("p is not null").groupBy("p").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    known = known.join(classes.withColumnRenamed("node", "p"), "p", "left").join(degrees, "p", "left").withColumn("root", F.coalesce("component", "p"))
    known = stored(known.select("p", "root", "first", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    of = known.join(least, "root").select("p", "n_links", "least")
    done = rows.join(of, "p", "left")
    component = F.when(F.col("p").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    kept = F.coalesce(F.col("vec_id") == component, component.isNull())
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))
