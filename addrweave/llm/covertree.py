"""Exact threshold pairs of embeddings by dual traversal of cover trees.

Vectors are scaled to length 1, so a cosine from ``c`` on means a distance up to sqrt(2 - 2c). Equal
vectors are one point with a weight. Points go to the nearest of some pivots (cells), a cell is dealt
out to blocks of bounded size, and each block holds a cover tree: nested levels of nodes whose radii
halve, every node a range of the block's points with its true covering radius. Above the blocks,
cells and the root are further levels.

The traversal starts with the pair (root, root) and replaces pairs of nodes by pairs of their
children. A pair is dropped if its centres are further apart than the limit plus both radii. If
they are closer than the limit less both radii, all points of one link with all of the other: sizes are
added to the counts of both ranges, no pairs are made. Only points of leaves that fall between the two bounds are
compared, in double precision. Cells and blocks are traversed as tables (joined on the parent's id), block pairs
inside tasks that read the trees' files. A task returns a count and one link to a smaller point for each
point, never its pairs.

The number of node pairs grows with the square of the number of points that are further apart than the
limit but closer than the levels above can tell; bounds of distances prune little among vectors of
many dimensions without structure.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite numbers link with nothing;
vectors of different lengths do not link; rows that repeat an id or a vector count as further vectors; a row
with a null id counts as a link of others, and its component is the smallest id reached (null if none); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.components import components
from addrweave.llm.shared import cut, read_shared, tidy, write_shared
from addrweave.session import scratch_path

BLOCK = 4096  # points of a block, about
PIVOTS = 256  # pivots at most: a bounded sample fixes the cells, all points are in the trees
LEAF = 1 / 8  # nodes of a radius up to this part of the limit are not split further
SLACK = 1e-6  # of bounds, beside what single precision may lose in a product


def _raw_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vec (binary, doubles; null if it links with nothing) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
            flat = col.flatten().cast(pa.float64())
            x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            total = np.r_[0, np.cumsum(~np.isfinite(x))], np.r_[0, np.cumsum(np.nan_to_num(x, posinf=1, neginf=1) != 0)]
            fine = (total[0][ends] == total[0][ends - size]) & (total[1][ends] > total[1][ends - size])
            rows = [x[e - n : e].tobytes() if ok else None for e, n, ok in zip(ends, size, fine, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "vec"])

    d = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    return d.mapInArrow(tidy(run), "id bigint, vec binary")


def _unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # lengths of very large or small numbers stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def build_tree(x: np.ndarray, limit: float) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Cover tree over unit vectors: order of the points, and node arrays by level: centre, radius, start, end
    (range of points), first and last child. Node 0 is the root; children of a node stand together, one level down."""
    n = len(x)
    far = lambda i, of: np.sqrt(np.maximum(2 - 2 * (x[of] @ x[i]), 0))
    radius = float(far(0, np.arange(n)).max())
    nodes = [[0, radius, np.arange(n), 0, 0]]
    level, rho = [0], radius / 2
    while level:
        below = []
        for k in level:
            centre, r, members, _, _ = nodes[k]
            if r <= limit * LEAF or len(members) == 1:
                continue
            nodes[k][3] = len(nodes)
            left = members
            while len(left):  # the node's own centre first: levels are nested
                c = centre if len(left) == len(members) else left[0]
                d = far(c, left)
                near = d <= rho
                near |= left == c
                below.append(len(nodes))
                nodes.append([c, float(d[near].max()), left[near], 0, 0])
                left = left[~near]
            nodes[k][4] = len(nodes)
        level, rho = below, rho / 2
    # the range of a node: points in the order of a walk down the tree
    order, start = [], np.zeros(len(nodes), np.int64)
    stack, at = [0], 0
    while stack:
        k = stack.pop()
        start[k] = at
        if nodes[k][4] > nodes[k][3]:
            stack.extend(range(nodes[k][4] - 1, nodes[k][3] - 1, -1))
        else:
            order.append(nodes[k][2])
            at += len(nodes[k][2])
    out = {
        "centre": np.array([k[0] for k in nodes], np.int64),
        "radius": np.array([k[1] for k in nodes]),
        "start": start,
        "end": start + np.array([len(k[2]) for k in nodes]),
        "first": np.array([k[3] for k in nodes], np.int64),
        "last": np.array([k[4] for k in nodes], np.int64),
    }
    order = np.concatenate(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    out["centre"] = place[out["centre"]]
    return order, out


class Tree:
    """A block: unit vectors in tree order, ids and weights of the points, node arrays."""

    FIELDS = ("centre", "start", "end", "first", "last")

    def __init__(self, x: np.ndarray, point: np.ndarray, weight: np.ndarray, nodes: dict[str, np.ndarray]):
        self.x, self.point, self.weight, self.nodes = x, point, weight, nodes
        self.sum = np.r_[0, np.cumsum(weight)]
        self.x32 = x.astype(np.float32)

    def parts(self) -> list[np.ndarray]:
        head = np.array([*self.x.shape, len(self.nodes["radius"])], "<i8")
        return [head, self.x.astype("<f8"), self.point.astype("<i8"), self.weight.astype("<i8"), self.nodes["radius"].astype("<f8"), *(self.nodes[f].astype("<i8") for f in self.FIELDS)]

    @classmethod
    def read(cls, path: str) -> Tree:
        raw, at = read_shared(path), 0

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.ndarray((n,), kind, buffer=raw, offset=at)
            at += 8 * n
            return out

        n, dim, k = map(int, take(3, "<i8"))
        x = take(n * dim, "<f8").reshape(n, dim)
        point, weight, nodes = take(n, "<i8"), take(n, "<i8"), {"radius": take(k, "<f8")}
        return cls(x, point, weight, nodes | {f: take(k, "<i8") for f in cls.FIELDS})


class _Links:
    """What a traversal finds, by place in the block: links counted, and groups of linked points."""

    def __init__(self, a: Tree, b: Tree):
        self.same = a is b
        self.a, self.b = a, b
        self.count = [np.zeros(len(a.point) + 1, np.int64), np.zeros(len(b.point) + 1, np.int64)]  # steps of the counts
        self.join = [np.zeros(len(a.point) + 1, np.int64), np.zeros(len(b.point) + 1, np.int64)]  # steps: linked with the next point
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def ranges(self, s: np.ndarray, e: np.ndarray, t: np.ndarray, f: np.ndarray) -> None:
        """All points s..e-1 of a link with all points t..f-1 of b."""
        a, b = self.a, self.b
        for side, lo, hi, w in ((0, s, e, b.sum[f] - b.sum[t]), (1, t, f, a.sum[e] - a.sum[s])):
            np.add.at(self.count[side], lo, w)
            np.add.at(self.count[side], hi, -w)
            np.add.at(self.join[side], lo, 1)
            np.add.at(self.join[side], hi - 1, -1)
        self.edges.append((s, t))

    def within(self, s: np.ndarray, e: np.ndarray) -> None:
        """All points s..e-1 link with each other (one tree); the weight of the point itself is taken off later."""
        np.add.at(self.count[0], s, self.a.sum[e] - self.a.sum[s])
        np.add.at(self.count[0], e, -(self.a.sum[e] - self.a.sum[s]))
        own = np.zeros(len(self.a.point) + 1, np.int64)
        np.add.at(own, s, 1)
        np.add.at(own, e, -1)
        self.own = getattr(self, "own", 0) + own
        np.add.at(self.join[0], s, 1)
        np.add.at(self.join[0], e - 1, -1)

    def result(self) -> pd.DataFrame:
        """point, n (links), to (a point of the same group) of every point with a link."""
        a, b = self.a, self.b
        n_a, n_b = np.cumsum(self.count[0])[:-1], np.cumsum(self.count[1])[:-1]
        chain = [np.flatnonzero(np.cumsum(j)[:-1] > 0) for j in self.join]
        s = np.concatenate([x for x, _ in self.edges]) if self.edges else np.zeros(0, np.int64)
        t = np.concatenate([y for _, y in self.edges]) if self.edges else np.zeros(0, np.int64)
        if self.same:
            n = n_a + n_b - (np.cumsum(self.own)[:-1] * a.weight if hasattr(self, "own") else 0)
            point = a.point
            u, v = np.r_[s, chain[0], chain[1]], np.r_[t, chain[0] + 1, chain[1] + 1]
        else:
            k = len(a.point)
            n, point = np.r_[n_a, n_b], np.r_[a.point, b.point]
            u, v = np.r_[s, chain[0], k + chain[1]], np.r_[t + k, chain[0] + 1, k + chain[1] + 1]
        label = point.copy()
        while len(u):  # smallest point of each group
            least = np.minimum(label[u], label[v])
            open_ = (label[u] != least) | (label[v] != least)
            if not open_.any():
                break
            np.minimum.at(label, u[open_], least[open_])
            np.minimum.at(label, v[open_], least[open_])
        keep = n > 0
        return pd.DataFrame({"point": point[keep], "n": n[keep], "to": label[keep]})


def _product(first_a, last_a, first_b, last_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of the ranges [first_a, last_a) and [first_b, last_b), row by row, and the row of each."""
    w = last_b - first_b
    size = (last_a - first_a) * w
    row = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    return first_a[row] + k // w[row], first_b[row] + k % w[row], row


def traverse(a: Tree, b: Tree, cosine: float) -> pd.DataFrame:
    """Links between the points of two trees, or within one (``a is b``)."""
    limit = np.sqrt(2 - 2 * cosine)
    out, same = _Links(a, b), a is b
    na, nb = a.nodes, b.nodes
    loss = (a.x.shape[1] + 4) * 1.2e-7  # of a product of unit vectors in single precision, at most

    def points(p: np.ndarray, q: np.ndarray) -> None:
        for i in range(0, len(p), 200_000):
            u, v = p[i : i + 200_000], q[i : i + 200_000]
            ok = np.einsum("ij,ij->i", a.x[u], b.x[v]) >= cosine
            out.ranges(u[ok], u[ok] + 1, v[ok], v[ok] + 1)

    def settle(i: np.ndarray, j: np.ndarray, dots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of node pairs i, j (not the same node), given the products of their centres: drop, link, compare leaves;
        the rest is returned."""
        ra, rb = na["radius"][i], nb["radius"][j]
        live = np.sqrt(np.maximum(2 - 2 * (dots + loss), 0)) <= limit + ra + rb + SLACK
        i, j, dots, ra, rb = i[live], j[live], dots[live], ra[live], rb[live]
        whole = np.sqrt(2 - 2 * np.minimum(dots - loss, 1)) + ra + rb <= limit - SLACK
        out.ranges(na["start"][i[whole]], na["end"][i[whole]], nb["start"][j[whole]], nb["end"][j[whole]])
        i, j = i[~whole], j[~whole]
        leaf = (na["last"][i] == na["first"][i]) & (nb["last"][j] == nb["first"][j])
        for k in range(0, int(leaf.sum()), 256):
            x, y = i[leaf][k : k + 256], j[leaf][k : k + 256]
            p, q, _ = _product(na["start"][x], na["end"][x], nb["start"][y], nb["end"][y])
            points(p, q)
        return i[~leaf], j[~leaf]

    def split(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of the wider node of each pair with the other node, or with its children if it is as wide."""
        ra, rb = np.where(na["last"][i] > na["first"][i], na["radius"][i], -1.0), np.where(nb["last"][j] > nb["first"][j], nb["radius"][j], -1.0)
        open_a, open_b = ra >= rb / 2, rb >= ra / 2
        fa, la = np.where(open_a & (ra >= 0), na["first"][i], i), np.where(open_a & (ra >= 0), na["last"][i], i + 1)
        fb, lb = np.where(open_b & (rb >= 0), nb["first"][j], j), np.where(open_b & (rb >= 0), nb["last"][j], j + 1)
        p, q, _ = _product(fa, la, fb, lb)
        return p, q

    # top: the children of the roots, all against all, in strips
    top = lambda t: np.arange(t["first"][0], t["last"][0]) if t["last"][0] > t["first"][0] else np.zeros(1, np.int64)
    ta, tb = top(na), top(nb)
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    widest = nb["radius"][tb].max()
    cb = np.ascontiguousarray(b.x32[nb["centre"][tb]].T)
    for i in range(0, len(ta), 512):
        strip = ta[i : i + 512]
        dots = a.x32[na["centre"][strip]] @ cb
        reach = limit + na["radius"][strip] + widest + SLACK
        p, q = np.nonzero(dots >= (1 - reach * reach / 2 - 2 * loss)[:, None].astype(np.float32))
        if same:
            p, q = p[strip[p] < tb[q]], q[strip[p] < tb[q]]
        pending.append(settle(strip[p], tb[q], dots[p, q].astype(np.float64)))
    alone = ta if same else np.zeros(0, np.int64)  # nodes to be compared with themselves
    while pending or len(alone):
        if len(alone):
            r = na["radius"][alone]
            whole = 2 * r <= limit - SLACK
            out.within(na["start"][alone[whole]], na["end"][alone[whole]])
            alone = alone[~whole]
            leaf = na["last"][alone] == na["first"][alone]
            for k in alone[leaf]:  # a node wider than the limit allows is no leaf, but a point may be
                p, q = np.triu_indices(na["end"][k] - na["start"][k], 1)
                points(na["start"][k] + p, na["start"][k] + q)
            alone = alone[~leaf]
            p, q, _ = _product(na["first"][alone], na["last"][alone], na["first"][alone], na["last"][alone])
            pending.append((np.r_[p[p < q]], np.r_[q[p < q]], None))
            alone = p[p == q]
            continue
        item = pending.pop()
        i, j = split(*item) if len(item) == 2 else item[:2]
        for k in range(0, len(i), 500_000):
            x, y = i[k : k + 500_000], j[k : k + 500_000]
            dots = np.empty(len(x))
            for s in range(0, len(x), 50_000):
                dots[s : s + 50_000] = np.einsum("ij,ij->i", a.x32[na["centre"][x[s : s + 50_000]]], b.x32[nb["centre"][y[s : s + 50_000]]])
            rest = settle(x, y, dots)
            if len(rest[0]):
                pending.append(rest)
    return out.result()


def _blocks(points: DataFrame, limit: float) -> DataFrame:
    """Cover tree of each block, in a file of its own: block, cell, dim, file, n, weight, centre, radius."""
    spark = points.sparkSession
    counts = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per length of vectors
    folder, n = scratch_path(spark, "cover-trees"), sum(r.n for r in counts)
    n_pivots = max(1, min(PIVOTS, n // BLOCK))
    sample = points.select("point", "vec", "dim").orderBy(F.xxhash64("point")).limit(n_pivots).collect()  # bounded by PIVOTS
    pivots: dict[int, np.ndarray] = {}
    for dim in {r.dim for r in sample}:
        pivots[dim] = _unit([bytes(r.vec) for r in sample if r.dim == dim])

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in frames:
            cell = np.zeros(len(t), np.int64)
            for dim, rows in t.groupby("dim").indices.items():
                if dim in pivots:
                    cell[rows] = (_unit(list(t.vec.iloc[rows])) @ pivots[dim].T).argmax(1)
            yield t.assign(cell=cell)

    d = points.mapInPandas(tidy(nearest), "point bigint, vec binary, n bigint, dim int, cell bigint")
    d = cut(d, "cells")
    size = d.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    d = d.join(size, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")))

    def build(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        x = _unit(list(t.vec))
        order, nodes = build_tree(x, limit)
        tree = Tree(x[order], t.point.to_numpy()[order], t.n.to_numpy()[order], nodes)
        name = f"{folder}/{key[0]}-{key[1]}-{key[2]}-{uuid.uuid4().hex[:12]}.tree"
        write_shared(name, tree.parts())
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "part": [key[2]], "file": [name], "weight": [int(t.n.sum())], "centre": [tree.x[nodes["centre"][0]]], "radius": [nodes["radius"][0]]})

    trees = d.groupBy("dim", "cell", "part").applyInPandas(build, "dim int, cell bigint, part bigint, file string, weight bigint, centre array<double>, radius double")
    return cut(trees.withColumn("block", F.monotonically_increasing_id()), "trees")


def _near_blocks(blocks: DataFrame, limit: float) -> DataFrame:
    """Pairs of blocks (a <= b, by number) that may hold links: the traversal from the root through the cells."""
    middle = blocks.groupBy("dim", "cell").agg(F.min_by("centre", "block").alias("centre"), F.collect_list(F.struct("centre", "radius")).alias("under"))

    def gap(p: str, q: str) -> str:
        return f"sqrt(greatest(2 - 2 * aggregate(zip_with({p}, {q}, (x, y) -> x * y), 0D, (s, x) -> s + x), 0D))"

    # the radius of a cell covers its blocks
    middle = middle.withColumn("radius", F.expr(f"aggregate(under, 0D, (m, u) -> greatest(m, {gap('centre', 'u.centre')} + u.radius))")).drop("under")

    def meet(pairs: DataFrame, below: DataFrame, parent: list[str], name: str) -> DataFrame:
        """Children of both nodes of each pair that are close enough, each pair once."""
        side = lambda x: below.select(*(F.col(c).alias(f"{c}_{x}") for c in (*parent, name, "centre", "radius") if c in below.columns))
        on = lambda x: [f"{c}_{x}" for c in parent]
        d = pairs.join(side("a"), on("a")).join(side("b"), on("b")).where(F.expr("radius_a IS NOT NULL"))
        return d.where(F.expr(f"{gap('centre_a', 'centre_b')} <= {limit!r} + radius_a + radius_b + {SLACK!r}"))

    # the roots are the lengths of vectors; they pair with themselves only
    root = blocks.select(F.col("dim").alias("dim_a"), F.col("dim").alias("dim_b")).distinct()
    cells = meet(root, middle, ["dim"], "cell").where("cell_a <= cell_b").select("dim_a", "cell_a", "dim_b", "cell_b")
    pairs = meet(cells, blocks.select("dim", "cell", "block", "centre", "radius"), ["dim", "cell"], "block")
    pairs = pairs.where("cell_a < cell_b OR block_a <= block_b").select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))
    for x in ("a", "b"):
        pairs = pairs.join(blocks.select(F.col("block").alias(x), F.col("file").alias(f"file_{x}")), x)
    return pairs


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """id, n_links, component_id (smallest id reachable), kept, of every row: see the module's notes."""
    limit = float(np.sqrt(2 - 2 * cosine))
    raw = cut(_raw_vectors(vectors, id_col, vec_col), "vectors")
    points = raw.where("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    points = cut(points.withColumn("point", F.monotonically_increasing_id()), "points")
    dims = points.select("point", "vec", "n", (F.octet_length("vec") / 8).cast("int").alias("dim"))
    blocks = _blocks(dims, limit)
    pairs = cut(_near_blocks(blocks, limit), "block-pairs")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: OrderedDict[str, Tree] = OrderedDict()

        def tree(path: str) -> Tree:
            if path not in trees:
                trees[path] = Tree.read(path)
                while len(trees) > 4:
                    trees.popitem(last=False)
            trees.move_to_end(path)
            return trees[path]

        for t in frames:
            for p, q in zip(t.file_a, t.file_b, strict=True):
                a = tree(p)
                yield traverse(a, tree(q) if q != p else a, cosine)

    # a pair of blocks is much work for a small row: a few to each task
    dealt = pairs.select("file_a", "file_b").repartition(max(8, pairs.count() // 8))
    found = cut(dealt.mapInPandas(tidy(run), "point bigint, n bigint, to bigint"), "point-links")
    linked = components(found.select(F.col("point").alias("a"), F.col("to").alias("b"))).withColumnRenamed("id", "point")
    n_links = found.groupBy("point").agg(F.sum("n").alias("links"))
    whole = points.join(linked, "point", "left").join(n_links, "point", "left").withColumn("component", F.coalesce("component", "point"))
    least = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    whole = whole.join(least, "component").select("vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = raw.join(whole, "vec", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("vec").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
