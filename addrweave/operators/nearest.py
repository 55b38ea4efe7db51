"""Nearest neighbours between piles: many positions beside many features of one address.

A grid cell bounds pairs by the search distance only: a thousand positions and a thousand features within centimetres meet
pairwise there. Here both sides of such a pile are split into boxes, round by round, in halves of each axis of a box's own
extent. Of a box of positions, a box of features stays a partner only if its least possible distance does not exceed the largest
possible distance to the best partner (and the limit): what is left is, for each box of positions, the few boxes of features that
can hold a nearest one. A pair of boxes with few pairs of members goes on to positions one by one, then to exact distances.

Each round is a join of the pairs of boxes with both sides' parts, written down; its rows follow the number of
boxes, not the product of members. Bounds hold for any feature inside its box, so lines are pruned like points (only lines of one
address that share their middle are not told apart by boxes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions.geo import M_PER_DEG, dist_point_line
from addrweave.operators.spatial_join import by_merge, grid_for, within_pairs

PILE = 32  # positions of one address in a grid cell from which they count as a pile
FEW = 32  # pairs of members of two boxes that are compared one by one

_KEYS = ["i_hn", "i_street"]
_P_BOX = ["p_x0", "p_y0", "p_x1", "p_y1"]
_Q_BOX = ["min_lon", "min_lat", "max_lon", "max_lat"]
#: Rounding of bounds, in metres and as a share: far above that of the distances, far below what matters.
_SLACK, _SHARE = 1e-6, 1e-9


def _extent(box: list[str], x: Column, y: Column) -> list[Column]:
    """The box of a group, its members, and whether they have one middle."""
    x0, y0, x1, y1 = box
    whole = (F.min(x) == F.max(x)) & (F.min(y) == F.max(y))
    return [F.min(x0).alias(x0), F.min(y0).alias(y0), F.max(x1).alias(x1), F.max(y1).alias(y1), F.count(F.lit(1)).alias("n"), whole.alias("whole")]


def distance_bounds(p: list[str] = _P_BOX, q: list[str] = _Q_BOX) -> tuple[Column, Column]:
    """Least and largest metres between a position in box ``p`` and anything inside box ``q`` (local plane at the position)."""
    px0, py0, px1, py1 = map(F.col, p)
    qx0, qy0, qx1, qy1 = map(F.col, q)
    high = F.greatest(F.abs(py0), F.abs(py1))
    low = F.when((py0 <= 0) & (py1 >= 0), F.lit(0.0)).otherwise(F.least(F.abs(py0), F.abs(py1)))
    none = F.lit(0.0)

    def metres(dx: Column, dy: Column, lat: Column) -> Column:
        return F.sqrt(F.pow(dx * F.cos(F.radians(lat)), 2) + F.pow(dy, 2)) * M_PER_DEG

    near = metres(F.greatest(qx0 - px1, px0 - qx1, none), F.greatest(qy0 - py1, py0 - qy1, none), high)
    far = metres(F.greatest(qx1 - px0, px1 - qx0), F.greatest(qy1 - py0, py1 - qy0), low)
    return near * (1 - _SHARE) - _SLACK, far * (1 + _SHARE) + _SLACK


def in_cells(spots: DataFrame, metres: float) -> DataFrame:
    """Positions with their grid cell ``cx, cy``."""
    side = grid_for(metres).cell_deg
    return spots.select("*", F.floor(F.col("p_lon") / side).alias("cx"), F.floor(F.col("p_lat") / side).alias("cy"))


def piles(spots: DataFrame, metres: float) -> DataFrame:
    """``i_hn, i_street, cx, cy``: grid cells with ``PILE`` positions of one address or more."""
    held = in_cells(spots, metres).groupBy(*_KEYS, "cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    return held.where(F.col("n") >= PILE).drop("n")


def _roots(spots: DataFrame, feats: DataFrame, metres: float) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``node``: a grid cell each; a feature larger than a cell is a box of its own."""
    side = grid_for(metres).cell_deg
    p = spots.withColumn("node", F.xxhash64(F.floor(F.col("p_lon") / side), F.floor(F.col("p_lat") / side)))
    large = (F.col("max_lon") - F.col("min_lon") > side) | (F.col("max_lat") - F.col("min_lat") > side)
    cell = F.xxhash64(F.floor(F.col("min_lon") / side), F.floor(F.col("min_lat") / side))
    return p, feats.withColumn("node", F.when(large, F.xxhash64(F.lit("large"), "id")).otherwise(cell))


def _halves(d: DataFrame, boxes: DataFrame, keys: list[str], x: Column, y: Column) -> DataFrame:
    """Rows of the listed boxes with ``part``: the quarter of their middles' extent that they stand in. Unless all middles
    are one, there are two parts at least."""
    extents = d.groupBy(*keys, "node").agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))

    def upper(v: Column, a: Column, b: Column) -> Column:
        return ((v > (a + b) / 2) | ((v == b) & (b > a))).cast("int")

    quarter = upper(x, F.col("_x0"), F.col("_x1")) * 2 + upper(y, F.col("_y0"), F.col("_y1"))
    listed = boxes.select(*keys, "node").join(by_merge(extents), [*keys, "node"])
    return d.join(by_merge(listed), [*keys, "node"]).withColumn("part", F.xxhash64("node", quarter)).drop("_x0", "_x1", "_y0", "_y1")


def nearest_in_piles(spots: DataFrame, feats: DataFrame, metres: float, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Per position and feature type the nearest feature of the same address within ``metres``, then lowest id:
    ``i_hn, i_street, p_lon, p_lat, type, dist, id``.

    ``spots`` (i_hn, i_street, p_lon, p_lat) are distinct; ``feats`` (l_hn, l_street, type, id, geom and box) hold no
    two equal geometries of one address and type. ``keep(df, name)`` writes and reads back a round's tables.
    """
    typed = [*_KEYS, "type"]
    of_p, of_q = [*_KEYS, "p_node"], [*typed, "q_node"]
    feats = feats.withColumnsRenamed({"l_hn": "i_hn", "l_street": "i_street"})
    p, q = _roots(spots, feats.join(by_merge(spots.select(*_KEYS).distinct()), _KEYS, "left_semi"), metres)
    p, q = keep(p, "pile_spots"), keep(q, "pile_features")
    q_x, q_y = (F.col("min_lon") + F.col("max_lon")) / 2, (F.col("min_lat") + F.col("max_lat")) / 2

    def p_boxes(d: DataFrame) -> DataFrame:
        d = d.select("*", F.col("p_lon").alias("p_x0"), F.col("p_lon").alias("p_x1"), F.col("p_lat").alias("p_y0"), F.col("p_lat").alias("p_y1"))
        return d.groupBy(*_KEYS, "node").agg(*_extent(_P_BOX, F.col("p_lon"), F.col("p_lat")))

    def q_boxes(d: DataFrame) -> DataFrame:
        return d.groupBy(*typed, "node").agg(*_extent(_Q_BOX, q_x, q_y))

    def bounded(pairs: DataFrame, pb: DataFrame, qb: DataFrame) -> DataFrame:
        """Pairs of boxes that can hold a nearest pair, with ``bound``, and whether they are small enough."""
        near, far = distance_bounds()
        d = pairs.join(by_merge(pb.withColumnsRenamed({"node": "p_node", "n": "n_p", "whole": "p_whole"})), of_p)
        d = d.join(by_merge(qb.withColumnsRenamed({"node": "q_node", "n": "n_q", "whole": "q_whole"})), of_q)
        ready = (F.col("n_p") * F.col("n_q") <= FEW) | (F.col("p_whole") & F.col("q_whole"))  # or nothing is left to split
        d = d.select(*of_q, "p_node", "bound", near.alias("near"), far.alias("far"), ready.alias("ready"))
        d = keep(d.where(F.col("near") <= metres), "pile_bounds")
        best = d.groupBy(*typed, "p_node").agg(F.least(F.min("far"), F.min("bound")).alias("least"))
        return d.join(by_merge(best), [*typed, "p_node"]).where(F.col("near") <= F.col("least")).select(*of_q, "p_node", F.col("least").alias("bound"), "ready")

    def one_by_one(pairs: DataFrame, p: DataFrame, q: DataFrame, qb: DataFrame) -> DataFrame:
        """Exact distances of the members of pairs of boxes; a position leaves out boxes that its own bound rules out."""
        boxes = qb.withColumnRenamed("node", "q_node").drop("n", "whole")
        spot = [*_KEYS, "p_lon", "p_lat", "type"]
        near, far = distance_bounds(["p_lon", "p_lat", "p_lon", "p_lat"])
        d = pairs.select(*of_q, "p_node", "bound").join(by_merge(p.withColumnRenamed("node", "p_node")), of_p).join(by_merge(boxes), of_q)
        d = d.select(*spot, "q_node", "bound", near.alias("near"), far.alias("far"))
        least = d.groupBy(*spot).agg(F.least(F.min("far"), F.min("bound")).alias("least"))
        d = d.join(by_merge(least), spot).where((F.col("near") <= F.col("least")) & (F.col("near") <= metres))
        d = d.join(by_merge(q.withColumnRenamed("node", "q_node")), of_q).select(*spot, "id", dist_point_line("p_lon", "p_lat", "geom").alias("dist"))
        return keep(d, "pile_pairs").where(F.col("dist") <= metres).groupBy(*spot).agg(F.min(F.struct("dist", "id")).alias("best"))

    pb, qb = p_boxes(p), q_boxes(q)
    # the first pairs come from the grid: from the middle of a box of positions, its half diagonal further
    middle = pb.select(
        *(F.col(c).alias(f"at_{c}") for c in _KEYS),
        F.col("node").alias("p_node"),
        ((F.col("p_x0") + F.col("p_x1")) / 2).alias("p_lon"),
        ((F.col("p_y0") + F.col("p_y1")) / 2).alias("p_lat"),
    )
    reach = metres + grid_for(metres).cell_deg * M_PER_DEG
    q_side = qb.select(*typed, F.col("node").alias("q_node"), *_Q_BOX)
    pairs = within_pairs(middle, q_side, reach, lambda *_: F.lit(0.0), keys=[(f"at_{c}", c) for c in _KEYS], levels_in_use=True)
    pairs = keep(pairs.select(*of_q, "p_node", F.lit(float("inf")).alias("bound")), "pile_roots")
    found = []
    while True:
        pairs = keep(bounded(pairs, pb, qb), "pile_nodes")
        found.append(one_by_one(pairs.where("ready"), p, q, qb))
        pairs = pairs.where("NOT ready")
        if pairs.isEmpty():
            break
        heavy_p = pb.join(by_merge(pairs.select(*_KEYS, F.col("p_node").alias("node")).distinct()), [*_KEYS, "node"], "left_semi")
        heavy_q = qb.join(by_merge(pairs.select(*typed, F.col("q_node").alias("node")).distinct()), [*typed, "node"], "left_semi")
        p = keep(_halves(p, heavy_p, _KEYS, F.col("p_lon"), F.col("p_lat")), "pile_spots")
        q = keep(_halves(q, heavy_q, typed, q_x, q_y), "pile_features")
        p_parts = p.select(*_KEYS, F.col("node").alias("p_node"), F.col("part").alias("p_part")).distinct()
        q_parts = q.select(*typed, F.col("node").alias("q_node"), F.col("part").alias("q_part")).distinct()
        pairs = pairs.join(by_merge(p_parts), of_p).join(by_merge(q_parts), of_q).select(*typed, F.col("p_part").alias("p_node"), F.col("q_part").alias("q_node"), "bound")
        p, q = p.drop("node").withColumnRenamed("part", "node"), q.drop("node").withColumnRenamed("part", "node")
        pb, qb = p_boxes(p), q_boxes(q)
    out = found[0]
    for d in found[1:]:
        out = out.unionByName(d)
    # pairs of one position can become few in different rounds
    out = out.groupBy(*_KEYS, "p_lon", "p_lat", "type").agg(F.min("best").alias("best"))
    return out.select(*_KEYS, "p_lon", "p_lat", "type", "best.dist", "best.id")
