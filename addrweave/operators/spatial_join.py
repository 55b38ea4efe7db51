"""Distance joins between points and features on a multi-level grid (equi-join on cells).

Spark has no spatial index, and a join on a distance predicate alone would plan
as a nested-loop join. Instead:

* every point gets exactly one cell per grid level: ``floor(lon/c), floor(lat/c)``; with ``levels_in_use`` (for features
  that are written: their boxes are read twice) only for levels that some feature has, found by one small aggregate
  that is evaluated with the join;
* every feature picks the finest level at which its bounding box, expanded by
  the search distance, covers at most ``max_cells`` cells, and is exploded to
  those cells;
* the two sides are equi-joined on ``(level, cx, cy)`` plus optional extra keys,
  then filtered by the expanded box and the exact distance.

A point has one cell per level and a feature one level, so each (point,
feature) pair meets at most once: no de-duplication is needed. Hot cells are
ordinary skewed join keys; AQE's skew-join handling splits them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions.geo import M_PER_DEG, metres_to_lat_degrees, sql_lon_expand_degrees


BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


@dataclass(frozen=True)
class Grid:
    """Grid parameters for a search radius of ``metres``."""

    metres: float
    cell_deg: float
    levels: int = 4
    max_cells: int = 16

    def size(self, level: int) -> float:
        return self.cell_deg * LEVELS[level]


#: Ids that are sent to all tasks (about 150 bytes each, as the hash table that they become there and on the driver).
FEW_IDS = 200_000


def by_merge(side: DataFrame) -> DataFrame:
    """A side of a join that both sides are shuffled and sorted for. Left to itself, Spark judges a written table by the size of its compressed
    files and sends up to 10 MB of those to all tasks: hundreds of MB as a hash table. Small tables that were counted are
    broadcast by name (``FEW_IDS``), which goes first."""
    return side.hint("merge")


#: Rows of one key from which on a sorted join deals them out to several tasks.
MANY_ROWS = 10_000


def semi_join_shared_out(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], by: Column) -> DataFrame:
    """``rows`` whose ``keys`` are among ``wanted`` (distinct). A key of ``MANY_ROWS`` rows or more comes in shares of about that
    many, told by the hash ``by``, each of which meets the wanted key in a task of its own: left to itself, Spark splits a key from
    256 MB of compressed rows on only, several GB once sorted. Such keys are counted by an aggregate and sent to all tasks, at most one for
    ``MANY_ROWS`` rows."""
    keys = list(keys)
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= MANY_ROWS)
    many = F.broadcast(many.select(*keys, F.ceil(F.col("_n") / MANY_ROWS).alias("_shares")))
    shares = F.coalesce("_shares", F.lit(1))
    columns = rows.columns
    dealt = rows.join(many, keys, "left").withColumn("_share", F.pmod(by, shares)).drop("_shares")
    each = wanted.join(many, keys, "left").select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)).alias("_share"))
    return dealt.join(by_merge(each), [*keys, "_share"], "left_semi").select(*columns)


# cells of a level, in base cells of at least 20 m: houses, blocks, regions (about 80 km), and half the earth, where
# no feature has more than ``max_cells``
LEVELS = (1, 16, 4096, 1 << 20)


def grid_for(metres: float, levels: int = len(LEVELS), max_cells: int = 16) -> Grid:
    """Base cell about four search radii (at least 20 m) tall; coarser levels for large features."""
    metres = max(float(metres), 0.0)
    cell_m = max(4.0 * metres, 20.0)
    return Grid(metres=metres, cell_deg=cell_m / M_PER_DEG, levels=levels, max_cells=max_cells)


def point_cells(
    points: DataFrame, grid: Grid, lon: str = "p_lon", lat: str = "p_lat", prefix: str = "", levels: Column | None = None
) -> DataFrame:
    """One row per point and level with columns ``{prefix}lvl, {prefix}cx, {prefix}cy``; ``levels`` (an array) names
    the levels to make, by default all."""
    cells = [
        f"named_struct('lvl', {k}, 'cx', floor({lon} / {grid.size(k)!r}D), 'cy', floor({lat} / {grid.size(k)!r}D))" for k in range(grid.levels)
    ]
    cells = f"array({', '.join(cells)})"
    cols = points.columns
    if levels is not None:
        points = points.withColumn("_levels", levels)
        cells = f"filter({cells}, c -> array_contains(_levels, c.lvl))"
    names = ", ".join(f"{prefix}{c}" for c in ("lvl", "cx", "cy"))
    return points.select(*cols, F.expr(f"inline({cells}) AS ({names})"))


def feature_levels(features: DataFrame, grid: Grid) -> DataFrame:
    """Expanded box (``e_min_lon`` …) and level (``lvl``) of each feature, from its box columns
    ``min_lon, min_lat, max_lon, max_lat``."""
    e_lat = f"{metres_to_lat_degrees(grid.metres)!r}D"
    e_lon = sql_lon_expand_degrees(grid.metres, "greatest(abs(min_lat), abs(max_lat))")
    df = features.selectExpr(
        "*",
        f"min_lon - {e_lon} AS e_min_lon",
        f"max_lon + {e_lon} AS e_max_lon",
        f"min_lat - {e_lat} AS e_min_lat",
        f"max_lat + {e_lat} AS e_max_lat",
    )

    def n_cells(level: int) -> str:
        c = f"{grid.size(level)!r}D"
        return " * ".join(f"(floor(e_max_{v} / {c}) - floor(e_min_{v} / {c}) + 1)" for v in ("lon", "lat"))

    whens = " ".join(f"WHEN {n_cells(k)} <= {grid.max_cells} THEN {k}" for k in range(grid.levels - 1))
    return df.selectExpr("*", f"CASE {whens} ELSE {grid.levels - 1} END AS lvl" if whens else "0 AS lvl")


def feature_cells(features: DataFrame, grid: Grid) -> DataFrame:
    """Expanded box, and one row per covered cell (``lvl, cx, cy``)."""
    df = feature_levels(features, grid)
    size = "CASE lvl " + " ".join(f"WHEN {k} THEN {grid.size(k)!r}D" for k in range(grid.levels)) + " END"
    size = f"({size})"
    cells = (
        f"flatten(transform(sequence(floor(e_min_lon / {size}), floor(e_max_lon / {size})), "
        f"x -> transform(sequence(floor(e_min_lat / {size}), floor(e_max_lat / {size})), "
        f"y -> named_struct('cx', x, 'cy', y))))"
    )
    return df.selectExpr("*", f"inline({cells}) AS (cx, cy)")


_HELPER_COLUMNS = ("_p_lvl", "_p_cx", "_p_cy", "lvl", "cx", "cy", "e_min_lon", "e_max_lon", "e_min_lat", "e_max_lat")


def points_at_levels_in_use(points: DataFrame, features: DataFrame, grid: Grid, p_lon: str = "p_lon", p_lat: str = "p_lat") -> DataFrame:
    """A row for each point and level that some feature has (an array of a few numbers, found by one aggregate over boxes)."""
    in_use = feature_levels(features.select(*BOX), grid).agg(F.collect_set("lvl")).scalar()
    return point_cells(points, grid, p_lon, p_lat, prefix="_p_", levels=in_use)


def _cell_join(points, features, metres, grid, p_lon, p_lat, keys, how, extra=None, levels_in_use=False):
    grid = grid or grid_for(metres)
    if levels_in_use:
        p = points_at_levels_in_use(points, features, grid, p_lon, p_lat)
    else:
        p = point_cells(points, grid, p_lon, p_lat, prefix="_p_")
    f = feature_cells(features, grid)
    equal = [("_p_lvl", "lvl"), ("_p_cx", "cx"), ("_p_cy", "cy"), *keys]
    cond = F.expr(
        " AND ".join(f"{a} = {b}" for a, b in equal)
        + f" AND {p_lon} BETWEEN e_min_lon AND e_max_lon AND {p_lat} BETWEEN e_min_lat AND e_max_lat"
    )
    if extra is not None:
        cond = cond & extra
    return p.join(by_merge(f), cond, how)


def within_pairs(
    points: DataFrame,
    features: DataFrame,
    metres: float,
    distance: Callable[[str, str, str], Column],
    keys: Sequence[tuple[str, str]] = (),
    grid: Grid | None = None,
    p_lon: str = "p_lon",
    p_lat: str = "p_lat",
    geom: str = "geom",
    levels_in_use: bool = False,
) -> DataFrame:
    """All (point, feature) pairs with ``distance(p_lon, p_lat, geom) <= metres``, with column ``dist``.

    ``keys`` are extra equality pairs ``(point_column, feature_column)`` (e.g. house
    number and street). Column names of the two sides must not clash.
    """
    joined = _cell_join(points, features, metres, grid, p_lon, p_lat, keys, "inner", levels_in_use=levels_in_use)
    return _within(joined, metres, distance(p_lon, p_lat, geom)).drop(*_HELPER_COLUMNS)


def _within(joined: DataFrame, metres: float, distance: Column) -> DataFrame:
    """Rows whose ``distance`` is at most ``metres``, with ``dist``.

    The distance is produced by a one-element generator and filtered there: a plain filter on a projected distance would
    be pushed into the join condition and the (vertex-loop) distance evaluated twice per pair."""
    dist = F.explode(F.filter(F.array(distance), lambda d: d <= F.lit(float(metres)))).alias("dist")
    return joined.select(*joined.columns, dist)


def box_pairs(points: DataFrame, features: DataFrame, ids: Sequence[str], metres: float, levels_in_use: bool = False) -> DataFrame:
    """Points with the ``ids`` of features whose box lies within ``metres``: no geometry goes through the cells."""
    joined = _cell_join(points, features.select(*ids, *BOX), metres, None, "p_lon", "p_lat", (), "inner", levels_in_use=levels_in_use)
    return joined.select(*points.columns, *ids)


def named_by(features: DataFrame, pairs: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Features whose ``ids`` occur in ``pairs``, a written table. It is counted, and up to ``FEW_IDS`` ids are sent to the features,
    which then need no shuffle; more are sorted and merged."""
    wanted = pairs.select(*ids).distinct()
    wanted = F.broadcast(wanted) if pairs.count() <= FEW_IDS else by_merge(wanted)
    return features.join(wanted, list(ids), "left_semi")


def within_by_id(pairs: DataFrame, features: DataFrame, ids: Sequence[str], metres: float, distance: Callable[[str, str, str], Column], geom: str = "geom") -> DataFrame:
    """Those of ``pairs`` (of points and feature ids) within ``metres``, with the features' geometry and ``dist``."""
    return _within(pairs.join(by_merge(features), list(ids)), metres, distance("p_lon", "p_lat", geom))


def left_within(
    points: DataFrame,
    features: DataFrame,
    metres: float,
    distance: Callable[[str, str, str], Column],
    grid: Grid | None = None,
    p_lon: str = "p_lon",
    p_lat: str = "p_lat",
    geom: str = "geom",
) -> DataFrame:
    """Every point row (once per grid level) with the features within ``metres``, or NULL feature columns.

    A left outer join on the cell with the box and distance tests in the join
    condition; callers aggregate per point key (e.g. count features), which also
    folds the per-level copies of a point back into one row.
    """
    extra = distance(p_lon, p_lat, geom) <= F.lit(float(metres))
    joined = _cell_join(points, features, metres, grid, p_lon, p_lat, (), "left", extra)
    return joined.select(*[c for c in joined.columns if c not in _HELPER_COLUMNS])
