"""Planar geometry on vertex arrays, as Spark SQL expressions (no UDFs).

A geometry is ``ARRAY<STRUCT<lon DOUBLE, lat DOUBLE>>``: a node is a one-vertex
array, a way its vertex list, a ring a closed vertex list (first == last).
Distances are metres in a local plane centred on the query point:
``x = dlon * cos(lat0) * M``, ``y = dlat * M`` with ``M`` metres per degree on the
sphere of radius ``EARTH_RADIUS_M``. Edges are straight in lon/lat.

Loops over vertices are ``transform``/``exists``/``filter``/``aggregate`` over
``sequence`` so everything runs in the JVM. The builders produce SQL text
(``sql_*``), which the public functions wrap with ``F.expr``: one call per
expression instead of thousands of Column-API round trips from Python.
Arguments are SQL expressions (usually plain column names). Values used more than
once are bound once to a lambda variable (``_let``) so that optimizer rewrites that
substitute an input expression never multiply it.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in metres, and metres per degree on that sphere.
EARTH_RADIUS_M = 6371008.7714
M_PER_DEG = EARTH_RADIUS_M * math.pi / 180.0

_M = f"{M_PER_DEG!r}D"
_ids = itertools.count()


def _v(prefix: str) -> str:
    """A fresh lambda variable name (nested lambdas must not shadow each other)."""
    return f"{prefix}_{next(_ids)}"


def _let(value: str, body) -> str:
    """Evaluate ``value`` once; ``body(var)`` returns SQL using the bound name."""
    v = _v("let")
    return f"transform(array({value}), {v} -> {body(v)})[0]"


def _d(x: float) -> str:
    return f"{float(x)!r}D"


# --------------------------------------------------------------------------- basics


def sql_point(lon: str, lat: str) -> str:
    return f"array(named_struct('lon', CAST({lon} AS DOUBLE), 'lat', CAST({lat} AS DOUBLE)))"


def point(lon: str, lat: str) -> Column:
    """a one-vertex geometry."""
    return F.expr(sql_point(lon, lat))


def bbox_columns(geom: str, prefix: str = "") -> list[Column]:
    """min_lon, min_lat, max_lon, max_lat of a vertex array (plain doubles: they push down)."""
    p = _v("p")
    return [
        F.expr(f"array_min(transform({geom}, {p} -> {p}.lon))").alias(prefix + "min_lon"),
        F.expr(f"array_min(transform({geom}, {p} -> {p}.lat))").alias(prefix + "min_lat"),
        F.expr(f"array_max(transform({geom}, {p} -> {p}.lon))").alias(prefix + "max_lon"),
        F.expr(f"array_max(transform({geom}, {p} -> {p}.lat))").alias(prefix + "max_lat"),
    ]


def sql_is_closed(geom: str) -> str:
    return _let(
        geom,
        lambda g: f"(size({g}) >= 4 AND {g}[0].lon = element_at({g}, -1).lon AND {g}[0].lat = element_at({g}, -1).lat)",
    )


def is_closed(geom: str) -> Column:
    """First vertex equals last vertex, and a ring needs at least 4 vertices."""
    return F.expr(sql_is_closed(geom))


# --------------------------------------------------------------------------- distances


def _sql_seg_dist(px: str, py: str, kx: str, a: str, b: str) -> str:
    """Metres from (px, py) to segment a-b by clamped projection in the local plane."""

    def with_vec(s: str) -> str:
        def with_t(t: str) -> str:
            return f"sqrt(pow({s}.ax + {t} * {s}.dx, 2) + pow({s}.ay + {t} * {s}.dy, 2))"

        dd = f"({s}.dx * {s}.dx + {s}.dy * {s}.dy)"
        t_expr = f"CASE WHEN {dd} > 0 THEN greatest(0D, least(1D, -({s}.ax * {s}.dx + {s}.ay * {s}.dy) / {dd})) ELSE 0D END"
        return _let(t_expr, with_t)

    vec = (
        f"named_struct('ax', ({a}.lon - {px}) * {kx}, 'ay', ({a}.lat - {py}) * {_M}, "
        f"'dx', ({b}.lon - {a}.lon) * {kx}, 'dy', ({b}.lat - {a}.lat) * {_M})"
    )
    return _let(vec, with_vec)


def _sql_point_dist(px: str, py: str, q: str) -> str:
    """Closed form for a one-vertex geometry (no vertex loop)."""
    return f"sqrt(pow(({q}.lat - {py}) * {_M}, 2) + pow(({q}.lon - {px}) * cos(radians({py})) * {_M}, 2))"


def _sql_line_body(px: str, py: str, kx: str, g: str) -> str:
    i, acc = _v("i"), _v("acc")
    seg = _sql_seg_dist(px, py, kx, f"{g}[{i} - 1]", f"{g}[{i}]")
    segs = f"aggregate(sequence(1, size({g}) - 1), CAST('Infinity' AS DOUBLE), ({acc}, {i}) -> least({acc}, {seg}))"
    return f"CASE WHEN size({g}) >= 2 THEN {segs} WHEN size({g}) = 1 THEN {_sql_point_dist(px, py, f'{g}[0]')} END"


def sql_dist_point_line(px: str, py: str, geom: str) -> str:
    def body(g: str) -> str:
        loop = _let(f"cos(radians({py})) * {_M}", lambda kx: _sql_line_body(px, py, kx, g))
        return f"CASE WHEN size({g}) = 1 THEN {_sql_point_dist(px, py, f'{g}[0]')} ELSE {loop} END"

    return _let(geom, body)


def dist_point_line(px: str, py: str, geom: str) -> Column:
    """Metres from a point to a vertex array read as a line (a single vertex is a point).

    This is the distance that ``ST_Intersects(buffer(p, r), line)`` compares with ``r``.
    """
    return F.expr(sql_dist_point_line(px, py, geom))


def dist_point_point(px: str, py: str, qx: str, qy: str) -> Column:
    """Metres between two points, local plane at the first."""
    return F.expr(f"sqrt(pow(({qy} - {py}) * {_M}, 2) + pow(({qx} - {px}) * cos(radians({py})) * {_M}, 2))")


def _sql_crossings(px: str, py: str, g: str) -> str:
    """Ring edges crossed by a ray from (px, py) towards +lon (even-odd rule).

    The division only runs when the edge straddles ``py`` (AND short-circuits), so
    its latitudes differ.
    """
    i = _v("i")
    a, b = f"{g}[{i} - 1]", f"{g}[{i}]"
    cond = (
        f"(({a}.lat > {py}) != ({b}.lat > {py})) AND "
        f"(({px} - {a}.lon) < ({b}.lon - {a}.lon) * ({py} - {a}.lat) / ({b}.lat - {a}.lat))"
    )
    return f"CASE WHEN size({g}) >= 2 THEN size(filter(sequence(1, size({g}) - 1), {i} -> {cond})) ELSE 0 END"


def sql_point_in_ring(px: str, py: str, ring: str) -> str:
    return _let(ring, lambda g: f"({_sql_crossings(px, py, g)} % 2 = 1)")


def point_in_ring(px: str, py: str, ring: str) -> Column:
    """Even-odd point-in-polygon for one closed ring (boundary handled by the caller)."""
    return F.expr(sql_point_in_ring(px, py, ring))


def sql_dist_point_polygon(px: str, py: str, ring: str, bbox: tuple[str, str, str, str] | None = None) -> str:
    def body(g: str) -> str:
        line = _let(f"cos(radians({py})) * {_M}", lambda kx: _sql_line_body(px, py, kx, g))
        full = f"CASE WHEN {_sql_crossings(px, py, g)} % 2 = 1 THEN 0D ELSE {line} END"
        if bbox is None:
            return full
        x0, y0, x1, y1 = bbox
        # outside the ring's box the point cannot be inside: skip the crossing loop
        return f"CASE WHEN {px} < {x0} OR {px} > {x1} OR {py} < {y0} OR {py} > {y1} THEN {line} ELSE {full} END"

    return _let(ring, body)


def dist_point_polygon(px: str, py: str, ring: str, bbox: tuple[str, str, str, str] | None = None) -> Column:
    """Metres from a point to the polygon filled by a closed ring: 0 inside, else edge distance.

    ``bbox`` (column names of the ring's box), when given, lets points outside the
    box skip the inside test.
    """
    return F.expr(sql_dist_point_polygon(px, py, ring, bbox))


# --------------------------------------------------------------------------- intersections


def _sql_orient(p: tuple[str, str], q: tuple[str, str], r: tuple[str, str]) -> str:
    """Sign of the turn p -> q -> r (cross product in lon/lat)."""
    return f"signum(({q[0]} - {p[0]}) * ({r[1]} - {p[1]}) - ({q[1]} - {p[1]}) * ({r[0]} - {p[0]}))"


def _sql_segments_intersect(a1, a2, b1, b2) -> str:
    """Closed segments a1-a2 and b1-b2 share a point (touching counts). Args are (lon, lat) SQL pairs.

    Straddle tests on both segments; in the all-collinear case the box overlap decides.
    """
    boxes = (
        f"greatest({a1[0]}, {a2[0]}) >= least({b1[0]}, {b2[0]}) AND greatest({b1[0]}, {b2[0]}) >= least({a1[0]}, {a2[0]}) AND "
        f"greatest({a1[1]}, {a2[1]}) >= least({b1[1]}, {b2[1]}) AND greatest({b1[1]}, {b2[1]}) >= least({a1[1]}, {a2[1]})"
    )
    o1 = _sql_orient(a1, a2, b1)
    o2 = _sql_orient(a1, a2, b2)
    o3 = _sql_orient(b1, b2, a1)
    o4 = _sql_orient(b1, b2, a2)
    return f"({boxes} AND {o1} * {o2} <= 0 AND {o3} * {o4} <= 0)"


def _xy(v: str) -> tuple[str, str]:
    return (f"{v}.lon", f"{v}.lat")


def sql_drop_repeated_vertices(geom: str) -> str:
    def body(g: str) -> str:
        i = _v("i")
        j = _v("j")
        keep = f"filter(sequence(0, size({g}) - 1), {i} -> {i} = 0 OR {g}[{i}].lon != {g}[{i} - 1].lon OR {g}[{i}].lat != {g}[{i} - 1].lat)"
        return f"CASE WHEN size({g}) >= 1 THEN transform({keep}, {j} -> {g}[{j}]) ELSE {g} END"

    return _let(geom, body)


def drop_repeated_vertices(geom: str) -> Column:
    """Remove consecutive duplicate vertices (zero-length edges)."""
    return F.expr(sql_drop_repeated_vertices(geom))


def _sql_valid_simple_ring(r: str) -> str:
    n = f"size({r})"
    m = f"({n} - 1)"  # edges; edge i runs from r[i] to r[i+1]
    i, k, s = _v("i"), _v("k"), _v("acc")
    area = (
        f"aggregate(sequence(0, {m} - 1), 0D, ({s}, {k}) -> {s} + ({r}[{k}].lon - {r}[0].lon) * ({r}[{k} + 1].lat - {r}[0].lat)"
        f" - ({r}[{k} + 1].lon - {r}[0].lon) * ({r}[{k}].lat - {r}[0].lat))"
    )
    # Sweep over the edges by western end: an edge is compared with those that still reach as far east.
    e, f, acc = _v("e"), _v("f"), _v("acc")
    p0, p1 = f"{r}[{i}]", f"{r}[{i} + 1]"
    edge = (
        f"named_struct('x0', least({p0}.lon, {p1}.lon), 'i', {i}, 'x1', greatest({p0}.lon, {p1}.lon), "
        f"'ax', {p0}.lon, 'ay', {p0}.lat, 'bx', {p1}.lon, 'by', {p1}.lat)"
    )
    edges = f"array_sort(transform(sequence(0, {m} - 1), {i} -> {edge}))"
    cross = _sql_segments_intersect((f"{e}.ax", f"{e}.ay"), (f"{e}.bx", f"{e}.by"), (f"{f}.ax", f"{f}.ay"), (f"{f}.bx", f"{f}.by"))
    apart = f"abs({e}.i - {f}.i) NOT IN (1, {m} - 1)"  # neighbours share a vertex
    reach = f"filter({acc}.live, {f} -> {f}.x1 >= {e}.x0)"
    step = _let(reach, lambda live: f"named_struct('met', exists({live}, {f} -> {apart} AND {cross}), 'live', concat({live}, array({e})))")
    sweep = lambda all_edges: (
        f"aggregate({all_edges}, named_struct('met', false, 'live', slice({all_edges}, 1, 0)), "
        f"({acc}, {e}) -> CASE WHEN {acc}.met THEN {acc} ELSE {step} END, {acc} -> {acc}.met)"
    )
    non_adjacent = _let(edges, sweep)
    # spike: edge q folds back onto the next edge (the closing vertex repeats r[0], so after the last edge comes r[1])
    q = _v("q")
    a, b = f"{r}[{q}]", f"{r}[{q} + 1]"
    c = f"{r}[CASE WHEN {q} + 2 <= {m} THEN {q} + 2 ELSE 1 END]"
    turn = _sql_orient(_xy(a), _xy(b), _xy(c))
    back = f"(({b}.lon - {a}.lon) * ({c}.lon - {b}.lon) + ({b}.lat - {a}.lat) * ({c}.lat - {b}.lat))"
    spike = f"exists(sequence(0, {m} - 1), {q} -> {turn} = 0 AND {back} < 0)"
    return f"CASE WHEN {n} >= 4 THEN ({area} != 0 AND NOT {non_adjacent} AND NOT {spike}) ELSE false END"


def sql_ring_is_valid(ring: str) -> str:
    return _let(sql_drop_repeated_vertices(ring), _sql_valid_simple_ring)


def ring_is_valid(ring: str) -> Column:
    """A closed ring makes a valid polygon.

    Valid means: at least 4 vertices after dropping repeats, non-zero area, no two
    non-adjacent edges meet, and no spike (an edge folding back on its neighbour). Edges are swept from west to east,
    so a ring of n vertices takes n log n and a comparison for each two edges that overlap in longitude.
    Callers test ``is_closed`` first; the expression is total either way, so
    evaluation order does not matter.
    """
    return F.expr(sql_ring_is_valid(ring))


# --------------------------------------------------------------------------- area of interest


def sql_area_edges(rings: list[list[tuple[float, float]]]) -> str:
    """All edges of all rings of the area as one literal ``ARRAY<STRUCT<ax,ay,bx,by>>``."""
    edges = []
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
            edges.append(f"named_struct('ax', {_d(ax)}, 'ay', {_d(ay)}, 'bx', {_d(bx)}, 'by', {_d(by)})")
    return f"array({', '.join(edges)})"


def _sql_point_in_area(px: str, py: str, edges: str) -> str:
    e, f = _v("e"), _v("e")
    cross = (
        f"(({e}.ay > {py}) != ({e}.by > {py})) AND "
        f"(({px} - {e}.ax) < ({e}.bx - {e}.ax) * ({py} - {e}.ay) / ({e}.by - {e}.ay))"
    )
    on_edge = (
        f"({f}.bx - {f}.ax) * ({py} - {f}.ay) - ({f}.by - {f}.ay) * ({px} - {f}.ax) = 0 AND "
        f"{px} >= least({f}.ax, {f}.bx) AND {px} <= greatest({f}.ax, {f}.bx) AND "
        f"{py} >= least({f}.ay, {f}.by) AND {py} <= greatest({f}.ay, {f}.by)"
    )
    return f"(size(filter({edges}, {e} -> {cross})) % 2 = 1 OR exists({edges}, {f} -> {on_edge}))"


def point_in_area(px: str, py: str, edges: str) -> Column:
    """Point inside the area (even-odd over all rings: holes and multipolygons work) or on its boundary."""
    return F.expr(_let(edges, lambda e: _sql_point_in_area(px, py, e)))


def sql_line_intersects_area(geom: str, edges: str) -> str:
    def body(g: str) -> str:
        p, i, e = _v("p"), _v("i"), _v("e")
        vertex_in = f"exists({g}, {p} -> {_sql_point_in_area(f'{p}.lon', f'{p}.lat', edges)})"
        hit = _sql_segments_intersect(_xy(f"{g}[{i} - 1]"), _xy(f"{g}[{i}]"), (f"{e}.ax", f"{e}.ay"), (f"{e}.bx", f"{e}.by"))
        edge_hit = f"CASE WHEN size({g}) >= 2 THEN exists(sequence(1, size({g}) - 1), {i} -> exists({edges}, {e} -> {hit})) ELSE false END"
        return f"({vertex_in} OR {edge_hit})"

    return _let(geom, body)


def line_intersects_area(geom: str, edges: str) -> Column:
    """A line touches the area: a vertex inside (or on the boundary), or an edge crossing an area edge."""
    return F.expr(_let(edges, lambda e: sql_line_intersects_area(geom, e)))


def metres_to_lat_degrees(metres: float) -> float:
    """Degrees of latitude spanned by ``metres`` (slightly generous, for pre-filters)."""
    return metres / M_PER_DEG * (1.0 + 1e-9) + 1e-12


def sql_lon_expand_degrees(metres: float, abs_lat: str) -> str:
    """Degrees of longitude spanned by ``metres`` at latitude ``abs_lat``; the full circle where that reaches 89.9 degrees."""
    lat = f"(abs({abs_lat}) + {_d(metres_to_lat_degrees(metres))})"
    return f"(CASE WHEN {lat} < 89.9D THEN {_d(metres / M_PER_DEG * (1.0 + 1e-9) + 1e-12)} / cos(radians({lat})) ELSE 360D END)"


# --------------------------------------------------------------------------- indexed area tests

_EDGE_T = "ARRAY<STRUCT<ax: DOUBLE, ay: DOUBLE, bx: DOUBLE, by: DOUBLE>>"


def sql_area_index(idx) -> str:
    """The index as one literal struct: cell letters and per-row edge arrays.

    It is written as JSON and becomes a literal when the plan is optimized: a boundary of many thousand
    vertices would take the SQL parser minutes as nested constructor calls.
    """
    text = json.dumps({"cells": idx.cells, "bands": [[dict(zip(("ax", "ay", "bx", "by"), e)) for e in b] for b in idx.bands]})
    return f"from_json('{text}', 'cells STRING, bands ARRAY<{_EDGE_T}>')"


def _sql_cell(idx, px: str, py: str) -> str:
    i = f"least({idx.nx - 1}, greatest(0, CAST(floor(({px} - {_d(idx.x0)}) / {_d(idx.dx)}) AS INT)))"
    j = f"least({idx.ny - 1}, greatest(0, CAST(floor(({py} - {_d(idx.y0)}) / {_d(idx.dy)}) AS INT)))"
    return f"named_struct('i', {i}, 'j', {j})"


def _sql_point_in_area_indexed(px: str, py: str, idx, x: str, bbox) -> str:
    bx0, by0, bx1, by1 = bbox

    def body(c: str) -> str:
        letter = f"substr({x}.cells, {c}.j * {idx.nx} + {c}.i + 1, 1)"
        exact = _sql_point_in_area(px, py, f"element_at({x}.bands, {c}.j + 1)")
        return f"CASE {letter} WHEN 'I' THEN true WHEN 'O' THEN false ELSE {exact} END"

    outside = f"({px} < {_d(bx0)} OR {px} > {_d(bx1)} OR {py} < {_d(by0)} OR {py} > {_d(by1)})"
    return f"CASE WHEN {outside} THEN false ELSE {_let(_sql_cell(idx, px, py), body)} END"


def point_in_area_indexed(px: str, py: str, idx, bbox) -> Column:
    """P1 with the area index: most points are decided by their cell's letter; points in
    boundary cells run the exact even-odd/boundary test against their row's edges only."""
    return F.expr(_let(sql_area_index(idx), lambda x: _sql_point_in_area_indexed(px, py, idx, x, bbox)))


def line_intersects_area_indexed(geom: str, idx, bbox) -> Column:
    """P2 with the area index: a vertex inside, or an edge crossing an area edge of the rows it spans."""
    bx0, by0, bx1, by1 = bbox

    def with_index(x: str) -> str:
        def body(g: str) -> str:
            p, k, e = _v("p"), _v("k"), _v("e")
            vertex_in = f"exists({g}, {p} -> {_sql_point_in_area_indexed(f'{p}.lon', f'{p}.lat', idx, x, bbox)})"
            a, b = f"{g}[{k} - 1]", f"{g}[{k}]"
            row = lambda y: f"least({idx.ny - 1}, greatest(0, CAST(floor(({y} - {_d(idx.y0)}) / {_d(idx.dy)}) AS INT)))"
            ja, jb = row(f"least({a}.lat, {b}.lat)"), row(f"greatest({a}.lat, {b}.lat)")
            near = (
                f"greatest({a}.lon, {b}.lon) >= {_d(bx0)} AND least({a}.lon, {b}.lon) <= {_d(bx1)} AND "
                f"greatest({a}.lat, {b}.lat) >= {_d(by0)} AND least({a}.lat, {b}.lat) <= {_d(by1)}"
            )
            hit = _sql_segments_intersect(_xy(a), _xy(b), (f"{e}.ax", f"{e}.ay"), (f"{e}.bx", f"{e}.by"))
            edges = f"flatten(slice({x}.bands, {ja} + 1, {jb} - {ja} + 1))"
            edge_hit = (
                f"CASE WHEN size({g}) >= 2 THEN exists(sequence(1, size({g}) - 1), {k} -> "
                f"{near} AND exists({edges}, {e} -> {hit})) ELSE false END"
            )
            return f"({vertex_in} OR {edge_hit})"

        return _let(geom, body)

    return F.expr(_let(sql_area_index(idx), with_index))
