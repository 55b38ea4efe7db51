"""Hand-made geometry: distances, point in ring, validity, area clipping."""

import math

import pytest
from pyspark.sql import functions as F

from addrweave.functions import geo
from addrweave.sources.area import parse_wkt_area


def ring(*pts):
    return [{"lon": float(x), "lat": float(y)} for x, y in pts]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [
        ("square", ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))),
        ("bowtie", ring((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))),
        ("triangle3", ring((0, 0), (1, 0), (0, 0))),
        ("spike", ring((0, 0), (2, 0), (2, 1), (2, 2), (2, 1), (0, 1), (0, 0))),
        ("concave", ring((0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0))),
        ("repeated", ring((0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 0))),
        ("flat", ring((0, 0), (1, 0), (2, 0), (0, 0))),
        ("touching", ring((0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0))),
    ]
    return spark.createDataFrame(rows, "name string, g array<struct<lon:double,lat:double>>")


def test_validity(shapes):
    got = {r["name"]: r["v"] for r in shapes.select("name", geo.ring_is_valid("g").alias("v")).collect()}
    assert got == {
        "square": True,
        "bowtie": False,
        "triangle3": False,
        "spike": False,
        "concave": True,
        "repeated": True,
        "flat": False,
        "touching": False,
    }


def test_closed(shapes):
    got = {r["name"]: r["c"] for r in shapes.select("name", geo.is_closed("g").alias("c")).collect()}
    assert got["square"] and got["bowtie"] and not got["triangle3"]


def test_point_in_concave_ring(spark, shapes):
    pts = spark.createDataFrame([(2.0, 0.5, True), (2.0, 2.0, False), (1.0, 2.0, True), (5.0, 1.0, False)], "x double, y double, inside boolean")
    conc = shapes.where("name = 'concave'").select("g")
    got = pts.crossJoin(conc).select("inside", geo.point_in_ring("x", "y", "g").alias("got")).collect()
    assert all(r["inside"] == r["got"] for r in got)


def test_distances_match_closed_form(spark):
    m = geo.M_PER_DEG
    lat0 = 49.2
    df = spark.createDataFrame(
        [(0.0, lat0, ring((0.001, lat0 - 0.001), (0.001, lat0 + 0.001)))], "x double, y double, g array<struct<lon:double,lat:double>>"
    )
    r = df.select(
        geo.dist_point_line("x", "y", "g").alias("line"),
        geo.dist_point_point("x", "y", "g[0].lon", "g[0].lat").alias("pp"),
    ).collect()[0]
    assert r["line"] == pytest.approx(0.001 * math.cos(math.radians(lat0)) * m, rel=1e-9)
    assert r["pp"] == pytest.approx(math.hypot(0.001 * m, 0.001 * math.cos(math.radians(lat0)) * m), rel=1e-9)


def test_polygon_distance_zero_inside(spark):
    sq = ring((0, 0), (0.001, 0), (0.001, 0.001), (0, 0.001), (0, 0))
    df = spark.createDataFrame([(0.0005, 0.0005, sq), (0.002, 0.0005, sq)], "x double, y double, g array<struct<lon:double,lat:double>>")
    got = [r["d"] for r in df.select(geo.dist_point_polygon("x", "y", "g").alias("d")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(0.001 * geo.M_PER_DEG, rel=1e-9)
    line = [r["d"] for r in df.select(geo.dist_point_line("x", "y", "g").alias("d")).collect()]
    assert line[0] == pytest.approx(0.0005 * geo.M_PER_DEG, rel=1e-6)


def test_area_clip_holes_and_crossing_lines(spark):
    area = parse_wkt_area("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))")
    edges = geo.sql_area_edges(area.ring_lists())
    pts = spark.createDataFrame(
        [(1.0, 1.0, True), (5.0, 5.0, False), (10.0, 5.0, True), (11.0, 5.0, False), (4.0, 5.0, True)], "x double, y double, want boolean"
    )
    assert all(r["want"] == r["got"] for r in pts.select("want", geo.point_in_area("x", "y", edges).alias("got")).collect())
    lines = spark.createDataFrame(
        [
            ("crosses_without_vertex_inside", ring((-1, 5), (11, 5)), True),
            ("inside_hole_only", ring((4.5, 4.5), (5.5, 5.5)), False),
            ("outside", ring((11, 0), (12, 5)), False),
            ("around_the_area", ring((-1, -1), (11, -1), (11, 11), (-1, 11), (-1, -1)), False),
            ("touches_corner", ring((10, 10), (12, 12)), True),
        ],
        "name string, g array<struct<lon:double,lat:double>>, want boolean",
    )
    got = lines.select("name", "want", geo.line_intersects_area("g", edges).alias("got")).collect()
    assert {r["name"]: r["got"] for r in got} == {r["name"]: r["want"] for r in got}


def _star(n_points: int, cx=-80.0, cy=40.0, r1=0.5, r2=0.2):
    pts = []
    for k in range(2 * n_points):
        r = r1 if k % 2 == 0 else r2
        a = math.pi * k / n_points
        pts.append(f"{cx + r * math.cos(a)!r} {cy + r * math.sin(a)!r}")
    pts.append(pts[0])
    return "(" + ", ".join(pts) + ")"


@pytest.mark.parametrize("n_points", [3, 40, 400])
def test_indexed_area_tests_equal_plain_tests(spark, n_points):
    """Concave star with a hole, many edges: the grid-indexed clip agrees with the all-edges test."""
    import random

    from addrweave.sources.area import build_area_index

    wkt = f"POLYGON({_star(n_points)}, (-80.05 39.95, -79.95 39.95, -79.95 40.05, -80.05 40.05, -80.05 39.95))"
    area = parse_wkt_area(wkt)
    idx = build_area_index(area)
    assert set(idx.cells) <= {"I", "O", "B"} and "B" in idx.cells
    edges = geo.sql_area_edges(area.ring_lists())
    rnd = random.Random(n_points)
    pts = [(-80.0 + rnd.uniform(-0.6, 0.6), 40.0 + rnd.uniform(-0.6, 0.6)) for _ in range(1500)]
    pts += [(float(x), float(y)) for x, y in area.rings[0][:20]]  # vertices: on the boundary
    df = spark.createDataFrame(pts, "x double, y double")
    r = df.select(
        geo.point_in_area("x", "y", edges).alias("plain"), geo.point_in_area_indexed("x", "y", idx, area.bbox).alias("fast")
    ).collect()
    assert all(row["plain"] == row["fast"] for row in r)
    assert any(row["fast"] for row in r) and not all(row["fast"] for row in r)
    segs = [
        [{"lon": x, "lat": y}, {"lon": x + rnd.uniform(-0.3, 0.3), "lat": y + rnd.uniform(-0.3, 0.3)}] for x, y in pts[:600]
    ]
    lines = spark.createDataFrame([(s,) for s in segs], "g array<struct<lon:double,lat:double>>")
    r = lines.select(
        geo.line_intersects_area("g", edges).alias("plain"), geo.line_intersects_area_indexed("g", idx, area.bbox).alias("fast")
    ).collect()
    assert all(row["plain"] == row["fast"] for row in r)


def _ring(n, r=0.01, wobble=0.2, seed=0):
    import random

    rng = random.Random(seed)
    pts = []
    for k in range(n):
        a, d = 2 * math.pi * k / n, r * (1 + wobble * rng.random())
        pts.append((10 + d * math.cos(a), 50 + d * math.sin(a)))
    return pts + pts[:1]


def _brute_valid(ring):
    """All pairs of edges, exactly."""
    from fractions import Fraction as Q

    r = [(Q(x), Q(y)) for x, y in ring]
    r = [p for k, p in enumerate(r) if k == 0 or p != r[k - 1]]
    if len(r) < 4:
        return False
    m = len(r) - 1
    turn = lambda p, q, s: (q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0])
    sign = lambda v: (v > 0) - (v < 0)
    if sum(r[k][0] * r[k + 1][1] - r[k + 1][0] * r[k][1] for k in range(m)) == 0:
        return False
    for i in range(m):
        a, b, c = r[i], r[i + 1], r[i + 2 if i + 2 <= m else 1]
        if turn(a, b, c) == 0 and (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) < 0:
            return False
        for j in range(i + 2, m):
            if i == 0 and j == m - 1:
                continue
            p, q, s, t = r[i], r[i + 1], r[j], r[j + 1]
            boxes = all(max(p[k], q[k]) >= min(s[k], t[k]) and max(s[k], t[k]) >= min(p[k], q[k]) for k in (0, 1))
            if boxes and sign(turn(p, q, s)) * sign(turn(p, q, t)) <= 0 and sign(turn(s, t, p)) * sign(turn(s, t, q)) <= 0:
                return False
    return True


def test_validity_sweep_equals_all_pairs(spark):
    """Rings on a small lattice (touching, crossing, spikes, repeats, vertical edges) and large smooth ones."""
    import random

    rng = random.Random(5)
    rings = []
    for _ in range(300):
        n = rng.randint(3, 9)
        pts = [(float(rng.randint(0, 4)), float(rng.randint(0, 4))) for _ in range(n)]
        rings.append(pts + pts[:1])
    rings += [_ring(n, seed=n) for n in (3, 4, 40, 200)]
    rings += [r[:50] + [r[120], r[51]] + r[52:] for r in (_ring(200, seed=9),)]
    df = spark.createDataFrame([(k, [{"lon": x, "lat": y} for x, y in r]) for k, r in enumerate(rings)], "k int, g array<struct<lon:double,lat:double>>")
    got = {r.k: r.v for r in df.select("k", geo.ring_is_valid("g").alias("v")).collect()}
    want = {k: _brute_valid(r) for k, r in enumerate(rings)}
    assert got == want and 20 < sum(want.values()) < 280


def test_validity_of_long_rings_is_not_quadratic(spark):
    """A ring of 2,000 vertices takes no more than twice the time of ten rings of 200."""
    import time

    def seconds(n, copies):
        rows = [(k, [{"lon": x, "lat": y} for x, y in _ring(n, wobble=8 / n, seed=k)]) for k in range(copies)]
        df = spark.createDataFrame(rows, "k int, g array<struct<lon:double,lat:double>>").coalesce(1).cache()
        df.count()
        best = 1e9
        for _ in range(4):
            t = time.perf_counter()
            assert all(r.v for r in df.select(geo.ring_is_valid("g").alias("v")).collect())
            best = min(best, time.perf_counter() - t)
        df.unpersist()
        return best

    few, many = seconds(2000, 10), seconds(200, 100)
    assert few <= 2 * many, (few, many)
