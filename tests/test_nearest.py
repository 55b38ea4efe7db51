"""Nearest neighbours of piles: box by box, as brute force finds them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from addrweave.functions.geo import M_PER_DEG
from addrweave.operators import nearest
from addrweave.operators.match import nocity_matches
from addrweave.session import write_read
from addrweave.sources.snapshot import load_imports

LON, LAT = -123.1, 49.2


def seg_dist(px, py, line):
    """Metres to a vertex list in the plane at the point, written independently."""
    kx = math.cos(math.radians(py)) * M_PER_DEG
    pts = [((x - px) * kx, (y - py) * M_PER_DEG) for x, y in line]
    if len(pts) == 1:
        return math.hypot(*pts[0])
    best = math.inf
    for (ax, ay), (bx, by) in zip(pts, pts[1:]):
        dx, dy = bx - ax, by - ay
        t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(ax + t * dx, ay + t * dy))
    return best


def tables(spark, imports, feats):
    """Imports (id, address, lon, lat) and features (type, id, address, vertices) as the merge holds them."""
    imp = load_imports(
        spark.createDataFrame(
            [(i, {"addr:housenumber": a, "addr:street": "S"}, x, y) for i, a, x, y in imports], "import_id int, tags map<string,string>, lon double, lat double"
        )
    )
    rows = []
    for kind, i, a, line in feats:
        xs, ys = [x for x, _ in line], [y for _, y in line]
        rows.append((kind, i, 1, {"addr:housenumber": a}, line, None, a, "S", None, min(xs), min(ys), max(xs), max(ys), None))
    schema = (
        "type string, id bigint, version int, tags map<string,string>, geom array<struct<lon:double,lat:double>>, way_nodes array<bigint>, hn string, street string, "
        "city string, min_lon double, min_lat double, max_lon double, max_lat double, n_ways bigint"
    )
    return write_read(imp, "t_imports"), write_read(spark.createDataFrame(rows, schema), "t_local")


def brute(imports, feats, metres):
    out = []
    for i, a, x, y in imports:
        best = {}
        for kind, k, b, line in feats:
            if a == b:
                d = seg_dist(x, y, line)
                if d <= metres:
                    best[kind] = min(best.get(kind, (math.inf, 0)), (d, k))
        out += [(i, kind, k, round(d, 6)) for kind, (d, k) in best.items()]
    return sorted(out)


def found(imp, local, metres, keep=None):
    m = nocity_matches(imp, local, metres, keep=keep)
    return sorted((r.import_id, r.type, r.id, round(r.dist, 6)) for r in m.select("import_id", "type", "id", "dist").collect())


def test_two_piles_of_jittered_points(spark):
    """A thousand positions and a thousand objects of one address within 2 cm: a million pairs by brute force."""
    rng = random.Random(2)
    spread = 0.02 / M_PER_DEG
    imports = [(-(k + 1), "1", LON + rng.random() * spread, LAT + rng.random() * spread) for k in range(1000)]
    feats = [("N", k + 1, "1", [(LON + rng.random() * spread, LAT + rng.random() * spread)]) for k in range(1000)]
    rows = {}

    def keep(df, name):
        out = write_read(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    imp, local = tables(spark, imports, feats)
    assert found(imp, local, 5.0, keep) == brute(imports, feats, 5.0)
    assert sum(rows["pile_pairs"]) < 50_000, rows
    assert all(sum(n) < 100_000 for n in rows.values()), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_piles_of_every_shape(spark, monkeypatch, seed):
    """Small thresholds: piles apart from each other, lines and points, ties, equal middles, other addresses, at the limit."""
    monkeypatch.setattr(nearest, "PILE", 3)
    monkeypatch.setattr(nearest, "FEW", 2)
    rng = random.Random(seed)
    m = 1 / M_PER_DEG

    def near(x, y, r):
        return LON + (x + rng.uniform(-r, r)) * m, LAT + (y + rng.uniform(-r, r)) * m

    imports, feats = [], []
    for address, x, y in (("1", 0, 0), ("1", 3.0, 0), ("2", 0, 0), ("1", 40, 0), ("3", 0, 9)):
        imports += [(-(len(imports) + k + 1), address, *near(x, y, 0.5)) for k in range(12)]
        feats += [("N", 100 + len(feats) + k, address, [near(x + 1, y, 0.3)]) for k in range(9)]
        feats += [("W", 100 + len(feats) + k, address, [near(x, y + 2, 2), near(x, y, 8), near(x, y, 1)]) for k in range(9)]
    centre = (LON + 41 * m, LAT)
    for k in range(6):  # boxes of one middle
        w, h = rng.uniform(0, 3) * m, rng.uniform(0, 3) * m
        feats.append(("M", 900 + k, "1", [(centre[0] - w, centre[1] - h), (centre[0] + w, centre[1] + h)]))
    feats.append(("W", 990, "1", [(LON - 400 * m, LAT + 1.5 * m), (LON + 400 * m, LAT + 1.5 * m)]))  # longer than a cell
    imports += [(-500, "1", LON, LAT), (-501, "1", LON, LAT), (-502, "9", LON, LAT), (-503, "1", LON, LAT + 2000 * m)]
    feats += [("N", 995, "1", [(LON + 0.1 * m, LAT)]), ("N", 994, "1", [(LON - 0.1 * m, LAT)]), ("N", 996, "1", [(LON + 0.1 * m, LAT)])]
    imp, local = tables(spark, imports, feats)
    got = found(imp, local, 5.0)
    assert got == brute(imports, feats, 5.0)
    assert {kind for _, kind, _, _ in got} == {"N", "W", "M"}


def test_bounds_hold(spark):
    """The distance of any two places lies between the bounds of their boxes, near the equator and the poles too."""
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        lat, size = rng.choice([0.0, 10.0, -60.0, 89.0]), rng.choice([1e-7, 1e-4, 1e-2])
        p = sorted(rng.uniform(0, size) for _ in range(2)), sorted(lat + rng.uniform(-size, size) for _ in range(2))
        q = sorted(rng.uniform(0, size) for _ in range(2)), sorted(lat + rng.uniform(-size, size) for _ in range(2))
        px, py = rng.uniform(*p[0]), rng.uniform(*p[1])
        qx, qy = rng.uniform(*q[0]), rng.uniform(*q[1])
        rows.append((p[0][0], p[1][0], p[0][1], p[1][1], q[0][0], q[1][0], q[0][1], q[1][1], seg_dist(px, py, [(qx, qy)])))
    names = ["p_x0", "p_y0", "p_x1", "p_y1", "min_lon", "min_lat", "max_lon", "max_lat"]
    d = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "dist"]))
    least, most = nearest.distance_bounds()
    assert d.where((F.col("dist") < least) | (F.col("dist") > most)).count() == 0
