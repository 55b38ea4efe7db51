"""Grid join == brute force; plans have no nested-loop or Cartesian join."""

import random

import pytest
from pyspark.sql import functions as F

from addrweave.functions import geo
from addrweave.operators.spatial_join import grid_for, within_pairs


def _random_inputs(spark, seed, n_pts=300, n_feat=60):
    rnd = random.Random(seed)
    pts = []
    for i in range(n_pts):
        # a third of all points on one spot (hot cell)
        if i % 3 == 0:
            pts.append((i, 10.0005, 50.0005))
        else:
            pts.append((i, 10.0 + rnd.random() * 0.01, 50.0 + rnd.random() * 0.01))
    feats = []
    for j in range(n_feat):
        cx, cy = 10.0 + rnd.random() * 0.01, 50.0 + rnd.random() * 0.01
        kind = j % 3
        if kind == 0:
            g = [(cx, cy)]
        elif kind == 1:
            h = rnd.random() * 0.0003
            g = [(cx - h, cy - h), (cx + h, cy - h), (cx + h, cy + h), (cx - h, cy + h), (cx - h, cy - h)]
        else:  # long line, spans many base cells (goes to the coarse level)
            g = [(cx, cy), (cx + 0.005, cy + 0.004)]
        feats.append((j, [{"lon": x, "lat": y} for x, y in g]))
    p = spark.createDataFrame(pts, "pid int, p_lon double, p_lat double")
    f = spark.createDataFrame(feats, "fid int, geom array<struct<lon:double,lat:double>>")
    f = f.select("*", *geo.bbox_columns("geom"))
    return p, f


@pytest.mark.parametrize("metres,levels", [(5.0, 2), (30.0, 2), (30.0, 1), (120.0, 3)])
def test_grid_join_equals_brute_force(spark, metres, levels):
    p, f = _random_inputs(spark, seed=int(metres) + levels)
    grid = grid_for(metres, levels=levels)
    got = within_pairs(p, f, metres, geo.dist_point_line, grid=grid).select("pid", "fid").collect()
    brute = (
        p.crossJoin(f)
        .select("pid", "fid", geo.dist_point_line("p_lon", "p_lat", "geom").alias("d"))
        .where(F.col("d") <= metres)
        .select("pid", "fid")
        .collect()
    )
    assert len(got) == len(set(got)), "a pair met twice"
    assert sorted(got) == sorted(brute)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_in_spatial_joins(spark):
    from addrweave.operators import match as M
    from addrweave.plans.catalog import context

    ctx = context(spark, "/root/testdata/sf0.001")
    for df in (
        M.building_matches(ctx.pool, ctx.local_all, 0.5, 10.0),
        M.building_matches(ctx.pool, ctx.local_all, 0.5, 10.0, "intended"),
        M.nocity_pairs(ctx.pool, ctx.local_all, 5.0),
    ):
        plan = _plan(df)
        assert "NestedLoopJoin" not in plan
        assert "CartesianProduct" not in plan


def test_passes_at_scale_settings(spark):
    """With broadcasts off (as when no side is small): equi-joins on cells and ids only, no window operator (which would
    pull a hot group into one task), aggregation before each shuffle, and no tag map in an aggregate."""
    from addrweave.operators import match as M
    from addrweave.plans.catalog import context

    ctx = context(spark, "/root/testdata/sf0.001")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.maxMetadataStringLength")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        for df in (M.building_matches(ctx.pool, ctx.local_all, 0.5, 10.0), M.nocity_matches(ctx.pool, ctx.local_all, 5.0)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
            assert "partial_" in plan  # map-side partial aggregation before the shuffle
            for line in plan.splitlines():
                if "Aggregate" in line:
                    assert "tags" not in line and "way_nodes" not in line
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_building_distance_only_near_imports(spark):
    """Buildings in cells without an import reach no distance: of many buildings, the join makes rows only around the
    one import, and J8/J9 look at its building alone."""
    from addrweave.operators import match as M
    from addrweave.operators.local import local_features
    from addrweave.sources.area import parse_wkt_area
    from addrweave.sources.snapshot import Snapshot

    def square(x, y, h=0.00004):
        return [{"lon": x + dx * h, "lat": y + dy * h} for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]

    ways = [(k + 1, 1, {"building": "yes"}, [1, 2, 3, 4, 1], square(10 + (k % 40) * 0.001, 50 + (k // 40) * 0.001)) for k in range(1600)]
    nodes = [(k + 1, 1, {"addr:housenumber": "5"}, 10 + (k % 40) * 0.001, 50 + (k // 40) * 0.001) for k in range(0, 1600, 2)]
    snap = Snapshot(
        spark.createDataFrame(nodes, "id bigint, version int, tags map<string,string>, lon double, lat double"),
        spark.createDataFrame(ways, "id bigint, version int, tags map<string,string>, nodes array<bigint>, linestring array<struct<lon:double,lat:double>>"),
        spark.createDataFrame([], "id bigint, version int, tags map<string,string>"),
        spark.createDataFrame([], "relation_id bigint, member_id bigint, member_type string, member_role string, sequence_id int"),
    )
    la = local_features(snap, parse_wkt_area("POLYGON((9 49, 11 49, 11 51, 9 51, 9 49))")).all.cache()
    pool = spark.createDataFrame([(-1, {"addr:housenumber": "5"}, 10.001, 50.0)], "import_id int, tags map<string,string>, lon double, lat double")
    seen = {}
    got = M.building_matches(pool, la, 0.5, 10.0, keep=lambda df, name: seen.setdefault(name, df.cache())).collect()
    assert [(r.import_id, r.type, r.id) for r in got] == [(-1, "W", 2)]
    assert seen["building_near"].count() == 1 and seen["building_found"].count() == 1
    la.unpersist()


def test_large_features_cover_few_cells(spark):
    """A box of a degree, one around the earth and one at a pole are cut into few cells, and none is missed."""
    from addrweave.operators.spatial_join import feature_cells

    def box(x0, y0, x1, y1):
        return [{"lon": float(x), "lat": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]

    rows = [(1, box(10, 50, 11, 51)), (2, box(-179, -80, 179, 80)), (3, box(10, 89.0, 11, 89.95)), (4, box(10, 50, 10.0001, 50.0001))]
    f = spark.createDataFrame(rows, "fid int, geom array<struct<lon:double,lat:double>>").select("fid", "geom", *geo.bbox_columns("geom"))
    n = {r.fid: r["count"] for r in feature_cells(f, grid_for(5.0)).groupBy("fid").count().collect()}
    assert set(n) == {1, 2, 3, 4} and max(n.values()) <= 16
    pts = [(1, 10.0, 50.5), (2, 179.0, 10.0), (3, 10.5, 89.95), (4, 10.00005, 50.0001), (5, 100.0, 0.0)]
    p = spark.createDataFrame(pts, "pid int, p_lon double, p_lat double")
    got = {(r.pid, r.fid) for r in within_pairs(p, f, 5.0, geo.dist_point_line).select("pid", "fid").collect()}
    brute = p.crossJoin(f).where(geo.dist_point_line("p_lon", "p_lat", "geom") <= 5.0)
    assert got == {(r.pid, r.fid) for r in brute.select("pid", "fid").collect()} and (3, 3) in got


def test_left_grid_join_counts_equal_brute_force(spark):
    from addrweave.operators.spatial_join import left_within

    p, f = _random_inputs(spark, seed=7, n_pts=200, n_feat=50)
    got = {
        r["pid"]: r["n"]
        for r in left_within(p, f, 40.0, geo.dist_point_line).groupBy("pid").agg(F.count("fid").alias("n")).collect()
    }
    brute = {r["pid"]: 0 for r in p.select("pid").collect()}
    for r in (
        p.crossJoin(f).where(geo.dist_point_line("p_lon", "p_lat", "geom") <= 40.0).groupBy("pid").count().collect()
    ):
        brute[r["pid"]] = r["count"]
    assert got == brute
    assert any(v == 0 for v in got.values()) and any(v > 0 for v in got.values())
