"""What may cross a shuffle: geometry never goes through grid cells, matching ways meet no shuffle, picks hold no tags."""

import contextlib

import pytest
from pyspark.sql import functions as F

from addrweave.operators import local as L
from addrweave.operators import match as M
from addrweave.operators import spatial_join as S
from addrweave.plans.catalog import BOUNDS, context
from addrweave.session import write_read
from addrweave.sources.area import parse_wkt_area
from addrweave.sources.snapshot import read_snapshot, write_snapshot

SF = "/root/testdata/sf0.001"
GEOMETRY = {"geom", "linestring", "a_geom", "_0"}


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture
def unbroadcast(spark):
    """No side counts as small, as at scale (explicit broadcasts of counted tables stay)."""
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def shuffles(df):
    """(partitioning, names of the columns shuffled) of every exchange between tasks."""
    out = []
    for n in nodes(df._jdf.queryExecution().executedPlan()):
        if n.nodeName() == "Exchange":
            columns = n.output()
            out.append((n.outputPartitioning().toString(), {columns.apply(i).name() for i in range(columns.size())}))
    return out


def test_no_geometry_through_the_cells(spark, unbroadcast):
    """Ids and boxes meet in the cells, and the geometry of the counted candidates is fetched without a shuffle."""
    ctx = context(spark, SF)
    written = {}

    def keep(df, name):
        written[name] = shuffles(df)
        return write_read(df, name)

    hits = M.building_hits(ctx.pool, ctx.local_all, 0.5, 10.0, M.INTENDED, keep)
    for name in ("building_boxes", "area_boxes"):
        assert any("cx" in by for by, _ in written[name])
        assert not any(columns & GEOMETRY for _, columns in written[name])
    assert written["building_shapes"] and not any(columns & GEOMETRY for _, columns in written["building_shapes"])
    plain = M.building_hits(ctx.pool, ctx.local_all, 0.5, 10.0, M.INTENDED)
    assert sorted(hits.collect()) == sorted(plain.collect()) != []


def test_matching_ways_meet_no_shuffle(spark, unbroadcast, tmp_path, monkeypatch):
    from addrweave.sources.fixtures import load_fixtures

    write_snapshot(load_fixtures(spark, SF).snapshot, str(tmp_path))
    snap, area = read_snapshot(spark, str(tmp_path)), parse_wkt_area(BOUNDS)
    part_ids = L._part_ids(snap.relations, snap.relation_members)
    plans = {}

    def keep(df, name):
        plans[name] = shuffles(df)
        return write_read(df, name)

    w, parts = L._split_ways(snap.ways, area, part_ids, keep)
    few = sorted(r.id for r in w.select("id").collect()), sorted(r.id for r in parts.select("id").collect())
    assert plans["local_ways"] == []  # counted member ids come to the scan
    assert few[0] and few[1]
    monkeypatch.setattr(L, "FEW_IDS", -1)
    for k in (keep, None):
        w, parts = L._split_ways(snap.ways, area, part_ids, k)
        assert shuffles(w) == []
        assert all(columns <= {"id", "linestring", *S.BOX, "relation_id", "member_id"} for _, columns in shuffles(parts))
        assert few == (sorted(r.id for r in w.select("id").collect()), sorted(r.id for r in parts.select("id").collect()))


def test_points_at_levels_in_use_only(spark):
    grid = S.grid_for(5.0)
    pts = spark.range(1000).select("id", (F.col("id") * 0.001).alias("p_lon"), F.lit(50.0).alias("p_lat"))

    def boxes(*sizes):
        return spark.createDataFrame([(0.0, 50.0, d, 50.0 + d) for d in sizes], "min_lon double, min_lat double, max_lon double, max_lat double")

    for sizes, levels in (((1e-4,), 1), ((1e-4, 2e-4, 1e-3), 2), ((1e-4, 1e-3, 1.0, 100.0), 4), ((), 0)):
        assert S.points_at_levels_in_use(pts, boxes(*sizes), grid).count() == 1000 * levels


def test_picks_hold_no_tags(spark, unbroadcast):
    """D3 and D5 pick on ids and distances; tags and node lists are joined to what is left."""
    ctx = context(spark, SF)
    hits = M.building_hits(ctx.pool, ctx.local_all, 0.5, 10.0)
    picks = M.building_assignments(hits).unionByName(M.nocity_picks(ctx.pool, ctx.local_all, 5.0))
    resolved = M.resolve_conflicts(picks, "nearest")
    assert resolved.columns == M.PICK_COLUMNS
    with settings(spark, **{"spark.sql.maxMetadataStringLength": "100000"}):
        plan = M.with_payload(resolved, ctx.pool, ctx.local_all)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Aggregate" in line:
            assert "way_nodes" not in line and "i_tags" not in line and "l_tags" not in line


def joins(df):
    return [n.nodeName() for n in nodes(df._jdf.queryExecution().sparkPlan()) if "Join" in n.nodeName()]


def test_small_files_are_not_broadcast(spark, monkeypatch):
    """A written table of few bytes may hold many rows: with Spark's own limits on, joins by address, cell, position and id are
    merged; ids are broadcast only if they were counted."""
    ctx = context(spark, SF)
    for df in (
        M.remaining_after_duplicates(ctx.imports, ctx.local_all),
        M.nocity_pairs(ctx.pool, ctx.local_all, 5.0, written=True),
        M.nocity_matches(ctx.pool, ctx.local_all, 5.0, keep=write_read),
        M.nocity_matches(ctx.pool, ctx.local_all, 1.0, M.INTENDED, write_read),
        M.building_matches(ctx.pool, ctx.local_all, 0.5, 10.0, keep=write_read),
    ):
        assert set(joins(df)) == {"SortMergeJoin"}
    ids = write_read(ctx.local_all.select("type", "id").limit(5), "ids")
    for most, kind in ((5, "BroadcastHashJoin"), (4, "SortMergeJoin")):
        monkeypatch.setattr(S, "FEW_IDS", most)
        found = S.named_by(ctx.local_all, ids, ["type", "id"])
        assert joins(found) == [kind] and found.count() == 5


def test_counted_ids_stay_small():
    """As a hash table of about 150 bytes an id, on the driver and beside each executor's tasks."""
    assert S.FEW_IDS * 150 <= 64_000_000


def test_pairs_by_levels_in_use_are_the_same(spark):
    ctx = context(spark, SF)
    plain, fewer = (M.nocity_pairs(ctx.pool, ctx.local_all, 5.0, written=w).select("import_id", "type", "id", "dist") for w in (False, True))
    assert sorted(plain.collect()) == sorted(fewer.collect()) != []
