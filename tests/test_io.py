"""Snapshot Parquet round trip (S2), sorted output (O2), all outputs of a merge (K1, K5, K6, A3)."""

import glob
import tempfile

from pyspark.sql import functions as F

from addrweave.plans.catalog import BOUNDS, context
from addrweave.plans.merge import MergeOptions, merge_addresses, write_outputs
from addrweave.sources.fixtures import load_fixtures
from addrweave.sources.snapshot import read_snapshot, write_snapshot

SF = "/root/testdata/sf0.001"


def test_snapshot_parquet_round_trip_and_merge_outputs(spark):
    fx = load_fixtures(spark, SF)
    d = tempfile.mkdtemp(prefix="snap-")
    write_snapshot(fx.snapshot, d + "/snap")
    snap = read_snapshot(spark, d + "/snap")
    assert snap.nodes.count() == fx.snapshot.nodes.count()
    assert snap.ways.columns == ["id", "version", "tags", "nodes", "linestring", "min_lon", "min_lat", "max_lon", "max_lat"]
    r = merge_addresses(
        spark, fx.imports, snap, BOUNDS, MergeOptions(nocity=5.0, building=10.0, conflicts="nearest", sorted_output=True)
    )
    ids = [x[0] for x in r.remaining.select("import_id").collect()]
    assert ids == sorted(ids)
    write_outputs(r, d + "/out", single_file=True, keep_scratch=True)
    osm = open(glob.glob(d + "/out/remaining.osm/part-*")[0], encoding="utf-8").read()
    assert osm.count("<node") == len(ids)
    osc = open(glob.glob(d + "/out/changes.osc/part-*")[0], encoding="utf-8").read()
    assert osc.count("<modify>") == r.matches.where(F.col("type") != "M").count() + r.changes.relations.count()
    assert spark.read.parquet(d + "/out/changes/changed_ways").count() == r.changes.ways.count()
    assert spark.read.parquet(d + "/out/summary").count() == 8


def test_same_result_with_and_without_written_intermediates(spark):
    ctx = context(spark, SF)
    a = merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(nocity=5.0, building=10.0, conflicts="nearest"))
    b = merge_addresses(
        spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(nocity=5.0, building=10.0, conflicts="nearest", materialize=False)
    )
    cols = ["import_id", "type", "id", "pass"]
    assert sorted(a.matches.select(*cols).collect()) == sorted(b.matches.select(*cols).collect())


def test_area_box_is_pushed_to_the_scan(spark):
    from addrweave.operators.local import local_nodes, local_ways
    from addrweave.sources.area import parse_wkt_area

    fx = load_fixtures(spark, SF)
    d = tempfile.mkdtemp(prefix="push-")
    write_snapshot(fx.snapshot, d + "/snap")
    snap = read_snapshot(spark, d + "/snap")
    area = parse_wkt_area(BOUNDS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated PushedFilters in the plan text
    n_plan = local_nodes(snap.nodes, area)._jdf.queryExecution().executedPlan().toString()
    w_plan = local_ways(snap.ways, area)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lon," in n_plan and "LessThanOrEqual(lat," in n_plan
    assert "GreaterThanOrEqual(max_lon," in w_plan and "LessThanOrEqual(min_lat," in w_plan
    # column pruning: the node scan reads only what P1 and the local table need
    assert "ReadSchema: struct<id:bigint,version:int,tags:map<string,string>,lon:double,lat:double>" in n_plan


def test_scratch_tables_go_after_the_outputs(spark):
    import os

    from addrweave.session import ensure_checkpoint_dir

    fx = load_fixtures(spark, SF)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    r = merge_addresses(spark, fx.imports, fx.snapshot, BOUNDS, MergeOptions(nocity=5.0, building=10.0, conflicts="nearest"))
    assert len(set(os.listdir(folder)) - before) >= 4
    write_outputs(r, tempfile.mkdtemp(prefix="out-") + "/out")
    assert set(os.listdir(folder)) == before


def test_local_table_of_a_merge_holds_what_can_match(spark):
    """Objects without a number or building tag are not written, ways are scanned once, and the result is the same."""
    from addrweave.operators.local import local_features
    from addrweave.sources.area import parse_wkt_area

    fx = load_fixtures(spark, SF)
    d = tempfile.mkdtemp(prefix="snap-")
    write_snapshot(fx.snapshot, d)
    snap = read_snapshot(spark, d)
    written = {}

    def keep(df, name):
        df.write.parquet(f"{d}/{name}")
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return spark.read.parquet(f"{d}/{name}")

    area = parse_wkt_area(BOUNDS)
    few, full = local_features(snap, area, matchable=True, keep=keep), local_features(snap, area)
    cond = "hn IS NOT NULL OR coalesce(map_contains_key(tags, 'building'), false)"
    key = ["type", "id"]
    assert sorted(few.all.select(key).collect()) == sorted(full.all.where(cond).select(key).collect())
    assert few.all.where(f"NOT ({cond})").count() == 0 and full.all.where(f"NOT ({cond})").count() > 0
    lines = ["id", F.size("geom").alias("n"), "n_ways"]
    assert sorted(few.multipolygons.select(lines).collect()) == sorted(full.multipolygons.where(F.expr("tags['building'] IS NOT NULL OR tags['addr:housenumber'] IS NOT NULL")).select(lines).collect())
    plan = few.all._jdf.queryExecution().executedPlan().toString()
    assert f"{d}/ways" not in plan and "local_ways" in written


def test_snapshot_follows_a_curve(spark, tmp_path):
    """An area's box leaves out most files and row groups of a clustered snapshot, and nearly none of one that is not."""
    import glob

    import pyarrow.parquet as pq

    from addrweave.sources.snapshot import Snapshot

    n = 40_000
    d = spark.range(n).select("id", F.lit(1).alias("version"), F.expr("map('a', 'b')").alias("tags"), (F.rand(1) * 20 - 10).alias("lon"), (F.rand(2) * 20 + 40).alias("lat"))
    ways = d.select("id", "version", "tags", F.array("id").alias("nodes"), F.expr("array(named_struct('lon', lon, 'lat', lat), named_struct('lon', lon + 0.01, 'lat', lat))").alias("linestring"))
    fx = load_fixtures(spark, SF).snapshot
    snap = Snapshot(d, ways, fx.relations, fx.relation_members)
    box = (1.0, 45.0, 2.0, 46.0)

    def read_share(path, names):
        """Share of rows in row groups whose statistics overlap the box."""
        read = total = 0
        for f in glob.glob(f"{path}/*.parquet"):
            meta = pq.read_metadata(f)
            for g in range(meta.num_row_groups):
                cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
                x0, y0, x1, y1 = names
                hit = cols[x1].max >= box[0] and cols[x0].min <= box[2] and cols[y1].max >= box[1] and cols[y0].min <= box[3]
                read, total = read + hit * meta.row_group(g).num_rows, total + meta.row_group(g).num_rows
        return read / total

    for clustered in (True, False):
        path = str(tmp_path / f"snap{clustered}")
        write_snapshot(snap, path, clustered=clustered, files=64)
        shares = read_share(f"{path}/nodes", ("lon", "lat", "lon", "lat")), read_share(f"{path}/ways", ("min_lon", "min_lat", "max_lon", "max_lat"))
        assert max(shares) < 0.1 if clustered else min(shares) > 0.9, shares
        back = read_snapshot(spark, path)
        assert back.nodes.count() == back.ways.count() == n
        assert sorted(back.nodes.where("id % 1000 = 7").collect()) == sorted(snap.nodes.where("id % 1000 = 7").select(back.nodes.columns).collect())


def test_curve_key(spark):
    """Interleaved bits of both coordinates; values beyond the ends stay in the last cells."""
    from addrweave.sources.snapshot import curve_key

    pts = [(-180.0, -90.0), (180.0, 90.0), (10.0, 50.0), (-200.0, 95.0), (0.0, 0.0)]
    got = [r[0] for r in spark.createDataFrame(pts, "lon double, lat double").coalesce(1).select(curve_key(F.col("lon"), F.col("lat"))).collect()]

    def plain(lon, lat):
        x, y = (min(max(int((v - lo) / w * 65536 // 1), 0), 65535) for v, lo, w in ((lon, -180, 360), (lat, -90, 180)))
        return sum(((x >> b) & 1) << (2 * b) | ((y >> b) & 1) << (2 * b + 1) for b in range(16))

    assert got == [plain(*p) for p in pts]
