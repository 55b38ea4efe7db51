"""Hot spots: a third of the imports are copies at one spot, and a pile of identical OSM copies
sits there too. Results must equal brute force over the uncollapsed pairs."""

import pytest

from addrweave.operators import match as M
from addrweave.operators.local import local_features
from addrweave.sources.area import parse_wkt_area
from addrweave.sources.snapshot import Snapshot

AREA = "POLYGON((9.99 49.99, 10.02 49.99, 10.02 50.02, 9.99 50.02, 9.99 49.99))"


def _square(cx, cy, h):
    return [{"lon": cx + dx * h, "lat": cy + dy * h} for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]


@pytest.fixture(scope="module")
def data(spark):
    hot = (10.0, 50.0)
    imports = [(i, {"addr:housenumber": "1", "addr:street": "Main"}, hot[0], hot[1]) for i in range(1, 301)]
    for k in range(600):  # scattered imports on a lattice, some inside buildings
        x, y = 10.001 + (k % 30) * 0.0004, 50.001 + (k // 30) * 0.0004
        imports.append((1000 + k, {"addr:housenumber": str(k % 7), "addr:street": "Side"}, x, y))
    nodes = [(5000 + i, 1, {"addr:housenumber": "1", "addr:street": "Main"}, hot[0] + 0.00002, hot[1]) for i in range(100)]
    nodes += [(6000 + k, 1, {"addr:housenumber": str(k % 7), "addr:street": "Side"}, 10.001 + (k % 30) * 0.0004 + 0.00001, 50.001 + (k // 30) * 0.0004)
              for k in range(0, 600, 5)]
    ways = [(1, 1, {"building": "yes"}, [10, 11, 12, 13, 10], _square(hot[0], hot[1], 0.00005))]
    for k in range(0, 600, 3):
        x, y = 10.001 + (k % 30) * 0.0004, 50.001 + (k // 30) * 0.0004
        ways.append((100 + k, 1, {"building": "yes"}, [1, 2, 3, 4, 1], _square(x, y, 0.00004)))
    snap = Snapshot(
        spark.createDataFrame(nodes, "id bigint, version int, tags map<string,string>, lon double, lat double"),
        spark.createDataFrame(ways, "id bigint, version int, tags map<string,string>, nodes array<bigint>, linestring array<struct<lon:double,lat:double>>"),
        spark.createDataFrame([], "id bigint, version int, tags map<string,string>"),
        spark.createDataFrame([], "relation_id bigint, member_id bigint, member_type string, member_role string, sequence_id int"),
    )
    imp = spark.createDataFrame(imports, "import_id int, tags map<string,string>, lon double, lat double")
    la = local_features(snap, parse_wkt_area(AREA)).all.cache()
    return imp, la


def test_building_pass_with_copies_equals_brute_force(data):
    imp, la = data
    got = {(r["import_id"], r["type"], r["id"]) for r in M.building_matches(imp, la, 0.5, 10.0).collect()}
    rows = M.building_pairs(imp, la, 0.5, 10.0).collect()
    by_b = {}
    for r in rows:
        by_b.setdefault((r["b_type"], r["b_id"]), []).append(r)
    want = set()
    for (bt, bid), rs in by_b.items():
        for r in rs:
            if r["kind"] != "I" or r["dist"] > 0.5 or not r["b_valid"]:
                continue
            blocked = any(
                o["dist"] <= 10.0 and ((o["kind"] == "I" and o["pid"] != r["pid"]) or (o["kind"] == "A" and o["pid"] != bid))
                for o in rs
            )
            if not blocked:
                want.add((int(r["pid"]), bt, bid))
    assert got == want
    assert want, "the lattice must produce some matches"
    assert not any(i <= 300 for i, _, _ in got), "the pile of copies blocks its building"


def test_nocity_with_copies_equals_brute_force(data):
    imp, la = data
    got = {(r["import_id"], r["type"], r["id"]) for r in M.nocity_matches(imp, la, 5.0).collect()}
    best = {}
    for r in M.nocity_pairs(imp, la, 5.0).collect():
        k = (r["import_id"], r["type"])
        if k not in best or (r["dist"], r["id"]) < (best[k]["dist"], best[k]["id"]):
            best[k] = r
    want = {(k[0], k[1], v["id"]) for k, v in best.items()}
    assert got == want
    assert sum(1 for i, _, n in got if i <= 300 and n == 5000) == 300  # all copies pick the lowest-id node


def test_intended_city_filter_applies_before_copies_collapse(spark):
    """Two copies of one address node: the lower id has a city, the higher one has none.
    As coded the lower id matches; intended mode must still find the city-less copy."""
    snap = Snapshot(
        spark.createDataFrame(
            [
                (1, 1, {"addr:housenumber": "5", "addr:street": "Elm", "addr:city": "X"}, 10.0, 50.0),
                (2, 1, {"addr:housenumber": "5", "addr:street": "Elm"}, 10.0, 50.0),
            ],
            "id bigint, version int, tags map<string,string>, lon double, lat double",
        ),
        spark.createDataFrame([], "id bigint, version int, tags map<string,string>, nodes array<bigint>, linestring array<struct<lon:double,lat:double>>"),
        spark.createDataFrame([], "id bigint, version int, tags map<string,string>"),
        spark.createDataFrame([], "relation_id bigint, member_id bigint, member_type string, member_role string, sequence_id int"),
    )
    la = local_features(snap, parse_wkt_area(AREA)).all
    imp = spark.createDataFrame([(7, {"addr:housenumber": "5", "addr:street": "Elm", "addr:city": "Y"}, 10.00001, 50.0)],
                                "import_id int, tags map<string,string>, lon double, lat double")
    assert [r["id"] for r in M.nocity_matches(imp, la, 5.0).collect()] == [1]
    assert [r["id"] for r in M.nocity_matches(imp, la, 5.0, "intended").collect()] == [2]


def test_objects_of_one_address_are_dealt_out(spark, monkeypatch):
    """An address of many objects meets the imports' addresses in several tasks, and every object with a wanted address is kept once."""
    from pyspark.sql import functions as F

    from addrweave.operators import spatial_join

    monkeypatch.setattr(spatial_join, "MANY_ROWS", 10)
    addresses = [("1", "Main")] * 400 + [("7", "Elsewhere")] * 400 + [(str(k), "Side") for k in range(50)] + [(None, "Main"), ("1", None)]
    rows = [("N", i if i % 9 else 0, hn, street, [(0.0, 0.0)], 0.0, 0.0, 0.0, 0.0) for i, (hn, street) in enumerate(addresses)]
    schema = "type string, id bigint, hn string, street string, geom array<struct<lon:double,lat:double>>, min_lon double, min_lat double, max_lon double, max_lat double"
    local_all = spark.createDataFrame(rows, schema)
    wanted = [("1", "Main"), ("1", "Main"), ("3", "Side"), ("99", "Side"), (None, "Main"), ("1", None)]
    imports = spark.createDataFrame([({k: v for k, v in (("addr:housenumber", hn), ("addr:street", street)) if v},) for hn, street in wanted], "tags map<string,string>")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = M._addressed(local_all, imports, M.AS_CODED).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    found = sorted((r["id"], r["l_hn"], r["l_street"]) for r in got)
    assert found == sorted((r[1], r[2], r[3]) for r in rows if (r[2], r[3]) in {("1", "Main"), ("3", "Side")})
    per_task = [sum(r["task"] == t and r["l_street"] == "Main" for r in got) for t in {r["task"] for r in got}]
    assert len(per_task) > 4 and max(per_task) < 200
