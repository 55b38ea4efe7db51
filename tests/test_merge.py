"""Merge properties (partition of import ids, conflicts, tag merging, versions, strip list)."""

import pytest
from pyspark.sql import functions as F

from addrweave.plans.catalog import BOUNDS, context
from addrweave.plans.merge import MergeOptions, merge_addresses
from addrweave.sources.fixtures import SAMPLE_STRIP_KEYS, load_fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    ctx = context(spark, SF)
    opt = MergeOptions(nocity=5.0, building=10.0, strip_keys=SAMPLE_STRIP_KEYS, conflicts="nearest")
    return ctx, merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, opt)


def test_import_ids_are_partitioned(result):
    ctx, r = result
    dup = {x[0] for x in r.duplicates.select("import_id").collect()}
    matched = {x[0] for x in r.matches.select("import_id").collect()}
    remaining = [x[0] for x in r.remaining.select("import_id").collect()]
    allids = {x[0] for x in ctx.imports.select("import_id").collect()}
    assert len(remaining) == len(set(remaining))
    assert dup.isdisjoint(matched) and dup.isdisjoint(remaining) and matched.isdisjoint(remaining)
    assert dup | matched | set(remaining) == allids


def test_change_ids_unique_and_versions(result):
    ctx, r = result
    for df in (r.changes.nodes, r.changes.ways, r.changes.relations):
        assert df.count() == df.select("id").distinct().count()
    rel = r.changes.relations.join(ctx.snapshot.relations.select("id", F.col("version").alias("v0")), "id")
    assert rel.where("version <> v0 + 1").count() == 0
    node = r.changes.nodes.join(ctx.snapshot.nodes.select("id", F.col("version").alias("v0")), "id")
    assert node.where("version <> v0").count() == 0


def test_merged_tags_keep_existing_values(result):
    ctx, r = result
    n = r.changes.nodes.join(ctx.snapshot.nodes.select("id", F.col("tags").alias("old")), "id").collect()
    assert n
    for row in n:
        for k, v in row["old"].items():
            if k == "created_by":  # on the strip list
                assert k not in row["tags"]
            else:
                assert row["tags"][k] == v


def test_relation_members_ordered(result):
    _, r = result
    for row in r.changes.relations.collect():
        assert row["types"] == ["W", "W"]
        assert row["ids"] == sorted(row["ids"])
        assert len(row["roles"]) == len(row["ids"])


def test_conflict_policy_error_raises(spark):
    ctx = context(spark, SF)
    with pytest.raises(ValueError, match="conflicting"):
        merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(nocity=5.0, conflicts="error"))


def test_no_conflicts_at_one_metre(spark):
    ctx = context(spark, SF)
    r = merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(nocity=1.0, conflicts="error"))
    assert r.conflicts.count() == 0
    assert r.matches.count() > 0


def test_no_passes_means_no_changes(spark):
    ctx = context(spark, SF)
    r = merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions())
    assert r.matches.count() == 0
    assert r.changes.nodes.count() == 0
    assert r.remaining.count() == r.remaining_after_duplicates.count()


def test_semantics_checked(spark):
    ctx = context(spark, SF)
    with pytest.raises(ValueError):
        merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(nocity=1.0, semantics="other"))


def test_summary_consistent(result):
    _, r = result
    s = {row["stage"]: row["n"] for row in r.summary.collect()}
    assert s["imports"] == s["duplicates"] + s["remaining_after_duplicates"]
    assert s["remaining"] == s["remaining_after_duplicates"] - s["matched_imports"]


def test_conflict_policy_report_keeps_all_matches(spark, result):
    ctx, resolved = result
    r = merge_addresses(
        spark, ctx.imports, ctx.snapshot, BOUNDS,
        MergeOptions(nocity=5.0, building=10.0, strip_keys=SAMPLE_STRIP_KEYS, conflicts="report"),
    )
    groups = r.conflicts.collect()
    assert groups, "the fixtures have conflicts at 5 m"
    extra = sum(g["n_imports"] - 1 for g in groups)
    assert r.matches.count() == resolved.matches.count() + extra


def test_intended_emits_multipolygon_building_changes(spark):
    """Q6: as coded, multipolygon building matches change nothing; intended emits them as
    relation changes (version + 1). sf0.1 with the wide bounds: 212 way matches (SURVEY §5.3)."""
    ctx = context(spark, "/root/testdata/sf0.1")
    coded = merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS, MergeOptions(building=10.0, conflicts="nearest"),
                            local_all=ctx.local_all, pool=ctx.pool)
    intended = merge_addresses(spark, ctx.imports, ctx.snapshot, BOUNDS,
                               MergeOptions(building=10.0, semantics="intended", conflicts="nearest"),
                               local_all=ctx.local_all, pool=ctx.pool)
    c = {r["pass"]: r["count"] for r in coded.matches.groupBy("pass").count().collect()}
    i = {r["pass"]: r["count"] for r in intended.matches.groupBy("pass").count().collect()}
    assert "building_M" not in c and coded.changes.relations.count() == 0
    assert i["building_W"] == 212
    assert i["building_M"] > 0 and intended.changes.relations.count() == i["building_M"]
    assert intended.changes.relations.where("version <> 4").count() == 0  # fixture relations have version 3


def test_repeated_import_id_stops_the_merge(spark):
    fx = context(spark, SF)
    twice = fx.imports.unionByName(fx.imports.limit(1))
    with pytest.raises(ValueError, match="duplicate import_id"):
        merge_addresses(spark, twice, fx.snapshot, BOUNDS, MergeOptions(nocity=5.0, conflicts="nearest"))
    r = merge_addresses(spark, twice, fx.snapshot, BOUNDS, MergeOptions(nocity=5.0, conflicts="nearest", strict=False))
    assert r.remaining.count() > 0


def test_repeated_object_key_and_bad_versions_stop_the_merge(spark):
    from addrweave.sources.snapshot import Snapshot

    s = context(spark, SF).snapshot
    imports = context(spark, SF).imports
    addressed = s.nodes.where("tags['addr:housenumber'] IS NOT NULL")
    again = Snapshot(s.nodes.unionByName(addressed), s.ways, s.relations, s.relation_members)
    with pytest.raises(ValueError, match="duplicate type/id"):
        merge_addresses(spark, imports, again, BOUNDS, MergeOptions(nocity=5.0, conflicts="nearest"))
    zero = Snapshot(s.nodes.withColumn("version", F.lit(0)), s.ways, s.relations, s.relation_members)
    r = merge_addresses(spark, imports, zero, BOUNDS, MergeOptions(nocity=5.0, conflicts="nearest"))
    with pytest.raises(ValueError, match="version below 1"):
        r.changes  # noqa: B018


def test_no_imports(spark):
    """An empty import file: every table is empty, and every count is known and zero."""
    fx = load_fixtures(spark, SF)
    none = spark.createDataFrame([], "import_id int, tags map<string,string>, lon double, lat double")
    r = merge_addresses(spark, none, fx.snapshot, BOUNDS, MergeOptions(nocity=5.0, building=10.0, conflicts="nearest"))
    assert {x.stage: x.n for x in r.summary.collect()} == dict.fromkeys(
        ["imports", "duplicates", "remaining_after_duplicates", "matched_imports", "changed_nodes", "changed_ways", "changed_relations", "remaining"], 0
    )
    assert r.remaining.count() == r.changes.relations.count() == 0
    r.close()
