"""Named queries over the fixture tables, one per operator group.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match
the DuckDB oracle in ``oracle.py``: maps are rendered as sorted ``k=v;...`` text,
arrays as comma-joined text, distances as whole centimetres.

Queries on the local table (C1) plan its operators over the snapshot; when they are built, nothing runs but the look-up of
the greatest keys (once per session and input files), which say how far the area reaches. Queries on matches (C2 to C4) plan their operators over the local table and the import pool, which are
written once, as in a merge. Queries on the outputs of a whole merge read the tables that the merge
writes, as a user who reads several outputs of one run would. What is written is kept per session and input files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrweave.functions.tags import strip_tags, tags_text
from addrweave.operators import match as M
from addrweave.operators.changes import strip_keys
from addrweave.operators.checks import check_change_sets, check_changes, check_imports, check_local_keys
from addrweave.operators.local import Local, local_features, local_nodes, local_ways, multipolygon_lines
from addrweave.plans.merge import MergeOptions, MergeResult, merge_addresses
from addrweave.session import scratch_path, write_read
from addrweave.sinks.osm_xml import osc_rows, write_osc, write_osm
from addrweave.sources.area import parse_wkt_area
from addrweave.sources.fixtures import BOUNDS_WIDE, SAMPLE_STRIP_KEYS, STRIP_FILE_LINES, Fixtures, holed_bounds, load_fixtures, n_blocks, wide_bounds
from addrweave.sources.osm_xml import read_osm_nodes, read_osm_nodes_report
from addrweave.sources.snapshot import Snapshot, read_snapshot, write_snapshot
from addrweave.sources.striplist import read_strip_list

# Fixed query parameters (metres), and the area of tables whose keys fit one block of the fixture lattice.
BOUNDS = BOUNDS_WIDE
BUFFER = 0.5
NOCITY = 5.0
BUILDING = 10.0


@dataclass
class Context:
    """Fixture tables and the operators' inputs."""

    imports: DataFrame
    snapshot: Snapshot
    local: Local
    local_all: DataFrame
    pool: DataFrame


_CONTEXTS: dict[tuple, Context] = {}
_MERGES: dict[tuple, MergeResult] = {}
_BLOCKS: dict[tuple, int] = {}
_FIXTURES: dict[tuple, Fixtures] = {}


def bounds_of(spark: SparkSession, sf_dir: str) -> str:
    """The area used by every registered query: it reaches as far as the tables' keys."""
    return wide_bounds(blocks_of(spark, sf_dir))


def blocks_of(spark: SparkSession, sf_dir: str) -> int:
    """Blocks of the fixture lattice that the keys reach, looked up once per session and input files."""
    key = (spark.sparkContext.applicationId, _input_state(spark, sf_dir))
    if key not in _BLOCKS:
        _BLOCKS[key] = n_blocks(spark, sf_dir)
    return _BLOCKS[key]


def fixtures_of(spark: SparkSession, sf_dir: str) -> Fixtures:
    """The fixture tables, planned once per session and input files."""
    key = (spark.sparkContext.applicationId, _input_state(spark, sf_dir))
    if key not in _FIXTURES:
        _FIXTURES[key] = load_fixtures(spark, sf_dir)
    return _FIXTURES[key]


def local_table(spark: SparkSession, sf_dir: str, bounds: str | None = None) -> DataFrame:
    """U1 over the fixture snapshot, not run yet."""
    return local_features(fixtures_of(spark, sf_dir).snapshot, parse_wkt_area(bounds or bounds_of(spark, sf_dir))).all


def context(spark: SparkSession, sf_dir: str) -> Context:
    """Imports, local features and the import pool, written once per session and input files."""
    key = (spark.sparkContext.applicationId, _input_state(spark, sf_dir))
    if key not in _CONTEXTS:
        fx = fixtures_of(spark, sf_dir)
        imports = write_read(fx.imports, "fx_imports")
        local = local_features(fx.snapshot, parse_wkt_area(bounds_of(spark, sf_dir)))
        local_all = write_read(local.all, "local_all")
        pool = write_read(M.remaining_after_duplicates(imports, local_all), "import_pool")
        _CONTEXTS[key] = Context(imports, fx.snapshot, local, local_all, pool)
    return _CONTEXTS[key]


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files: a changed folder is another input."""
    at = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def _merge(spark: SparkSession, sf_dir: str, conflicts: str = "nearest", semantics: str = M.AS_CODED) -> MergeResult:
    """The whole merge, run once per session, input files and options."""
    key = (spark.sparkContext.applicationId, _input_state(spark, sf_dir), conflicts, semantics)
    if key not in _MERGES:
        fx = fixtures_of(spark, sf_dir)
        opt = MergeOptions(
            buffer=BUFFER, nocity=NOCITY, building=BUILDING, strip_keys=SAMPLE_STRIP_KEYS, conflicts=conflicts, semantics=semantics
        )
        _MERGES[key] = merge_addresses(spark, fx.imports, fx.snapshot, bounds_of(spark, sf_dir), opt)
    return _MERGES[key]


def _cm(c: str = "dist") -> Column:
    return F.round(F.col(c) * 100).cast("bigint").alias("dist_cm")


def _csv(c: str) -> Column:
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


# --------------------------------------------------------------------------- queries


def q_local_nodes(spark, sf_dir):
    ln = local_nodes(fixtures_of(spark, sf_dir).snapshot.nodes, parse_wkt_area(bounds_of(spark, sf_dir)))
    return ln.select("id", tags_text("tags").alias("tags_text"), "lon", "lat")


def q_local_ways(spark, sf_dir):
    lw = local_ways(fixtures_of(spark, sf_dir).snapshot.ways, parse_wkt_area(bounds_of(spark, sf_dir)))
    return lw.select("id", tags_text("tags").alias("tags_text"), F.size("geom").alias("n_vertices"))


def q_multipolygon_lines(spark, sf_dir):
    snap = fixtures_of(spark, sf_dir).snapshot
    mps = multipolygon_lines(local_ways(snap.ways, parse_wkt_area(bounds_of(spark, sf_dir))), snap.relations, snap.relation_members)
    return mps.select(
        "id",
        tags_text("tags").alias("tags_text"),
        F.size("geom").alias("n_vertices"),
        F.col("geom")[0]["lon"].alias("first_lon"),
        F.col("geom")[0]["lat"].alias("first_lat"),
        F.element_at("geom", -1)["lon"].alias("last_lon"),
        F.element_at("geom", -1)["lat"].alias("last_lat"),
        F.col("n_ways").cast("bigint").alias("n_ways"),
    )


def q_local_features(spark, sf_dir):
    la = local_table(spark, sf_dir)
    return la.select("type", "id", tags_text("tags").alias("tags_text"), F.size("geom").alias("n_vertices"))


def q_local_features_holed(spark, sf_dir):
    """C1 on concave areas with holes, two in each block: slanted edges, lines that cross them without a vertex inside,
    multipolygons of which a part is clipped."""
    la = local_table(spark, sf_dir, holed_bounds(blocks_of(spark, sf_dir)))
    return la.select("type", "id", F.size("geom").alias("n_vertices"))


def q_snapshot_features(spark, sf_dir):
    """The local table over a snapshot written to and read from Parquet."""
    path = scratch_path(spark, "snapshot")
    write_snapshot(fixtures_of(spark, sf_dir).snapshot, path)
    la = local_features(read_snapshot(spark, path), parse_wkt_area(bounds_of(spark, sf_dir))).all
    return la.select("type", "id", tags_text("tags").alias("tags_text"), F.size("geom").alias("n_vertices"))


def q_area_latitude(spark, sf_dir):
    """A4: greatest absolute latitude of the area, beside that of the nodes it keeps."""
    area = parse_wkt_area(bounds_of(spark, sf_dir))
    ln = local_nodes(fixtures_of(spark, sf_dir).snapshot.nodes, area)
    return ln.agg(F.max(F.abs("lat")).alias("max_abs_lat")).select(F.lit(area.max_abs_lat).alias("area_max_abs_lat"), "max_abs_lat")


def q_exact_duplicates(spark, sf_dir):
    ctx = context(spark, sf_dir)
    d = M.exact_duplicates(ctx.imports, ctx.local_all)
    return d.select(
        "import_id",
        F.col("tags")["addr:housenumber"].alias("hn"),
        F.col("tags")["addr:street"].alias("street"),
        F.col("tags")["addr:city"].alias("city"),
    )


def _import_rows(df: DataFrame) -> DataFrame:
    return df.select("import_id", tags_text("tags").alias("tags_text"), "lon", "lat")


def q_remaining_after_duplicates(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return _import_rows(M.remaining_after_duplicates(ctx.imports, ctx.local_all))


def _nocity(spark, sf_dir, type_code: str):
    ctx = context(spark, sf_dir)
    m = M.nocity_matches(ctx.pool, ctx.local_all, NOCITY, keep=write_read)
    return m.where(F.col("type") == type_code).select("import_id", "id", _cm(), tags_text("tags").alias("tags_text"))


def q_nocity_nodes(spark, sf_dir):
    return _nocity(spark, sf_dir, "N")


def q_nocity_nodes_intended(spark, sf_dir):
    """Q2: only objects without a city."""
    ctx = context(spark, sf_dir)
    m = M.nocity_matches(ctx.pool, ctx.local_all, NOCITY, M.INTENDED, write_read).where(F.col("type") == "N")
    return m.select("import_id", "id", _cm(), tags_text("tags").alias("tags_text"))


def q_nocity_nodes_1m(spark, sf_dir):
    ctx = context(spark, sf_dir)
    m = M.nocity_matches(ctx.pool, ctx.local_all, 1.0, keep=write_read).where(F.col("type") == "N")
    return m.select("import_id", "id", _cm(), tags_text("tags").alias("tags_text"))


def q_nocity_ways(spark, sf_dir):
    return _nocity(spark, sf_dir, "W")


def q_nocity_relations(spark, sf_dir):
    return _nocity(spark, sf_dir, "M")


def q_merged_tags(spark, sf_dir):
    ctx = context(spark, sf_dir)
    p = M.nocity_pairs(ctx.pool, ctx.local_all, NOCITY, written=True)
    return p.select("import_id", "type", "id", tags_text("tags").alias("tags_text"))


def q_stripped_tags(spark, sf_dir):
    la = local_table(spark, sf_dir)
    st = la.select("type", "id", strip_tags("tags", strip_keys(SAMPLE_STRIP_KEYS)).alias("st"))
    return st.select("type", "id", tags_text("st").alias("tags_text"))


def q_stripped_by_file(spark, sf_dir):
    """Keys from a written file, with blanks around them and an empty line."""
    path = scratch_path(spark, "strip-list")
    spark.createDataFrame([(x,) for x in STRIP_FILE_LINES], "value string").coalesce(1).write.text(path)
    la = local_table(spark, sf_dir)
    st = la.select("type", "id", strip_tags("tags", read_strip_list(spark, path)).alias("st"))
    return st.select("type", "id", tags_text("st").alias("tags_text"))


def q_building_candidates(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return M.building_candidates(ctx.pool, ctx.local_all, BUFFER).select("import_id", "type", "id", _cm())


def _building(spark, sf_dir, semantics):
    ctx = context(spark, sf_dir)
    m = M.building_matches(ctx.pool, ctx.local_all, BUFFER, BUILDING, semantics, keep=write_read)
    return m.select("import_id", "type", "id", _cm(), tags_text("tags").alias("tags_text"))


def q_building_matches(spark, sf_dir):
    return _building(spark, sf_dir, M.AS_CODED)


def q_building_matches_intended(spark, sf_dir):
    return _building(spark, sf_dir, M.INTENDED)


def q_conflicts(spark, sf_dir):
    return _merge(spark, sf_dir).conflicts


def q_resolved_nearest(spark, sf_dir):
    return _merge(spark, sf_dir).matches.select("import_id", "type", "id", "pass", _cm())


def q_changed_nodes(spark, sf_dir):
    c = _merge(spark, sf_dir).changes.nodes
    return c.select("id", "version", tags_text("tags").alias("tags_text"), "lon", "lat")


def q_changed_ways(spark, sf_dir):
    c = _merge(spark, sf_dir).changes.ways
    return c.select("id", "version", tags_text("tags").alias("tags_text"), _csv("nodes").alias("nodes_text"))


def q_changed_relations(spark, sf_dir):
    c = _merge(spark, sf_dir).changes.relations
    return c.select(
        "id",
        "version",
        tags_text("tags").alias("tags_text"),
        _csv("types").alias("types_text"),
        _csv("ids").alias("ids_text"),
        _csv("roles").alias("roles_text"),
    )


def q_changed_relations_intended(spark, sf_dir):
    """Q6: multipolygons matched by the building pass are changed too."""
    m = _merge(spark, sf_dir, semantics=M.INTENDED)
    c = m.changes.relations
    return c.select("id", "version", tags_text("tags").alias("tags_text"), _csv("ids").alias("ids_text"))


def q_remaining_final(spark, sf_dir):
    return _import_rows(_merge(spark, sf_dir).remaining)


def q_merge_summary(spark, sf_dir):
    return _merge(spark, sf_dir).summary


def q_xml_roundtrip(spark, sf_dir):
    """K1 then S1: write the remaining imports as OSM XML into the checkpoint folder, read them back."""
    path = scratch_path(spark, "remaining_osm")
    write_osm(_merge(spark, sf_dir).remaining, path)
    return _import_rows(read_osm_nodes(spark, path))


def q_xml_exact_values(spark, sf_dir):
    """K1 then S1: values with blanks, markup and quotes come back as they are, in file order (O2)."""
    path = scratch_path(spark, "exact_osm")
    imports = fixtures_of(spark, sf_dir).imports
    odd = F.concat(F.lit("  <a b='c'> & \"d\"  "), F.col("import_id").cast("string"), F.lit(" </node> "))
    tags = F.map_concat(F.map_filter("tags", lambda k, _: k != "note"), F.create_map(F.lit("note"), odd))
    write_osm(imports.withColumn("tags", tags), path, single_file=True)
    back = read_osm_nodes(spark, path, with_position=True)
    rank = F.rank().over(Window.partitionBy("position.file").orderBy("position"))
    return back.select("import_id", tags_text("tags").alias("tags_text"), "lon", "lat", rank.cast("bigint").alias("place"))


#: Nodes as a damaged file may hold them; ``@`` is the id. All others are written well-formed.
XML_FAULTS = (
    '<node\n<tag k="id" v="@"/></node>',
    '<node <tag k="id" v="@"/></node>',
    "<node\n",
    '<node id="@" lon="1" lat="2"><tag k="a" v="b"/>',
    '<node id="x@" lon="1" lat="2"/>',
    '<node id="@" lon="1" lat="2"/></node>',
)


def q_xml_faults(spark, sf_dir):
    """S1 on files with faults: damaged, unclosed and unreadable nodes between good ones, a file without a head and one
    without its end. Every node comes back, or is listed with what is wrong."""
    n_files = 4 * blocks_of(spark, sf_dir)
    d = fixtures_of(spark, sf_dir).imports.select(F.col("import_id").cast("bigint").alias("id"), "lon", "lat")
    good = F.concat(F.lit('<node id="'), "id", F.lit('" lon="'), "lon", F.lit('" lat="'), "lat", F.lit('"/>'))
    line, fault = good, F.abs("id") % 13
    for k, text in enumerate(XML_FAULTS):
        line = F.when(fault == k, F.replace(F.lit(text), F.lit("@"), F.col("id").cast("string"))).otherwise(line)
    nodes = d.select((F.abs("id") % n_files).alias("file"), F.lit(1).alias("part"), "id", line.alias("value"))
    files = spark.range(n_files).withColumnRenamed("id", "file")
    none = F.lit(0).cast("bigint").alias("id")
    head = F.when(F.col("file") == 2, F.lit("<map>")).otherwise(F.lit('<?xml version="1.0"?>\n<osm version="0.6">'))
    heads = files.select("file", F.lit(0).alias("part"), none, head.alias("value"))
    ends = files.where("file <> 1").select("file", F.lit(2).alias("part"), none, F.lit("</osm>").alias("value"))
    path = scratch_path(spark, "faulty_osm")
    lines = nodes.unionByName(heads).unionByName(ends).repartition("file").sortWithinPartitions("file", "part", "id")
    lines.select("file", "value").write.partitionBy("file").text(path)
    found, bad = read_osm_nodes_report(spark, path)
    found = found.select(F.lit("node").alias("kind"), F.col("import_id").cast("bigint").alias("id"), F.lit(None).cast("string").alias("reason"))
    kind = F.when(F.col("text").isNull(), F.lit("file")).otherwise(F.lit("bad"))
    number = F.nullif(F.regexp_extract("text", r"=\"x?(-?[0-9]{1,15})\"", 1), F.lit("")).cast("bigint")
    return found.unionByName(bad.select(kind.alias("kind"), number.alias("id"), "reason"))


def q_osc_file(spark, sf_dir):
    """K5 written and read back: member types, node order and tag text of each change."""
    path = scratch_path(spark, "changes_osc")
    write_osc(_merge(spark, sf_dir).changes, path)
    tag = "tag array<struct<_k:string,_v:string>>"
    schema = (
        f"node struct<_id:bigint,_version:int,_lon:double,_lat:double,{tag.replace(' ', ':', 1)}>, "
        f"way struct<_id:bigint,_version:int,nd:array<struct<_ref:bigint>>,{tag.replace(' ', ':', 1)}>, "
        f"relation struct<_id:bigint,_version:int,member:array<struct<_type:string,_ref:bigint,_role:string>>,{tag.replace(' ', ':', 1)}>"
    )
    d = spark.read.format("xml").option("rowTag", "modify").option("mode", "FAILFAST").option("ignoreSurroundingSpaces", "false").schema(schema).load(path)
    kind = F.when(F.col("node").isNotNull(), "node").when(F.col("way").isNotNull(), "way").otherwise("relation")
    any_of = lambda f: F.coalesce(F.col(f"node.{f}"), F.col(f"way.{f}"), F.col(f"relation.{f}"))
    text = F.array_join(F.transform(any_of("tag"), lambda t: F.concat(t["_k"], F.lit("="), t["_v"])), ";")
    nd = F.array_join(F.transform("way.nd", lambda n: n["_ref"].cast("string")), ",")
    member = F.array_join(F.transform("relation.member", lambda m: F.concat_ws(":", m["_type"], m["_ref"].cast("string"), m["_role"])), ",")
    return d.select(
        kind.alias("kind"), any_of("_id").alias("id"), any_of("_version").alias("version"), F.col("node._lon").alias("lon"),
        F.col("node._lat").alias("lat"), text.alias("tags_text"),
        F.coalesce(nd, F.lit("")).alias("nd_text"), F.coalesce(member, F.lit("")).alias("member_text"),
    )


def q_osc_rows(spark, sf_dir):
    rows = osc_rows(_merge(spark, sf_dir).changes)
    kind = F.when(F.col("node").isNotNull(), "node").when(F.col("way").isNotNull(), "way").otherwise("relation")
    el = F.coalesce(F.col("node.tag"), F.col("way.tag"), F.col("relation.tag"))
    version = F.coalesce(F.col("node._version"), F.col("way._version"), F.col("relation._version"))
    return rows.select(
        kind.alias("kind"),
        "id",
        version.cast("int").alias("version"),
        F.coalesce(F.size("way.nd"), F.lit(0)).cast("bigint").alias("n_nd"),
        F.coalesce(F.size("relation.member"), F.lit(0)).cast("bigint").alias("n_member"),
        F.size(el).cast("bigint").alias("n_tag"),
    )


def q_invalid_rows(spark, sf_dir):
    """D6 on inputs with injected faults: supplier rows reuse customer import ids; node versions lowered by one."""
    fx = fixtures_of(spark, sf_dir)
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    dirty_imports = fx.imports.select("import_id", "lon", "lat").unionByName(
        supplier.select(
            (-(F.col("s_suppkey") + 1)).cast("int").alias("import_id"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat")
        )
    )
    dirty_nodes = fx.snapshot.nodes.select("id", (F.col("version") - 1).alias("version"))
    return check_imports(dirty_imports).unionByName(check_changes(dirty_nodes, "nodes"))


def q_invalid_merge_rows(spark, sf_dir):
    """D6 on a merge without faults and without resolution: the objects that several imports change, in all three
    change tables, and the keys of the local table (none)."""
    m = _merge(spark, sf_dir, "report")
    return check_change_sets(m.changes).unionByName(check_local_keys(context(spark, sf_dir).local_all))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "local_nodes": q_local_nodes,
    "local_ways": q_local_ways,
    "multipolygon_lines": q_multipolygon_lines,
    "local_features": q_local_features,
    "exact_duplicates": q_exact_duplicates,
    "remaining_after_duplicates": q_remaining_after_duplicates,
    "nocity_nodes": q_nocity_nodes,
    "nocity_ways": q_nocity_ways,
    "nocity_relations": q_nocity_relations,
    "merged_tags": q_merged_tags,
    "stripped_tags": q_stripped_tags,
    "building_candidates": q_building_candidates,
    "building_matches": q_building_matches,
    "building_matches_intended": q_building_matches_intended,
    "conflicts": q_conflicts,
    "resolved_nearest": q_resolved_nearest,
    "changed_nodes": q_changed_nodes,
    "changed_ways": q_changed_ways,
    "changed_relations": q_changed_relations,
    "remaining_final": q_remaining_final,
    "merge_summary": q_merge_summary,
    "xml_roundtrip": q_xml_roundtrip,
    "osc_rows": q_osc_rows,
    "invalid_rows": q_invalid_rows,
    "invalid_merge_rows": q_invalid_merge_rows,
    "local_features_holed": q_local_features_holed,
    "snapshot_features": q_snapshot_features,
    "area_latitude": q_area_latitude,
    "nocity_nodes_intended": q_nocity_nodes_intended,
    "nocity_nodes_1m": q_nocity_nodes_1m,
    "stripped_by_file": q_stripped_by_file,
    "changed_relations_intended": q_changed_relations_intended,
    "xml_exact_values": q_xml_exact_values,
    "osc_file": q_osc_file,
    "xml_faults": q_xml_faults,
}
