"""The local snapshot - features clipped to the area of interest, in one table.

P1 clip nodes, P2 clip ways, P3/J1/A1 multipolygon lines, P4 type codes, U1 union.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions.geo import bbox_columns, line_intersects_area_indexed, point, point_in_area_indexed
from addrweave.functions.tags import HOUSENUMBER, address_columns, has_tag, tag
from addrweave.operators.spatial_join import BOX, FEW_IDS
from addrweave.session import side_by_side
from addrweave.sources.area import Area, build_area_index
from addrweave.sources.snapshot import Snapshot

# ``version`` and ``way_nodes`` (ways only) travel with each feature so change sets need no
# lookup in the unclipped base tables (J6): every changed object is a local feature.
LOCAL_COLUMNS = [
    "type", "id", "version", "tags", "geom", "way_nodes", "hn", "street", "city",
    "min_lon", "min_lat", "max_lon", "max_lat", "n_ways",
]


@dataclass
class Local:
    nodes: DataFrame
    ways: DataFrame
    multipolygons: DataFrame
    all: DataFrame


def local_nodes(nodes: DataFrame, area: Area) -> DataFrame:
    """Nodes inside the area (boundary included). The box test pushes down to the scan."""
    x0, y0, x1, y1 = area.bbox
    idx = build_area_index(area)
    return (
        nodes.where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1))
        .where(point_in_area_indexed("lon", "lat", idx, area.bbox))
        .select("id", "version", "tags", point("lon", "lat").alias("geom"), "lon", "lat")
    )


def _clipped(ways: DataFrame, area: Area) -> DataFrame:
    """Rows of ways that touch the area: box overlap first, then vertex-inside or edge-crossing."""
    x0, y0, x1, y1 = area.bbox
    idx = build_area_index(area)
    w = ways if "min_lon" in ways.columns else ways.select("*", *bbox_columns("linestring"))  # stored boxes push down to the scan
    overlap = (F.col("max_lon") >= x0) & (F.col("min_lon") <= x1) & (F.col("max_lat") >= y0) & (F.col("min_lat") <= y1)
    return w.where(overlap).where(line_intersects_area_indexed("linestring", idx, area.bbox))


def local_ways(ways: DataFrame, area: Area) -> DataFrame:
    """Ways touching the area."""
    return _clipped(ways, area).select("id", "version", "tags", F.col("linestring").alias("geom"), "nodes", *BOX)


def _can_match() -> Column:
    """Objects that some pass of the merge looks at: those with a house number, and buildings."""
    return tag("tags", HOUSENUMBER).isNotNull() | has_tag("tags", "building")


def multipolygon_lines(lways: DataFrame, relations: DataFrame, members: DataFrame, matchable: bool = False) -> DataFrame:
    """Per multipolygon relation, its member ways inside the area joined into one line.

    Ways are concatenated in ``sequence_id`` order (the original leaves the order
    open); when a way starts where the previous one ended, the repeated vertex is
    dropped, as a line-building aggregate does. ``matchable`` leaves out relations that no pass looks at (lakes, forests).
    """
    if matchable:
        relations = relations.where(_can_match())
    mp = relations.where(tag("tags", "type") == "multipolygon").select(
        F.col("id").alias("relation_id"), "version", "tags"
    )
    # members of multipolygons first (semi-join), then the (large) local ways
    parts = (
        members.where(F.col("member_type") == "W")
        .select("relation_id", "member_id", "sequence_id")
        .join(mp.select("relation_id"), "relation_id", "left_semi")
        .join(lways.select(F.col("id").alias("member_id"), "geom"), "member_id")
    )
    grouped = parts.groupBy("relation_id").agg(
        F.array_sort(F.collect_list(F.struct("sequence_id", "member_id", "geom"))).alias("parts"),
        F.count(F.lit(1)).alias("n_ways"),
    )

    # a way whose first vertex repeats the previous way's last vertex contributes from its second vertex on
    prev = "parts[greatest(i - 1, 0)].geom"
    same = (
        f"i > 0 AND size(w.geom) > 0 AND size({prev}) > 0 "
        f"AND w.geom[0].lon = element_at({prev}, -1).lon AND w.geom[0].lat = element_at({prev}, -1).lat"
    )
    line = F.expr(f"flatten(transform(parts, (w, i) -> CASE WHEN {same} THEN slice(w.geom, 2, size(w.geom) - 1) ELSE w.geom END))")
    lines = grouped.select(F.col("relation_id").alias("id"), line.alias("geom"), "n_ways").join(
        mp.withColumnRenamed("relation_id", "id"), "id"
    )
    return lines.select("id", "version", "tags", "geom", *bbox_columns("geom"), "n_ways")


def _part_ids(relations: DataFrame, members: DataFrame) -> DataFrame:
    """Ids of the member ways of multipolygons that can match."""
    mp = relations.where((tag("tags", "type") == "multipolygon") & _can_match()).select(F.col("id").alias("relation_id"))
    return members.where(F.col("member_type") == "W").join(mp, "relation_id", "left_semi").select(F.col("member_id").alias("id")).distinct()


def _split_ways(
    ways: DataFrame, area: Area, part_ids: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None
) -> tuple[DataFrame, DataFrame]:
    """Clipped ways that can match (as local features), and those that a multipolygon that can match is made of (a way may be
    both): ``id, geom``.

    Ways that match are found by one scan and meet no join at all. Member ids that are written and counted small go to that
    scan, which then finds the parts as well; else parts are looked for by a scan of their own, where ids meet before
    the clip, and only ids and geometry are shuffled.
    """
    if keep is not None:
        part_ids = keep(part_ids, "part_ids")
        if part_ids.count() <= FEW_IDS:
            d = local_ways(ways, area).join(F.broadcast(part_ids.withColumn("is_part", F.lit(True))), "id", "left")
            d = keep(way_features(d.where(_can_match() | F.col("is_part")), "is_part"), "local_ways")
            return d.where(_can_match()).drop("is_part"), d.where("is_part").select("id", "geom")
    box = [c for c in BOX if c in ways.columns]
    slim = ways.select("id", "linestring", *box).join(part_ids, "id", "left_semi")
    return way_features(local_ways(ways, area).where(_can_match())), _clipped(slim, area).select("id", F.col("linestring").alias("geom"))


def _none(kind: str, name: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def node_features(ln: DataFrame) -> DataFrame:
    box = [F.col(c).alias(f"{end}_{c}") for end in ("min", "max") for c in ("lon", "lat")]
    return ln.select(F.lit("N").alias("type"), "id", "version", "tags", "geom", _none("array<bigint>", "way_nodes"), *address_columns("tags"), *box, _none("bigint", "n_ways"))


def way_features(lw: DataFrame, *more: str) -> DataFrame:
    nodes = F.col("nodes").alias("way_nodes")
    return lw.select(F.lit("W").alias("type"), "id", "version", "tags", "geom", nodes, *address_columns("tags"), *BOX, _none("bigint", "n_ways"), *more)


def multipolygon_features(mps: DataFrame) -> DataFrame:
    n_ways = F.col("n_ways").cast("bigint").alias("n_ways")
    return mps.select(F.lit("M").alias("type"), "id", "version", "tags", "geom", _none("array<bigint>", "way_nodes"), *address_columns("tags"), *BOX, n_ways)


def local_features(
    snapshot: Snapshot, area: Area, matchable: bool = False, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> Local:
    """``type, id, tags, geom, hn, street, city`` and box columns for N, W and M features.

    ``matchable`` leaves out objects that no pass of the merge looks at (nearly all nodes of a snapshot carry neither
    a number nor a building tag). ``keep(df, name)``, if given, writes the features of each type (and the ids of
    multipolygons' parts), nodes beside ways; ways are read twice: as features and as parts of multipolygons.
    """

    def nodes() -> DataFrame:
        ln = local_nodes(snapshot.nodes, area)
        n = node_features(ln.where(_can_match()) if matchable else ln)
        return keep(n, "local_nodes") if keep is not None else n

    def ways() -> tuple[DataFrame, DataFrame]:
        if matchable:
            w, parts = _split_ways(snapshot.ways, area, _part_ids(snapshot.relations, snapshot.relation_members), keep)
        else:
            w = way_features(local_ways(snapshot.ways, area))
            w = parts = keep(w, "local_ways") if keep is not None else w
        m = multipolygon_features(multipolygon_lines(parts, snapshot.relations, snapshot.relation_members, matchable))
        return w, keep(m, "local_multipolygons") if keep is not None else m

    n, (w, m) = side_by_side(nodes, ways) if keep is not None else (nodes(), ways())
    return Local(nodes=n, ways=w, multipolygons=m, all=n.unionByName(w).unionByName(m))
