"""Exact duplicates, no-city matches and building matches, plus D3/D5.

Every "pick one" step is an aggregate with ``min_by`` (partial aggregation on the
map side, so a hot key is combined before the shuffle) rather than a window that
would pull a whole group into one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions.geo import dist_point_line, dist_point_polygon, is_closed, ring_is_valid
from addrweave.functions.tags import address_columns, has_tag, merge_tags
from addrweave.operators.nearest import in_cells, nearest_in_piles, piles
from addrweave.operators.spatial_join import box_pairs, by_merge, named_by, semi_join_shared_out, within_by_id, within_pairs
from addrweave.session import write_read

AS_CODED = "as_coded"
INTENDED = "intended"

# A match carries what its change row needs (version, way node list, node position),
# taken from the local feature, so no base-table lookup is needed later.
MATCH_COLUMNS = ["import_id", "type", "id", "dist", "tags", "version", "way_nodes", "f_lon", "f_lat", "pass"]
PICK_COLUMNS = ["import_id", "type", "id", "dist", "pass"]  # of a match before its tags and payload are joined
_PAYLOAD = ["version", "way_nodes", "f_lon", "f_lat"]


def _check_semantics(semantics: str) -> None:
    if semantics not in (AS_CODED, INTENDED):
        raise ValueError(f"semantics must be {AS_CODED!r} or {INTENDED!r}, not {semantics!r}")


# --------------------------------------------------------------------------- C2: exact duplicates


def _import_keys(imports: DataFrame) -> DataFrame:
    return imports.select("*", *address_columns("tags"))


def _local_address_keys(local_all: DataFrame) -> DataFrame:
    """Distinct (number, street, city) of local features; partial aggregation collapses hot keys early."""
    return (
        local_all.select("hn", "street", "city")
        .where(F.col("hn").isNotNull() & F.col("street").isNotNull() & F.col("city").isNotNull())
        .distinct()
    )


def exact_duplicates(imports: DataFrame, local_all: DataFrame) -> DataFrame:
    """Imports equal to some local object in number, street and city (NULL never matches)."""
    return (
        _import_keys(imports)
        .join(by_merge(_local_address_keys(local_all)), ["hn", "street", "city"], "left_semi")
        .select(*imports.columns)
    )


def remaining_after_duplicates(imports: DataFrame, local_all: DataFrame) -> DataFrame:
    """J12 (first stage): imports without an exact duplicate (anti-join keeps rows with NULL keys)."""
    return (
        _import_keys(imports)
        .join(by_merge(_local_address_keys(local_all)), ["hn", "street", "city"], "left_anti")
        .select(*imports.columns)
    )


# --------------------------------------------------------------------------- D3


def one_per_group(pairs: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Keep one row per ``group``: the least ``order`` tuple (e.g. nearest, then lowest id)."""
    others = [c for c in pairs.columns if c not in group]
    best = F.min_by(F.struct(*others), F.struct(*order)).alias("_best")
    return pairs.groupBy(*group).agg(best).select(*group, *[F.col("_best")[c].alias(c) for c in others])


# --------------------------------------------------------------------------- C3: no-city


def _import_points(imports: DataFrame) -> DataFrame:
    return imports.select(
        "import_id",
        F.col("tags").alias("i_tags"),
        F.col("lon").alias("p_lon"),
        F.col("lat").alias("p_lat"),
        *address_columns("tags", prefix="i_"),
    )


def _addressed(local_all: DataFrame, imports: DataFrame | None, semantics: str) -> DataFrame:
    """Local objects with a number and street (that some import has too, if given): id, keys, geometry and box only."""
    _check_semantics(semantics)
    feats = local_all.where(F.col("hn").isNotNull() & F.col("street").isNotNull())
    if semantics == INTENDED:
        feats = feats.where(F.col("city").isNull())
    feats = feats.select("type", "id", "geom", "hn", "street", "min_lon", "min_lat", "max_lon", "max_lat")
    if imports is not None:
        wanted = imports.select(*address_columns("tags")[:2]).distinct()
        feats = semi_join_shared_out(feats, wanted, ["hn", "street"], F.xxhash64("type", "id"))
    return feats.withColumnsRenamed({"hn": "l_hn", "street": "l_street"})


_ADDRESS_KEYS = [("i_hn", "l_hn"), ("i_street", "l_street")]


def with_payload(matches: DataFrame, imports: DataFrame, local_all: DataFrame) -> DataFrame:
    """Matches (import_id, type, id, ...) with the merged tags (F1) and what a change row needs, joined back by id:
    no tag map or node list travels through the spatial joins and the picks."""
    objects = local_all.select(
        "type",
        "id",
        F.col("tags").alias("l_tags"),
        "version",
        "way_nodes",
        F.when(F.col("type") == "N", F.col("min_lon")).alias("f_lon"),
        F.when(F.col("type") == "N", F.col("min_lat")).alias("f_lat"),
    )
    tags = imports.select("import_id", F.col("tags").alias("i_tags"))
    d = matches.join(by_merge(objects), ["type", "id"]).join(by_merge(tags), "import_id")
    return d.select(*matches.columns, merge_tags("i_tags", "l_tags").alias("tags"), *_PAYLOAD)


def nocity_pairs(imports: DataFrame, local_all: DataFrame, metres: float, semantics: str = AS_CODED, written: bool = False) -> DataFrame:
    """Every (import, local object) with equal number and street within ``metres`` of the object's geometry.

    As coded, the object's city is not looked at (Q2); ``intended`` requires it to be missing.
    The grid cell is part of the join key, so a hot (number, street) pair never
    meets objects far away, and its objects are not gathered in one task before. If ``local_all`` is ``written`` (boxes are read twice), imports make rows for levels in use only.
    """
    pts = _import_points(imports).where(F.col("i_hn").isNotNull() & F.col("i_street").isNotNull()).drop("i_tags")
    feats = _addressed(local_all, None, semantics)
    pairs = within_pairs(pts, feats, metres, dist_point_line, keys=_ADDRESS_KEYS, levels_in_use=written)
    return with_payload(pairs.select("import_id", "type", "id", "dist"), imports, local_all)


def nocity_matches(
    imports: DataFrame, local_all: DataFrame, metres: float, semantics: str = AS_CODED, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """C3 with D3: per import and object type, the nearest match (then lowest id), with its tags and payload."""
    picked = nocity_picks(imports, local_all, metres, semantics, keep)
    return with_payload(picked, imports, local_all).select(*MATCH_COLUMNS)


def nocity_picks(
    imports: DataFrame, local_all: DataFrame, metres: float, semantics: str = AS_CODED, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """The picks of C3 as ids and distances: ``PICK_COLUMNS``.

    The pick depends on an import's position and address only, and among objects of one type, address and
    geometry only the lowest id can be picked: equal ones are one row on either side of the spatial join, so a
    pile of copies does not meet another pile copy by copy. Positions of one address that crowd a cell (a small job looks for
    them) find their nearest objects box by box instead of pairwise; ``keep(df, name)`` writes tables of that.
    """
    spot = ["i_hn", "i_street", "p_lon", "p_lat"]
    pts = _import_points(imports).where(F.col("i_hn").isNotNull() & F.col("i_street").isNotNull()).select("import_id", *spot)
    box = ["min_lon", "min_lat", "max_lon", "max_lat"]
    feats = _addressed(local_all, imports, semantics).groupBy("type", "l_hn", "l_street", "geom", *box).agg(F.min("id").alias("id"))
    if keep is not None:
        feats = keep(feats, "addressed")  # boxes are read twice
    spots = pts.select(*spot).distinct()
    crowds = piles(spots, metres)
    if crowds.isEmpty():
        best = _nearest(spots, feats, metres, keep is not None)
    else:
        keep = keep or write_read
        crowds = keep(crowds, "piles")
        cells = in_cells(spots, metres)
        on = ["i_hn", "i_street", "cx", "cy"]
        best = _nearest(cells.join(by_merge(crowds), on, "left_anti").select(*spot), feats, metres, True)
        crowded = keep(cells.join(by_merge(crowds), on, "left_semi").select(*spot), "crowded")
        best = best.unionByName(nearest_in_piles(crowded, feats, metres, keep))
    return pts.join(by_merge(best), spot).select("import_id", "type", "id", "dist", F.concat(F.lit("nocity_"), F.col("type")).alias("pass"))


def _nearest(spots: DataFrame, feats: DataFrame, metres: float, written: bool) -> DataFrame:
    pairs = within_pairs(spots, feats, metres, dist_point_line, keys=_ADDRESS_KEYS, levels_in_use=written)
    best = pairs.groupBy(*spots.columns, "type").agg(F.min(F.struct("dist", "id")).alias("best"))
    return best.select(*spots.columns, "type", "best.dist", "best.id")


# --------------------------------------------------------------------------- C4: buildings


def building_features(local_all: DataFrame) -> DataFrame:
    """Unaddressed closed ways and multipolygons with a ``building`` tag."""
    return local_all.where(
        F.col("type").isin("W", "M") & has_tag("tags", "building") & F.col("hn").isNull() & is_closed("geom")
    )


def _area_features(local_all: DataFrame) -> DataFrame:
    """J10 (intended): ways/multipolygons that are buildings or carry a house number."""
    return local_all.where(F.col("type").isin("W", "M") & (has_tag("tags", "building") | F.col("hn").isNotNull()))


_BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def _to_polygon(x: str, y: str, g: str) -> Column:
    return dist_point_polygon(x, y, g, _BOX)


def _building_keys(local_all: DataFrame) -> DataFrame:
    return building_features(local_all).select(F.col("type").alias("b_type"), F.col("id").alias("b_id"), "geom", *_BOX)


def _import_spots(pool: DataFrame) -> DataFrame:
    """Positions of imports: how many stand there (``cnt``) and the lowest id (``pid``)."""
    return pool.groupBy(F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("import_id").cast("bigint").alias("pid")
    )


def _address_spots(local_all: DataFrame) -> DataFrame:
    """The same of address nodes."""
    nodes = local_all.where((F.col("type") == "N") & F.col("hn").isNotNull())
    return nodes.groupBy(F.col("min_lon").alias("p_lon"), F.col("min_lat").alias("p_lat")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("id").alias("pid")
    )


def _candidates(
    pool: DataFrame, local_all: DataFrame, buffer: float, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(position of imports, building) pairs within ``buffer``, and the valid buildings (P9) among them with their
    geometry. With ``keep``, ids and boxes alone meet in the grid cells, and geometry is fetched for the buildings whose
    box an import touches; without it (tables would be planned again for each use) geometry goes along. Only
    buildings within the distance reach the validity test."""
    blds, ids = _building_keys(local_all), ["b_type", "b_id"]
    columns = ["p_lon", "p_lat", "cnt", "pid", *ids, "dist"]
    if keep is None:
        near = within_pairs(_import_spots(pool), blds, buffer, _to_polygon).select(*columns)
        return near, blds.join(by_merge(near.select(*ids).distinct()), ids, "left_semi").where(ring_is_valid("geom"))
    near = keep(box_pairs(_import_spots(pool), blds, ids, buffer, levels_in_use=True), "building_boxes")
    shapes = keep(named_by(blds, near, ids), "building_shapes")
    near = keep(within_by_id(near, shapes, ids, buffer, _to_polygon).select(*columns), "building_near")
    found = shapes.join(by_merge(near.select(*ids).distinct()), ids, "left_semi").where(ring_is_valid("geom"))
    return near, keep(found, "building_found")


def building_candidates(pool: DataFrame, local_all: DataFrame, buffer: float) -> DataFrame:
    """J7 with P9: ``import_id, type, id, dist`` of every import within ``buffer`` of a valid unaddressed building."""
    near, found = _candidates(pool, local_all, buffer)
    near = near.join(by_merge(found.select("b_type", "b_id")), ["b_type", "b_id"], "left_semi")
    spot = pool.select("import_id", F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat"))
    return spot.join(by_merge(near), ["p_lon", "p_lat"]).select("import_id", F.col("b_type").alias("type"), F.col("b_id").alias("id"), "dist")


def building_pairs(pool: DataFrame, local_all: DataFrame, buffer: float, metres: float) -> DataFrame:
    """Every import ('I') and address node ('A') with every unaddressed building within ``max(buffer, metres)``:
    ``kind, pid, b_type, b_id, dist, b_valid``. For checks; ``building_matches`` looks at the candidates' surroundings only."""
    imp = pool.select(F.lit("I").alias("kind"), F.col("import_id").cast("bigint").alias("pid"), F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat"))
    adr = local_all.where((F.col("type") == "N") & F.col("hn").isNotNull()).select(
        F.lit("A").alias("kind"), F.col("id").alias("pid"), F.col("min_lon").alias("p_lon"), F.col("min_lat").alias("p_lat")
    )
    blds = _building_keys(local_all).withColumn("b_valid", ring_is_valid("geom"))
    return within_pairs(imp.unionByName(adr), blds, max(float(buffer), float(metres)), _to_polygon).drop("geom", *_BOX)


def building_matches(
    pool: DataFrame,
    local_all: DataFrame,
    buffer: float,
    metres: float,
    semantics: str = AS_CODED,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """J7-J10 (see ``building_hits``) with merged tags and payload."""
    return with_payload(building_hits(pool, local_all, buffer, metres, semantics, keep), pool, local_all)


def building_hits(
    pool: DataFrame,
    local_all: DataFrame,
    buffer: float,
    metres: float,
    semantics: str = AS_CODED,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """``import_id, type, id, dist`` of (import, building) pairs that survive all filters, before D3.

    J7: the buffered import touches a valid building polygon.
    J8: no other import of the pool lies within ``metres`` of the building.
    J9: no address node within ``metres`` (as coded, a node whose id equals the
        building id is ignored - Q4; ``intended`` drops that inequality).
    J10 (``intended`` only; as coded it never excludes anything - Q3): no other
        building or addressed area within ``metres`` of the import point.

    J7 comes first, so the work follows the imports: only its buildings meet other imports and address
    nodes. Copies of imports (and of address nodes) at one position are one row with a count. "No other within N" is decided from counts and
    lowest ids per building (partial aggregates), not by pairing neighbours.
    ``keep(df, name)``, if given, writes the tables of J7 and J10, which are read several times.
    """
    _check_semantics(semantics)
    near, found = _candidates(pool, local_all, buffer, keep)
    spots = _import_spots(pool).withColumn("kind", F.lit("I")).unionByName(_address_spots(local_all).withColumn("kind", F.lit("A")))
    around = within_pairs(spots, found, metres, _to_polygon, levels_in_use=keep is not None)

    def figures(kind: str, n: str, least: str) -> list[Column]:
        of = F.col("kind") == kind
        return [F.coalesce(F.sum(F.when(of, F.col("cnt"))), F.lit(0)).alias(n), F.min(F.when(of, F.col("pid"))).alias(least)]

    per_building = around.groupBy("b_type", "b_id").agg(*figures("I", "n_imp", "min_imp"), *figures("A", "n_adr", "min_adr"))
    # a candidate further away than ``metres`` (a wide buffer) may have nothing around it
    per_building = found.select("b_type", "b_id").join(by_merge(per_building), ["b_type", "b_id"], "left")
    per_building = per_building.fillna(0, ["n_imp", "n_adr"])
    m = near.join(by_merge(per_building), ["b_type", "b_id"])
    other_import = (F.col("n_imp") >= 2) | ((F.col("n_imp") == 1) & (F.col("min_imp") != F.col("pid")))
    if semantics == AS_CODED:
        other_addr = (F.col("n_adr") >= 2) | ((F.col("n_adr") == 1) & (F.col("min_adr") != F.col("b_id")))
    else:
        other_addr = F.col("n_adr") >= 1
    m = m.where(~other_import & ~other_addr).select("p_lon", "p_lat", F.col("b_type").alias("type"), F.col("b_id").alias("id"), "dist")
    spot = pool.select("import_id", F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat"))
    m = spot.join(by_merge(m), ["p_lon", "p_lat"]).select("import_id", "type", "id", "dist", "p_lon", "p_lat")
    if semantics == INTENDED:
        m = _without_nearby_areas(m, local_all, metres, keep)
    return m.drop("p_lon", "p_lat")


def _without_nearby_areas(m: DataFrame, local_all: DataFrame, metres: float, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Drop matches whose import point has another building/addressed area within ``metres``. As in J7, with ``keep``
    ids and boxes meet first, and geometry is fetched for the areas that a match's box test leaves."""
    areas = _area_features(local_all).select(
        F.col("type").alias("a_type"), F.col("id").alias("a_id"), F.col("geom").alias("a_geom"), *_BOX
    )
    ids, hit = ["a_type", "a_id"], ["import_id", "type", "id"]
    itself = (F.col("a_type") == F.col("type")) & (F.col("a_id") == F.col("id"))
    if keep is None:
        other = within_pairs(m.select(*hit, "p_lon", "p_lat"), areas, metres, dist_point_line, geom="a_geom").where(~itself)
    else:
        m = keep(m, "area_hits")
        near = keep(box_pairs(m.select(*hit, "p_lon", "p_lat"), areas, ids, metres, levels_in_use=True).where(~itself), "area_boxes")
        shapes = named_by(areas.select(*ids, "a_geom"), near, ids)
        other = within_by_id(near, shapes, ids, metres, dist_point_line, geom="a_geom")
    return m.join(by_merge(other.select(*hit).distinct()), hit, "left_anti")


def building_assignments(matches: DataFrame, semantics: str = AS_CODED) -> DataFrame:
    """J11 with D3: per import one building (nearest, then lowest id), as ``PICK_COLUMNS``.

    As coded only ways are used (Q6: multipolygon matches are dropped);
    ``intended`` also emits multipolygons, one per import and type.
    """
    _check_semantics(semantics)
    if semantics == AS_CODED:
        matches = matches.where(F.col("type") == "W")
    picked = one_per_group(matches.select("import_id", "type", "id", "dist"), ["import_id", "type"], ["dist", "id"])
    return picked.select(*PICK_COLUMNS[:-1], F.concat(F.lit("building_"), F.col("type")).alias("pass"))


# --------------------------------------------------------------------------- D5


def conflict_groups(matches: DataFrame) -> DataFrame:
    """D5 ``report``: objects chosen by more than one import (each would break the change table's key)."""
    return (
        matches.groupBy("type", "id")
        .agg(
            F.count(F.lit(1)).alias("n_imports"),
            F.min("import_id").alias("min_import_id"),
            F.max("import_id").alias("max_import_id"),
        )
        .where(F.col("n_imports") > 1)
    )


def resolve_conflicts(matches: DataFrame, policy: str = "error") -> DataFrame:
    """Make change ids unique.

    ``error``: raise if any object was chosen twice (the original aborts the run);
    ``nearest``: keep the nearest import per object (then lowest import id), the
    others stay in the import file; ``report``: return matches unchanged (use
    ``conflict_groups`` to see the groups).
    """
    if policy == "nearest":
        return one_per_group(matches, ["type", "id"], ["dist", "import_id"]).select(*matches.columns)
    if policy == "report":
        return matches
    if policy == "error":
        bad = conflict_groups(matches).limit(5).collect()
        if bad:
            desc = ", ".join(f"{r['type']}{r['id']} x{r['n_imports']}" for r in bad)
            raise ValueError(f"conflicting changes: several imports modify the same object ({desc})")
        return matches
    raise ValueError(f"unknown conflict policy {policy!r}")
