"""Change sets of matched objects (J6: their version, nodes and position come with the match), with
ordered member arrays for relations (A2), raised relation versions (F12, Q7) and the
strip list applied (F2)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.functions.tags import ALWAYS_STRIPPED, strip_tags
from addrweave.operators.spatial_join import by_merge


@dataclass
class Changes:
    nodes: DataFrame  # id, version, tags, lon, lat
    ways: DataFrame  # id, version, tags, nodes
    relations: DataFrame  # id, version, tags, types, ids, roles


def strip_keys(extra: Iterable[str] = ()) -> list[str]:
    """The strip list united with the keys that are always removed."""
    return sorted(set(k for k in extra if k) | set(ALWAYS_STRIPPED))


def ordered_members(members: DataFrame, relation_ids: DataFrame) -> DataFrame:
    """A2/O1: per relation, member types, ids and roles in ``sequence_id`` order.

    One sorted array of structs is split with ``transform``, so the three arrays
    always line up. Only relations in ``relation_ids`` are aggregated.
    """
    m = members.join(relation_ids.select(F.col("id").alias("relation_id")).distinct(), "relation_id", "left_semi")
    g = m.groupBy("relation_id").agg(
        F.array_sort(F.collect_list(F.struct("sequence_id", "member_type", "member_id", "member_role"))).alias("ms")
    )
    return g.select(
        F.col("relation_id").alias("id"),
        F.transform("ms", lambda x: x["member_type"]).alias("types"),
        F.transform("ms", lambda x: x["member_id"]).alias("ids"),
        F.transform("ms", lambda x: x["member_role"]).alias("roles"),
    )


def change_sets(matches: DataFrame, relation_members: DataFrame, strip: Iterable[str] = ()) -> Changes:
    """Build the three change tables from resolved matches (``MATCH_COLUMNS``).

    Version, way node list and node position come with each match (they were
    carried from the local feature, which is the base-table row). Nodes and ways
    keep their version; relations get ``version + 1`` and their full member list.
    """
    keys = strip_keys(strip)
    stripped = strip_tags("tags", keys).alias("tags")
    nodes = matches.where(F.col("type") == "N").select(
        "id", "version", stripped, F.col("f_lon").alias("lon"), F.col("f_lat").alias("lat")
    )
    ways = matches.where(F.col("type") == "W").select("id", "version", stripped, F.col("way_nodes").alias("nodes"))
    rel_matches = matches.where(F.col("type") == "M")
    relations = rel_matches.join(by_merge(ordered_members(relation_members, rel_matches)), "id").select(
        "id",
        (F.col("version") + 1).alias("version"),
        stripped,
        "types",
        "ids",
        "roles",
    )
    return Changes(nodes=nodes, ways=ways, relations=relations)
