"""K1-K5: write OSM XML (remaining imports) and osmChange XML (change sets) with Spark's XML writer.

Each task writes its own part file; ``single_file=True`` joins sorted parts to one file in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.operators.changes import Changes
from addrweave.sinks.one_file import write_one_file

# Root elements of the two file kinds and the member type names.
OSM_ROOT = 'osm version="0.6" upload="false" generator="addrweave"'
OSC_ROOT = 'osmChange version="0.6" upload="false" generator="addrweave"'
MEMBER_TYPE_NAMES = {"N": "node", "W": "way", "R": "relation"}


def _tag_array(tags: str) -> Column:
    """map -> ``array<struct<_k,_v>>`` in key order (deterministic output)."""
    return F.transform(
        F.array_sort(F.map_entries(F.col(tags))), lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v"))
    )


def _num(c: str) -> Column:
    return F.col(c).cast("string")


def osm_node_rows(remaining: DataFrame, *more: Column) -> DataFrame:
    """K1: ``<node visible="true" id lon lat>`` with tags (not stripped, no version)."""
    return remaining.select(
        F.lit("true").alias("_visible"),
        _num("import_id").alias("_id"),
        _num("lon").alias("_lon"),
        _num("lat").alias("_lat"),
        _tag_array("tags").alias("tag"),
        *more,
    )


def member_type_name(code: Column) -> Column:
    """member type code to element name."""
    args = []
    for k, v in MEMBER_TYPE_NAMES.items():
        args += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*args), code)


def osc_rows(changes: Changes) -> DataFrame:
    """K2-K5: one ``<modify>`` row per change, holding exactly one of ``node``, ``way``, ``relation``.

    Order of the file: nodes, then ways, then relations (``kind_order``, ``id``).
    """
    node = F.struct(
        _num("id").alias("_id"),
        _num("version").alias("_version"),
        _num("lon").alias("_lon"),
        _num("lat").alias("_lat"),
        _tag_array("tags").alias("tag"),
    )
    way = F.struct(
        _num("id").alias("_id"),
        _num("version").alias("_version"),
        F.transform("nodes", lambda r: F.struct(r.cast("string").alias("_ref"))).alias("nd"),
        _tag_array("tags").alias("tag"),
    )
    rel = F.struct(
        _num("id").alias("_id"),
        _num("version").alias("_version"),
        F.zip_with(
            F.zip_with("types", "ids", lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
            "roles",
            lambda ti, role: F.struct(
                member_type_name(ti["t"]).alias("_type"), ti["i"].cast("string").alias("_ref"), role.alias("_role")
            ),
        ).alias("member"),
        _tag_array("tags").alias("tag"),
    )
    n = changes.nodes.select(F.lit(0).alias("kind_order"), "id", node.alias("node"))
    w = changes.ways.select(F.lit(1).alias("kind_order"), "id", way.alias("way"))
    r = changes.relations.select(F.lit(2).alias("kind_order"), "id", rel.alias("relation"))
    n2 = n.select("kind_order", "id", "node", F.lit(None).cast(w.schema["way"].dataType).alias("way"),
                  F.lit(None).cast(r.schema["relation"].dataType).alias("relation"))
    w2 = w.select("kind_order", "id", F.lit(None).cast(n.schema["node"].dataType).alias("node"), "way",
                  F.lit(None).cast(r.schema["relation"].dataType).alias("relation"))
    r2 = r.select("kind_order", "id", F.lit(None).cast(n.schema["node"].dataType).alias("node"),
                  F.lit(None).cast(w.schema["way"].dataType).alias("way"), "relation")
    return n2.unionByName(w2).unionByName(r2)


def write_osm(remaining: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """K1: the addresses still to add, as OSM XML."""
    if single_file:  # in file order if it is known (O2)
        order = remaining["position"] if "position" in remaining.columns else remaining["import_id"]
        df = osm_node_rows(remaining, order.alias("order"), remaining["import_id"].alias("number"))
        write_one_file(df, [F.col("order"), F.col("number")], ["order", "number"], path, OSM_ROOT, "node", mode)
        return
    df = osm_node_rows(remaining)
    df.write.mode(mode).format("xml").option("rootTag", OSM_ROOT).option("rowTag", "node").save(path)


def write_osc(changes: Changes, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """K5: the change set as osmChange XML (``modify`` blocks only; NULL structs are omitted)."""
    df = osc_rows(changes)
    if single_file:
        write_one_file(df, [F.col("kind_order"), F.col("id")], ["kind_order", "id"], path, OSC_ROOT, "modify", mode)
        return
    df.drop("kind_order", "id").write.mode(mode).format("xml").option("rootTag", OSC_ROOT).option(
        "rowTag", "modify"
    ).save(path)


def write_changes_parquet(changes: Changes, path: str, mode: str = "overwrite") -> None:
    """K6: the three change tables as Parquet."""
    changes.nodes.write.mode(mode).parquet(f"{path}/changed_nodes")
    changes.ways.write.mode(mode).parquet(f"{path}/changed_ways")
    changes.relations.write.mode(mode).parquet(f"{path}/changed_relations")
