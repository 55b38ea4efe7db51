"""The OSM snapshot tables and the import addresses as typed DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrweave.functions.tags import tags_or_empty

NODES_SCHEMA = "id bigint, version int, tags map<string,string>, lon double, lat double"
WAYS_SCHEMA = (
    "id bigint, version int, tags map<string,string>, nodes array<bigint>, "
    "linestring array<struct<lon:double,lat:double>>"
)
RELATIONS_SCHEMA = "id bigint, version int, tags map<string,string>"
MEMBERS_SCHEMA = "relation_id bigint, member_id bigint, member_type string, member_role string, sequence_id int"
IMPORTS_SCHEMA = "import_id int, tags map<string,string>, lon double, lat double"


@dataclass
class Snapshot:
    """The four snapshot tables (unclipped)."""

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    relation_members: DataFrame


def read_snapshot(spark: SparkSession, path: str) -> Snapshot:
    """Read ``nodes``, ``ways``, ``relations`` and ``relation_members`` Parquet tables under ``path``.

    Only the needed columns are selected, so the scans prune everything else.
    """

    def rd(name: str, schema: str, optional: tuple[str, ...] = ()) -> DataFrame:
        df = spark.read.parquet(f"{path}/{name}")
        cols = [c.strip().split(" ")[0] for c in _split_schema(schema)]
        return df.select(*cols, *[c for c in optional if c in df.columns])

    return Snapshot(
        nodes=rd("nodes", NODES_SCHEMA),
        # stored way boxes, when present, let the area filter prune Parquet row groups
        ways=rd("ways", WAYS_SCHEMA, ("min_lon", "min_lat", "max_lon", "max_lat")),
        relations=rd("relations", RELATIONS_SCHEMA),
        relation_members=rd("relation_members", MEMBERS_SCHEMA),
    )


def curve_key(lon: Column, lat: Column) -> Column:
    """Place on a space-filling (Z-order) curve of cells of about 0.3 km: bits of both coordinates, interleaved."""

    def spread(c: Column, low: float, width: float) -> Column:
        x = F.least(F.greatest(F.floor((c - low) / width * 65536), F.lit(0)), F.lit(65535)).cast("bigint")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return x

    return spread(lon, -180.0, 360.0).bitwiseOR(F.shiftleft(spread(lat, -90.0, 180.0), 1))


def write_snapshot(snapshot: Snapshot, path: str, mode: str = "overwrite", clustered: bool = True, files: int | None = None) -> None:
    """Write a snapshot as Parquet tables (the layout ``read_snapshot`` expects).

    Ways get their box columns stored. ``clustered`` deals nodes and ways out by ranges of a space-filling curve and sorts them
    along it, so that a file and each of its row groups cover a small region, and an area's box
    prunes all others; ``files`` sets the number of ranges (by default as many as shuffle partitions).
    """
    from addrweave.functions.geo import bbox_columns

    ways = snapshot.ways
    if "min_lon" not in ways.columns:
        ways = ways.select("*", *bbox_columns("linestring"))

    def along_curve(df: DataFrame, lon: Column, lat: Column) -> DataFrame:
        if not clustered:
            return df
        d = df.withColumn("_curve", curve_key(lon, lat))
        # the id deals out and orders objects of one cell
        d = d.repartitionByRange(files, "_curve", "id") if files else d.repartitionByRange("_curve", "id")
        return d.sortWithinPartitions("_curve", "id").drop("_curve")

    middle = [(F.col(f"min_{c}") + F.col(f"max_{c}")) / 2 for c in ("lon", "lat")]
    along_curve(snapshot.nodes, F.col("lon"), F.col("lat")).write.mode(mode).parquet(f"{path}/nodes")
    along_curve(ways, *middle).write.mode(mode).parquet(f"{path}/ways")
    snapshot.relations.write.mode(mode).parquet(f"{path}/relations")
    snapshot.relation_members.write.mode(mode).parquet(f"{path}/relation_members")


def _split_schema(schema: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in schema:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    if cur.strip():
        out.append(cur)
    return out


def load_imports(df: DataFrame) -> DataFrame:
    """S3: normalise import addresses to ``import_id INT, tags MAP, lon DOUBLE, lat DOUBLE`` (and ``position``, their
    place in the file, if it is there)."""
    return df.select(
        F.col("import_id").cast("int").alias("import_id"),
        tags_or_empty("tags").alias("tags"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
        *(["position"] if "position" in df.columns else []),
    )
