"""Deterministic test inputs derived from the driver's TPC-H-like tables.

Address points and OSM features sit on one lattice (slot ``j``: column ``j % 50``,
row ``floor(j / 50)``; every 100,000 slots the rows begin anew in a block further east, so latitudes stay in
range and the area can follow the keys at any scale). Id ranges are a billion apart. Imports come from ``customer`` (+ ``supplier`` extras), OSM
objects from ``part`` (+ ``nation`` multipolygons, ``supplier`` extra buildings).
The SQL text runs unchanged on Spark and DuckDB; each engine then builds its own
tag maps / geometry. See FIXTURES.md for the case table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrweave.functions.tags import tags_from_columns
from addrweave.sources.snapshot import Snapshot

# The fixture area (columns 0-40, rows 0-24 of the lattice) and the wide variant (all rows of a
# block), of which ``wide_bounds`` makes one for each block that holds keys.
BOUNDS_NARROW = (
    "POLYGON((-123.1005 49.1995, -123.0798 49.1995, -123.0798 49.2098, -123.1005 49.2098, -123.1005 49.1995))"
)
BOUNDS_WIDE = "POLYGON((-123.1005 49.1995, -123.0798 49.1995, -123.0798 50.0, -123.1005 50.0, -123.1005 49.1995))"

BLOCK_SLOTS, BLOCK_DEG = 100_000, 0.03


def n_blocks(spark: SparkSession, sf_dir: str) -> int:
    """Blocks of the lattice that the tables' keys reach."""
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "16 * s_suppkey + 5"}
    most = [spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.max(F.expr(k))).first()[0] or 0 for t, k in keys.items()]
    return max(most) // BLOCK_SLOTS + 1


def wide_bounds(blocks: int) -> str:
    """Columns 0-40 and all rows of each block."""
    if blocks == 1:
        return BOUNDS_WIDE
    ring = [(-123.1005, 49.1995), (-123.0798, 49.1995), (-123.0798, 50.0), (-123.1005, 50.0), (-123.1005, 49.1995)]
    strips = ["((" + ", ".join(f"{x + k * BLOCK_DEG!r} {y!r}" for x, y in ring) + "))" for k in range(blocks)]
    return f"MULTIPOLYGON({', '.join(strips)})"


# A concave area with a hole: slanted edges through the lattice, and a notch that thin lines cross.
BOUNDS_HOLED = (
    "POLYGON((-123.1003 49.1997, -123.0877 49.2031, -123.0799 49.1996, -123.0801 49.2397, -123.0902 49.2203, -123.1002 49.2399, "
    "-123.1003 49.1997),(-123.0952 49.2051, -123.0853 49.2049, -123.0901 49.2102, -123.0952 49.2051))"
)

# Its upper part is repeated, stretched, over the other rows of a block.
HOLED_FROM, HOLED_STRETCH = 49.2446, 18.0


def holed_bounds(blocks: int) -> str:
    """The concave area and its stretched copy above, in each block."""
    rings = [[tuple(map(float, p.split())) for p in r.split(", ")] for r in BOUNDS_HOLED.removeprefix("POLYGON((").removesuffix("))").split("),(")]
    tall = [[(x, HOLED_FROM + (y - 49.1996) * HOLED_STRETCH) for x, y in r] for r in rings]
    parts = []
    for k in range(blocks):
        for shape in (rings, tall):
            parts.append("(" + ",".join("(" + ", ".join(f"{x + k * BLOCK_DEG!r} {y!r}" for x, y in r) + ")" for r in shape) + ")")
    return f"MULTIPOLYGON({', '.join(parts)})"


# Keys to strip in queries, and a file of such keys as a user may write it: blanks around keys, an empty line.
SAMPLE_STRIP_KEYS = ["note:import", "source", "created_by"]
STRIP_FILE_LINES = ["  note\t", "", "highway ", "created_by"]

FX_IMPORT_SQL = """
SELECT CAST(-(c_custkey + 1) AS int) AS import_id,
       -123.1e0 + (c_custkey % 50) * 0.0005e0 + floor(c_custkey / 100000) * 0.03e0 AS lon,
       49.2e0 + floor((c_custkey % 100000) / 50) * 0.0004e0 AS lat,
       CAST(100 + c_custkey % 50 AS string) AS hn,
       'Row ' || CAST(CAST(floor(c_custkey / 50) AS bigint) AS string) AS street,
       CASE WHEN c_custkey % 11 <> 10 THEN 'City A' END AS city,
       'import' AS note
FROM {customer}
UNION ALL
SELECT CAST(-(1000000001 + s_suppkey) AS int),
       -123.1e0 + ((16 * s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN 5 ELSE 1 END) % 50) * 0.0005e0 + floor((16 * s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN 5 ELSE 1 END) / 100000) * 0.03e0 + 0.00002e0,
       49.2e0 + floor(((16 * s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN 5 ELSE 1 END) % 100000) / 50) * 0.0004e0 + 0.00002e0,
       CASE WHEN s_suppkey % 2 = 0 THEN '9' || CAST(s_suppkey AS string)
            ELSE CAST(100 + (16 * s_suppkey + 1) % 50 AS string) END,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Extra'
            ELSE 'Row ' || CAST(CAST(floor((16 * s_suppkey + 1) / 50) AS bigint) AS string) END,
       'City A', 'import'
FROM {supplier}
"""

FX_NODES_SQL = """
SELECT CASE WHEN p_partkey % 16 = 6 THEN p_partkey + 1 ELSE p_partkey + 10000000001 END AS id,
       p_size AS version,
       -123.1e0 + (p_partkey % 50) * 0.0005e0 + floor(p_partkey / 100000) * 0.03e0 + (p_partkey % 4) * 0.00001e0 AS lon,
       49.2e0 + floor((p_partkey % 100000) / 50) * 0.0004e0 AS lat,
       CASE WHEN p_partkey % 8 IN (0, 1, 2) THEN CAST(100 + p_partkey % 50 AS string) ELSE '7' END AS hn,
       CASE WHEN p_partkey % 8 IN (0, 1, 2) THEN 'Row ' || CAST(CAST(floor(p_partkey / 50) AS bigint) AS string) ELSE 'Elsewhere' END AS street,
       CASE WHEN p_partkey % 8 = 0 THEN 'City A' WHEN p_partkey % 8 = 2 THEN 'City B' END AS city,
       CASE WHEN p_partkey % 3 = 0 THEN 'editor' END AS created_by,
       CASE WHEN p_partkey % 2 = 0 THEN 'osm' END AS note
FROM {part} WHERE p_partkey % 8 IN (0, 1, 2, 3, 6)
UNION ALL
SELECT p_partkey + 30000000001, p_size,
       -123.1e0 + (p_partkey % 50) * 0.0005e0 + floor(p_partkey / 100000) * 0.03e0 + 0.00004e0,
       49.2e0 + floor((p_partkey % 100000) / 50) * 0.0004e0,
       CAST(100 + p_partkey % 50 AS string),
       'Row ' || CAST(CAST(floor(p_partkey / 50) AS bigint) AS string), NULL, NULL, NULL
FROM {part} WHERE p_partkey % 16 = 9
"""

FX_WAYS_SQL = """
SELECT p_partkey + 1 AS id, p_size AS version,
       -123.1e0 + (p_partkey % 50) * 0.0005e0 + floor(p_partkey / 100000) * 0.03e0 AS cx,
       49.2e0 + floor((p_partkey % 100000) / 50) * 0.0004e0 AS cy,
       0.00004e0 AS half,
       CASE WHEN p_partkey % 8 = 7 THEN 'line' WHEN p_partkey % 16 = 13 THEN 'bowtie' ELSE 'square' END AS shape,
       CASE WHEN p_partkey % 8 IN (4, 5, 6) THEN 'yes' END AS building,
       CASE WHEN p_partkey % 8 = 7 THEN 'yes' END AS highway,
       CASE WHEN p_partkey % 8 = 4 THEN CAST(100 + p_partkey % 50 AS string) END AS hn,
       CASE WHEN p_partkey % 8 = 4 THEN 'Row ' || CAST(CAST(floor(p_partkey / 50) AS bigint) AS string) END AS street
FROM {part} WHERE p_partkey % 8 IN (4, 5, 6, 7)
UNION ALL
SELECT 20000000001 + 2 * n_nationkey + h, 1,
       -123.1e0 + ((16 * n_nationkey + CASE WHEN n_nationkey % 2 = 0 THEN 12 ELSE 15 END) % 50) * 0.0005e0 + floor((16 * n_nationkey + CASE WHEN n_nationkey % 2 = 0 THEN 12 ELSE 15 END) / 100000) * 0.03e0,
       49.2e0 + floor(((16 * n_nationkey + CASE WHEN n_nationkey % 2 = 0 THEN 12 ELSE 15 END) % 100000) / 50) * 0.0004e0,
       0.00003e0, CASE WHEN h = 0 THEN 'half_se' ELSE 'half_nw' END, NULL, NULL, NULL, NULL
FROM {nation} CROSS JOIN (SELECT 0 AS h UNION ALL SELECT 1) hs
UNION ALL
SELECT 40000000001 + s_suppkey, 1,
       -123.1e0 + ((16 * s_suppkey + 5) % 50) * 0.0005e0 + floor((16 * s_suppkey + 5) / 100000) * 0.03e0,
       49.2e0 + floor(((16 * s_suppkey + 5) % 100000) / 50) * 0.0004e0 + 0.0001e0,
       0.00002e0, 'square', 'yes', NULL, NULL, NULL
FROM {supplier} WHERE s_suppkey % 4 = 1
"""

FX_RELATIONS_SQL = """
SELECT CAST(n_nationkey + 1 AS bigint) AS id, 3 AS version,
       CASE WHEN n_nationkey % 5 = 4 THEN 'route' ELSE 'multipolygon' END AS rel_type,
       'yes' AS building,
       CASE WHEN n_nationkey % 2 = 0 THEN CAST(100 + (16 * n_nationkey + 12) % 50 AS string) END AS hn,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Row ' || CAST(CAST(floor((16 * n_nationkey + 12) / 50) AS bigint) AS string) END AS street
FROM {nation}
"""

FX_RELATION_MEMBERS_SQL = """
SELECT CAST(n_nationkey + 1 AS bigint) AS relation_id,
       CAST(20000000001 + 2 * n_nationkey + h AS bigint) AS member_id,
       'W' AS member_type, 'outer' AS member_role, h AS sequence_id
FROM {nation} CROSS JOIN (SELECT 0 AS h UNION ALL SELECT 1) hs
"""

FIXTURE_SQL = {
    "fx_import": FX_IMPORT_SQL,
    "fx_nodes": FX_NODES_SQL,
    "fx_ways": FX_WAYS_SQL,
    "fx_relations": FX_RELATIONS_SQL,
    "fx_relation_members": FX_RELATION_MEMBERS_SQL,
}

SOURCE_TABLES = ("customer", "supplier", "part", "nation")

_TWO_ROWS_SQL = "CROSS JOIN (SELECT 0 AS h UNION ALL SELECT 1) hs"
_TWO_ROWS_SPARK = "LATERAL VIEW explode(array(0, 1)) hs AS h"

# Vertex order of each fixture shape, as corner names.
SHAPES = {
    "square": ["SW", "SE", "NE", "NW", "SW"],
    "bowtie": ["SW", "NE", "SE", "NW", "SW"],
    "line": ["SW", "NE"],
    "half_se": ["SW", "SE", "NE"],
    "half_nw": ["NE", "NW", "SW"],
}

BOXES = (("min_lon", "cx", "-"), ("min_lat", "cy", "-"), ("max_lon", "cx", "+"), ("max_lat", "cy", "+"))


@dataclass
class Fixtures:
    imports: DataFrame
    snapshot: Snapshot


def fixture_sql_for(name: str, tables: dict[str, str] | None = None) -> str:
    """The fixture SQL with plain table names (for DuckDB)."""
    tables = tables or {t: t for t in SOURCE_TABLES}
    return FIXTURE_SQL[name].format(**tables)


def _corner_sql(name: str) -> str:
    sx = "cx + half" if name[1] == "E" else "cx - half"
    sy = "cy + half" if name[0] == "N" else "cy - half"
    return f"named_struct('lon', {sx}, 'lat', {sy})"


def _shape_geometry() -> tuple[Column, Column]:
    """Vertex array and node-id array for each fixture shape (one SQL CASE each)."""
    geoms, ids = [], []
    for shape, corners in SHAPES.items():
        distinct: list[str] = []
        for c in corners:
            if c not in distinct:
                distinct.append(c)
        g = ", ".join(_corner_sql(c) for c in corners)
        n = ", ".join(f"CAST(id * 10 + {distinct.index(c)} AS BIGINT)" for c in corners)
        geoms.append(f"WHEN shape = '{shape}' THEN array({g})")
        ids.append(f"WHEN shape = '{shape}' THEN array({n})")
    return F.expr("CASE " + " ".join(geoms) + " END"), F.expr("CASE " + " ".join(ids) + " END")


def load_fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    """Read the driver tables under ``sf_dir`` and derive imports and an OSM snapshot."""
    src = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES}

    def q(name: str) -> DataFrame:
        # the two half-ways per nation come from a generator on Spark (no cross join)
        sql = FIXTURE_SQL[name].replace(_TWO_ROWS_SQL, _TWO_ROWS_SPARK)
        return spark.sql(sql, **src)

    imports = q("fx_import").select(
        F.col("import_id").cast("int").alias("import_id"),
        tags_from_columns({"addr:housenumber": "hn", "addr:street": "street", "addr:city": "city", "note": "note"}).alias(
            "tags"
        ),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
    )
    nodes = q("fx_nodes").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("version").cast("int").alias("version"),
        tags_from_columns(
            {
                "addr:housenumber": "hn",
                "addr:street": "street",
                "addr:city": "city",
                "created_by": "created_by",
                "note": "note",
            }
        ).alias("tags"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
    )
    geom, node_ids = _shape_geometry()
    ways = q("fx_ways").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("version").cast("int").alias("version"),
        tags_from_columns(
            {"building": "building", "highway": "highway", "addr:housenumber": "hn", "addr:street": "street"}
        ).alias("tags"),
        node_ids.alias("nodes"),
        geom.alias("linestring"),
        # stored boxes, as written snapshots have them: every shape reaches all sides of its square
        *(F.expr(f"CAST({c} {sign} half AS DOUBLE)").alias(name) for name, c, sign in BOXES),
    )
    relations = q("fx_relations").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("version").cast("int").alias("version"),
        tags_from_columns(
            {"type": "rel_type", "building": "building", "addr:housenumber": "hn", "addr:street": "street"}
        ).alias("tags"),
    )
    members = q("fx_relation_members").select(
        F.col("relation_id").cast("bigint").alias("relation_id"),
        F.col("member_id").cast("bigint").alias("member_id"),
        F.col("member_type").cast("string").alias("member_type"),
        F.col("member_role").cast("string").alias("member_role"),
        F.col("sequence_id").cast("int").alias("sequence_id"),
    )
    return Fixtures(imports=imports, snapshot=Snapshot(nodes, ways, relations, members))
