"""Read the import file (OSM XML ``<node>`` elements).

Files are read as text records that end where the next ``<node`` begins, so that one large file is split over
tasks; each record's element is parsed by Spark's XML functions. Values stay as they are (no trimming).

What stands before a file's first node is its head, known by its place (the first record of the file) and its
beginning (``<?xml`` or ``<osm``). Every other record is a node: a malformed element, one that is not closed, a stray end tag, a
file without its head or its closing root tag, or with more behind that, stops the read, or is listed
(``read_osm_nodes_report``); nothing is dropped or turned into nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_XML_SCHEMA = "_id bigint, _lon double, _lat double, tag array<struct<_k:string,_v:string>>"
_BAD = "_malformed"

# how a file begins, a byte order mark included
_HEAD = r"^\x{FEFF}?\s*<(\?xml|osm)[\s>]"

# the start tag's attributes, up to ">" or "/>"; values may hold ">" but no "<"
_START = r"""^((?:\s+[^\s=<>/"']+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*/?>)"""


def tag_array_to_map(col: str = "tag"):
    """``array<struct<_k,_v>>`` -> map; NULL array -> empty map; a repeated key keeps its last value."""
    arr = f"coalesce({col}, CAST(array() AS ARRAY<STRUCT<_k: STRING, _v: STRING>>))"
    # keep an entry only if no later entry has the same key
    last = f"filter(sequence(0, size(a) - 1), i -> NOT exists(sequence(0, size(a) - 1), j -> j > i AND a[j]._k = a[i]._k))"
    entries = f"transform({last}, i -> named_struct('key', a[i]._k, 'value', a[i]._v))"
    return F.expr(
        f"transform(array({arr}), a -> CASE WHEN size(a) > 0 THEN map_from_entries({entries}) "
        f"ELSE CAST(map() AS MAP<STRING,STRING>) END)[0]"
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of text: ``file, block, row`` (its place), ``head`` (what stands before a file's first node) and
    ``element`` / ``rest`` (the node and what follows it) or a null ``element`` if it is not closed."""
    text = spark.read.option("lineSep", "<node").text(path)
    start = F.regexp_extract("value", _START, 1)
    d = text.select(
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value"),
        start.alias("start"),
    )
    is_head = (F.col("block") == 0) & F.rlike(F.col("value"), F.lit(_HEAD))
    close = F.locate("</node>", F.col("value"))
    single = F.endswith("start", F.lit("/>"))
    end = F.when(single, F.length("start")).when(close > 0, close + F.lit(len("</node>") - 1))
    element = F.when(F.col("start") != "", F.concat(F.lit("<node"), F.expr("substr(value, 1, end)")))
    d = d.select("file", "block", "row", "value", is_head.alias("head"), end.alias("end"), "start")
    return d.select(
        "file", "block", "row", "value", "head", element.alias("element"),
        F.when(F.col("head"), F.col("value")).otherwise(F.expr("substr(value, end + 1)")).alias("rest"),
    )


def _broken_files(records: DataFrame) -> DataFrame:
    """Files that do not begin with a head, end with the closing root tag, and hold one of each; or that hold
    comments or CDATA (which may hide a node)."""
    place = F.struct("block", "row")
    rest = F.coalesce("rest", "value")  # all of a record whose element is not closed
    ends = F.rlike(rest, F.lit(r"(</osm>|<osm[^>]*/>)\s*$"))
    per_file = records.groupBy("file").agg(
        F.min_by("head", place).alias("begins"),
        F.count_if("head").alias("heads"),
        F.max_by(ends, place).alias("closed"),
        F.sum(F.size(F.split(rest, "</osm>")) - 1).alias("closings"),
        F.max(F.contains("value", F.lit("<!--")) | F.contains("value", F.lit("<![CDATA["))).alias("hidden"),
    )
    reason = (
        F.when(F.col("hidden"), "comment or CDATA in the file")
        .when(~F.col("begins"), "file has no head")
        .when(F.col("heads") > 1, "file head inside the file")
        .when((F.col("closings") > 1) | (F.col("closings") > 0) & ~F.col("closed"), "content behind the closing root tag")
        .when(~F.col("closed"), "file is not closed")
    )
    return per_file.select("file", F.lit(None).cast("bigint").alias("block"), reason.alias("reason"), F.lit(None).cast("string").alias("text")).where("reason IS NOT NULL")


def _parsed(records: DataFrame) -> DataFrame:
    """Records of nodes with the parsed element ``n``; ``n._malformed`` is set where it can't be parsed."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "ignoreSurroundingSpaces": "false", "rowTag": "node"}
    return records.where(~F.col("head")).withColumn("n", F.from_xml("element", f"{NODE_XML_SCHEMA}, {_BAD} string", options))


def _is_bad() -> Column:
    return F.col("element").isNull() | F.col("n").isNull() | F.col(f"n.{_BAD}").isNotNull() | _stray_end()


def _stray_end() -> Column:
    return F.coalesce(F.contains("rest", F.lit("</node")), F.lit(False))


def _nodes(parsed: DataFrame, drop_untagged: bool, with_position: bool) -> DataFrame:
    position = F.struct("file", "block", "row").alias("position")
    df = parsed.select(
        F.col("n._id").cast("int").alias("import_id"),
        tag_array_to_map("n.tag").alias("tags"),
        F.col("n._lon").alias("lon"),
        F.col("n._lat").alias("lat"),
        *([position] if with_position else []),
    )
    return df.where(F.size("tags") > 0) if drop_untagged else df


def read_osm_nodes(spark: SparkSession, path: str, drop_untagged: bool = False, with_position: bool = False) -> DataFrame:
    """Import addresses ``import_id, tags, lon, lat`` from OSM XML nodes.

    Raises on files without their head or end (one pass over the files, now) and, when the result is used, on the first
    malformed element. ``with_position`` adds ``position``, which orders the nodes as the files do (O2).
    """
    records = _records(spark, path)
    bad_files = _broken_files(records).limit(5).collect()
    if bad_files:
        raise ValueError("malformed OSM XML: " + "; ".join(f"{r['file']}: {r['reason']}" for r in bad_files))
    stop = F.raise_error(F.concat(F.lit("malformed OSM XML node: "), F.substring("value", 1, 200)))
    checked = _parsed(records).withColumn("n", F.when(_is_bad(), stop.cast(_node_type())).otherwise(F.col("n")))
    return _nodes(checked, drop_untagged, with_position)


def _node_type() -> str:
    tag = "array<struct<_k:string,_v:string>>"
    return f"struct<_id:bigint,_lon:double,_lat:double,tag:{tag},{_BAD}:string>"


def read_osm_nodes_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Well-formed nodes, and a table of what is wrong: ``file, block, reason, text``."""
    records = _records(spark, path)
    parsed = _parsed(records)
    reason = F.when(F.col("element").isNull(), "element is not closed").when(_stray_end(), "end tag without its element").otherwise("element can't be parsed")
    bad = parsed.where(_is_bad()).select("file", "block", reason.alias("reason"), F.concat(F.lit("<node"), F.col("value")).alias("text"))
    return _nodes(parsed.where(~_is_bad()), False, False), bad.unionByName(_broken_files(records))
