"""Connected components of a table of links, by alternating large and small stars.

Each round links every node's larger neighbours to its smallest one, then its smaller neighbours
and itself to the smallest. Both keep the components and shrink distances until every node hangs on
the smallest id of its component. Only one flag leaves the executors; each round starts from written files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import cut


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    others = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _open(e: DataFrame) -> bool:
    """Whether some node hangs on two others, or on one that hangs itself."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.agg(F.max((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0] or False


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id that some link joins to a smaller one.

    ``links`` holds pairs of longs in any order, repeated or not; nulls and links to itself count for nothing.
    Smallest ids and ids without links are not listed.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
    e = cut(e.where("x AND y AND u > v").select("u", "v").distinct(), "links")
    while _open(e):
        e = cut(_small_star(_large_star(e)), "stars")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
