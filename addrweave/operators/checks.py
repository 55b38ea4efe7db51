"""Integrity checks Spark does not enforce (the original relied on table constraints).

Each check returns the violating rows as ``table, key, reason`` so a job can
report them, fail on them (``assert_valid``) or filter them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["table", "key", "reason"]


def _dup_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(table).alias("table"), F.col(key).cast("bigint").alias("key"), F.lit(f"duplicate {key}").alias("reason"))
    )


def _rows(df: DataFrame, table: str, key: str, cond, reason: str) -> DataFrame:
    return df.where(cond).select(F.lit(table).alias("table"), F.col(key).cast("bigint").alias("key"), F.lit(reason).alias("reason"))


def check_imports(imports: DataFrame) -> DataFrame:
    """``import_id`` present and unique; coordinates present."""
    return (
        _dup_keys(imports, "imports", "import_id")
        .unionByName(_rows(imports, "imports", "import_id", F.col("import_id").isNull(), "missing import_id"))
        .unionByName(
            _rows(imports, "imports", "import_id", F.col("lon").isNull() | F.col("lat").isNull(), "missing coordinates")
        )
    )


def check_changes(df: DataFrame, table: str) -> DataFrame:
    """Change ids unique and ``> 0``; versions ``>= 1``."""
    return (
        _dup_keys(df, table, "id")
        .unionByName(_rows(df, table, "id", F.col("id").isNull() | (F.col("id") <= 0), "id not positive"))
        .unionByName(_rows(df, table, "id", F.col("version").isNull() | (F.col("version") < 1), "version below 1"))
    )


def check_local_keys(local_all: DataFrame) -> DataFrame:
    """``(type, id)`` unique among local features."""
    k = F.concat_ws(":", "type", F.col("id").cast("string"))
    return (
        local_all.groupBy("type", "id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit("local_all").alias("table"), F.col("id").cast("bigint").alias("key"), F.concat(F.lit("duplicate type/id "), k).alias("reason"))
    )


def check_change_sets(changes) -> DataFrame:
    """All three change tables."""
    out = check_changes(changes.nodes, "nodes")
    return out.unionByName(check_changes(changes.ways, "ways")).unionByName(check_changes(changes.relations, "relations"))


def check_matches(matches: DataFrame) -> DataFrame:
    """The same rules on resolved matches, whose rows become the change tables: one pass over ids and versions."""
    table = F.when(F.col("type") == "N", "nodes").when(F.col("type") == "W", "ways").otherwise("relations")
    raised = F.when(F.col("type") == "M", 1).otherwise(0)
    bad_version = F.col("version").isNull() | (F.col("version") + raised < 1)
    d = matches.groupBy("type", "id").agg(F.count(F.lit(1)).alias("n"), F.max(bad_version).alias("bad_version"))
    reasons = F.array(
        F.when(F.col("n") > 1, F.lit("duplicate id")),
        F.when(F.col("id").isNull() | (F.col("id") <= 0), F.lit("id not positive")),
        F.when(F.col("bad_version"), F.lit("version below 1")),
    )
    return d.select(table.alias("table"), F.col("id").cast("bigint").alias("key"), F.explode(F.array_compact(reasons)).alias("reason"))


def is_broken(df: DataFrame, key: list[str], cond) -> bool:
    """Whether a key repeats or a row meets ``cond``: one small job."""
    d = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max(cond).alias("bad"))
    return not d.where((F.col("n") > 1) | F.col("bad")).isEmpty()


def assert_valid(violations: DataFrame) -> None:
    """Strict mode: one small action; raise with a few examples if anything is wrong."""
    bad = violations.limit(5).collect()
    if bad:
        raise ValueError("integrity check failed: " + "; ".join(f"{r['table']} {r['key']}: {r['reason']}" for r in bad))
