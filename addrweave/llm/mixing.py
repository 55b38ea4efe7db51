"""Mixing sources to target weights, with DataFrame operations only.

Sizes are summed per source (at once, into a small written table), a repetition rate is derived for each source, and every document
is emitted floor(rate) times, plus once more if a number drawn from its id falls below the
fraction of the rate.

Defined results: a null text has size 0; a null source is a source of its own, last in order;
rows that repeat a doc_id draw alike (they are emitted equally often); an empty table gives an
empty mix; sources of size 0 have target 0 and rate 0. Columns beside ``id_col``, ``text_col``
and ``source_col`` pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrweave.llm.shared import WORD_PATTERN, cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed only (60 bits of an MD5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").cast("double") / F.lit(float(16**15))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """One row per source (columns ``__source``, ``__source_size``) with its ``__target``.

    Targets are weight shares of ``share`` times all sizes, at most ``max_repeat`` times the
    source's size; what a full source leaves goes to the others by weight. With sources sorted by
    limit over weight that is min(limit, level * weight), where the level is the largest of (total -
    limits before) / (weights from here on). The windows run over one row per source.
    """
    order = Window.orderBy(F.col("__source").asc_nulls_last())
    choose = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumns({"__weight": choose, "__limit": (F.col("__source_size") * max_repeat).cast("double")})
    by = Window.orderBy(F.col("__limit") / F.col("__weight"), F.col("__source").asc_nulls_last())
    everything = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("__limit").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("__weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("__source_size").over(everything) * F.lit(share)
    level = F.max(F.col("__here")).over(everything)
    t = t.withColumn("__here", (total - before) / rest)
    return t.select("__source", "__source_size", F.least("__limit", level * F.col("__weight")).alias("__target"))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
) -> DataFrame:
    """Every document once, with ``__size``, ``__source_size``, ``__target`` and the number of copies ``__copies``;
    columns of these names in the input are replaced."""
    d = docs.drop("__size", "__source_size", "__target", "__copies", "__source").withColumn("__size", n_words(F.col(text_col)))
    sizes = d.groupBy(F.col(source_col).alias("__source")).agg(F.sum("__size").alias("__source_size"))
    # written, so that its size is known when the join is planned: with few sources the documents stay where they are
    targets = cut(source_targets(sizes, weights, share, max_repeat), "source-targets")
    d = d.join(targets, F.col(source_col).eqNullSafe(F.col("__source")), "left").drop("__source")
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    extra = draw(F.col(id_col), seed) < rate - F.floor(rate)
    return d.withColumn("__copies", F.floor(rate).cast("int") + extra.cast("int"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents: the input's columns, each row as often as its source's rate says."""
    row = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    plan = mix_plan(row, "id", "text", "source", **options).where(F.col("__copies") > 0)
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("row.*")
