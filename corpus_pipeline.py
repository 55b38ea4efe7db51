"""A training corpus from raw documents: five stages, each written and read again.

Each stage works on all that the one before kept, and returns the columns of ``documents`` (the last one
its tokens). Other columns of the input, whatever their names, pass through.

1. ``language_id``: learns from the labelled rows and drops documents without a letter, and those whose language
   is a guess (score below ``MIN_SCORE``, which real text of a few words exceeds).
2. ``near_dedup``: of documents linked by a similarity of 0.8 or more over shingles of five words, directly or by others, exactly
   one row stays: the one with the smallest id (nulls last; of rows that repeat it one). Every row counts for itself, whatever
   its id; documents without words are linked with nothing and stay.
3. ``suffix_dedup``: removes bytes that a 50-byte string shared with a document of smaller id covers; the document stays,
   with what is left of its text (``n_chars`` follows).
4. ``mixing``: emits each document as often as its source's rate says.
5. ``bpe``: token ids of every text, with digests of the ids and of the text decoded from them.

Null and empty texts go with the first stage, rows that repeat with the second; an empty table gives no rows at any stage. A
null source is a source of its own in mixing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrweave.llm.bpe import bpe_encode
from addrweave.llm.langid import UND, labelled_rows, learn, with_language
from addrweave.llm.mixing import mix
from addrweave.llm.queries import tokenizer_file
from addrweave.llm.setsketch import near_duplicates
from addrweave.llm.shared import cut
from addrweave.llm.suffix import remove_shared

MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = docs.select(F.struct("*").alias("row"), F.col("text"))
    d = with_language(row, learn(labelled_rows(docs)))
    return d.where((F.col("lang_pred") != UND) & (F.col("score") >= MIN_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = "row"
    while row in (c.lower() for c in docs.columns):
        row += "_"
    # numbers are fixed once written
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(row, "text"), id_col=row, width=5, percent=80).select(F.col(row).alias("n"), "component_id")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(row))
    # one row a component leaves each task, and rows meet by their numbers: a large group is no hot key
    places = found.join(rows.select(F.col(row).alias("n"), place.alias("place")), "n")
    first = places.groupBy("component_id").agg(F.min("place").alias("first")).select(F.col("first")[row].alias("n"))
    gone = found.select("n").join(first, "n", "left_anti").select(F.col("n").alias(row))
    return rows.join(cut(gone, "copies"), row, "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = docs.select(F.struct(*[c for c in docs.columns if c.lower() != "text"]).alias("row"), F.col("doc_id"), F.col("text"))
    d = remove_shared(row)
    columns = {c: F.col("text") if c.lower() == "text" else F.col("row")[c] for c in docs.columns}
    columns |= {c: F.length("text").cast(t) for c, t in docs.dtypes if c.lower() == "n_chars"}
    return d.select(*(x.alias(c) for c, x in columns.items()))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = bpe_encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_file("word_bpe_49k.json"))
    return d.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

# Several stages are beyond SQL (a learned model, tokenizer, byte ranges); tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
