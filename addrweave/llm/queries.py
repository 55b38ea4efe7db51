"""One registered query per operator: each applies it with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrweave.llm import oracle
from addrweave.llm.bpe import bpe_encode
from addrweave.llm.covertree import near_vectors
from addrweave.llm.langid import identify
from addrweave.llm.lm import lm_scores
from addrweave.llm.mixing import mix_plan
from addrweave.llm.periodic import collapse_runs
from addrweave.llm.quality import quality_rules
from addrweave.llm.ranked import search
from addrweave.llm.setsketch import near_duplicates
from addrweave.llm.suffix import remove_shared
from addrweave.llm.token_file import read_token_files, write_token_files
from addrweave.llm.urls import judge_urls
from addrweave.llm.warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's definition, installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bpe_encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("word_bpe_49k.json"))
    return d.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
    )


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules(_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = remove_shared(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth text (by the CRC of its id) ends in a repeated block, planted as the query is defined."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    d = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    d = d.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    planted = "transform(sequence(0, n - 1), i -> words[CAST(if(i < a, i, a + (i - a) % p) AS INT)])"
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.expr(planted), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = collapse_runs(with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    greatest = F.expr(
        "reduce(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), "
        "(best, r) -> CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)"
    )
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return d.withColumn("best", greatest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(_table(spark, sf_dir, "pages"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_minhash": op2_minhash,
    "op3_bpe": op3_bpe,
    "op4_mixing": op4_mixing,
    "op5_lm_scores": op5_lm_scores,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_suffix_array": op10_suffix_array,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_vectors": oracle.near_vectors(),
    "op2_minhash": oracle.near_documents(),
    "op4_mixing": oracle.mixing(),
    "op6_url_filters": oracle.url_filters(),
    "op7_quality_rules": oracle.quality(),
    "op10_suffix_array": oracle.shared_passages(),
    "op11_periodic_runs": oracle.periodic_runs(),
    "op12_ranked_search": oracle.ranked_search(),
    "op13_warc": oracle.warc(),
}
