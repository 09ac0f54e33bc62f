"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecharge.llm import word_bpe
from sitecharge.llm.cap_filters import near_vectors
from sitecharge.llm.hilbert import LAW, sharded
from sitecharge.llm.importance import ORACLE as IMPORTANCE_SQL
from sitecharge.llm.importance import resampled
from sitecharge.llm.licenses import license_findings
from sitecharge.llm.minhash import near_duplicates
from sitecharge.llm.mixing import taken
from sitecharge.llm.order_minhash import compared_with_edits
from sitecharge.llm.quality import judged
from sitecharge.llm.sentencepiece_codec import transcoded, with_digests
from sitecharge.llm.shared import table
from sitecharge.llm.spelling import ORACLE as SPELLING_SQL
from sitecharge.llm.spelling import spelling_variants
from sitecharge.llm.suffixes import removals
from sitecharge.llm.unit_dedup import ORACLE as UNITS_SQL
from sitecharge.llm.unit_dedup import unit_report


TOKENIZER = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_digests(transcoded(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharded(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform("spans", lambda s: F.concat_ws("-", s["first"], s["last"]))
    return unit_report(table(spark, sf_dir, "documents")).withColumn("spans", F.array_join(shown, ","))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removals(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents")).drop("source")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_findings(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_edits(table(spark, sf_dir, "documents"))


def op11_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_bpe.transcoded(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return word_bpe.with_digests(found).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_quality": op2_quality,
        "op3_cap_filters": op3_cap_filters,
        "op4_hilbert": op4_hilbert,
        "op5_minhash": op5_minhash,
        "op6_units": op6_units,
        "op7_suffix_arrays": op7_suffix_arrays,
        "op8_mixing": op8_mixing,
        "op9_licenses": op9_licenses,
        "op10_order_minhash": op10_order_minhash,
        "op11_word_table": op11_word_table,
        "op12_importance": op12_importance,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_units": UNITS_SQL, "op12_importance": IMPORTANCE_SQL, "op13_spelling": SPELLING_SQL}
