"""A corpus pipeline of five stages over ``documents``: quality, near-dedup, repeated passages, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``docs``.
``run`` writes every stage's result to the shared folder and hands what it reads back to the next one. Null, empty
and repeated rows are treated as the operators state; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitecharge.llm import quality, suffixes
from sitecharge.llm.minhash import near_duplicates
from sitecharge.llm.mixing import mixed_documents, row_hash
from sitecharge.llm.sentencepiece_codec import transcoded, with_digests
from sitecharge.llm.shared import stored, table

TOKENIZER = "piece_bpe_32k.model"
#: Per cent of word shingles that near duplicates share at least; the 85 of op5 binds that query alone.
NEAR = 80
#: (bands, rows) for NEAR: a pair at exactly 0.80 shares no band with a chance of 7 in a million.
NEAR_BANDS = (30, 5)
#: Bytes of a string that counts as repeated: shorter than nearly all passages of over 50 words. The 400 of op7 binds that query alone.
REPEATED = 200


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, does not reject."""
    rows = quality.scored(docs, table(spark, sf_dir, "labels"), name="_score")
    return rows.where(F.col("_score") >= quality.THRESHOLD).select(*(f"`{c}`" for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates; one row per doc_id.

    Near are texts whose sets of word shingles have a similarity of 0.80 or more.
    Rows without doc_id belong to no group and stay.
    """
    bands, rows = NEAR_BANDS
    near = near_duplicates(docs, threshold=NEAR, bands=bands, rows=rows)
    kept = near.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept.hint("merge"), "doc_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    named = named.withColumn("_first", first).where("_first = 1").drop("_first")
    return named.select(*(f"`{c}`" for c in docs.columns)).unionByName(docs.where("doc_id IS NULL"))


def without_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of REPEATED bytes that occur elsewhere; characters stay whole."""
    spans, held = suffixes.repeated_bytes(docs, length=REPEATED)
    kept = suffixes.kept_bytes(spans, held, whole_characters=True).groupBy("text_id").agg(F.min("kept").alias("_kept"))
    found = spans.join(kept, "text_id", "left").select(F.col("text_id").alias("_id"), F.col("n_removed").alias("_removed"), "_kept")
    rows = docs.withColumn("_id", suffixes.text_id()).join(found, "_id", "left")
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.coalesce(F.col("_kept").cast("string"), F.lit("")))
    rows = rows.withColumn("_text", text)
    n_chars = F.when(F.col("_removed").isNull(), F.col("n_chars")).otherwise(F.char_length("_text").cast(docs.schema["n_chars"].dataType))
    changed = {"text": F.col("_text"), "n_chars": n_chars}
    return rows.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix starts them: once for every slot that takes their first word."""
    placed, mix = mixed_documents(docs)
    starts = mix.where("first = 0").groupBy("row").agg(F.count("*").alias("_times"))
    nth = F.row_number().over(Window.partitionBy("h", "doc_id").orderBy("row")).alias("_nth")
    wanted = placed.select("row", "doc_id", "h", nth).join(starts, "row").select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), "_nth", "_times")
    hashed = docs.withColumn("_h", row_hash())
    numbered = hashed.withColumn("_nth", F.row_number().over(Window.partitionBy("_h", "doc_id").orderBy("_h")))
    rows = numbered.join(wanted.hint("merge"), ["_h", "_nth"]).where(F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return rows.select(*(f"`{c}`" for c in docs.columns))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return with_digests(transcoded(docs, public_tokenizers.path(TOKENIZER))).drop("decoded")


STAGES = [
    ("quality", good_quality),
    ("minhash", one_of_each_group),
    ("suffix_arrays", without_repeated_bytes),
    ("mixing", mixed),
    ("sentencepiece", tokenised),
]

#: Sketches, a trained network and suffix arrays are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
