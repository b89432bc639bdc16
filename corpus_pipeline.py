"""Cleaning of a corpus in five stages, each working on all that the one before kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfeat.llm.blocks import quoted
from tabfeat.llm.bpe import encode_documents
from tabfeat.llm.decontamination import find_benchmark_windows
from tabfeat.llm.language_id import keep_identified
from tabfeat.llm.minhash import near_duplicates
from tabfeat.llm.suffix_array import remove_repeated_strings
from tabfeat.session import scratch_path, small_side

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: a null text, or one without letters. Rows are kept whole."""
    return keep_identified(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates (five words, similarity 0.8) the smallest doc_id stays.

    Documents without words or doc_id stay; rows with the doc_id that stays all stay.
    """
    found = near_duplicates(docs, size=5, percent=80)
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.alias("docs").join(small_side(gone).alias("gone"), F.col("docs.doc_id") == F.col("gone.doc_id"), "left_anti")


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document has are cut out; n_chars follows.

    A document of which nothing but white space is left goes, unless it was empty before.
    """
    cut = remove_repeated_strings(docs, keep_text=True, carry=tuple(docs.columns))
    text = F.col("kept_text")
    changed = {"text": F.when(F.col("n_removed") > 0, text).otherwise(F.col("carry.text")),
               "n_chars": F.when(F.col("n_removed") > 0, F.char_length(text)).otherwise(F.col("carry.n_chars"))}
    kinds = {field.name: field.dataType for field in docs.schema}
    return (cut.where("n_removed = 0 OR trim(kept_text) <> ''")
            .select(*[changed.get(c, F.col("carry." + quoted(c))).cast(kinds[c]).alias(c) for c in docs.columns]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    known = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    gone = (find_benchmark_windows(known, benchmark, keep=("text_hash",)).where("contaminated")
            .select("doc_id", "text_hash").distinct())
    same = F.col("docs.doc_id").eqNullSafe(F.col("gone.doc_id")) & (F.xxhash64("docs.text") == F.col("gone.text_hash"))
    return docs.alias("docs").join(small_side(gone).alias("gone"), same, "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit numbers) of every document, and the digests of ids and decoded text."""
    return encode_documents(docs, TOKENIZER, keep_ids=True, keep=("doc_id", "lang", "source")).drop("decoded")


STAGES = [("language_id", language), ("minhash_near_dedup", near_duplicate), ("suffix_array_dedup", repeated_strings),
          ("decontamination", decontaminated), ("bpe", tokens)]

#: SQL can express neither the network, nor the sorted removal over long texts, nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
