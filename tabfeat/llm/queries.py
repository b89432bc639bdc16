"""The training-text operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabfeat.llm.bpe import encode_documents
from tabfeat.llm import chat, hard_negatives, lexical
from tabfeat.llm.chat import format_conversations
from tabfeat.llm.decontamination import find_benchmark_windows
from tabfeat.llm.language_id import identify_language
from tabfeat.llm.maxent import score_texts
from tabfeat.llm.minhash import near_duplicates
from tabfeat.llm.near_prints import near_prints
from tabfeat.llm.quality import score_quality
from tabfeat.llm.simhash import document_links, edited_neighbours
from tabfeat.llm.substring import remove_repeated_windows
from tabfeat.llm.suffix_array import remove_repeated_strings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op7_substring_dedup(spark, folder):
    return remove_repeated_windows(_documents(spark, folder))


@_query
def op8_suffix_array_dedup(spark, folder):
    return remove_repeated_strings(_documents(spark, folder))


@_query
def op10_decontaminate(spark, folder):
    return find_benchmark_windows(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@_query
def op5_minhash_near_dedup(spark, folder):
    return near_duplicates(_documents(spark, folder), size=4)


@_query
def op6_bpe(spark, folder):
    return encode_documents(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op2_chat_format(spark, folder):
    return format_conversations(spark.read.parquet(f"{folder}/conversations.parquet"))


ORACLES["op2_chat_format"] = chat.ORACLE


@_query
def op4_simhash(spark, folder):
    return edited_neighbours(_documents(spark, folder))


@_query
def simhash_links(spark, folder):
    """The links that op4's ``n_near`` counts."""
    return document_links(_documents(spark, folder))


@_query
def op1_language_id(spark, folder):
    return identify_language(_documents(spark, folder))


@_query
def op9_quality(spark, folder):
    return score_quality(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@_query
def op3_maxent_lm(spark, folder):
    return score_texts(_documents(spark, folder))


@_query
def op13_simhash_near_dedup(spark, folder):
    return near_prints(_documents(spark, folder))


@_query
def op11_hard_negatives(spark, folder):
    return hard_negatives.mine_hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


ORACLES["op11_hard_negatives"] = hard_negatives.ORACLE


@_query
def op12_lexical_search(spark, folder):
    return lexical.search_items(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


ORACLES["op12_lexical_search"] = lexical.ORACLE
