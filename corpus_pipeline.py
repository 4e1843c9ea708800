"""A corpus pipeline: toxic documents go, near-duplicates go, repeated passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift.llm import near_dedup, packing, substring_dedup, toxicity
from roadsift.llm.common import cut, forget, read_table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: SQL can't express the score, the links or the tokens; the tests hold run() against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; the model learns from the labels of sf_dir."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity 0.8 on five-word shingles, the one with the smallest id stays."""
    return near_dedup.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 35 words and more that stand elsewhere too go; the document stays, and n_chars follows its text."""
    out, told = substring_dedup.remove_repeats(docs), substring_dedup.result_name(docs)
    columns = [F.col(told)["text"].alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = out.select(*columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, one piece each."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each result written as Parquet to the shared folder and read again; what a later stage has read is deleted."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
