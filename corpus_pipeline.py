"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept and returns a DataFrame; ``run`` writes each stage as Parquet under
the shared folder and reads it again as the next one's docs.  All stages but the
last return the columns of documents, and extra columns travel along.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bpe, minhash, mixing, quality, toxicity
from strata.llm.common import ROW, cut, pack, read, unpack
from strata.llm.queries import public_vocabulary, toxicity_grammar

ORACLE_SQL = None  # numpy models and hashes; the stages are tested against brute-force versions


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers go."""
    return unpack(quality.judge_rows(spark, docs).filter("__quality.kept"))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted label of 1 go; the model learns from labelled documents that are not held out."""
    grammar = toxicity_grammar(spark, docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score(pack(docs), grammar, keys=(ROW,), within=ROW)
    return unpack(scored.filter("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, one with the smallest id."""
    return minhash.representatives(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in shuffled shards."""
    return mixing.mix(spark, docs).select(*[f"`{c}`" for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of every text."""
    path, pattern = public_vocabulary()
    return bpe.encode(docs, path, pattern)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("near-duplicates", near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
