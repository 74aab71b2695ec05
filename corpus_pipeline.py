"""A training-data pipeline over ``documents``: toxic documents go, documents of low quality go, one document of each group of
near copies stays, the sources are mixed to target weights, and the result is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents for the next one, which are written as Parquet and read again.
The mixing stage reads documents as often as the target weights ask for, so the sources' shares of its output are those weights, and
packing, which takes the shares of what it is given, fills every sequence to them.

The stages' decisions have no SQL form (a learned classifier, a learned decision list, tokenized pieces), so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard_join, mixing, packing, quality, toxicity
from tidemark.llm.common import discard, materialise, table
from tidemark.llm.queries import BYTE_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, target_entropy=0.9, most_repeats=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE, end_id=0, seq_len=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialise(docs, "pipeline-" + name.replace(" ", "-"))
            discard(before)
    return docs
