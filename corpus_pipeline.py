"""From raw documents to token ids: each stage calls one operator of lexloom.llm and works on all that is left.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the docs of the next. All but the last return the columns of documents (COLUMNS);
further columns that a table may have are left out from the first stage on. A stage's output is deleted once the next
one is written, the last one's stays.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from lexloom.llm import bpe, mixing, near_copies, quality, toxicity
from lexloom.llm.common import remove, shared_dir, table
from pyspark.sql import DataFrame, SparkSession

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or of sentences does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees."""
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs.select(*COLUMNS), model).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: SimHash links and five-word Jaccard of 0.8 or more."""
    return near_copies.keep_first(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights, in its order; a document comes once for each pass that takes words of it."""
    mixed = mixing.mixed_documents(docs.select(*COLUMNS))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "mix_shard", "mix_position", "doc_id").sortWithinPartitions("mix_shard", "mix_position", "doc_id").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the hashes of ids and of what they decode to.

    The executors' heaps have grown in the stages before, so the workers remember less than they do by default.
    """
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, states=40_000, pieces=240_000)


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality), ("near_copies", drop_near_copies), ("mixing", mix_sources), ("tokens", tokenize)]

#: The fitted models and the pseudorandom permutations have no SQL form; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
