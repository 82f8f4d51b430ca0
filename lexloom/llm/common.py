"""What the operators of this subpackage share: tables, shared folders, held-out folds."""

from __future__ import annotations

import tempfile
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word, wherever a contract speaks of words: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bounds of the samples that classifiers are fitted to: bytes of all texts, and of one text.
SAMPLE_BYTES, SAMPLE_LONGEST = 64 << 20, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; Parquet reads no others."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it, resolved by Spark's file systems.

    A local session that names none (a test on one machine) gets one under its own temporary folder; on a cluster an
    executor's own disk would lose data, so there it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.gettempdir()}/lexloom-shared-{uuid.uuid4().hex}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    path = sc._jvm.org.apache.hadoop.fs.Path(named)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that ``shared_dir`` holds, when nothing reads it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as decimal text, modulo ``parts``; null ids have no fold."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)).cast("int")


def fold_of(ids: pd.Series, parts: int) -> np.ndarray:
    """``fold`` in Python; -1 for null ids."""
    return np.array([zlib.crc32(str(int(i)).encode()) % parts if pd.notna(i) else -1 for i in ids])


def bounded_sample(rows: DataFrame, bound: int, most_bytes: int = SAMPLE_BYTES, longest: int = SAMPLE_LONGEST) -> DataFrame:
    """Of rows (doc_id, text, others) at most ``bound`` with at most ``most_bytes`` of text together, the same in every run.

    For fitting classifiers only: those with the smallest hashes of doc_id and text. Rows that are equal in both come
    once, whatever their number, with one of their other values (the greatest); texts of more than ``longest`` bytes are
    not fitted to. What is chosen is known by its hashes first (8 bytes for each of ``bound`` rows, hence the broadcast).
    """
    others = [c for c in rows.columns if c not in ("doc_id", "text")]
    marked = rows.withColumn("tie", F.xxhash64("doc_id", "text"))
    keys = marked.select("tie", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).where(F.col("size") <= longest).distinct().orderBy("tie").limit(bound)
    upto = F.sum("size").over(W.orderBy("tie").rowsBetween(W.unboundedPreceding, 0))  # over ``bound`` rows
    chosen = keys.withColumn("upto", upto).where(F.col("upto") <= most_bytes).select("tie")
    return marked.join(F.broadcast(chosen), "tie").groupBy("tie").agg(F.max("doc_id").alias("doc_id"), F.max("text").alias("text"), *(F.max(c).alias(c) for c in others)).drop("tie")


def first_ids(df: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows of df, whose doc_ids are distinct: those with the smallest hashes. Small enough to be broadcast."""
    return df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
