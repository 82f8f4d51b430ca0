"""Prefix scans over ordered rows: numbers, running sums and extremes, previous rows, without one task that sees all rows.

Rows are dealt to range partitions and sorted there, which is settled once in the shared folder. Each scan then takes two
passes: totals of each partition, a few rows, are carried over to the partitions after it, and frames inside a partition
start from what is carried. A group (``by``) may span any number of partitions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only a local session that names none gets one of its own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or f"file://{tempfile.gettempdir()}/lexloom-scan-{uuid.uuid4().hex}")
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df, its lineage cut by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def in_order(df: DataFrame, *order) -> DataFrame:
    """df with ``_i``, ascending in the order given, the partition in the bits from the 34th on.

    Equal rows of the order share a partition and stand in no fixed order; end the order with a column that tells rows apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_i", F.monotonically_increasing_id()))


def scanned(rows: DataFrame, by: list[str], before: bool = True, own: bool = False, **what: tuple[str, Column]) -> DataFrame:
    """rows of ``in_order`` with further columns over those before each (or after it), by group, with or without its own.

    what: name = (kind, column) with kind sum, max or min. Nulls count for nothing; with no row the sum is 0, others are null.
    The value of the row before is the max of a struct of ``_i`` and the value.
    """
    part = F.shiftright("_i", 33)
    order = F.col("_i") if before else F.col("_i").desc()
    frame = W.partitionBy("_p", *by).orderBy(order).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    fold = {"sum": F.sum, "max": F.max, "min": F.min}
    marked = rows.withColumn("_p", part)
    totals = marked.groupBy("_p", *by).agg(*(fold[kind](c).alias(f"_t{k}") for k, (kind, c) in enumerate(what.values())))
    # One row a partition and group: in a group as many as there are partitions at most.
    earlier = W.partitionBy(*by).orderBy("_p" if before else F.col("_p").desc()).rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(F.col("_p").alias("_q"), *(F.col(c).alias(f"_b{k}") for k, c in enumerate(by)), *(fold[kind](f"_t{k}").over(earlier).alias(f"_c{k}") for k, (kind, _) in enumerate(what.values())))
    local = marked.select("*", *(fold[kind](c).over(frame).alias(f"_l{k}") for k, (kind, c) in enumerate(what.values())))
    same = F.col("_p") == F.col("_q")
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_b{k}"))
    both = {"sum": lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)), "max": F.greatest, "min": F.least}
    out = {name: both[kind](F.col(f"_l{k}"), F.col(f"_c{k}")).alias(name) for k, (name, (kind, _)) in enumerate(what.items())}
    return local.join(carried, same).select(*rows.columns, *out.values())


def numbered(df: DataFrame, name: str, order: list, by: list[str] | None = None) -> DataFrame:
    """df with the row's number in order, from 1, in its group."""
    return scanned(in_order(df, *order), by or [], own=True, **{name: ("sum", F.lit(1).cast("long"))}).drop("_i")
