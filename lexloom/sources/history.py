"""Builds of a corpus as versions: each is written whole, then becomes visible by one commit; any earlier one can be read.

A build's rows lie in a folder of their own that nothing names until its commit file exists. That file is made by creating
it and failing if it is there, so of two writers of one version one fails, and a writer that dies leaves nothing visible.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import count_delta

COMMIT = "version long, folder string, live_entries long, reported long, at string"


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark.sparkContext._jvm.org.apache.hadoop.fs.Path


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """version, folder, live_entries, reported (the count in the build's own report, or null) and time of all builds."""
    fs, path = _files(spark, folder)
    if not fs.exists(path(f"{folder}/commits")):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(f"{folder}/commits")


def commit(build: DataFrame, folder: str, reported: int | None = None, at: str | None = None) -> int:
    """Writes a build as the next version and gives its number; raises if another writer took that number."""
    spark = build.sparkSession
    rows = f"{folder}/builds/{uuid.uuid4().hex}"
    build.write.parquet(rows)
    version = (commits(spark, folder).agg(F.max("version")).first()[0] or 0) + 1
    n = spark.read.parquet(rows).count()
    fs, path = _files(spark, folder)
    line = json.dumps({"version": version, "folder": rows, "live_entries": n, "reported": reported, "at": at or str(spark.sql("select current_timestamp()").first()[0])})
    out = fs.create(path(f"{folder}/commits/{version:08d}.json"), False)  # never over another one
    try:
        out.write(bytearray(line.encode()))
    finally:
        out.close()
    return version


def as_of(spark: SparkSession, folder: str, version: int | None = None, at: str | None = None) -> DataFrame:
    """The rows of the last build, or of the last one up to a version or a time."""
    known = commits(spark, folder)
    known = known.where(F.col("version") <= version) if version is not None else known
    known = known.where(F.col("at") <= at) if at is not None else known
    last = known.agg(F.max_by("folder", "version")).first()[0]
    if last is None:
        raise LookupError(f"no build in {folder} up to version {version} or time {at}")
    return spark.read.parquet(last)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """version, now, before, delta and verdict of each build's count against the one before it.

    Builds are few, one row each. A change stands if the build's report has the count that the build has.
    """
    every = commits(spark, folder).select("version", F.col("live_entries").alias("now"), "reported")
    before = every.select((F.col("version") + 1).alias("version"), F.col("now").alias("before"))
    both = every.join(before, "version", "left")
    return both.select("version", "now", "before", (F.col("now") - F.col("before")).alias("delta"), count_delta(F.col("now"), F.col("before"), F.col("reported")).alias("verdict"))
