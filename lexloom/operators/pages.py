"""Page numbers of entries: ranges by letter, breaks in their order, inferred letters, recovery actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import index_quantiles, iqr_fences, jump_bucket
from .joins import closest
from .scan import in_order, scanned

BREAK, FAR = 12, 200


def letter_ranges(df: DataFrame, letter: str = "letter", page: str = "page") -> DataFrame:
    """min, p10, median, p90 and max page by letter, by index; below 3 rows the ends stand for the quantiles (A5)."""
    n = F.col("n")
    q = index_quantiles(df, letter, page, p10=F.floor(n * 0.1), median=F.floor(n / 2), p90=F.least(F.floor(n * 0.9), n - 1))
    few = n < 3
    return q.select(letter, "n", F.col("low").alias("min"), F.when(few, F.col("low")).otherwise(F.col("p10")).alias("p10"), "median", F.when(few, F.col("high")).otherwise(F.col("p90")).alias("p90"), F.col("high").alias("max"))


def breaks(df: DataFrame, letter: str, order: str, page: str, tie: str, most: int = BREAK) -> DataFrame:
    """Entries whose page lies more than ``most`` before the greatest so far, with the entry that last raised it.

    The running maximum is a prefix scan, so a letter is spread over as many tasks as its rows need.
    """
    rows = in_order(df.where(F.col(page).isNotNull()), letter, order, tie)
    out = scanned(rows, [letter], _top=("max", F.struct(F.col(page).alias("p"), (-F.col("_i")).alias("o"), F.col(order).alias("head"))))
    out = out.where(F.col(page) < F.col("_top.p") - most)
    return out.withColumn("running_max", F.col("_top.p")).withColumn("previous", F.col("_top.head")).withColumn("jump", F.col("_top.p") - F.col(page)).drop("_i", "_top")


def histogram(broken: DataFrame) -> DataFrame:
    """Breaks by size of the jump."""
    return broken.groupBy(jump_bucket(F.col("jump")).alias("bucket")).agg(F.count("*").alias("n"), F.avg("jump").alias("mean"))


def outliers(df: DataFrame, letter: str, page: str) -> DataFrame:
    """Entries outside their letter's fences, with severity by the distance from its median."""
    fences = iqr_fences(df, letter, page).drop("n").join(letter_ranges(df, letter, page).select(letter, "median"), letter)
    out = df.join(fences, letter).where((F.col(page) < F.col("lower")) | (F.col(page) > F.col("upper")))
    return out.withColumn("severity", F.when(F.abs(F.col(page) - F.col("median")) > FAR, "high").otherwise("medium"))


def infer_letter(df: DataFrame, ranges: DataFrame, key: str, page: str) -> DataFrame:
    """The letter whose range holds a page and whose median is nearest, else that of the nearest end.

    ranges has one row a letter (at most 27), so it meets the distinct pages only, not the rows.
    """
    distinct = df.select(page).where(F.col(page).isNotNull()).distinct()
    r = ranges.select("letter", "min", "max", "median")
    p = F.col(page)
    inside = p.between(F.col("min"), F.col("max"))
    gap = F.struct((~inside).cast("int").alias("out"), F.when(inside, F.abs(p - F.col("median"))).otherwise(F.least(F.abs(p - F.col("min")), F.abs(p - F.col("max")))).alias("gap"))
    best = closest(distinct.crossJoin(F.broadcast(r)), page, gap, "letter").select(page, F.col("letter").alias("inferred"))
    return df.join(best, page, "left")


def cause(share_large: Column, share_small: Column, n: Column) -> Column:
    """The main cause of breaks from their sizes."""
    return F.when(n == 0, "none").when(share_large > 0.5, "wrong_pages").when(share_small > 0.8, "page_unit_mix").otherwise("mixed")


def action(severity: Column, inferred: Column, letter: Column, has_source: Column) -> Column:
    """What to do with an entry out of range."""
    return F.when(inferred == letter, "keep").when(has_source, "repair_from_source").when(severity == "high", "review").otherwise("fill_from_neighbours")
