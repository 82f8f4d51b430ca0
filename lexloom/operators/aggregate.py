"""Counts, duplicates, frequencies, index quantiles, set comparison and ordered picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scan import numbered


def counts(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows by key with the first position of each, by which equal counts are ordered (A1)."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first")


def duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key came before, with the position that had it last (A2)."""
    w = W.partitionBy(key).orderBy(order)
    return df.withColumn("previous", F.lag(order).over(w)).where("previous is not null")


def word_frequency(df: DataFrame, body: str) -> DataFrame:
    """Upper-case words and how often they occur (A3)."""
    return df.select(F.explode(F.regexp_extract_all(F.upper(body), F.lit("[A-Z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def phrase_count(df: DataFrame, body: str, phrase: str) -> DataFrame:
    """Occurrences of a phrase with no letter beside it (A4)."""
    return df.agg(F.coalesce(F.sum(F.regexp_count(F.upper(body), F.lit(rf"(?<![A-Z])\Q{phrase}\E(?![A-Z])"))), F.lit(0)).cast("long").alias("n"))


def ranked_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each key with their number, so that index quantiles need no list of a whole group.

    Columns: key, value, upto (rows of the key with this value or less), n (rows of the key). The window sees one row
    for each distinct value of a key.
    """
    each = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("c"))
    w = W.partitionBy(key).orderBy(value)
    return each.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(W.partitionBy(key)))


def index_quantiles(df: DataFrame, key: str, value: str, **at: Column) -> DataFrame:
    """For each key the values at given 0-based places of its sorted rows (A5, A6); places may use the column n."""
    r = ranked_values(df, key, value)
    picks = [F.min(F.when(F.col("upto") > place, F.col(value))).alias(name) for name, place in at.items()]
    return r.groupBy(key).agg(F.max("n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), *picks)


def iqr_fences(df: DataFrame, key: str, value: str, least: int = 30) -> DataFrame:
    """Lower and upper fence of each key: quartiles by index, twice their distance or at least ``least``; fewer than 4 rows: the ends."""
    n = F.col("n")
    q = index_quantiles(df, key, value, q1=F.floor(n / 4), q3=F.floor(3 * n / 4))
    width = F.greatest(2 * (F.col("q3") - F.col("q1")), F.lit(least))
    return q.select(key, "n", F.when(n < 4, F.col("low")).otherwise(F.col("q1") - width).alias("lower"), F.when(n < 4, F.col("high")).otherwise(F.col("q3") + width).alias("upper"))


def jump_bucket(jump: Column) -> Column:
    """Histogram bucket of a jump."""
    return F.when(jump <= 5, "1-5").when(jump <= 10, "6-10").when(jump <= 20, "11-20").when(jump <= 50, "21-50").when(jump <= 100, "51-100").otherwise("100+")


def rate(part: Column, whole: Column) -> Column:
    """Per cent with one decimal as text; of nothing 0.0%."""
    return F.format_string("%.1f%%", 100.0 * part / F.greatest(whole, F.lit(1)))


def letter_rollup(df: DataFrame, key: str, **measures: Column) -> DataFrame:
    """Sums by key and a row ALL (A10)."""
    out = df.rollup(key).agg(F.grouping(key).alias("_g"), *(m.alias(k) for k, m in measures.items()))
    return out.withColumn(key, F.when(F.col("_g") == 1, "ALL").otherwise(F.col(key))).drop("_g")


def ids_of(df: DataFrame, key: str, value: str) -> DataFrame:
    """key -> ascending values."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("ids"))


def examples(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first k rows of each class with the size of the class (A14). A rank limit is cut before the shuffle."""
    w = W.partitionBy(key).orderBy(order)
    sizes = df.groupBy(key).agg(F.count("*").alias("class_size"))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).join(sizes, key)


def last_number(df: DataFrame, id_column: str) -> DataFrame:
    """The greatest number that an id ends in."""
    return df.agg(F.max(F.regexp_extract(id_column, r"(\d+)$", 1).try_cast("long")).alias("last"))


def set_compare(a: DataFrame, b: DataFrame, key: str, least: int = 2) -> DataFrame:
    """Sizes of both sets of keys, of what they share and of both differences, with per cents (SET1)."""
    x = a.select(key).where(F.length(key) >= least).select(key, F.lit(1).alias("a"), F.lit(0).alias("b"))
    y = b.select(key).where(F.length(key) >= least).select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    each = x.unionByName(y).groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    n = each.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("in_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("in_b"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("shared"))
    return n.select("in_a", "in_b", "shared", (F.col("in_a") - F.col("shared")).alias("only_a"), (F.col("in_b") - F.col("shared")).alias("only_b"), rate(F.col("shared"), F.col("in_a")).alias("share_of_a"))


def without(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of a whose key b lacks (SET2)."""
    return a.join(b.select(key).distinct(), key, "left_anti")


def append_new(old: DataFrame, new: DataFrame, key: str, order: str, prefix: str = "BLD2-") -> DataFrame:
    """old and those rows of new whose key it lacks, numbered on from the last id in order, then by key (SET3)."""
    fresh = numbered(without(new, old, key), "_n", [order, key]).crossJoin(F.broadcast(last_number(old, "id")))  # one row
    fresh = fresh.withColumn("id", F.format_string(prefix + "%05d", F.coalesce("last", F.lit(-1)) + F.col("_n"))).drop("_n", "last")
    return old.unionByName(fresh, allowMissingColumns=True)


def longest(df: DataFrame, key: str, body: str, order: str) -> DataFrame:
    """The longest body of each key, the first of equals."""
    best = df.groupBy(key).agg(F.max(F.struct(F.length(body).alias("l"), (-F.col(order)).alias("o"), F.col(body).alias("b"))).alias("m"))
    return best.select(key, (-F.col("m.o")).alias(order), F.col("m.b").alias(body))


def build_delta(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Counts of this build, the last one, and the difference by key."""
    a, b = now.groupBy(key).agg(F.count("*").alias("now")), before.groupBy(key).agg(F.count("*").alias("before"))
    out = a.join(b, key, "full").select(key, F.coalesce("now", F.lit(0)).alias("now"), F.coalesce("before", F.lit(0)).alias("before"))
    return out.withColumn("delta", F.col("now") - F.col("before"))


def ranks(df: DataFrame, value: str, tie: str) -> DataFrame:
    """df with rank: 1 for the greatest value, ties in order of ``tie``.

    Only the distinct values go through one ordered window; rows are numbered among those of their own value.
    """
    by = df.groupBy(value).agg(F.count("*").alias("_n"))
    above = F.coalesce(F.sum("_n").over(W.orderBy(F.col(value).desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = by.select(F.col(value).alias("_v"), above.alias("_above"))
    own = df.withColumn("_own", F.row_number().over(W.partitionBy(value).orderBy(tie)))
    return own.join(ahead, F.col(value).eqNullSafe(F.col("_v"))).withColumn("rank", F.col("_above") + F.col("_own")).drop("_v", "_above", "_own")
