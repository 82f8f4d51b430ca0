"""The lexicon that the queries run on, derived from the harness tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import FOLD_FROM, FOLD_TO, fold

FOLDED = f"regexp_replace(translate(text, '{FOLD_FROM}', '{FOLD_TO}'), '[^\\x00-\\x7F]', '', 'g')"
#: Characters of a text that have its first two words, mostly.
BEGINNING = 200
SPACED = "regexp_replace(regexp_replace({}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
#: Entries: index, term (first two words in upper case, without end marks), body, page, lang, entry_type.
SQL = f"""
folded as (select doc_id as index, {FOLDED} as body, lang from documents),
lex as (
  select f.index, f.body, f.lang, 1 + f.index % 1238 as page,
    regexp_replace(upper({SPACED.format("regexp_extract(f.body, '^\\s*(\\S+(?:\\s+\\S+)?)', 1)")}), '[.,;:]+$', '') as term,
    case when l.toxic = 1 then 'fragment_artifact' when l.quality = 1 then 'verified_main' when l.quality = 0 then 'legacy_unresolved' else 'unmatched_keep' end as entry_type
  from folded f left join labels l on f.index = l.doc_id)
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lexicon(spark: SparkSession, sf: str, labelled: bool = True) -> DataFrame:
    """The lex table of SQL; not labelled, without entry_type, and a document is one row however many labels it has."""
    # The first two words are read off the beginning, if they end there: folding goes by characters.
    begin = lambda x: F.regexp_extract(x, r"^\s*(\S+(?:\s+\S+)?)", 1)
    some = fold(F.substring("text", 1, BEGINNING))
    first = F.when(some.rlike(r"^\s*\S+\s+\S+\s"), begin(some)).otherwise(begin(fold("text")))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("index"), fold("text").alias("body"), "lang", first.alias("first"))
    term = F.regexp_replace(F.upper(F.regexp_replace("first", r"\s+", " ")), "[.,;:]+$", "")
    columns = ["index", "body", "lang", (1 + F.col("index") % 1238).alias("page"), term.alias("term")]
    if not labelled:
        return docs.select(*columns)
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("index"), "quality", "toxic")
    kind = F.when(F.col("toxic") == 1, "fragment_artifact").when(F.col("quality") == 1, "verified_main").when(F.col("quality") == 0, "legacy_unresolved").otherwise("unmatched_keep")
    return docs.join(labels, "index", "left").select(*columns, kind.alias("entry_type"))
