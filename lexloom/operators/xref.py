"""Cross-references in bodies: extraction, resolution against headwords, rates and triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins as J
from .aggregate import rate

#: What a forward reference may begin with, and words that are no target (fixed values).
PREFIX = "See also|See|see|Vide|Same as"
STOP = (
    "A", "AN", "AS", "AT", "BE", "BY", "DO", "GO", "HE", "IF", "IN", "IS", "IT", "ME", "MY", "NO", "OF", "ON", "OR", "SO", "TO", "UP", "WE", "THE", "AND",
    "BUT", "FOR", "NOR", "NOT", "YET", "ALL", "ANY", "ARE", "HIS", "HER", "HAS", "HAD", "WAS", "DID", "CAN", "MAY", "ITS", "OUR", "OWN", "USE", "WAY", "OUT",
    "SUPRA", "INFRA", "ANTE", "POST", "ALSO", "THOSE", "TITLES", "THAT",
)
FORWARD = rf"\b({PREFIX})\s+([A-Z][A-Z '&.;,-]{{0,80}})"
BACK = r"((?:[A-Za-z'-]+\s+){0,3}[A-Za-z'-]+)\s*\(q\. v\.\)"
WHICH = r"((?:[A-Za-z'-]+\s+){0,4}[A-Za-z'-]+),\s*which see"
STRICT = r"\bSee ([A-Z][A-Z ]{2,})"


def _found(df: DataFrame, pattern: str, group: int, kind: str) -> DataFrame:
    return df.select("index", F.posexplode(F.regexp_extract_all("body", F.lit(pattern), F.lit(group))).alias("nth", "raw")).select("index", F.lit(kind).alias("kind"), "nth", "raw")


def forward(df: DataFrame) -> DataFrame:
    """Targets after See, Vide and the like, several parted by ';' (X1)."""
    each = _found(df, FORWARD, 2, "forward").select("index", "kind", "nth", F.posexplode(F.split("raw", ";")).alias("part", "raw"))
    cleaned = F.regexp_replace(F.regexp_replace("raw", r"^\s+", ""), r"[,;:.\s]+$", "")
    return each.select("index", "kind", (F.col("nth") * 100 + F.col("part")).alias("nth"), cleaned.alias("raw")).where("raw <> ''")


def back(df: DataFrame) -> DataFrame:
    """Phrases before (q. v.)."""
    return _found(df, BACK, 1, "qv")


def which_see(df: DataFrame) -> DataFrame:
    """Phrases before ', which see' (X3)."""
    return _found(df, WHICH, 1, "which_see")


def strict(df: DataFrame) -> DataFrame:
    """See and capitals, as the audit looks for them."""
    out = _found(df, STRICT, 1, "strict")
    return out.withColumn("raw", F.trim("raw"))


def _resolved(refs: DataFrame, heads: DataFrame, how) -> DataFrame:
    """Distinct phrases are resolved once, and the answers joined back to all references."""
    phrases = refs.select(F.col("raw").alias("ref_id"), "raw").distinct()
    found = how(phrases, heads)
    return refs.join(found, refs.raw == found.ref_id, "left").drop("ref_id")


def resolve_forward(refs: DataFrame, heads: DataFrame) -> DataFrame:
    """refs with target and the words left over; null without a target."""
    return _resolved(refs, heads, lambda p, h: J.longest_prefix(p, h, "raw", STOP))


def resolve_back(refs: DataFrame, heads: DataFrame) -> DataFrame:
    """refs with target."""
    return _resolved(refs, heads, lambda p, h: J.longest_phrase(p, h, "raw", STOP))


def rates(resolved: DataFrame) -> DataFrame:
    """References, those with a target, and their per cent by kind."""
    out = resolved.groupBy("kind").agg(F.count("*").alias("total"), F.count("target").alias("resolved"))
    return out.withColumn("rate", rate(F.col("resolved"), F.col("total")))


def unresolved(refs: DataFrame, heads: DataFrame) -> DataFrame:
    """Targets that are no headword, and how many references want them."""
    missing = refs.withColumn("term", F.upper("raw")).join(heads.select("term").distinct(), "term", "left_anti")
    return missing.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("index").alias("entries"))


def truncated(term: Column) -> Column:
    """Targets that were cut off: three letters or fewer, or a last word of one letter."""
    last = F.regexp_extract(term, r"(\S+)$", 1)
    return (F.length(term) <= 3) | ((F.length(last) == 1) & (last != "A"))


def triage(missing: DataFrame, heads: DataFrame, suppressed: DataFrame, most: int = 2, entries: DataFrame | None = None) -> DataFrame:
    """A reason for each missing target; the first that fits: garbled, truncated, suppressed, compact, subentry, fuzzy, absent.

    entries (index, term, body), where given: a target that stands anywhere in the body of another entry, in capitals, is its subentry.
    """
    compact = heads.select(F.regexp_replace("term", r"[\s-]", "").alias("ck"), "term").groupBy("ck").agg(F.min("term").alias("compact"))
    out = missing.withColumn("ck", F.regexp_replace("term", r"[\s-]", "")).join(compact, "ck", "left").drop("ck")
    out = out.join(suppressed.select("term").distinct().withColumn("hidden", F.lit(True)), "term", "left")
    near = J.nearest(missing.where("length(term) >= 8"), heads, "term", most)
    near = near.where((F.length("a") >= 12) | (F.col("distance") <= 1)).select(F.col("a").alias("term"), F.col("b").alias("near"))
    out = out.join(near, "term", "left")
    if entries is None:
        out = out.withColumn("inside", F.lit(None).cast("boolean"))
    else:
        # Owners by their hashes, whose least and greatest tell whether any differs from the term.
        found = J.places(missing.select(F.col("term").alias("pattern")), entries.select(F.xxhash64(F.upper("term")).alias("owner"), F.upper("body").alias("body")), "owner")
        own = F.xxhash64("pattern")
        found = found.where((F.col("least") != own) | (F.col("greatest") != own))
        out = out.join(found.select(F.col("pattern").alias("term"), F.lit(True).alias("inside")), "term", "left")
    reason = (
        F.when(F.col("term").rlike("[0-9]"), "ocr_garbled").when(truncated(F.col("term")), "truncated").when(F.col("hidden"), "suppressed")
        .when(F.col("compact").isNotNull(), "compact_match").when(F.col("inside"), "subentry").when(F.col("near").isNotNull(), "fuzzy").otherwise("absent")
    )
    return out.select("term", reason.alias("reason"), F.when(F.col("compact").isNotNull() | F.col("inside").isNull(), F.coalesce("compact", "near")).alias("suggestion"))


def see_target(body: Column) -> Column:
    """The target of a body that only refers (X6); null for others."""
    got = F.regexp_extract(body, r"^\s*[Ss]ee\s+([A-Z][A-Za-z '&-]{1,80}?)\s*[.,;]?\s*$", 1)
    return F.when(got != "", F.upper(got))


def correct(missing: DataFrame, heads: DataFrame, fixes: DataFrame, most: int = 2) -> DataFrame:
    """A headword for a garbled target (F12): from a table of fixes, else by R for B, else the nearest within ``most`` edits."""
    from ..functions.similarity import substitutions

    known = heads.select("term").distinct()
    a = missing.join(fixes.select("term", "fixed"), "term").join(known.withColumnRenamed("term", "fixed"), "fixed", "left_semi").groupBy("term").agg(F.min("fixed").alias("by_table"))
    made = missing.select("term", F.explode(substitutions("term", 2, (("B", "R"),))).alias("fixed"))
    b = made.join(known.withColumnRenamed("term", "fixed"), "fixed", "left_semi").groupBy("term").agg(F.min("fixed").alias("by_letter"))
    c = J.nearest(missing.where("length(term) >= 5"), known, "term", most).select(F.col("a").alias("term"), F.col("b").alias("by_distance"))
    out = missing.select("term").distinct().join(a, "term", "left").join(b, "term", "left").join(c, "term", "left")
    return out.select("term", F.coalesce("by_table", "by_letter", "by_distance").alias("fixed"))
