"""Audits of a corpus: each check gives rows (check, level, key, message); classifiers of single rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbled
from ..functions.normalize import LAST_PAGE, space
from ..functions.similarity import ratio
from . import joins as J
from . import xref
from .scan import settled

#: Patterns and entry types (fixed values).
ABBREVIATION = r"^(?:[A-Z]\.){1,6}(?:\s*[&]\s*(?:[A-Z]\.){1,4})?$|^[A-Z]\.\s*[A-Z]\.$|^[A-Z]\.[A-Z&]\.|^[A-Z]\.[&)(\]]|^[A-Z]\.[A-Z]$"
LIVE_TYPES = ("verified_main", "provisional_main", "recovered_main", "low_confidence_main", "alias_variant", "reversed_polarity", "unmatched_keep", "subentry", "headword_corrected")
EXCLUDED_TYPES = ("alias_phantom", "legacy_duplicate", "fragment_artifact", "junk_headword", "appendix_abbrev", "legacy_unresolved", "cross_reference")


def labels(**when: Column) -> Column:
    """The names of the conditions that hold, ascending."""
    return F.array_sort(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in when.items()))))


def suspicious_headword(term: Column) -> Column:
    """Reasons to doubt a headword (V8)."""
    dotted = F.contains(term, F.lit(".")) & ~term.rlike(r"^[A-Z]{1,4}\.\s*$|^[A-Z]\.[A-Z]") & ~term.rlike(r"^[A-Z]\.\s*[A-Z]\.")
    return labels(
        single_letter=(F.length(term) == 1) & (term != "A"), too_short=(F.length(term) < 2) & (term != "A"), embedded_punctuation=term.rlike(r"[();]"),
        suspicious_period=dotted, citation_fragment=term.rlike(r"^\d+\s+([A-Z]|[A-Za-z]+\.)\s"),
    )


def boundary(term: Column, body: Column) -> Column:
    """Capitals at the beginning of a body that are not its headword (V9); null if all is well."""
    caps = F.regexp_extract(body, "^([A-Z]{3,})", 1)
    skip = body.rlike(r"(?i)^(In |Lat\.|adj\.|v\.|n\.|Fr\.|Sp\.|Sax\.|Eng\.)")
    return F.when(~skip & (caps != "") & (caps != term) & ~F.startswith(term, caps), caps)


def near_empty(body: Column, least: int = 20) -> Column:
    """V10."""
    return F.length(F.trim(F.coalesce(body, F.lit("")))) < least


def reflow_pairs(body: Column) -> Column:
    """Number of line ends inside a paragraph that should have been joined."""
    return F.regexp_count(body, F.lit(r"[A-Za-z]\n(?=[a-z])"))


def ocr_artifacts(body: Column) -> Column:
    """Digits inside words but for ordinals, and @ signs."""
    digits = F.regexp_extract_all(body, F.lit(r"(?<![0-9§–,./#:-])(\d[a-z]{1,3})(?=[\s,;.)])"), F.lit(1))
    odd = F.filter(digits, lambda d: ~d.rlike(r"^\d+(st|nd|rd|th|d|s)$"))
    return F.concat(odd, F.when(F.contains(body, F.lit("@")), F.array(F.lit("@"))).otherwise(F.array().cast("array<string>")))


def page_problem(pages: Column) -> Column:
    """What is wrong with a list of page strings (V14); null if nothing is."""
    number = F.transform(pages, lambda p: p.try_cast("int"))
    return (
        F.when(pages.isNull(), "missing").when(F.size(pages) == 0, "empty").when(F.exists(number, lambda p: p.isNull()), "non_numeric")
        .when(F.exists(number, lambda p: (p < 1) | (p > LAST_PAGE)), "out_of_range")
    )


def near_duplicates(entries: DataFrame, least: float = 0.95) -> DataFrame:
    """Pairs a < b of distinct headwords of one first letter with ratio >= least, of any length."""
    # Settled once, in many parts: all that strings meet by is made of the distinct heads, not of the entries.
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = settled(entries.select("term").where("length(term) > 0").distinct().repartition(parts, "term"))
    pairs = J.alike(heads.select(F.col("term").alias("a")), heads.select(F.col("term").alias("b")), least)
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.substring("a", 1, 1) == F.substring("b", 1, 1)))
    return pairs.select("a", "b", ratio()("a", "b").alias("ratio")).where(F.col("ratio") >= least)


def duplicate_terms(entries: DataFrame) -> DataFrame:
    return _rows(entries.groupBy("term").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_term", "error", F.col("term"), F.concat(F.col("n").cast("string"), F.lit(" entries")))


def _rows(df: DataFrame, check: str, level: str, key: Column, message: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(level).alias("level"), key.alias("key"), message.alias("message"))


def validate(entries: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """All checks over entries (term, body, source_pages) as one table (V18): errors fail a build, warnings are counted."""
    term, body, pages = F.col("term"), F.col("body"), F.col("source_pages")
    out = [
        _rows(entries.where(term.isNull() | body.isNull() | pages.isNull()), "missing_field", "error", term, F.lit("null field")),
        duplicate_terms(entries),
        _rows(entries.where((F.trim(body) == "") | body.rlike(r"^[\s\p{Punct}]+$")), "empty_body", "error", term, F.lit("no text")),
        _rows(entries.where(boundary(term, body).isNotNull()), "boundary", "warning", term, boundary(term, body)),
        _rows(entries.where(F.size(ocr_artifacts(body)) > 0), "ocr_artifact", "warning", term, F.array_join(ocr_artifacts(body), " ")),
        _rows(entries.where(page_problem(pages).isNotNull()), "pages", "warning", term, page_problem(pages)),
        _rows(entries.where(reflow_pairs(body) > 0), "reflow", "warning", term, reflow_pairs(body).cast("string")),
        _rows(entries.where(garbled(body)), "garbled_start", "warning", term, F.substring(body, 1, 20)),
        _rows(entries.where(F.size(suspicious_headword(term)) > 0), "headword", "warning", term, F.array_join(suspicious_headword(term), ",")),
        _rows(xref.unresolved(xref.strict(entries.withColumn("index", F.monotonically_increasing_id())), entries), "xref", "warning", term, F.col("n").cast("string")),
    ]
    if manifest is not None:
        from ..sources.io import manifest as count

        both = count(entries).select("letter", F.col("count").alias("have")).join(manifest.select("letter", "count"), "letter", "full")
        out.append(_rows(both.where(~F.col("have").eqNullSafe(F.col("count"))), "manifest", "error", F.col("letter"), F.concat_ws("/", F.col("have").cast("string"), F.col("count").cast("string"))))
    return reduce(DataFrame.unionByName, out)


def accounting(overlay: DataFrame, live: DataFrame) -> DataFrame:
    """Overlay entries that should be live and are not, and live ones the overlay lacks or leaves out (V5)."""
    wanted = overlay.where(F.col("entry_type").isin(*LIVE_TYPES)).select("term").distinct()
    a = wanted.join(live.select("term").distinct(), "term", "left_anti").select("term", F.lit("missing_from_live").alias("problem"))
    known = overlay.where(~F.col("entry_type").isin(*EXCLUDED_TYPES) | (F.col("entry_type") == "legacy_unresolved")).select("term").distinct()
    b = live.select("term").distinct().join(known, "term", "left_anti").select("term", F.lit("not_in_overlay").alias("problem"))
    return a.unionByName(b)


def count_delta(now: Column, before: Column, reported: Column) -> Column:
    """Whether a change of the count stands without a reason: it is explained if the build's report has the new count."""
    explained = F.coalesce(reported == now, F.lit(False))
    return F.when(before.isNull(), "first_build").when(now == before, "same").when(explained, "explained").otherwise("unexplained")


def probes(wanted: DataFrame, live: DataFrame, overlay: DataFrame) -> DataFrame:
    """wanted (term, expectation: live or suppressed) with status live, suppressed or absent, and whether it is as expected."""
    a = live.groupBy("term").agg(F.lit(True).alias("is_live"))
    b = J.first_wins(overlay.select("term", "index", "entry_type"), "term", "index").select("term", "entry_type")
    out = wanted.join(a, "term", "left").join(b, "term", "left")
    status = F.when(F.col("is_live"), "live").when(F.col("entry_type").isNotNull(), "suppressed").otherwise("absent")
    return out.select("term", "expectation", status.alias("status")).withColumn("as_expected", F.col("status") == F.col("expectation"))


def abbreviation(term: Column) -> Column:
    """K2."""
    return term.rlike(ABBREVIATION)


def junk(term: Column) -> Column:
    """Digits, short Roman numbers or less than two characters (K2)."""
    t = F.regexp_replace(term, "[.,;:]+$", "")
    return t.rlike(r"^\d+$") | t.rlike("^[IVXLCDM]{1,6}$") | (F.length(t) < 2)


def fragment(term: Column) -> Column:
    """Up to four capitals, or up to five letters that begin with no vowel (K2)."""
    return term.rlike("^[A-Z]{1,4}$") | (term.rlike("^[A-Za-z]{1,5}$") & ~term.rlike("^[AEIOUaeiou]"))


def build_flags(term: Column, body: Column, source: Column, score: Column) -> Column:
    """The flags of a rebuilt entry, ascending (K1)."""
    after = F.regexp_replace(body, r"^[^\n]*\n?", "")
    return labels(
        empty_body=F.trim(body) == "", page_number_artifact=body.rlike(r"(?m)^\d{1,4}$"), short_header_artifact=after.rlike("(?m)^[A-Z]{1,4}$"),
        missing_source_candidate=source.isNull(), headword_mismatch=source.isNotNull() & (source != term),
        embedded_caps_subentry=body.rlike(r"(?m)^[A-Z][A-Z0-9 '&().,-]{4,}\.(?:\s|$)"), short_body=F.length(body) < 40, low_match_score=score <= 0,
    )


def unverified(body: Column) -> Column:
    """K17."""
    return F.when(F.length(body) < 50, "fragment").when(F.length(body) < 100, "short").otherwise("normal")


def court_cites(body: Column) -> Column:
    """Number of 'Name v. Name' with two letters in a row before it in its line, told without going back over the text.

    The reference's pattern takes 'A v. B v. C' of bare names for one; here they are two.
    """
    parts = F.split(body, r"(?i)\s+v\.\s+(?=[a-z])")
    named = lambda p: F.substring_index(p, "\n", -1).rlike("(?i)[a-z]{2}")
    before = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p, i: named(F.when(i == 0, p).otherwise(F.substring(p, F.lit(2), F.length(p)))))
    return F.when(F.size(parts) < 2, 0).otherwise(F.size(F.filter(before, lambda x: x)))


def phantom(body: Column) -> Column:
    """Bodies that only refer or only cite (K18); null for others. A short reference is never taken for a citation."""
    refers = (F.length(body) < 80) & body.rlike(r"^(See|Cf\.) ")
    only = F.trim(F.regexp_replace(body, r"(?i)^(See|Cf\.)\s+[A-Z\s,]+[.;]\s*", "")) == ""
    defined = body.rlike(r"(?i)\b(is|means|denotes|signifies|a\s+.*?\s+who)\b")
    cites = court_cites(body)
    return F.when(refers, F.when(only, "short_see")).when((cites > 0) & ~defined & ((F.length(body) < 400) | (cites >= 2)), "court_cites_no_def")


def short_definition(body: Column) -> Column:
    """Short bodies that define all the same."""
    return (F.length(body) >= 5) & body.rlike(r"^(An?|The|To|One|In|Of)\s+\w+|^[A-Z][a-z]+[.;]?$")


def flat_start(body: Column) -> Column:
    """First 60 characters, blanks collapsed."""
    return space(F.substring(body, 1, 60))
