"""SpotSigs document fingerprints (operator 9), in DataFrame functions only.

A signature is the chain of the CHAIN content words that follow an anchor, an anchor being a
common word; the start of a text is an anchor too, and a chain at the end of a text may be
shorter. Words are compared in lower case, without symbols around them. Where there are fewer than FEW chains, or
fewer than one for each SPARSE words (lists, languages without listed anchors, common words only), every word is an
anchor, and all chains of CHAIN words are signatures; a text of symbols only takes them as its words. So all of a text
counts. A fingerprint is the ascending set of the signatures' 32-bit hashes, each as 8 hex digits; a text without
words has the empty fingerprint. Two empty fingerprints have likeness 1, an empty and another 0.

``near_pairs`` compares sets by pruned Jaccard: sets are partitioned by length, since
|A| / |B| bounds the likeness, and two sets meet only if they share one of their rarest
signatures, of which a likeness of t forces the first |A| - ceil(t |A|) + 1 to intersect.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

CHAIN, THRESHOLD, FEW, SPARSE = 2, 0.8, 4, 20
#: Rows of a bucket in ``with_next``, and how many buckets there are at most; larger tables get larger buckets.
BUCKET_ROWS, MAX_BUCKETS, STRIDE = 1000, 65536, 256
_LOWEST = -(1 << 63)

_SPACE = r"[\x20\x09-\x0D]"
_SYMBOL = r"[^\p{L}\p{N}\x20\x09-\x0D]"
#: Symbols at a word's beginning or end, looked for only where such a run begins.
_AROUND = rf"(?<!{_SYMBOL})(?:(?<={_SPACE}|^){_SYMBOL}++|{_SYMBOL}++(?={_SPACE}|\z))"

#: Common words of English, German, French and Spanish (fixed list).
ANCHORS = (
    "a an and are as at be by for from has he in is it of on that the this to was were will with "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au aux dans du elle en et la le les ou par pas pour que qui sur un une "
    "al como con el las lo los no para por se su una y"
).split()


def _bare(text: Column) -> Column:
    """Lower-case words without the symbols around them, a space between, before and after; each run of symbols is read once."""
    low = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _AROUND, "")
    return F.concat(F.lit(" "), F.regexp_replace(F.concat(low, F.lit(" ")), f"{_SPACE}+", " "))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Ascending distinct signature hashes (longs under 2^32) of a text; an empty array for null or no words."""
    # Arrays of one element name what is used twice.
    return F.transform(F.array(_bare(text)), lambda flat: _signatures(text, flat, chain))[0]


def _signatures(text: Column, flat: Column, chain: int) -> Column:
    parts = F.split(flat, f"(?<= )(?:{'|'.join(sorted(set(ANCHORS)))})(?= )")
    filled = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
    # Each part has a word at least, so `chain` parts hold a chain.
    chains = F.transform(
        F.array(filled),
        lambda ps: F.array_sort(F.array_distinct(F.transform(ps, lambda _, i: _hash(F.substring_index(F.array_join(F.slice(ps, i + 1, chain), " "), " ", chain))))),
    )[0]
    raw = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    words = F.when(F.trim(flat) != "", F.split(F.trim(flat), " ")).otherwise(raw)
    every = F.transform(F.array(words), lambda ws: F.array_sort(F.array_distinct(F.transform(ws, lambda _, i: _hash(F.array_join(F.slice(ws, i + 1, chain), " "))))))[0]
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))  # one more than words, unless there are none
    return F.transform(F.array(chains), lambda c: F.when((F.size(c) >= FEW) & (F.size(c) * SPARSE >= spaces), c).otherwise(every))[0]


def _hash(x: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(x), 32)


def fingerprint(sigs: Column) -> Column:
    """A fingerprint's text."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets, from 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.transform(F.array(common), lambda c: c / (F.size(a) + F.size(b) - c).cast("double"))[0]
    )


def with_next(docs: DataFrame) -> tuple[DataFrame, W]:
    """docs (doc_id, text) by buckets of neighbouring ids, and the window in which the next row follows.

    Rows go in descending doc_id (null last; equal ids by a hash of the text); after the last comes the
    first. The bounds of the buckets are ids of the table, at most MAX_BUCKETS of them. The first row of each
    bucket is also put at the end of the bucket before it, marked ghost, so that lead() needs one shuffle.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(_LOWEST)).cast("long"))
    n = docs.select(F.count("*")).first()[0]
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    got = docs.agg(F.percentile_approx("key", [(k + 1) / buckets for k in range(buckets)], 100 * buckets).alias("p"), F.max("key").alias("top")).first()
    bounds = sorted({*(got.p or []), got.top}) if n else [0]
    ends, inside = F.array(*(F.lit(x) for x in bounds[STRIDE - 1 :: STRIDE])).cast("array<bigint>"), F.array(*(F.lit(x) for x in bounds)).cast("array<bigint>")
    # The number of bounds below an id: first among every STRIDE-th, then among the STRIDE that follow.
    block = F.size(F.filter(ends, lambda b: b < F.col("key")))
    bucket = F.col("block") * STRIDE + F.size(F.filter(F.slice(inside, F.col("block") * STRIDE + 1, STRIDE), lambda b: b < F.col("key")))
    placed = docs.withColumn("block", block).withColumn("bucket", bucket)
    at_end = F.element_at(inside, F.col("bucket") + 1) == F.col("key")
    ghost = F.when(at_end, F.struct(F.pmod(F.col("bucket") + 1, F.lit(len(bounds))).cast("int").alias("bucket"), F.lit(True).alias("ghost")))
    both = F.array_compact(F.array(F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(False).alias("ghost")), ghost))
    rows = placed.select("doc_id", "text", "key", F.xxhash64("text").alias("tie"), F.explode(both).alias("to")).select("doc_id", "text", "key", "tie", "to.bucket", "to.ghost")
    return rows, W.partitionBy("bucket").orderBy("ghost", F.desc("key"), "tie")


def edited_and_next(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Per row of docs: n_chars, edited text's hash, both fingerprints, and likeness to the edited and the next text.

    Null texts count as empty. The edited text ends in the next row's beginning, for a third of its code points.
    """
    rows, order = with_next(docs)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumn("following", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring(F.coalesce("following", F.lit("")), F.lit(1), third)))
    rows = rows.select("doc_id", "key", "tie", "bucket", "ghost", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("text"), chain).alias("sigs"), F.when(~F.col("ghost"), signatures(F.col("edited"), chain)).alias("edited_sigs"))
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(order)).where("not ghost")
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"), likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """Near duplicates among docs (doc_id, text): members (doc_id, class) and pairs (a, b, likeness), a < b.

    Documents of equal fingerprints form a class, named by a hash of the set; pairs are between classes of
    non-empty sets, all with likeness >= threshold. A signature's rank is its number of classes, then itself.
    Sets meet by (signature among the rarest, partition of lengths): a set offers itself in its own partition
    and looks into those up to its length / threshold.
    """
    sigs = docs.select("doc_id", signatures(F.col("text"), chain).alias("sigs"))
    members = cut(sigs.withColumn("class", F.xxhash64("sigs")))
    sets = members.groupBy("class").agg(F.first("sigs").alias("sigs")).where(F.size("sigs") > 0)
    each = sets.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count("*").alias("often"))
    ranked = each.join(often, "sig").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("often", "sig"))).alias("by"), F.first("n").alias("n"))
    head = (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int")
    base = math.log(1 / threshold)
    part = lambda n: F.floor(F.log(n.cast("double")) / base).cast("int")
    heads = ranked.select("class", "n", F.explode(F.slice("by", F.lit(1), head)).alias("s")).select("class", "n", F.col("s.sig").alias("sig"), part(F.col("n")).alias("part"))
    # Lengths up to n / threshold lie in the own and the next partition (one more for rounding).
    look = heads.withColumn("part", F.explode(F.sequence(F.col("part"), F.col("part") + 2)))
    left = look.select(F.col("class").alias("a"), F.col("n").alias("na"), "sig", "part")
    right = heads.select(F.col("class").alias("b"), F.col("n").alias("nb"), "sig", "part")
    meets = left.join(right, ["sig", "part"]).where("a <> b and na <= nb").where(F.col("na") >= F.col("nb") * threshold)
    found = meets.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, two = sets.select(F.col("class").alias("a"), F.col("sigs").alias("sa")), sets.select(F.col("class").alias("b"), F.col("sigs").alias("sb"))
    pairs = found.join(one, "a").join(two, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= threshold)
    return members.select("doc_id", "class"), pairs.select("a", "b", "likeness")
