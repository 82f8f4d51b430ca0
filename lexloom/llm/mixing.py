"""Mixing sources to target weights by packed blocks (operator 5), in DataFrame functions only.

1. Pack: the words of a source form one sequence, cut into blocks of ``block_words`` words.
   Documents are dealt to ``lanes`` lanes of their source by hash, ordered inside a lane, and
   lanes follow one another, so that no window holds a whole source.
2. Draw: source s has the weight quota_s = round(target_s / block_words). Each output shard of ``shard_slots`` slots draws
   how many of them each source gets: the whole part of its expected number, and for the slots that are then left a
   multinomial draw by the fractions, one exact draw a slot (residual multinomial sampling). Draws of shards are
   independent and bound to no total, so what a source gives follows from them; a source's number in all shards lies
   within a few times sqrt(number of shards) / 2 of its quota. Once a source has given ``passes`` times all its blocks
   its further slots stay out, and the shard closes up.
3. Map: the slots of a shard follow from its counts and those of the source in shards before (a prefix scan). Slot q is block perm(q mod n) of
   its pass q div n; each source and pass has its own pseudorandom permutation of [0, n), a Feistel
   network on a mixed radix. Another permutation gives the slots their positions in the shard.
4. Join the slots with the blocks by (source, index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scan import in_order, scanned
from .common import WORD, cut

BLOCK_WORDS, LANES, LANE_ROWS, SHARD_SLOTS, MAX_PASSES = 32, 1024, 10_000, 4096, 3
WEIGHTS = (5, 2, 1)
#: Into how many cells the range of a draw is cut, each of which knows the sources that it may fall to.
CELLS = 1024


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight that stop at ``passes`` sizes.

    Sources in code point order, null last, take the weights in turn. Resharing what lies above the
    stops by weight until none is above ends at the level L with sum(min(stop, L * weight)) = all words.
    In ascending stop / weight, a source stops if the level left by those before it is not below its own.
    One row a source goes through the windows: sources are the entries of a mix, not a number that grows with the rows.
    """
    nth = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    named = sizes.withColumn("w", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (nth % len(weights) + 1).cast("int")))
    stop = F.col("source_size") * F.lit(float(passes))
    rising = W.orderBy(stop / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    past, rest, every = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(stop).over(past), F.lit(0.0))) / F.sum("w").over(rest)
    marked = named.withColumn("level", level).withColumn("stops", level * F.col("w") >= stop)
    # The level of the first source that does not stop holds for all after it.
    marked = marked.withColumn("at", F.row_number().over(rising))
    common = F.min(F.when(~F.col("stops"), F.struct("at", "level"))).over(every)["level"]
    return marked.withColumn("common", common).select("source", "source_size", F.when(F.col("stops"), stop).otherwise(F.col("common") * F.col("w")).alias("target"))


def _let(x: Column, then) -> Column:
    """then(x), where x is worked out once."""
    return F.element_at(F.transform(F.array(x), then), 1)


def permuted(x: Column, n: Column, seed: Column, rounds: int = 4) -> Column:
    """Where x goes in a pseudorandom permutation of [0, n), by seed.

    Alternate rounds on a grid of a x b >= n points, a = ceil(sqrt(n)); points outside go on until inside.
    Fewer than a points lie outside, so 64 steps suffice for n up to 4096, and above that a walk
    of 64 has probability under 64 ** -64; such a walk raises an error rather than give a wrong place.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def once(y: Column) -> Column:
        left, right = F.floor(y / b).cast("long"), y % b
        for r in range(rounds):
            if r % 2:
                right = F.pmod(right + F.pmod(F.xxhash64(left, seed, F.lit(r)), b), b)
            else:
                left = F.pmod(left + F.pmod(F.xxhash64(right, seed, F.lit(r)), a), a)
        return left * b + right

    # In an array of one element each step's result is computed once and named.
    def step(y: Column) -> Column:
        return F.when(y < n, y).otherwise(once(y))

    first = once(x)
    lost = F.raise_error(F.lit("a permutation did not come back into its range")).cast("long")
    walked = _let(F.aggregate(F.sequence(F.lit(1), F.lit(64)), first, lambda y, _: step(y)), lambda y: F.when(y < n, y).otherwise(lost))
    return F.when(n <= 1, F.lit(0).cast("long")).otherwise(F.transform(F.array(first), lambda y: F.when(y < n, y).otherwise(walked))[0])


def packed(docs: DataFrame, lanes: int = LANES) -> DataFrame:
    """docs (doc_id, source, size, tie) with the document's first word in its source's sequence: start."""
    lane = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(lanes)).cast("int")
    docs = docs.withColumn("lane", lane)
    before = W.partitionBy("source", "lane").orderBy("doc_id", "tie", "size").rowsBetween(W.unboundedPreceding, -1)
    inside = docs.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    totals = docs.groupBy("source", "lane").agg(F.sum("size").alias("lane_size"))
    earlier = W.partitionBy("source").orderBy("lane").rowsBetween(W.unboundedPreceding, -1)  # at most `lanes` rows a source
    offsets = totals.select(F.col("source").alias("s"), F.col("lane").alias("l"), F.coalesce(F.sum("lane_size").over(earlier), F.lit(0)).alias("offset"))
    return inside.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("lane") == F.col("l"))).withColumn("start", F.col("offset") + F.col("inside")).drop("s", "l", "lane", "inside", "offset")


def quotas(wanted: DataFrame, block_words: int = BLOCK_WORDS, passes: int = MAX_PASSES) -> DataFrame:
    """wanted (source, source_size, target) with n_blocks and quota in slots."""
    n = F.ceil(F.col("source_size") / block_words).cast("long")
    q = F.least(F.round(F.col("target") / block_words).cast("long"), n * passes)
    # A source that takes every word of all passes takes all slots, whatever the rounding.
    q = F.when(F.col("target") >= F.col("source_size") * passes, n * passes).otherwise(q)
    return wanted.withColumn("n_blocks", n).withColumn("quota", q)


def shares(quota: DataFrame, total: int, slots: int) -> DataFrame:
    """(source, n_blocks, whole, low, high) of a shard of ``slots`` slots: its expected number is whole + (high - low) / total.

    The ranges [low, high) of all sources stand side by side and are ``total`` times what the whole parts leave of the slots.
    """
    each = quota.where("quota > 0").select("source", "n_blocks", F.expr(f"cast({slots} as bigint) * quota div {total}").alias("whole"), F.expr(f"cast({slots} as bigint) * quota % {total}").alias("part"))
    upto = F.sum("part").over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(W.unboundedPreceding, 0))  # one row a source
    return each.withColumn("high", upto).select("source", "n_blocks", "whole", (F.col("high") - F.col("part")).alias("low"), "high")


def drawn(quota: DataFrame, total: int, shards: range, slots: int, seed: int, cells: int = CELLS) -> DataFrame:
    """(source, n_blocks, shard, n): counts of shards, each of ``slots`` slots, by quota out of total.

    What whole parts leave is drawn slot by slot: a number below the sum of all ranges falls to the source whose range has it.
    Numbers meet ranges by the cell that they are in, so no row holds all sources.
    """
    each = cut(shares(quota, total, slots))
    whole = each.where("whole > 0").select("source", "n_blocks", F.col("whole").alias("n"))
    left = each.agg(F.coalesce(F.max("high"), F.lit(0)).alias("high")).first()[0]
    free, width = left // total, max(1, -(-left // cells))
    step = 1 << max(8, len(shards).bit_length() // 2)  # two short lists, one in the other, instead of one of all shards
    runs = whole.withColumn("run", F.explode(F.sequence(F.lit(shards.start).cast("long"), F.lit(shards.stop - 1).cast("long"), F.lit(step).cast("long"))))
    fixed = runs.select("source", "n_blocks", F.explode(F.sequence("run", F.least(F.col("run") + step, F.lit(shards.stop)) - 1)).alias("shard"), "n")
    if not free:
        return fixed
    number = F.pmod(F.xxhash64(F.lit(seed), "shard", "k"), F.lit(left).cast("long"))
    parts = int(quota.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = quota.sparkSession.range(shards.start, shards.stop, 1, min(parts, len(shards))).select(F.col("id").alias("shard"))
    draws = named.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(free - 1)))).withColumn("number", number).withColumn("cell", F.floor(F.col("number") / width))
    known = each.where("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    met = draws.join(known, "cell").where("low <= number and number < high")
    return fixed.unionByName(met.groupBy("source", "n_blocks", "shard").agg(F.count("*").alias("n")))


def draws(quota: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS, passes: int = MAX_PASSES) -> DataFrame:
    """(source, n_blocks, shard, slots, n, first, ahead): the counts drawn for each output shard, of sources with any.

    slots: those of the shard; n: those of the source; first: the source's in shards before; ahead: those of other
    sources before it in the shard. Every source ends at ``passes`` times its blocks.
    """
    total = quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    full, rest = total // shard_slots, total % shard_slots
    counts = None
    for shards, n in ((range(full), shard_slots), (range(full, full + 1), rest)):  # the last one may be shorter
        if shards and n:
            got = drawn(quota, total, shards, n, seed)
            counts = got if counts is None else counts.unionByName(got)
    if counts is None:
        return quota.where("false").select("source", "n_blocks", *(F.lit(0).cast("long").alias(c) for c in ("shard", "slots", "n", "first", "ahead")))
    counts = counts.groupBy("source", "n_blocks", "shard").agg(F.sum("n").alias("n"))
    placed = scanned(in_order(counts, F.col("source").isNull(), F.col("source").cast("binary"), "shard"), ["source"], first=("sum", F.col("n"))).drop("_i")
    placed = placed.withColumn("n", F.least("n", F.col("n_blocks") * passes - F.col("first"))).where("n > 0")
    shard = W.partitionBy("shard")  # no more rows than a shard has slots
    earlier = shard.orderBy(F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(W.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    out = placed.select("source", "n_blocks", "shard", F.sum("n").over(shard).alias("slots"), "n", "first", ahead.alias("ahead"))
    # Few and small rows, each of which becomes thousands of slots: dealt to as many tasks as there are, not to as many as their bytes need.
    return cut(out.repartition(int(quota.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard"))


def slots(counts: DataFrame, seed: int = 0) -> DataFrame:
    """One row a slot of ``draws``: source, pass, block, and its place in the mix as shard and position."""
    i, q = F.col("i"), F.col("first") + F.col("i")
    each = counts.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).withColumn("pass", F.floor(q / F.col("n_blocks")).cast("int"))
    return each.select(
        "source", "pass", permuted(q % F.col("n_blocks"), F.col("n_blocks"), F.xxhash64(F.lit(seed), "source", "pass")).alias("block"),
        "shard", permuted(F.col("ahead") + i, F.col("slots"), F.xxhash64(F.lit(seed), "shard")).cast("int").alias("position"),
    )


def pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents (row, source, size, start) cut at block ends: (row, source, block, begin, words), begin in the document."""
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
    cutted = places.where("size > 0").withColumn("block", F.explode(blocks))
    begin = F.greatest(F.col("block") * block_words, F.col("start"))
    return cutted.select("row", "source", "block", (begin - F.col("start")).alias("begin"), (F.least((F.col("block") + 1) * block_words, end) - begin).alias("words"))


def mix(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mixes docs (doc_id, source, text): places, slots and the join of pieces with slots.

    places: doc_id, source, row (a hash that tells rows apart, but for equal ones), size, start, source_size, target.
    joined: row, source, block, begin, words, pass, shard, position.
    Null texts have size 0; null sources form one source; rows that are equal in all three columns
    stand side by side in the sequence and are told apart by their start.
    """
    base = cut(docs.select(F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = cut(quotas(targets(sizes), block_words))
    places = packed(base, max(LANES, base.count() // LANE_ROWS))  # more lanes for more rows, as a lane is one window
    named = plan.select(F.col("source").alias("s"), "source_size", "target")
    places = places.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("row", F.struct("doc_id", "tie", "start"))
    made = slots(draws(plan, seed), seed)
    right = made.select(F.col("source").alias("s"), F.col("block").alias("k"), "pass", "shard", "position")
    cutted = pieces(places, block_words)
    joined = cutted.join(right.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k"))).drop("s", "k")
    return places, made, joined


def taken(docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of docs: the words that the mix takes of it."""
    places, made, _ = mix(docs, seed, block_words)
    # How often a block is taken, before the join: at most one row a block and source, so a short row meets each piece.
    times = made.groupBy("source", "block").agg(F.count("*").alias("times"))
    right = times.select(F.col("source").alias("s"), F.col("block").alias("k"), "times")
    # Expanded rows are far more than their estimated size says: a sort-merge join, never a broadcast.
    joined = pieces(places, block_words).join(right.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k")))
    sums = joined.groupBy(F.col("row").alias("r")).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    # A document without words shares its start with the next one, and has no pieces.
    out = places.join(sums.hint("merge"), (F.col("size") > 0) & (F.struct("row") == F.struct(F.col("r"))), "left")
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0, block_words: int = 2048) -> DataFrame:
    """The mix as documents: docs (doc_id, source, text and others) once for each pass that takes words of it, and its place.

    A pass that takes all of a document gives its text as it is; one that takes some of its blocks gives their
    words in order, joined by one blank. n_chars, where docs have it, is counted anew. Documents that the
    mix takes nothing of are left out. Blocks are longer than those of ``taken``, so most documents stay whole.
    mix_shard and mix_position tell where in the mix the first of its blocks is.
    """
    places, _, joined = mix(docs, seed, block_words)
    by_pass = joined.groupBy("row", "pass").agg(F.sum("words").alias("n"), F.array_sort(F.collect_list(F.struct("begin", "words"))).alias("cuts"), F.min(F.struct("shard", "position")).alias("at"))
    whole = by_pass.select(F.col("row.doc_id").alias("p0"), F.col("row.tie").alias("p1"), "n", "cuts", "at")
    names = docs.columns
    marked = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col("doc_id").alias("k0"), F.xxhash64("text").alias("k1"), F.col("text").alias("body"))
    # Rows that are equal in id and text take part once here: each of them already has passes of its own.
    marked = marked.dropDuplicates(["k0", "k1"])
    both = marked.join(whole.hint("merge"), F.col("k0").eqNullSafe(F.col("p0")) & (F.col("k1") == F.col("p1")))
    words = F.regexp_extract_all("body", F.lit(WORD), F.lit(0))
    some = F.transform(F.array(words), lambda ws: F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice(ws, (c["begin"] + 1).cast("int"), c["words"].cast("int")))), " "))[0]
    text = F.when(F.col("n") == n_words(F.col("body")), F.col("body")).otherwise(some)
    out = both.withColumn("new", text)
    fresh = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    kept = [(fresh[c] if c in fresh else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)]
    return out.select(*kept, F.col("at.shard").alias("mix_shard"), F.col("at.position").alias("mix_position"))
