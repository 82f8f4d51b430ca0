"""Joins of the reference: first-wins look-ups, nearest spelling, as-of, bands, longest prefix and phrase.

No side is broadcast by hint; Spark broadcasts a side whose size is known to be small.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.similarity import ratio
from .scan import settled

#: Letters from rare to frequent in English text (a fixed order, which decides costs only).
RARE = "QXZJKVWYFBHGMPUDCLOTNRSAIE "
#: From this length on strings meet by grams of GRAM characters instead of pieces.
LONG, GRAM = 80, 4


def first_wins(df: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """One row a key: the first by order, or the last (J1). Combined before the shuffle, so a hot key stays small."""
    pick = F.max if last else F.min
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(pick(F.struct(order, *rest)).alias("_b"))
    return best.select(key, *(F.col(f"_b.{c}").alias(c) for c in (order, *rest)))


def positional(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows paired by index; rows of left beyond right stay."""
    return left.join(right, "index", "left")


def changed(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys of both builds in which a column differs, nulls being values."""
    a, b = old.select(key, *(F.col(c).alias(f"old_{c}") for c in columns)), new.select(key, *(F.col(c).alias(f"new_{c}") for c in columns))
    return a.join(b, key).where(reduce(Column.__or__, (~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in columns)))


#: Up to this length strings meet by what is left of them without some characters, beyond it by pieces.
SHORT = 24


def without(x, most: int) -> Column:
    """Distinct strings with up to ``most`` characters of x left out."""
    cut = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda k: F.concat(F.substring(s, F.lit(1), k - 1), F.substring(s, k + 1, F.length(s))))
    now = out = F.array(x)
    for _ in range(most):
        now = F.array_distinct(F.flatten(F.transform(now, cut)))
        out = F.array_union(out, now)
    return out


def dealt(df: DataFrame) -> DataFrame:
    """df, which an explode has made much larger than Spark takes it for, so that no join broadcasts it: both sides are dealt out and sorted."""
    return df.hint("merge")


def spread(df: DataFrame, x: str) -> DataFrame:
    """df over many tasks before an explode: what is small would be the work of one or two. By a hash, as Spark drops what is dealt out by the same key as before."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(x))


def edits_apart(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """Pairs of a and b (distinct strings) within ``most`` edits, with their distance.

    Strings so near become equal if each loses ``most`` characters at most, the changed ones and those put in; up to SHORT
    characters they meet by hashes of what is left, so candidates are few edits apart. Longer strings are cut into
    most + 1 pieces, of which one must occur unchanged in any other that is so near, shifted by at most ``most``. Each
    piece is offered with the length and its number, so the join is on equality and no bucket holds all strings of a length.
    """
    a, b = spread(a, "a"), spread(b, "b")
    left = lambda df, x: df.where(F.length(x) <= SHORT).select(x, F.explode(without(F.col(x), most)).alias("w")).select(x, F.xxhash64("w").alias("w"))
    near = lambda met: met.withColumn("distance", F.levenshtein("a", "b", most)).where("distance >= 0")
    short = near(left(a, "a").join(dealt(left(b, "b")), "w").select("a", "b"))

    cut = lambda n, i: F.floor(n * i / (most + 1)).cast("int")
    offered = b.where(F.length("b") > SHORT - most).select("b", F.length("b").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    offered = offered.select("b", "n", "i", cut(F.col("n"), F.col("i")).alias("x"), cut(F.col("n"), F.col("i") + 1).alias("y")).select("b", "n", "i", F.expr("substring(b, x + 1, y - x)").alias("piece"))
    look = a.where(F.length("a") > SHORT - most).select("a", F.explode(F.sequence(F.greatest(F.length("a") - most, F.lit(0)), F.length("a") + most)).alias("n"))
    look = look.select("a", "n", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    look = look.select("a", "n", "i", cut(F.col("n"), F.col("i")).alias("x"), cut(F.col("n"), F.col("i") + 1).alias("y"))
    look = look.select("a", "n", "i", "x", "y", F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("s")).where("x + s >= 0 and y + s <= length(a)")
    look = look.select("a", "n", "i", F.expr("substring(a, x + s + 1, y - x)").alias("piece")).distinct()
    long = near(look.join(dealt(offered), ["n", "i", "piece"]).select("a", "b").where(F.greatest(F.length("a"), F.length("b")) > SHORT))
    return short.unionByName(long).distinct()


def within(df: DataFrame, key: str, most: int) -> DataFrame:
    """Pairs a < b of distinct keys within ``most`` edits."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return edits_apart(keys.select(F.col(key).alias("a")), keys.select(F.col(key).alias("b")), most).where("a < b")


def nearest(left: DataFrame, right: DataFrame, key: str, most: int, every_tie: bool = False) -> DataFrame:
    """For each distinct key of left the key of right at least edit distance, up to ``most`` (J6); ties by the key.

    Distances are asked for one after the other, from 0: a key that has a partner is not looked up with more edits.
    """
    a, b = (settled(df.select(F.col(key).alias(x)).where(F.col(x).isNotNull()).distinct()) for df, x in ((left, "a"), (right, "b")))
    found = a.join(b, F.col("a") == F.col("b")).select("a", "b", F.lit(0).alias("distance"))
    for edits in range(1, most + 1):
        rest = a.join(found.select(F.col("a").alias("done")).distinct(), F.col("a") == F.col("done"), "left_anti")
        found = settled(found.unionByName(edits_apart(rest, b, edits)))
    if every_tie:
        return found
    return found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("m")).select("a", F.col("m.b").alias("b"), F.col("m.distance").alias("distance"))


def alike(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Pairs of a (a) and b (b), distinct strings, that may have a ratio of ``least`` or more (J7, J8): no such pair is missing.

    The ratio is twice the matched characters over both lengths m and n, so at most (1 - least)(m + n) characters are left
    out or put in, and as many as that are odd or even as m + n is. Where it is none, strings are equal; where it is one, the longer
    is the other with a character more. Otherwise of that many + 1 pieces of b one is whole in a, shifted by no more than what
    can be put in or left out before it. Where the longer string has LONG characters or more, pairs share one of their rarest grams instead: each
    edit spoils GRAM grams at most. Strings with too few different grams for that meet by pieces whatever their length.
    """
    share = 1 - least + 1e-9
    n_max, n_min = F.floor(F.length("a") * (2 - least) / least + 1e-9).cast("int"), F.ceil(F.length("a") * least / (2 - least) - 1e-9).cast("int")

    def with_few(a: DataFrame, b: DataFrame) -> DataFrame:
        # Pairs of up to one edit meet by what they have in common, which no other pair has: pieces of short strings are common.
        spare = lambda df, x: df.where(F.floor(share * (2 * F.length(x) - 1)).between(1, 2)).select(x, F.explode(F.filter(without(F.col(x), 1), lambda w: F.length(w) < F.length(x))).alias("w")).select(x, F.xxhash64("w").alias("w"))
        own = lambda df, x: df.select(x, F.xxhash64(x).alias("w"))
        met = [(own(a, "a"), own(b, "b"), 0), (spare(a, "a"), own(b, "b"), 1), (own(a, "a"), spare(b, "b"), -1)]
        return reduce(DataFrame.unionByName, (x.join(dealt(y), "w").select("a", "b").where(F.length("a") - F.length("b") == more) for x, y, more in met))

    def by_pieces(a: DataFrame, b: DataFrame) -> DataFrame:
        # offered: pieces of b for each number of edits that a partner can have; look: the places in a where they can be.
        sizes = b.select("b", F.length("b").alias("n"))
        top = F.floor(share * (F.col("n") + F.floor(F.col("n") * (2 - least) / least + 1e-9))).cast("int")
        low = F.floor(share * (F.col("n") + F.ceil(F.col("n") * least / (2 - least) - 1e-9))).cast("int")
        cut = lambda i: F.floor(F.col("n") * i / (F.col("d") + 1)).cast("int")
        offered = sizes.where(top >= 2).select("b", "n", F.explode(F.sequence(F.greatest(low - 1, F.lit(2)), top)).alias("d")).select("b", "n", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"))
        offered = offered.select("b", "n", "d", "i", cut(F.col("i")).alias("x"), cut(F.col("i") + 1).alias("y")).select("b", "n", "d", "i", F.expr("substring(b, x + 1, y - x)").alias("piece"))
        m = F.length("a")
        look = a.select("a", m.alias("m"), F.explode(F.sequence(F.greatest(n_min, F.lit(1)), F.greatest(n_max, F.lit(1)))).alias("n"))
        look = look.withColumn("d", F.floor(share * (F.col("m") + F.col("n"))).cast("int")).withColumn("d", F.expr("d - (d + m + n) % 2")).where("d >= 2 and abs(m - n) <= d")
        look = look.select("a", "m", "n", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"))
        look = look.select("a", "m", "n", "d", "i", cut(F.col("i")).alias("x"), cut(F.col("i") + 1).alias("y"), F.explode(F.expr("sequence(cast(floor(-(d + n - m) / 2) as int), cast(ceil((d + m - n) / 2) as int))")).alias("s"))
        look = look.where("x + s >= 0 and y + s <= m").select("a", "n", "d", "i", F.expr("substring(a, x + s + 1, y - x)").alias("piece")).distinct()
        return look.join(dealt(offered), ["n", "d", "i", "piece"]).select("a", "b").unionByName(with_few(a, b)).distinct()

    def grams(df: DataFrame, x: str) -> DataFrame:
        all_ = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - GRAM + 1), lambda k: F.substring(x, k, F.lit(GRAM))))
        d = F.floor(share * (F.length(x) + F.floor(F.length(x) * (2 - least) / least + 1e-9))).cast("int")
        return df.where(F.length(x) >= LONG * least / (2 - least) - 1).select(F.col(x), all_.alias("g"), (GRAM * d + 1).alias("p"))

    def by_grams(a: DataFrame, b: DataFrame) -> DataFrame:
        ga, gb = grams(a, "a"), grams(b, "b")
        often = gb.select(F.explode("g").alias("gram")).groupBy("gram").agg(F.count("*").alias("often"))

        def heads(df: DataFrame, x: str) -> DataFrame:
            each = df.select(x, "p", F.explode("g").alias("gram")).join(often, "gram", "left").groupBy(x).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram"))).alias("by"), F.first("p").alias("p"))
            return each.select(x, F.explode(F.slice("by", F.lit(1), F.col("p"))).alias("s")).select(x, F.col("s.gram").alias("gram"))

        met = heads(ga, "a").join(dealt(heads(gb, "b")), "gram").where(f"least(length(a), length(b)) * {(2 - least) / least} + 1e-6 >= greatest(length(a), length(b))")
        return met.select("a", "b").distinct()

    longer = F.greatest(F.length("a"), F.length("b"))
    short = lambda df, x: df.where(F.length(x) < LONG)
    # A pair is safe to meet by grams if both have more different grams than the edits can spoil.
    poor = lambda df, x: grams(df, x).where(F.size("g") < 2 * F.col("p")).select(x)
    pairs = by_pieces(short(a, "a"), short(b, "b")).where(longer < LONG)
    pairs = pairs.unionByName(by_grams(a, b).where(longer >= LONG)).unionByName(by_pieces(poor(a, "a"), poor(b, "b")).where(longer >= LONG)).distinct()
    most = F.floor(share * (F.length("a") + F.length("b"))).cast("int")
    return pairs.where(F.levenshtein("a", "b") <= most)


def letter_bag(x) -> Column:
    """The letters of a string with their occurrence numbers ('E1', 'E2'), rare letters first: as many as it has letters.

    Two strings share as many of these as their letters can be paired off.
    """
    coded = F.translate(x, RARE, "".join(chr(0xE000 + k) for k in range(len(RARE))))  # private use: no text has them
    letters = F.array_sort(F.filter(F.split(coded, ""), lambda c: c != ""))
    return F.transform(F.array(letters), lambda s: F.transform(s, lambda c, i: F.concat(c, (i - F.array_position(s, c) + 2).cast("string"))))[0]


def letter_bits(bag) -> Column:
    """A bag as bits: the first and second of each letter have their own, all else shares ten.

    What one bag has bits for and the other has not is missing there, so bits bound from above what two bags share.
    """
    nth = lambda c: F.substring(c, 2, 9)
    place = lambda c: F.when(F.ascii(c).between(0xE000, 0xE000 + len(RARE) - 1) & nth(c).isin("1", "2"), F.ascii(c) - 0xE000 + len(RARE) * (nth(c).cast("int") - 1)).otherwise(2 * len(RARE) + F.pmod(F.xxhash64(c), F.lit(64 - 2 * len(RARE))).cast("int"))
    return F.aggregate(bag, F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place(c))))


def by_letters(a: DataFrame, b: DataFrame, least: float, initial: bool = False) -> DataFrame:
    """Pairs of a (a) and b (b), distinct strings, that may have a ratio of ``least`` or more: no such pair is missing.

    For low ratios, where pieces of ``alike`` are too short to tell strings apart. The ratio is at most twice the letters
    that can be paired off over both lengths m and n, so o = least (m + n) / 2 letters are shared, and two of these are among
    the first m - o + 2 and n - o + 2 letters in order of rarity (one, of one letter less, where o is 1). Strings meet by
    both lengths and these two letters, by one hash of them. With initial only pairs with the same first letter are asked for.
    Pairs that meet grow with the square of the strings, so each is first judged by its bits, in the join itself.
    """
    low, high = least / (2 - least), (2 - least) / least
    first = F.substring("x", 1, 1) if initial else F.lit("")

    def keyed(df: DataFrame, x: str, other: str) -> DataFrame:
        each = df.select(F.col(x).alias("x"), F.length(x).alias("own")).where("own > 0").withColumn("bag", letter_bag(F.col("x"))).withColumn("bits", letter_bits(F.col("bag")))
        each = each.withColumn("far", F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(F.col("own") * low - 1e-9)).cast("int"), F.floor(F.col("own") * high + 1e-9).cast("int"))))
        each = each.withColumn("o", F.greatest(F.lit(1), F.ceil((F.col("own") + F.col("far")) * (least / 2) - 1e-9)).cast("int"))
        each = each.where("o <= least(own, far)").withColumn("p", F.slice("bag", F.lit(1), F.col("own") - F.col("o") + F.least(F.lit(2), F.col("o"))))
        two = F.flatten(F.transform("p", lambda s, i: F.transform(F.slice("p", i + 2, F.size("p")), lambda t: F.concat(s, F.lit(" "), t))))
        key = F.explode(F.when(F.col("o") == 1, F.col("p")).otherwise(two)).alias("key")
        each = each.select("x", "own", "bits", F.col("own").alias(f"n{x}"), F.col("far").alias(f"n{other}"), first.alias("head"), key)
        return each.select(F.col("x").alias(x), F.col("own").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}"), F.xxhash64("na", "nb", "head", "key").alias("key"))

    sizes = F.col("na") + F.col("nb")
    missing = lambda x, y: F.bit_count(F.col(f"bits_{x}").bitwiseAND(F.bitwise_not(f"bits_{y}")))
    may = (F.col("na") - missing("a", "b") >= sizes * (least / 2) - 1e-9) & (F.col("nb") - missing("b", "a") >= sizes * (least / 2) - 1e-9)
    near = F.when(may, F.levenshtein("a", "b") <= sizes * (1 - least) + 1e-9).otherwise(False)
    return keyed(spread(a, "a"), "a", "b").join(dealt(keyed(spread(b, "b"), "b", "a")), "key").where(near).select("a", "b").distinct()


def close_terms(wanted: DataFrame, known: DataFrame, n: int = 3, cutoff: float = 0.7) -> DataFrame:
    """Up to n strings of known (term) with a ratio of ``cutoff`` or more for each distinct string of wanted (term): term, close.

    Best first, of equal ratios the greater string, as difflib's close matches are. No pair is left out beforehand:
    ``by_letters`` finds all that can have the ratio, without a common first letter.
    """
    a, b = (df.select(F.col("term").alias(x)).where(F.length(x) > 0).distinct() for df, x in ((wanted, "a"), (known, "b")))
    near = by_letters(a, b, cutoff).withColumn("r", ratio()("b", "a")).where(F.col("r") >= cutoff)
    best = near.withColumn("nth", F.row_number().over(W.partitionBy("a").orderBy(F.desc("r"), F.desc("b")))).where(F.col("nth") <= n)
    lists = best.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("nth", "b"))).alias("l"))  # n at most
    return lists.select(F.col("a").alias("term"), F.transform("l", lambda x: x["b"]).alias("close"))


#: Patterns are looked up by their first RUN bytes, those of more than HEAD bytes where their first HEAD bytes are.
RUN, HEAD = 32, 8
#: Bits of the filter for each hash, and its greatest size, by the base-two logarithm.
FILTER_BITS, FILTER = 32, 27
_BASE, _HEAD, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xA24BAED4963EE407), tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def _passing(h: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Where hashes are that a filter may hold."""
    shift = np.uint64(65 - len(held).bit_length())
    at = np.flatnonzero(held[(h * _MIX[0]) >> shift])
    for mix in _MIX[1:]:
        at = at[held[(h[at] * mix) >> shift]]
    return at


def _filter_of(patterns: DataFrame, hashes, per_row: int = 1):
    """A broadcast filter, packed, of the hashes that a function gives for record batches of patterns: some bytes a pattern, the driver or-ing words."""
    bits = int(np.clip(np.ceil(np.log2(FILTER_BITS * max(1, per_row * patterns.count()))), 16, FILTER))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(1 << bits, bool)
        for b in batches:
            h = hashes(b)
            for mix in _MIX:
                filled[(h * mix) >> np.uint64(64 - bits)] = True
        packed = np.packbits(filled, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], names=["at", "bits"])

    got = patterns.mapInArrow(words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(1 << bits - 6, np.int64)
    packed[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return patterns.sparkSession.sparkContext.broadcast(packed.view(np.uint8))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by 2 ** 64."""
    ups, downs = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)]), dtype=np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    return ups, downs


def _sums(text: bytes, ups: np.ndarray) -> np.ndarray:
    """Running sums of a text's bytes times the powers of the base: runs are hashed by their differences."""
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * ups[: len(text)], out=sums[1:])
    return sums


def _scope_hash(scope: int | None) -> np.uint64:
    return np.uint64((scope * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64)) if scope is not None else np.uint64(0)


def _rows(part: pa.RecordBatch, row: list[int], runs: list, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    took = pa.array(row, pa.int32())
    return pa.RecordBatch.from_arrays([part.column(0).take(took), pa.array(runs, kind), *(part.column(k).take(took) for k in range(2, part.num_columns))], names=names)


def runs_of(patterns: DataFrame, bodies: DataFrame, key: str, scope: str | None = None) -> DataFrame:
    """(key, run, and scope) of the bodies (key, body, and scope): beginnings of patterns (run, and scope) that they have, each once.

    The runs of a body, of all sizes that patterns have, are hashed by running sums and asked for in a filter of a few bytes a
    pattern. What passes may be no pattern's: join the runs. A scope, a whole number, is part of what is looked for.
    """
    by = [scope] if scope else []
    sizes = sorted(r["n"] for r in patterns.select(F.octet_length("run").alias("n")).distinct().collect())

    def hashes(b: pa.RecordBatch) -> np.ndarray:
        ups, downs = _powers(RUN)
        out = []
        for r, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist() if by else [None] * b.num_rows):
            sums, own = _sums(r, ups), _scope_hash(s)
            out.append(sums[-1] ^ own)
            if len(r) > HEAD:
                out.append(sums[HEAD] ^ own ^ _HEAD)
        return np.array(out, np.uint64)

    shared = _filter_of(patterns.select("run", *by), hashes, 2)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value, bitorder="little").view(bool)
        ups, downs = _powers(1 << 16)
        for b in batches:
            for part in (b.slice(k, 256) for k in range(0, b.num_rows, 256)):
                row, runs = [], []
                for k, (text, s) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist() if by else [None] * part.num_rows)):
                    text = text.encode("utf-8", "surrogatepass") if text else b""
                    if len(text) > len(ups):
                        ups, downs = _powers(2 * len(text))
                    sums, own, heads = _sums(text, ups), _scope_hash(s), None
                    for q in sizes:
                        n = len(sums) - q
                        if n <= 0:
                            break
                        if q <= HEAD:
                            h = (sums[q:] - sums[:n]) * downs[:n] ^ own
                            at = _passing(h, held)
                            h = h[at]
                        else:
                            if heads is None:
                                m = len(sums) - HEAD
                                heads = _passing((sums[HEAD:] - sums[:m]) * downs[:m] ^ (own ^ _HEAD), held)
                            at = heads[: np.searchsorted(heads, n)]
                            h = (sums[at + q] - sums[at]) * downs[at] ^ own
                            some = _passing(h, held)
                            at, h = at[some], h[some]
                        if len(at):
                            at = at[np.unique(h, return_index=True)[1]].tolist()
                            row += [k] * len(at)
                            runs += [text[x : x + q] for x in at]
                yield _rows(part, row, runs, pa.binary(), [key, "run", *by])

    types = dict(bodies.dtypes)
    return bodies.select(key, "body", *by).mapInArrow(each, f"{key} {types[key]}, run binary" + (f", {scope} {types[scope]}" if scope else ""))


def word_runs_of(patterns: DataFrame, bodies: DataFrame, key: str) -> DataFrame:
    """(key, run) of the bodies (key, body): patterns (run) that they have as runs of whole words, each once; words stand between single blanks.

    As ``runs_of``, by hashes of words: what passes may be no pattern's.
    """
    sizes = sorted(r["n"] for r in patterns.select(F.size(F.split("run", " ")).alias("n")).distinct().collect())
    base = np.uint64(_BASE)

    def coded(words: list[str], known: dict[str, int]) -> np.ndarray:
        if len(known) > 1 << 18:
            known.clear()
        for w in words:
            if w not in known:
                c = w.encode("utf-8", "surrogatepass")
                known[w] = zlib.crc32(c) << 32 | zlib.adler32(c)
        return np.array([known[w] for w in words], np.uint64)

    def folded(codes: np.ndarray, size: int) -> np.ndarray:
        n = len(codes) - size + 1
        h = codes[:n].copy()
        for k in range(1, size):
            h = h * base + codes[k : k + n]
        return h * base + np.uint64(size)

    def hashes(b: pa.RecordBatch) -> np.ndarray:
        known: dict[str, int] = {}
        lists = [r.split(" ") for r in b.column(0).to_pylist()]
        return np.array([folded(coded(w, known), len(w))[0] for w in lists], np.uint64)

    shared = _filter_of(patterns.select("run"), hashes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value, bitorder="little").view(bool)
        known: dict[str, int] = {}
        for b in batches:
            for part in (b.slice(k, 256) for k in range(0, b.num_rows, 256)):
                row, runs = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    words = text.split(" ") if text else []
                    codes = coded(words, known)
                    for q in sizes:
                        if q > len(words):
                            break
                        some = {" ".join(words[x : x + q]) for x in _passing(folded(codes, q), held).tolist()}
                        row += [k] * len(some)
                        runs += some
                yield _rows(part, row, runs, pa.string(), [key, "run"])

    return bodies.select(key, "body").mapInArrow(each, f"{key} {dict(bodies.dtypes)[key]}, run string")


def _looked_up(patterns: DataFrame, *scope: str) -> DataFrame:
    """The distinct patterns with what they are looked up by, and whether that is all of them."""
    wanted = patterns.select("pattern", *scope).where(F.length("pattern") > 0).distinct()
    code = F.encode("pattern", "UTF-8")
    return settled(wanted.select("pattern", *scope, F.substring(code, 1, RUN).alias("run"), (F.octet_length("pattern") <= RUN).alias("whole")))


def substrings(patterns: DataFrame, bodies: DataFrame, key: str = "index", sample: int | None = None, scope: str | None = None) -> DataFrame:
    """Pairs (pattern, key) of the distinct patterns (pattern) and the bodies (key, body) that have them anywhere, byte for byte.

    Each pattern is looked up by its first RUN bytes, which meet the runs of the bodies by equality; a body is fetched again
    only for longer patterns. Empty and null patterns are in no body. With a scope, a whole number that both have, only bodies of the same scope are looked at.
    sample is of no effect: nothing is chosen by a sample of bodies any more.
    """
    by = [scope] if scope else []
    wanted = _looked_up(patterns, *by)
    met = runs_of(wanted.select("run", *by).distinct(), bodies, key, scope).join(wanted, ["run", *by])
    long = met.where("not whole").groupBy(key, *by).agg(F.collect_set("pattern").alias("p"))  # no more than a body has different runs
    found = bodies.select(key, "body", *by).join(long, [key, *by]).select(key, *by, F.explode(F.filter("p", lambda p: F.contains("body", p))).alias("pattern"))
    return met.where("whole").select("pattern", key, *by).unionByName(found.select("pattern", key, *by))


def places(patterns: DataFrame, bodies: DataFrame, key: str = "index") -> DataFrame:
    """(pattern, least, greatest): the least and greatest key of the bodies that have each pattern, of those that any has.

    As ``substrings``, but what a task finds is folded by pattern before it is shuffled, so frequent patterns stay small.
    """
    wanted = _looked_up(patterns)
    runs = runs_of(wanted.select("run").distinct(), bodies, key)
    ends = [F.min(key).alias("least"), F.max(key).alias("greatest")]
    whole = runs.groupBy("run").agg(*ends).join(wanted.where("whole"), "run").select("pattern", "least", "greatest")
    long = wanted.where("not whole")
    if long.limit(1).count():
        whole = whole.unionByName(substrings(long.select("pattern"), bodies, key).groupBy("pattern").agg(*ends))
    return whole


def _flat(c: str) -> Column:
    """The words of a text in capitals, between single blanks."""
    return F.trim(F.regexp_replace(F.upper(F.col(c)), "[^A-Z0-9]+", " "))


def _wanted_runs(terms: DataFrame, term: str) -> DataFrame:
    return settled(terms.select(term).distinct().withColumn("run", _flat(term)).where(F.length("run") > 0))


def containing(terms: DataFrame, bodies: DataFrame, term: str = "term", body: str = "body", key: str = "index") -> DataFrame:
    """Pairs (term, key) of a term and the bodies that have it as a run of whole words."""
    t = _wanted_runs(terms, term)
    runs = word_runs_of(t.select("run").distinct(), bodies.select(key, _flat(body).alias("body")), key)
    return runs.join(t, "run").select(term, key)


def first_containing(terms: DataFrame, bodies: DataFrame, term: str = "term", body: str = "body", key: str = "index") -> DataFrame:
    """(term, key): the least key of the bodies that ``containing`` finds for a term; folded by run before the shuffle."""
    t = _wanted_runs(terms, term)
    runs = word_runs_of(t.select("run").distinct(), bodies.select(key, _flat(body).alias("body")), key)
    return runs.groupBy("run").agg(F.min(key).alias(key)).join(t, "run").select(term, key)


def neighbours(df: DataFrame, order: list[str], value: str, *by: str) -> DataFrame:
    """The nearest known value before and after each row, in order within each group.

    Both frames begin at an end of the group and grow by a row, so a group is read twice whatever its size.
    """
    forth, back = W.partitionBy(*by).orderBy(*order), W.partitionBy(*by).orderBy(*(F.col(c).desc() for c in order))
    last = lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn("before", last(forth)).withColumn("after", last(back))


def band(left: DataFrame, right: DataFrame, a: str, b: str, width: int) -> DataFrame:
    """Pairs with |a - b| <= width, as an equality join on the bands of a."""
    spread = left.withColumn("_k", F.explode(F.sequence(F.col(a) - width, F.col(a) + width)))
    return spread.join(right.withColumn("_k", F.col(b)), "_k").drop("_k")


def line_start(terms: DataFrame, lines: DataFrame, most_pages: int = 3) -> DataFrame:
    """Pages on which a line begins with a term and '.', ',' or its end; terms on more than ``most_pages`` pages go.

    The first two words are the key of the join, of a term of one word that word; the whole term is then compared.
    """
    begin = lambda c, n: F.regexp_extract(F.upper(F.col(c)), r"^\s*([A-Z0-9]+" + r"[^A-Z0-9]+[A-Z0-9]+" * (n - 1) + ")", 1)
    t = terms.withColumn("_k", F.when(begin("term", 2) != "", begin("term", 2)).otherwise(begin("term", 1))).where("_k <> ''")
    keys = F.array_distinct(F.filter(F.array(begin("line", 1), begin("line", 2)), lambda k: k != ""))
    x = lines.withColumn("_k", F.explode(keys))
    rest = F.expr("substring(upper(ltrim(line)), length(term) + 1, 1)")
    met = t.join(x, "_k").where(F.startswith(F.upper(F.ltrim("line")), F.col("term")) & rest.isin(".", ",", ""))
    pages = met.groupBy("term").agg(F.array_sort(F.collect_set("page")).alias("pages"))
    return pages.where(F.size("pages") <= most_pages)


def scan_in_order(wanted: DataFrame, strategies: list[DataFrame]) -> DataFrame:
    """The first place that any strategy finds a term: least (place, strategy number) (J13); each has (term, place)."""
    found = reduce(DataFrame.unionByName, (s.select("term", "place", F.lit(i).alias("strategy")) for i, s in enumerate(strategies)))
    best = found.groupBy("term").agg(F.min(F.struct("place", "strategy")).alias("b"))
    return wanted.join(best, "term", "left").select("term", F.col("b.place").alias("place"), F.col("b.strategy").alias("strategy"))


def longest_prefix(refs: DataFrame, heads: DataFrame, phrase: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """The longest beginning of a phrase, in whole words, that is a headword; with the words left over.

    refs has ref_id and the phrase; heads has term in upper case. Beginnings of one character and stop words do not count.
    """
    words = F.filter(F.split(F.regexp_replace(F.col(phrase), r"[,;:\s]+$", ""), r"\s+"), lambda w: w != "")
    cut = refs.withColumn("words", words).where(F.size("words") > 0)
    each = cut.select("ref_id", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("n"))
    each = each.withColumn("term", F.upper(F.expr("array_join(slice(words, 1, n), ' ')"))).where((F.length("term") >= 2) & ~F.col("term").isin(*stop, ""))
    found = each.join(heads.select("term").distinct(), "term").groupBy("ref_id").agg(F.max(F.struct("n", "term", F.expr("array_join(slice(words, n + 1, size(words)), ' ')").alias("rest"))).alias("m"))
    return found.select("ref_id", F.col("m.term").alias("target"), F.col("m.rest").alias("rest"))


def longest_phrase(refs: DataFrame, heads: DataFrame, phrase: str, stop: tuple[str, ...] = (), right_first: bool = True) -> DataFrame:
    """The longest run of a phrase's words that is a headword, the right-most of equals."""
    words = F.filter(F.split(F.regexp_replace(F.col(phrase), r"[,;:.\s]+$", ""), r"\s+"), lambda w: w != "")
    cut = refs.withColumn("words", words).where(F.size("words") > 0)
    each = cut.select("ref_id", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("n"))
    each = each.select("ref_id", "words", "n", F.explode(F.expr("sequence(1, size(words) - n + 1)")).alias("at"))
    each = each.withColumn("term", F.upper(F.expr("array_join(slice(words, at, n), ' ')"))).where((F.length("term") >= 2) & ~F.col("term").isin(*stop, ""))
    at = F.col("at") if right_first else -F.col("at")
    found = each.join(heads.select("term").distinct(), "term").groupBy("ref_id").agg(F.max(F.struct("n", at.alias("at"), "term")).alias("m"))
    return found.select("ref_id", F.col("m.term").alias("target"))


def closest(pairs: DataFrame, key: str, gap: Column, *ties: str) -> DataFrame:
    """The pair of least gap for each key, ties by the columns named."""
    rest = [c for c in pairs.columns if c != key]
    best = pairs.groupBy(key).agg(F.min(F.struct(gap.alias("_gap"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(ties)), *rest)).alias("_b"))
    return best.select(key, *(F.col(f"_b.{c}").alias(c) for c in rest))


def fallback(left: DataFrame, keys: list[str], right: DataFrame, rkey: str, value: str) -> DataFrame:
    """value of the first of several keys that right has (J17); right has one row a key."""
    out = left
    for i, k in enumerate(keys):
        out = out.join(right.select(F.col(rkey).alias(f"_k{i}"), F.col(value).alias(f"_v{i}")), F.col(k) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    return out.withColumn(value, F.coalesce(*(f"_v{i}" for i in range(len(keys))))).drop(*(f"_v{i}" for i in range(len(keys))))


def is_subentry(parent: Column, head: Column) -> Column:
    """Whether a headword belongs to an entry: its beginning, or the same first word of four letters or more."""
    first = lambda c: F.regexp_extract(c, "^[A-Z]+", 0)
    return F.startswith(head, F.concat(parent, F.lit(" "))) | F.startswith(head, F.concat(parent, F.lit(","))) | ((first(parent) == first(head)) & (F.length(first(head)) >= 4))
