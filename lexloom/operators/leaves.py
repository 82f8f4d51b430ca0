"""Terms looked for on the pages of their leaves, all terms of a leaf at once; what follows them there."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import settled

#: Pages of a leaf that are looked at together, and characters of them at a time.
PAGES, BLOCK = 256, 1 << 20
#: Up to so many leaves their counts, some bytes each, are broadcast.
FEW = 1 << 16
#: White space as Java has it, and what is taken off before a body.
BLANK, LEAD = " \t\n\x0b\f\r", ".,;:-— \t\n\x0b\f\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _small(text: str) -> np.ndarray:
    """A byte for each character, its own one if it is ASCII."""
    return np.frombuffer(text.encode(), np.uint8) if text.isascii() else _codes(text).astype(np.uint8)


def _windows(data: np.ndarray, width: int) -> np.ndarray:
    """The numbers that width bytes make from each place on."""
    kind, padded = f"<u{width}", data.tobytes() + bytes(8)
    out = np.empty(len(data), kind)
    for o in range(min(width, len(data))):
        out[o::width] = np.frombuffer(padded, kind, len(out[o::width]), o)
    return out


def all_places(data: np.ndarray, wanted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the wanted bytes, place): everywhere in data that any of them stands, or seems to at its end; none is empty.

    They are met by their first 8, 4, 2 or 1 bytes, as many as they have, and then compared by as many at a time.
    """
    sizes, n = np.array([len(w) for w in wanted], np.int64), len(data)
    found = [(np.zeros(0, np.int64),) * 2]
    for width, below in ((8, 1 << 62), (4, 8), (2, 4), (1, 2)):
        own = np.flatnonzero((sizes >= width) & (sizes < below))
        if not len(own) or n < width:
            continue
        w, kind = _windows(data, width), f"<u{width}"
        at_byte = lambda off: np.array([int.from_bytes(wanted[k][(q := max(0, min(off, len(wanted[k]) - width))) : q + width], "little") for k in own], kind)  # noqa: B023, E731
        head = at_byte(0)
        order = np.argsort(head, kind="stable")
        own = own[order]
        keys, first, count = np.unique(head[order], return_index=True, return_counts=True)
        bits = 8 * width if width < 4 else int(np.clip(np.ceil(np.log2(64 * len(keys))), 12, 20))
        coded = (lambda x: x) if width < 4 else (lambda x: (x.astype(np.uint64) * _MIX) >> np.uint64(64 - bits))  # noqa: B023, E731
        table = np.zeros(1 << bits, bool)
        table[coded(keys)] = True
        at = np.flatnonzero(table[coded(w)])
        k = np.minimum(np.searchsorted(keys, w[at]), len(keys) - 1)
        same = keys[k] == w[at]
        at, k = at[same], k[same]
        row = np.repeat(np.arange(len(at)), count[k])
        k, at = first[k][row] + np.arange(len(row)) - np.repeat(np.cumsum(count[k]) - count[k], count[k]), at[row]
        for off in range(width, int(sizes[own].max()), width):
            rest, size = at_byte(off), sizes[own][k]
            to = at + np.minimum(off, size - width)
            fits = (size <= off) | (to < n) & (w[np.minimum(to, n - 1)] == rest[k])
            at, k = at[fits], k[fits]
        found.append((own[k], at))
    return tuple(np.concatenate(x) for x in zip(*found))


def stops(text: str) -> list[int]:
    """Where lines in capitals of more than three characters begin."""
    out, at = [], 0
    for line in text.rstrip(BLANK).split("\n"):
        bare = line.strip(" ")
        if len(bare) > 3 and bare == bare.upper():
            out.append(at)
        at += len(line) + 1
    return out


def body_from(text: str, at: int) -> tuple[int, int]:
    """The ends of the body that begins at a place of a text, as ``body_after`` cuts it."""
    first = at + len(text[at:]) - len(text[at:].lstrip(BLANK))
    cut = next((s for s in stops(text) if s > first), len(text))
    end = max(first, len(text[:cut].rstrip(BLANK)))
    return first + len(text[first:end]) - len(text[first:end].lstrip(LEAD)), end


def longest_bodies(terms: list[tuple[str, str]], pages: list[tuple[str, str]], least: int) -> dict[int, tuple[int, int]]:
    """For each term (with its capitals) the size of its longest body in pages (with their capitals), and the page, of those of more than least characters.

    Keys are the numbers of the terms. Of equally long bodies the greatest counts. The work goes by characters and places, not by pairs.
    """
    best: dict[int, tuple[int, int, int, int]] = {}

    def take(k: int, page: int, start: int, end: int) -> None:
        old, size = best.get(k), end - start
        if size > least and (not old or size > old[0] or size == old[0] and pages[page][0][start:end] > pages[old[1]][0][old[2] : old[3]]):
            best[k] = size, page, start, end

    lengths = np.array([len(t) for t, _ in terms], np.int64)
    wanted = [_small(u).tobytes() for _, u in terms]
    whole = [k for k, w in enumerate(wanted) if w]
    alike = [p for p, (text, upper) in enumerate(pages) if text and len(text) == len(upper)]
    for p in sorted(set(range(len(pages))) - set(alike)):  # capitals of more characters: places differ
        for k, (t, u) in enumerate(terms):
            if (at := pages[p][1].find(u)) >= 0:
                take(k, p, *body_from(pages[p][0], at + len(t)))
    empty = [k for k, w in enumerate(wanted) if not w]
    for p in alike if empty else ():
        ends_ = body_from(pages[p][0], 0)
        for k in empty:
            take(k, p, *ends_)

    def block(own: list[int]) -> None:
        upper = "".join(pages[p][1] for p in own)
        data, sure = _small(upper), upper.isascii()
        codes = data if sure else _codes(upper)
        ends = np.cumsum([len(pages[p][0]) for p in own])
        starts = np.append(0, ends[:-1])
        k, at = all_places(data, [wanted[x] for x in whole])
        k = np.array(whole, np.int64)[k]
        page = np.searchsorted(starts, at, "right") - 1
        fits = at + np.array([len(w) for w in wanted])[k] <= ends[page]
        if not (sure and all(terms[x][1].isascii() for x in whole)):
            fits &= np.fromiter((upper.startswith(terms[x][1], y) for x, y in zip(k.tolist(), at.tolist())), bool, len(k))
        k, at, page = k[fits], at[fits], page[fits]
        order = np.lexsort((at, page, k))
        k, at, page = k[order], at[order], page[order]
        first = np.append(True, (k[1:] != k[:-1]) | (page[1:] != page[:-1]))[: len(k)]
        k, at, page = k[first], at[first], page[first]
        if not len(k):
            return
        solid, meant = (np.append(np.flatnonzero(~np.isin(codes, _codes(x))), len(data)) for x in (BLANK, LEAD))
        cuts = np.sort(np.concatenate([ends, [len(data) + 1], *(np.array(stops(pages[p][0]), np.int64) + s for p, s in zip(own, starts))]))
        last = ends[page]
        start = np.minimum(solid[np.searchsorted(solid, np.minimum(at + lengths[k], last))], last)
        cut = np.minimum(cuts[np.searchsorted(cuts, start, "right")], last)
        end = np.maximum(np.append(solid, -1)[np.searchsorted(solid, cut) - 1] + 1, start)
        start = np.minimum(meant[np.searchsorted(meant, start)], end)
        size = end - start
        groups = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        top = np.repeat(np.maximum.reduceat(size, groups), np.diff(np.append(groups, len(k))))
        some = np.flatnonzero((size == top) & (size > least))
        for x, p, s, e in zip(k[some].tolist(), page[some].tolist(), start[some].tolist(), end[some].tolist()):
            take(x, own[p], s - int(starts[p]), e - int(starts[p]))

    now, held = [], 0
    for p in alike:
        now.append(p)
        held += len(pages[p][0])
        if held >= BLOCK:
            block(now)
            now, held = [], 0
    if now:
        block(now)
    return {k: (size, p) for k, (size, p, _, _) in best.items()}


def longest_on_pages(leaves: DataFrame, pages: DataFrame, least: int) -> DataFrame:
    """(leaf, term, page_size, page): the size of each term's longest body on a page of its leaf, and the pages, by their hashes, that may have it.

    leaves: leaf, term; pages: leaf, text, page (a hash of the text). A leaf's pages are dealt out by hash, PAGES to a group on average, and its
    terms to each group; bodies stay where they are.
    """
    groups = settled(pages.groupBy("leaf").agg(F.ceil(F.count("*") / PAGES).alias("groups")))
    if groups.count() <= FEW:  # so texts are dealt out once
        groups = F.broadcast(groups)
    terms = leaves.select("leaf", "term").distinct().join(groups, "leaf")
    terms = terms.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("nth"), "term", F.upper("term").alias("upper"))
    # Capitals of ASCII are made here and there alike.
    upper = F.when(F.length("text") != F.octet_length("text"), F.upper("text")).alias("upper")
    texts = pages.join(groups, "leaf").select("leaf", F.pmod("page", "groups").alias("nth"), "page", "text", upper)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        named = list(zip(left.column("term").to_pylist(), left.column("upper").to_pylist()))
        seen, own = set(), []
        hashes = right.column("page").to_pylist()
        for h, t, u in zip(hashes, right.column("text").to_pylist(), right.column("upper").to_pylist()) if named else ():
            if t is not None and t not in seen:
                seen.add(t)
                own.append((t, t.upper() if u is None else u, h))
        got = longest_bodies(named, [x[:2] for x in own], least) if own else {}
        leaf = left.column("leaf")[0].as_py() if got else None
        rows = {"leaf": [leaf] * len(got), "term": [named[k][0] for k in got], "page_size": [s for s, _ in got.values()], "page": [own[p][2] for _, p in got.values()]}
        return pa.table(rows, pa.schema([("leaf", pa.int32()), ("term", pa.string()), ("page_size", pa.int32()), ("page", pa.int64())]))

    by = ["leaf", "nth"]
    found = terms.groupBy(*by).cogroup(texts.groupBy(*by)).applyInArrow(each, "leaf int, term string, page_size int, page long")
    best = found.groupBy("leaf", "term").agg(F.max("page_size").alias("page_size"), F.collect_list(F.struct("page_size", "page")).alias("each"))  # one a group at most
    return best.select("leaf", "term", "page_size", F.expr("transform(filter(each, x -> x.page_size = page_size), x -> x.page)").alias("page"))
