"""Quality rules (operator 7): base statistics and gradient-boosted trees with monotonic constraints.

The trees are fitted to ``labels.quality`` on a bounded sample of labelled documents (SAMPLE
rows, the smallest hashes of doc_id), by logistic loss on quantile bins, on the driver. They
are flattened into numpy node arrays and score a batch of documents level by level. On chosen
features (repetition, symbols, duplicate lines) the score never rises with the feature.
Every document's statistics come from its whole text.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, first_ids

SAMPLE, TREES, DEPTH, BINS, RATE, THRESHOLD = 20_000, 60, 4, 64, 0.2, 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Only 13 numbers of a sampled text reach the driver, so its length has a bound of its own.
QUALITY_LONGEST = 1 << 24
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Derived features and the direction in which the score may move with each (-1: never up, 0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0, "digit_share": 0,
    "punct_share": 0, "distinct_share": 0, "line_words": 0, "long_word_share": 0, "non_ascii_share": 0, "common_word_share": 0,
}
_UPPER, _DIGITS, _PUNCT = bytes(range(65, 91)), b"0123456789", b".,;:!?\"'()-"


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """BASE and FEATURES of one whole text; null counts as empty.

    Words and repeats are told apart by 64-bit hashes of their bytes, which are the same for the same bytes.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # on ASCII white space only
    n = len(words)
    if not n:
        return [0] * len(BASE), [0.0] * len(FEATURES)
    joined = b"".join(words)
    continued = len(joined) - len(joined.translate(None, bytes(range(0x80, 0xC0))))
    chars = len(joined) - continued
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
            lines += 1
        elif line and not line.isspace():
            seen.add(line)
            lines += 1
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n)
    repeated = 0
    if n > WINDOW:
        grams = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + (ids[k : n - WINDOW + 1 + k] ^ (ids[k : n - WINDOW + 1 + k] >> np.uint64(29)))
        _, where, counts = np.unique(grams, return_inverse=True, return_counts=True)
        at = np.nonzero(counts[where] > 1)[0]
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW, -1)
        repeated = int((np.cumsum(edges)[:n] > 0).sum())
    share = lambda kind: (len(joined) - len(joined.translate(None, kind))) / len(joined)
    values, freq = np.unique(ids, return_counts=True)
    return [n, chars, symbols, dup, repeated], [
        float(np.log1p(n)), chars / n, symbols / chars, dup / max(lines, 1), repeated / n, share(_UPPER), share(_DIGITS),
        share(_PUNCT), len(values) / n, n / max(lines, 1), float((sizes > 16).mean()), continued / chars, float(freq.max() / n),
    ]


@dataclasses.dataclass
class Trees:
    """Flattened trees: node k of tree t goes left if x[feature] <= cut, children at 2k + 1 and 2k + 2; value at the last level."""

    feature: np.ndarray  # (trees, nodes) int
    cut: np.ndarray  # (trees, nodes) float
    value: np.ndarray  # (trees, leaves) float
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of x."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:  # all rows are at the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            total += value[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, least: float = 1.0) -> Trees:
    """Boosts logistic loss. A split on a constrained feature must order its sides' values, and passes the middle on as a bound."""
    inner, leaves = 2**depth - 1, 2**depth
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), base)
    if not len(y) or y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        at, low, high = np.zeros(len(y), np.int64), {0: -np.inf}, {0: np.inf}
        for k in range(inner):
            mine = np.nonzero(at == k)[0]
            lo, hi = low[k], high[k]
            best = (1e-9, None)
            mean = lambda gs, hs: np.clip(gs / (hs + least), lo, hi)  # noqa: E731, B023
            gain = lambda gs, hs, v: gs * v - 0.5 * (hs + least) * v * v
            if len(mine) >= 20:
                whole = gain(g[mine].sum(), h[mine].sum(), mean(g[mine].sum(), h[mine].sum()))
                for j, c in enumerate(cuts):
                    gl = np.cumsum(np.bincount(binned[mine, j], g[mine], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[mine, j], h[mine], len(c) + 1))[:-1]
                    nl = np.cumsum(np.bincount(binned[mine, j], minlength=len(c) + 1))[:-1]
                    gr, hr = g[mine].sum() - gl, h[mine].sum() - hl
                    vl, vr = mean(gl, hl), mean(gr, hr)
                    won = gain(gl, hl, vl) + gain(gr, hr, vr) - whole
                    won[(nl < 5) | (len(mine) - nl < 5) | (monotone[j] * (vr - vl) < 0)] = -1
                    if won.size and won.max() > best[0]:
                        i = int(won.argmax())
                        best = (won[i], (j, c[i], i, (vl[i] + vr[i]) / 2))
            left, right = 2 * k + 1, 2 * k + 2
            low[left] = low[right] = lo
            high[left] = high[right] = hi
            if best[1]:
                j, c, i, mid = best[1]
                out.feature[t, k], out.cut[t, k] = j, c
                if monotone[j] < 0:
                    low[left], high[right] = mid, mid
                elif monotone[j] > 0:
                    high[left], low[right] = mid, mid
                at[mine] = np.where(binned[mine, j] <= i, left, right)
            else:
                at[mine] = left
        for leaf in range(leaves):
            mine = at == inner + leaf
            if mine.any():
                out.value[t, leaf] = rate * np.clip(g[mine].sum() / (h[mine].sum() + least), low[inner + leaf], high[inner + leaf])
            else:
                out.value[t, leaf] = rate * np.clip(0, low[inner + leaf], high[inner + leaf])
        total += out.value[t][at - inner]
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for the label quality, from at most ``sample`` labelled documents; repeated labels of an id count as their least."""
    chosen = first_ids(labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label")), sample)
    # Bounded by `sample` rows of two numbers, hence the broadcast; an id may have any number of rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = bounded_sample(rows, sample, longest=QUALITY_LONGEST, most_bytes=sample * QUALITY_LONGEST)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statistics(t)[1] for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], names=["label", "x"])

    got = rows.select("label", "text").mapInArrow(each, "label int, x array<double>").toArrow()
    y = np.array(got.column("label").to_pylist(), float)
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, y])  # the same sums in every run
    return fit(x[order], y[order], np.array([*FEATURES.values()]))


def score(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """docs (whatever columns, text among them) with BASE, base_failed, score and kept.

    kept: the base rules pass and the trees' probability of good quality is at least ``threshold``.
    Columns of docs with these names are replaced.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    names = ("base_failed", "score", "kept")
    kept_names = [c for c in docs.columns if c not in (*BASE, *names)]
    frame = docs.select(*(F.col(f"`{c}`") for c in kept_names))
    where = kept_names.index("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema), *(f"{c} long" for c in BASE), "base_failed boolean", "score double", "kept boolean"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                both = [statistics(t) for t in b.column(where).to_pylist()]
                base = np.array([s for s, _ in both], np.int64)
                p = shared.value.score(np.array([x for _, x in both], float))
                failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
                columns = [*b.columns, *(pa.array(c) for c in base.T), pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept_names, *BASE, *names])

    return frame.mapInArrow(each, schema)
