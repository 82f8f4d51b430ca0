"""Toxicity by multiple-instance learning (operator 3).

A document is a bag of sentences. A sentence's score is a logistic function of its words'
features, and the document's score is the noisy-or of its sentences' scores. Only document
labels train it: the gradient of the bag's likelihood reaches each sentence in proportion to
its own share of the blame. The same sentence scores then locate the offending sentences.

Features of a word (lower case, outer punctuation removed): the word and its beginnings of
PREFIXES letters. Those kept are in at least LEAST toxic sample documents (and 1 in 100 of them) and more frequent
there; at most FEATURES of them, so that the model, which is broadcast, has a fixed bound.
Training reads a bounded sample of labelled documents (SAMPLE rows and SAMPLE_BYTES of text, smallest hashes).
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, first_ids, fold

SAMPLE, FEATURES, LEAST, STEPS, RIDGE = 8_000, 4096, 3, 200, 1e-4
PREFIXES, THRESHOLD, OFFENDING = (3, 4, 5, 6, 8), 0.3, 0.3
FOLDS, HELD = 4, 2
_OUTER = ".,;:!?\"'()[]|*#$%&<>-_"
_SENTENCES = re.compile(r"[^.!?\n]+(?:[.!?]+|\n|$)|[.!?\n]+")
_CACHE = 300_000


def features(word: str) -> list[str]:
    """Feature names of one white-space separated word."""
    bare = word.lower().strip(_OUTER)
    if not bare:
        return []
    return ["=" + bare, *(bare[:k] for k in PREFIXES if len(bare) >= k)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Begin and end of each sentence that has a word: up to and with . ! ? or a line end."""
    return [m.span() for m in _SENTENCES.finditer(text) if not m.group().isspace()]


class _Weights(dict):
    """Summed weight of a word, worked out when first seen; emptied when it holds _CACHE words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= _CACHE:
            self.clear()
        w = self.model.weights
        out = self[word] = float(sum(w[f] for f in features(word) if f in w))
        return out


@dataclasses.dataclass
class Model:
    """Feature weights and the bias of a sentence."""

    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self.words = _Weights(self)

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def sentence_scores(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of the sentences and the score of each."""
        spans = sentences(text)
        sums = np.array([sum(map(self.words.__getitem__, text[a:b].split())) for a, b in spans], float)
        return spans, _logistic(self.bias + sums)

    def score(self, text: str | None) -> float:
        """Noisy-or over all sentences of the whole text; of null or empty texts that of no sentence: 0."""
        text = text or ""
        if not any(map(self.words.__getitem__, text.split())):  # no word weighs anything: all sentences score alike
            n = len(sentences(text))
            return float(-np.expm1(n * np.log1p(-_logistic(self.bias))))
        _, p = self.sentence_scores(text)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-9)).sum()))


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Model:
    """Maximises the noisy-or likelihood by Adam over all bags at once; without both labels the score is the label's share."""
    share = labels.mean() if len(labels) else 0.0
    if not len(labels) or share in (0.0, 1.0):
        return Model({}, -20.0 if share < 1 else 20.0)
    least = max(LEAST, int(labels.sum() / 100))
    # Only features of enough toxic texts are counted in the others, so few of the sample's words are held.
    found_in = lambda text: {f for w in set(text.split()) for f in features(w)}
    toxic, all_docs = Counter(), Counter()
    for text, y in zip(texts, labels):
        if y:
            toxic.update(found_in(text))
    toxic = Counter({f: n for f, n in toxic.items() if n >= least})
    for text in texts:
        all_docs.update(f for f in found_in(text) if f in toxic)
    gain = {f: n * np.log(n / (all_docs[f] * share)) for f, n in toxic.items() if n > 1.5 * all_docs[f] * share}
    names = sorted(gain, key=lambda f: (-gain[f], f))[:FEATURES]
    index = {f: k for k, f in enumerate(names)}
    words: dict[str, tuple[int, ...]] = {}

    def kept(word: str) -> tuple[int, ...]:
        if word not in words:
            if len(words) >= _CACHE:
                words.clear()
            words[word] = tuple(index[f] for f in features(word) if f in index)
        return words[word]

    # Sentences without a kept feature differ only in number; the others are rows of (bag, features).
    bag, row, col, plain = [], [], [], np.zeros(len(texts))
    for b, text in enumerate(texts):
        for a, e in sentences(text):
            has = {k for w in text[a:e].split() for k in kept(w)}
            if has:
                row += [len(bag)] * len(has)
                col += has
                bag.append(b)
            else:
                plain[b] += 1
    bag, row, col = np.array(bag, np.int64), np.array(row, np.int64), np.array(col, np.int64)
    k, n = len(names), len(texts)
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    w[k] = -6.0
    # The prior is a fraction of the log odds by document: a word that never comes alone still counts.
    prior = np.array([0.4 * max(0.0, np.log((toxic[f] + 0.5) / (all_docs[f] - toxic[f] + 0.5))) for f in names])
    w[:k] = prior
    for t in range(1, steps + 1):
        z = w[k] + np.bincount(row, w[col], len(bag))
        p, p0 = _logistic(z), _logistic(w[k])
        log_clean = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-9)), n) + plain * np.log1p(-p0)
        total = -np.expm1(log_clean)
        # d log-likelihood / d log_clean: 1 for clean bags, -(1 - P) / P for toxic ones; d log(1 - p) / dz = -p.
        back = np.where(labels > 0, -np.exp(log_clean) / np.maximum(total, 1e-9), 1.0)
        gz = -p * back[bag]
        g = np.bincount(col, gz[row], k)
        g = np.append(g, gz.sum() - p0 * (plain * back).sum()) / n
        g[:k] -= RIDGE * (w[:k] - prior)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    keep = {f: float(x) for f, x in zip(names, w) if abs(x) > 0.02}
    return Model(keep, float(w[k]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of label toxic from rows outside the held-out fold; repeated labels of an id count as their greatest."""
    known = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id"), FOLDS) != HELD)
    chosen = first_ids(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")), sample)
    # Bounded by `sample` rows of two numbers, hence the broadcast; an id may have any number of rows.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    got = bounded_sample(rows, sample).select("text", "label").toArrow().to_pydict()
    order = sorted(range(len(got["label"])), key=lambda k: (got["text"][k], got["label"][k]))  # the same sums in every run
    return fit([got["text"][k] for k in order], np.array([got["label"][k] for k in order], float))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs (whatever columns, doc_id and text among them) with held_out, score, predicted and offending.

    offending: the sentences (begin and end in code points, score) with score >= OFFENDING. held_out is null for null ids.
    Columns of docs with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = ("held_out", "score", "predicted", "offending")
    kept = [c for c in docs.columns if c not in new]
    frame = docs.select(*(F.col(f"`{c}`") for c in kept))
    where = kept.index("text")
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema), "score double", "predicted int", "offending array<struct<begin:int,end:int,score:double>>"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for b in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                scores, found = [], []
                for text in b.column(where).to_pylist():
                    scores.append(model.score(text))
                    at, p = model.sentence_scores(text) if scores[-1] >= threshold else ([], [])
                    found.append([{"begin": a, "end": e, "score": float(x)} for (a, e), x in zip(at, p) if x >= OFFENDING])
                columns = [*b.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(found, spans)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new[1:]])

    out = frame.mapInArrow(each, schema)
    return out.withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD)
