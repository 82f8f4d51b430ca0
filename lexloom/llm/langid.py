"""Language identification of mixed text (operator 4).

Letters are put into scripts by code point ranges, and a word's script leaves only the languages
that the training texts write in it. A word is a run without white space; one of more than PIECE characters
(a text of a script without blanks is such a run) counts as several: it is cut where the script
changes, and after PIECE characters. Per word, each of these gets the log-probability of the word's
character 1- to 3-grams (smoothed, with word ends marked) and of the word itself if it is common
enough. Viterbi over the words, with a penalty for each switch of language, labels the spans of a
text; the text's language is the one with the most letters in its spans.

Trained on a bounded sample of labelled rows outside the held-out fold (SAMPLE documents and SAMPLE_BYTES of
text, smallest hashes, each whole), with at most GRAMS n-grams and WORDS words kept.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold

SAMPLE, GRAMS, WORDS, LEAST_WORD = 3_000, 60_000, 20_000, 3
PENALTY, FOLDS, HELD, UNKNOWN = 6.0, 3, 1, "und"
_OUTER = ".,;:!?\"'()[]|*#$%&<>-_=+/\\0123456789"
_CACHE, _LANES, PIECE = 200_000, 128, 32
#: Words of texts that are labelled side by side, counted with the padding; longer texts are labelled alone.
_CELLS, _BATCH_CHARS = 1 << 19, 1 << 21

#: Scripts by their ranges of code points (fixed values, ascending); letters elsewhere are of no known script.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
_FIRST = np.array([a for _, a, _ in SCRIPTS])


@lru_cache(1 << 16)
def script(letter: str) -> str | None:
    """The script of one letter."""
    k = int(np.searchsorted(_FIRST, ord(letter), side="right")) - 1
    return SCRIPTS[k][0] if k >= 0 and ord(letter) <= SCRIPTS[k][2] else None


def scripts(word: str) -> set[str | None]:
    """Scripts of a word's letters."""
    if word.isascii():
        return {"latin"} if any(map(str.isalpha, word)) else set()
    return {script(c) for c in word if c.isalpha()}


def words_of(text: str) -> list[str]:
    """The words of a text, long ones in pieces."""
    found = text.split()
    if max(map(len, found), default=0) <= PIECE:
        return found
    return [p for w in found for p in (pieces(w) if len(w) > PIECE else (w,))]


def pieces(word: str) -> Iterator[str]:
    """Parts of a word of one script each (what is no letter goes with what is before it), of PIECE characters at most."""
    begin, now = 0, None
    for k, c in enumerate(word):
        new = (("latin" if c.isascii() else script(c)) if c.isalpha() else now) or now
        if k - begin == PIECE or (now is not None and new != now):
            yield word[begin:k]
            begin = k
        now = new
    yield word[begin:]


def grams(word: str) -> list[str]:
    """Character 1- to 3-grams of a lower-case word, with its ends marked."""
    marked = f"\x02{word}\x03"
    return [marked[i : i + k] for k in (1, 2, 3) for i in range(len(marked) - k + 1)]


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all words as numbers (code points of 21 bits side by side), and the word that each is of."""
    points = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    out, of, code = [points], [word], points
    for k in (1, 2):
        code = (code[:-1] << np.uint64(21)) | points[k:]
        inside = word[k:] == word[: len(code)]
        out.append(code[inside])
        of.append(word[k:][inside])
    return np.concatenate(out), np.concatenate(of)


@dataclasses.dataclass
class Model:
    """Log-probabilities by n-gram and word (rows of matrices, a column a language), and each script's languages.

    The last row of ``gram_scores`` is that of unseen n-grams, the last of ``word_scores`` is zero.
    """

    languages: list[str]
    grams: np.ndarray  # codes, ascending
    gram_scores: np.ndarray
    words: dict[str, int]
    word_scores: np.ndarray
    allowed: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        self._forget()

    def __reduce__(self):
        return Model, (self.languages, self.grams, self.gram_scores, self.words, self.word_scores, self.allowed)

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)
        self.told = np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        """Scores of new words: best 0; words without letters, or of scripts no language is written in, speak for none."""
        none = len(self.words)
        lows, exact, masks, letters = [], [], [], []
        for word in words:
            low = word.lower().strip(_OUTER)
            letters.append(len(word) if word.isalpha() else sum(map(str.isalpha, word)))
            may = np.zeros(len(self.languages), bool)
            if letters[-1] and low:
                for x in scripts(low):
                    may |= self.allowed.get(x, False)
            masks.append(may)
            lows.append(low)
            exact.append(self.words.get(low, none))
        may = np.array(masks)
        code, of = codes(lows)
        at = np.searchsorted(self.grams, code)
        at = np.where(np.append(self.grams, 0)[at] == code, at, len(self.grams))
        sums = [np.bincount(of, column[at], len(words)) for column in self.gram_scores.T]
        out = np.stack(sums, axis=1) / 2 + self.word_scores[exact]
        out = np.where(may, out, -np.inf)
        out = np.where(may.any(axis=1)[:, None], np.maximum(out - out.max(axis=1, keepdims=True, initial=-1e9), -50.0), 0.0)
        self.row.update(zip(words, range(len(self.row), len(self.row) + len(words))))
        self.scores = np.concatenate([self.scores, out.astype(np.float32)])
        self.letters = np.concatenate([self.letters, np.array(letters, np.int64)])
        self.told = np.concatenate([self.told, may.any(axis=1)])

    def look_up(self, texts: list[list[str]]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Letters and scores of the words of each text, and whether they are of a script that some language has."""
        if len(self.row) > _CACHE:
            self._forget()
        new = list({w for ws in texts for w in ws if w not in self.row})
        if new:
            self._learn(new)
        rows = [np.fromiter(map(self.row.__getitem__, ws), np.int64, len(ws)) for ws in texts]
        return [self.letters[r] for r in rows], [self.scores[r] for r in rows], [self.told[r] for r in rows]


def fit(texts: list[str], langs: list[str]) -> Model:
    """Counts n-grams and words by language; languages weigh alike whatever their share of the sample."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((1, 0)), {}, np.zeros((1, 0)), {})
    at = {x: k for k, x in enumerate(languages)}
    counts = [Counter() for _ in languages]
    seen: list[dict[str, int]] = [{} for _ in languages]
    for text, lang in zip(texts, langs):
        counts[at[lang]].update(w for w in (x.lower().strip(_OUTER) for x in words_of(text)) if w)
    gram_counts = [Counter() for _ in languages]
    for k, c in enumerate(counts):
        for w, n in c.items():
            for s in scripts(w):
                seen[k][s] = seen[k].get(s, 0) + n
            for g in grams(w):
                gram_counts[k][g] += n
    total = Counter()
    for c in gram_counts:
        total.update(c)
    names = sorted(total, key=lambda g: (-total[g], g))[:GRAMS]
    numbers = np.array([sum(ord(c) << 21 * k for k, c in enumerate(reversed(g))) for g in names], np.uint64)
    order = np.argsort(numbers)
    names, numbers = [names[k] for k in order], numbers[order]
    sizes = np.array([[max(1, sum(n for g, n in c.items() if len(g) == k)) for c in gram_counts] for k in (1, 2, 3)], float)
    lengths = np.array([len(g) for g in names], np.int64)
    found = np.array([[c[g] for c in gram_counts] for g in names], float).reshape(-1, len(languages))
    table = np.log((found + 0.5) / (sizes[lengths - 1] + 0.5 * len(names)))
    table = np.concatenate([table, np.log(0.5 / (sizes[2:] + 0.5 * len(names)))])
    often = Counter()
    for c in counts:
        often.update(c)
    common = sorted((w for w in often if often[w] >= LEAST_WORD), key=lambda w: (-often[w], w))[:WORDS]
    total_words = np.array([max(1, c.total()) for c in counts], float)
    by_word = np.log(np.array([[c[w] for c in counts] for w in common], float).reshape(-1, len(languages)) / total_words + 1e-5)
    by_word = np.concatenate([by_word - by_word.max(axis=1, keepdims=True, initial=-99.0), np.zeros((1, len(languages)))])
    # A script belongs to a language if one letter-bearing word in a hundred of its text is in it.
    allowed = {s: np.array([x.get(s, 0) * 100 >= max(1, sum(x.values())) for x in seen]) for s in {s for x in seen for s in x if s}}
    return Model(languages, numbers, table, {w: k for k, w in enumerate(common)}, by_word, allowed)


def _label_one(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi labels of one long text: plain numbers instead of many small arrays."""
    n = scores.shape[1]
    best, back = scores[0].astype(float).tolist(), np.zeros((len(scores), n), np.int16)
    for begin in range(1, len(scores), 1 << 16):  # a block at a time carries the state
        came = []
        for row in scores[begin : begin + (1 << 16)].tolist():
            top = max(best)
            at, least = best.index(top), top - penalty
            came.append([k if v >= least else at for k, v in enumerate(best)])
            best = [(v if v >= least else least) + x for v, x in zip(best, row)]
        back[begin : begin + len(came)] = came
    state, labels = best.index(max(best)), np.zeros(len(scores), np.int64)
    for begin in range((len(scores) - 1) >> 16 << 16, -1, -1 << 16):
        came, some = back[begin : begin + (1 << 16)].tolist(), []
        for row in reversed(came):
            some.append(state)
            state = row[state]
        labels[begin : begin + len(came)] = some[::-1]
    return labels


def label_spans(scores: list[np.ndarray], penalty: float = PENALTY) -> list[np.ndarray]:
    """Viterbi labels of several texts, each a matrix of words by languages, side by side.

    The best path ends anywhere; switching costs ``penalty``; of equal paths the one that stays, then
    the first language wins. Texts are handled longest first, so those that have ended drop out; texts too long to
    be padded for are labelled alone, so memory is in proportion to the words of the texts.
    """
    order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    begin = 0
    while begin < len(order):
        lanes = min(_LANES, _CELLS // max(1, len(scores[order[begin]])))
        block = order[begin : begin + max(1, lanes)]
        begin += len(block)
        if len(block) < 8 and scores[block[0]].shape[1]:
            for k in block:
                out[k] = _label_one(scores[k], penalty) if len(scores[k]) else out[k]
            continue
        lengths = np.array([len(scores[k]) for k in block])
        longest = int(lengths[0]) if len(lengths) else 0
        if not longest:
            continue
        n = scores[block[0]].shape[1]
        alive = (lengths[None, :] > np.arange(longest)[:, None]).sum(axis=1)  # a prefix of the block
        pad = np.zeros((longest, len(block), n), np.float32)
        for j, k in enumerate(block):
            pad[: lengths[j], j] = scores[k]
        best = pad[0].astype(np.float64)
        stays = np.zeros((longest, len(block), n), bool)
        source = np.zeros((longest, len(block)), np.int16)
        for t in range(1, longest):
            a = alive[t]
            v = best[:a]
            top = v.max(axis=1)
            source[t, :a] = v.argmax(axis=1)
            keep = v >= (top - penalty)[:, None]
            stays[t, :a] = keep
            best[:a] = np.where(keep, v, (top - penalty)[:, None]) + pad[t, :a]
        state = best.argmax(axis=1)
        labels = np.zeros((longest, len(block)), np.int16)
        rows = np.arange(len(block))
        for t in range(longest - 1, -1, -1):
            a = alive[t]
            labels[t, :a] = state[:a]
            if t:
                state[:a] = np.where(stays[t, rows[:a], state[:a]], state[:a], source[t, :a])
        for j, k in enumerate(block):
            out[k] = labels[: lengths[j], j].astype(np.int64)
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from docs (doc_id, text, lang) with a language, outside the held-out fold."""
    known = docs.where("doc_id is not null and lang is not null and text is not null").where(fold(F.col("doc_id"), FOLDS) != HELD)
    got = bounded_sample(known.select("doc_id", "text", "lang"), sample).select("text", "lang").toArrow().to_pydict()
    order = sorted(range(len(got["lang"])), key=lambda k: (got["lang"][k], got["text"][k]))
    return fit([got["text"][k] for k in order], [got["lang"][k] for k in order])


def _by_size(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of _BATCH_CHARS characters together, or one longer text."""
    some, chars = [], 0
    for t in texts:
        if some and chars + len(t or "") > _BATCH_CHARS:
            yield some
            some, chars = [], 0
        some.append(t)
        chars += len(t or "")
    if some:
        yield some


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text) as doc_id, held_out, lang_pred, score and spans.

    spans: begin and end in words (white-space separated), and language. score: the share of the text's letters
    that lie in spans of lang_pred and in a script that some language is written in: letters of other scripts tell
    nothing. A text without letters, or a model without languages, gives UNKNOWN and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        n = len(model.languages)
        for whole in batches:
            for b in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                langs, shares, spans = [], [], []
                for texts in _by_size(b.column(1).to_pylist()):
                    letters, scores, told = model.look_up([words_of(t or "") if n else [] for t in texts])
                    for count, known, labels in zip(letters, told, label_spans(scores)):
                        total = count.sum() if n else 0
                        by = np.bincount(labels, count * known, n) if n else np.zeros(1)
                        langs.append(model.languages[int(by.argmax())] if total else UNKNOWN)
                        shares.append(float(by.max() / total) if total else 0.0)
                        cuts = [0, *(np.nonzero(np.diff(labels))[0] + 1).tolist(), len(labels)] if total else []
                        spans.append([{"begin": a, "end": e, "lang": model.languages[labels[a]]} for a, e in zip(cuts, cuts[1:])])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, kind)], names=["doc_id", "lang_pred", "score", "spans"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, lang_pred string, score double, spans array<struct<begin:int,end:int,lang:string>>")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score", "spans")
