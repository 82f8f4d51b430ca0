"""Scripts, Viterbi against all paths, held-out accuracy, mixed text, odd rows."""

import itertools
import zlib

import numpy as np
from lexloom.llm import langid, registry


def test_scripts():
    assert langid.scripts("a1é") == {"latin"} and langid.scripts("дa") == {"cyrillic", "latin"}
    assert langid.scripts("12.") == set() and langid.scripts("中") == {"han"} and langid.scripts("ﷺ") == {None}
    assert [a for _, a, _ in langid.SCRIPTS] == sorted(a for _, a, _ in langid.SCRIPTS)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    texts = [rng.normal(size=(n, 3)).astype(np.float32) * 4 for n in (6, 0, 1, 5, 7, 3)]
    for scores, got in zip(texts, langid.label_spans(texts, 3.0)):
        value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert len(got) == len(scores)
        if len(scores):
            assert np.isclose(value(tuple(got)), max(value(p) for p in itertools.product(range(3), repeat=len(scores))), atol=1e-4)


def test_spans_of_mixed_text(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(docs.select("doc_id", "text", "lang"))
    rows = docs.where("length(text) > 600").orderBy("doc_id").limit(200).collect()
    pick = {r.lang: " ".join(r.text.split()[30:70]) for r in rows}
    mixed = pick["en"] + " " + pick["fr"] + " " + pick["de"]
    got = langid.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert [s.lang for s in got.spans] == ["en", "fr", "de"]
    assert all(abs(s.begin - k * 40) <= 4 for k, s in enumerate(got.spans))


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = registry.op4_langid(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in rows if r.held_out]) > 0.98


def test_long_runs_are_read_whole(spark):
    """A text without blanks is judged by all of it; its change of language is a span; pieces lose nothing."""
    rng, few = np.random.default_rng(5), langid.fit(["the and of with that this from"] * 3 + ["und der nicht ist eine für mit"] * 3, ["en"] * 3 + ["de"] * 3)
    english, german = "".join(rng.choice("the and of with that this from".split(), 10)), "".join(rng.choice("und der nicht ist eine für mit".split(), 3000))
    word = english[:64] + german
    assert "".join(langid.pieces(word)) == word and max(map(len, langid.pieces(word))) <= langid.PIECE
    assert list(langid.pieces("abжжж1中")) == ["ab", "жжж1", "中"]
    got = langid.predict(spark.createDataFrame([(1, word), (2, english), (3, "жжж " * 9), (4, "жжж жжж the")], "doc_id long, text string"), few).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got[:2]] == ["de", "en"] and got[0].score > 0.9 and len(got[0].spans) == 2
    assert got[2].score == 0.0 and got[2].lang_pred in ("de", "en") and got[3].lang_pred == "en" and 0.2 < got[3].score < 0.4


def test_million_words_beside_short_texts():
    import resource

    few = langid.fit(["the and of with that this"] * 3 + ["und der nicht ist eine"] * 3, ["en"] * 3 + ["de"] * 3)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    texts = ["the and of " * 300_000 + "und der nicht " * 30_000, *["the of"] * 127]
    labels = []
    for some in langid._by_size(texts):
        _, scores, _ = few.look_up([langid.words_of(t) for t in some])
        labels += langid.label_spans(scores)
    assert [len(x) for x in labels] == [990_000] + [2] * 127 and np.count_nonzero(np.diff(labels[0])) == 1 and labels[0][0] == 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000


def test_long_and_side_by_side_are_alike():
    rng = np.random.default_rng(6)
    for _ in range(20):
        scores = rng.normal(size=(50, 4)).astype(np.float32) * 4
        one, many = langid._label_one(scores, 3.0), langid.label_spans([scores] * 9, 3.0)
        value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 3.0 * np.count_nonzero(np.diff(p))  # noqa: B023, E731
        assert all(np.isclose(value(one), value(x), atol=1e-3) for x in many)


def test_scores_are_those_of_counting():
    """The n-gram and word scores of every word from the plain counts, and the language from all paths of a short text."""
    texts, langs = ["the cat and the dog", "a cat the hat", "der hund und die katze", "die maus der hut", "ла ла кот"], ["en", "en", "de", "de", "ru"]
    model = langid.fit(texts, langs)
    words = {x: [w for t, y in zip(texts, langs) if y == x for w in t.split()] for x in model.languages}
    grams = {x: [g for w in ws for g in langid.grams(w)] for x, ws in words.items()}
    known = {g for gs in grams.values() for g in gs}
    often = {w for w in set().union(*words.values()) if sum(ws.count(w) for ws in words.values()) >= langid.LEAST_WORD}
    for word in ("the", "der", "xylophon", "hut", "кот", "кa"):
        want = []
        for x in model.languages:
            total = 0.0
            for g in langid.grams(word):
                k = len(g) if g in known else 3
                size = max(1, sum(len(y) == k for y in grams[x]))
                total += np.log(((grams[x].count(g) if g in known else 0) + 0.5) / (size + 0.5 * len(known)))
            exact = {y: np.log(ws.count(word) / len(ws) + 1e-5) for y, ws in words.items()}
            want.append(total / 2 + (exact[x] - max(exact.values()) if word in often else 0.0))
        may = [any(langid.script(c) in langid.scripts("".join(words[x])) for c in word) for x in model.languages]
        want = np.where(may, want, -np.inf)
        _, scores, _ = model.look_up([[word]])
        assert np.allclose(scores[0][0], np.maximum(want - want.max(), -50), atol=1e-3)


def test_repeated_rows_do_not_grow_the_sample(spark):
    docs = spark.createDataFrame([(2, "the and of", "en")] * 500 + [(3, "und der " * 300_000, "de"), (5, "und der", "de")], "doc_id long, text string, lang string")
    got = langid.bounded_sample(docs, 100)
    assert sorted((r.doc_id, r.lang) for r in got.collect()) == [(2, "en"), (5, "de")]
    assert langid.bounded_sample(docs, 100, most_bytes=12).count() == 1 and langid.bounded_sample(docs, 1).count() == 1


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "123 --", "en"), (0, "the of and " * 40000, "en"), (4, "ﷺ жжж", None), (0, "der die", "de")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    out = langid.predict(docs, langid.train(docs)).collect()
    assert [r.lang_pred for r in out[:3]] == ["und"] * 3 and out[3].lang_pred == "en" and out[4].lang_pred in ("en", "de") and out[4].score == 0.0
    none = docs.limit(0)
    assert langid.predict(none, langid.train(none)).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.train(none)).collect()} == {"und"}
