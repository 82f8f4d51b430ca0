"""Each stage's decisions against the operator's own brute-force facts."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import pytest
from lexloom.llm import mixing, quality, simhash, toxicity
from pyspark.sql import functions as F
from test_near_copies import plain_kept

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"file://{folder}/{k}")
        docs = spark.read.parquet(f"file://{folder}/{k}")
        out.append(docs)
    return [d.collect() for d in out]


def test_columns(steps):
    for rows in steps[:-1]:
        assert tuple(rows[0].__fields__) == pipeline.COLUMNS
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality", "near_copies", "mixing", "tokens"] and pipeline.ORACLE_SQL is None


def test_filters_keep_rows_as_they_are(spark, steps):
    for before, after in zip(steps, steps[1:4]):
        assert not Counter(after) - Counter(before)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in steps[0]} - {r.doc_id for r in steps[1]}
    assert sum(toxic.get(d, 0) for d in gone) >= 0.8 * sum(toxic.values())
    assert sum(toxic.get(d) == 0 for d in gone) <= 0.03 * sum(t == 0 for t in toxic.values())
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()} & {r.doc_id for r in steps[1]}
    fails = {r.doc_id for r in steps[1] if (b := quality.statistics(r.text)[0])[0] < 10 or 100 * b[4] > 20 * b[0]}
    left = {r.doc_id for r in steps[2]}
    assert not fails & left and len((good - fails) & left) >= 0.97 * len(good - fails)


def test_one_of_each_component(steps):
    """What all pairs in plain Python leave: links of op10's fingerprints and of five-word Jaccard 0.8 or more."""
    assert sorted(r.doc_id for r in steps[3]) == plain_kept([(r.doc_id, r.text) for r in steps[2]])
    assert len(steps[3]) < len(steps[2])


def test_mix(spark, steps):
    docs = spark.createDataFrame(steps[3], spark.read.parquet(f"{SF}/documents.parquet").schema)
    want = {r.source: (r.target, r.source_size) for r in mixing.targets(docs.withColumn("w", mixing.n_words(F.col("text"))).groupBy("source").agg(F.sum("w").alias("source_size"))).collect()}
    text, got, times = {r.doc_id: r.text for r in steps[3]}, defaultdict(int), Counter()
    for r in steps[4]:
        assert r.n_chars == len(r.text) and (r.text == text[r.doc_id] or not Counter(r.text.split()) - Counter(text[r.doc_id].split()))
        got[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    assert max(times.values()) <= 3
    for s, (target, _) in want.items():
        assert abs(got[s] - target) <= 2 * 2048


def test_tokens(steps):
    import hashlib

    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in steps[4]) == Counter((r.doc_id, r.decoded_sha256) for r in steps[5])
    assert all(len(r.ids) == r.n_tokens for r in steps[5])


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "a b c " * 30, "en", None, 5), (1, "a b c " * 30, "en", None, 5), (2, "idiot " * 40, None, "b", 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert simhash.keep_first(docs).count() == 3
    assert toxicity.score(docs, toxicity.Model({}, -9.0)).count() == 5
