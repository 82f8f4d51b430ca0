"""Search index, build history, repair ledger and page XML: what is written and read again."""

import os
import random
from collections import Counter

import pytest
from lexloom.operators import overlay as O
from lexloom.operators import search as Q
from lexloom.sources import history as H
from lexloom.sources import io


@pytest.mark.parametrize(("shard", "buckets"), [(65536, 16), (7, 3)])
def test_index_finds_what_scoring_all_finds(spark, tmp_path, shard, buckets):
    rnd = random.Random(shard)
    word = lambda: "".join(rnd.choice("abté") for _ in range(rnd.randrange(1, 4)))
    rows = [(k, " ".join(word() for _ in range(2)), " ".join(word() for _ in range(rnd.randrange(9)))) for k in range(60)] + [(70, None, "bat"), (71, "at", None), (72, "", ""), (72, "ab at", "x")]
    entries = spark.createDataFrame(rows, "index long, term string, body string")
    folder = f"file://{tmp_path}/index"
    Q.build_index(entries, folder, shard, buckets)
    for query in ("a", "ta", "abt", "at ba", "BAT", "t a b", "zz", "zzz", "é", "", "!?", "ab at", "bat at ab"):
        want = [tuple(r) for r in Q.ranked(entries, query, 1000).select("index", "term", "score").collect()]
        assert [tuple(r) for r in Q.search(spark, folder, query, 1000, buckets).collect()] == want, query
        assert len(want) > 5 or query not in ("a", "ta")


def test_three_builds(spark, tmp_path):
    folder = f"file://{tmp_path}/corpus"
    build = lambda n: spark.range(n).withColumnRenamed("id", "index")
    assert H.changes(spark, folder).count() == 0
    with pytest.raises(LookupError):
        H.as_of(spark, folder)
    assert [H.commit(build(n), folder, reported, f"2024-0{k + 1}-01") for k, (n, reported) in enumerate([(5, None), (7, 7), (6, 7), (6, None)])] == [1, 2, 3, 4]
    assert [tuple(r) for r in H.changes(spark, folder).orderBy("version").collect()] == [(1, 5, None, None, "first_build"), (2, 7, 5, 2, "explained"), (3, 6, 7, -1, "unexplained"), (4, 6, 6, 0, "same")]
    assert H.as_of(spark, folder).count() == 6 and H.as_of(spark, folder, 2).count() == 7 and H.as_of(spark, folder, at="2024-01-15").count() == 5


def test_one_of_two_writers_of_a_version_fails(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/corpus"
    H.commit(spark.range(3), folder)
    none = spark.createDataFrame([], H.COMMIT)
    monkeypatch.setattr(H, "commits", lambda *_: none)  # this writer has not seen the first one's commit
    with pytest.raises(Exception, match="[Ee]xist"):
        H.commit(spark.range(9), folder)
    monkeypatch.undo()
    assert H.as_of(spark, folder).count() == 3 and H.commit(spark.range(4), folder) == 2


def test_repair_asks_once_though_a_task_dies(spark, tmp_path):
    """A worker is killed in the middle; the next run asks for nothing that was answered, and errors are asked for again."""
    log, ledger = str(tmp_path / "calls"), f"file://{tmp_path}/ledger"
    os.makedirs(tmp_path / "ledger")

    def fix(bodies):
        with open(log, "a") as f:
            f.write("".join(f"{b}\n" for b in bodies))
        if "b13" in bodies and open(log).read().count("b13\n") == 1:
            os._exit(1)
        if "b5" in bodies and open(log).read().count("b5\n") == 1:
            raise OSError("busy")
        return [b.upper() for b in bodies]

    rows = [(k, "T", f"b{k % 20}") for k in range(60)] + [(60, "T", None), (61, "T", "")]
    e = spark.createDataFrame(rows, "index long, term string, body string").coalesce(1)
    with pytest.raises(Exception):  # noqa: B017  (local sessions do not run a task again)
        O.repair(e, fix, 1, ledger, 1).collect()
    first = Counter(open(log).read().split())
    got = {r["index"]: r.fixed for r in O.repair(e, fix, 1, ledger, 1).collect()}
    calls = Counter(open(log).read().split())
    assert all(got[k] == f"B{k % 20}" or k % 20 == 5 for k in range(60)) and got[60] is None and got[61] == ""
    assert calls["b13"] == 2 and all(n == 1 for b, n in calls.items() if b not in ("b13", "b5")) and len(calls) == 20 and first.total() >= 2
    fixed = {r["index"]: (r.fixed, r.error) for r in O.repair(e, fix, 1, ledger, 3).collect()}
    assert fixed[5] == ("B5", None) and Counter(open(log).read().split())["b7"] == 1


@pytest.mark.parametrize("size", ["100", "333", "1000000"])
def test_pages_are_numbered_whatever_the_splits(spark, tmp_path, size):
    head, obj = '<?xml version="1.0"?>\n<DjVuXML><BODY>\n', '<OBJECT width="100" height="{h}">\n<HIDDENTEXT><PAGECOLUMN><REGION><PARAGRAPH><LINE><WORD coords="1,9,5,2">p{k} é &amp; so</WORD></LINE></PARAGRAPH></REGION></PAGECOLUMN></HIDDENTEXT></OBJECT>\n'
    for name, n in (("a", 23), ("b", 4), ("none", 0)):
        (tmp_path / f"{name}.xml").write_text(head + "".join(obj.format(k=k, h=k) for k in range(n)) + "</BODY></DjVuXML>")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        got = io.page_xml(spark, f"file://{tmp_path}/*.xml").collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sorted((r.file[-5], r.leaf, r.height, r.text) for r in got) == sorted((f, k + 1, k, f"p{k} é & so") for f, n in (("a", 23), ("b", 4)) for k in range(n))
