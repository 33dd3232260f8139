"""What is stored stays stored once: versions of a table, batches, equal filings, answers that arrive before a failure."""

import hashlib
import json
import os
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foliate import schemas
from foliate.operators import extract as X
from foliate.plans import commands as K
from foliate.sources import artifacts as A
from foliate.sources import ledger
from foliate.sources.journal import Journal

AS_OF = datetime(2024, 5, 6, 7, 8, 9)


@pytest.mark.parametrize("hadoop", [False, True])
def test_a_version_is_put_once(spark, tmp_path, monkeypatch, hadoop):
    path = "file://" + str(tmp_path / "t")
    if hadoop:
        monkeypatch.setattr(ledger, "_local", lambda spark, path: None)
    assert ledger.snapshot(spark, path) == (0, [])
    commits = []
    for k in range(2 * ledger.FULL + 3):
        assert ledger.commit(spark, path, k, commits, f"c{k}")
        commits.append(f"c{k}")
    assert not ledger.commit(spark, path, 5, commits[:5], "other")
    assert ledger.snapshot(spark, path) == (len(commits), commits)
    assert ledger.snapshot(spark, path, 3) == (3, commits[:3])
    assert not [n for n in os.listdir(tmp_path / "t" / "_versions") if n.endswith(".tmp")]


def test_only_one_of_many_claims_a_version(spark, tmp_path):
    path, won = str(tmp_path / "v" / "1.json"), []
    barrier = threading.Barrier(8)

    def claim(k):
        barrier.wait()
        if ledger.put_if_absent(spark, path, json.dumps({"added": [k] * 1000})):
            won.append(k)

    threads = [threading.Thread(target=claim, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1
    with open(path) as f:
        assert json.load(f)["added"] == won * 1000


def test_batches_with_repeated_keys(spark, tmp_path):
    old = spark.createDataFrame([(3, "h", True), (4, "h", True), (5, "h", False)], "k int, content_sha256 string, ok boolean")
    rows = [(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "h"), (3, "h"), (4, "x"), (4, "h"), (5, "h"), (None, "n"), (None, "n"), (6, None), (6, None)]
    got = A.batch_status(spark.createDataFrame(rows, "k int, content_sha256 string"), old, ["k"], check=F.col("ok")).collect()
    want = {(1, "a", "conflict", 1), (1, "b", "conflict", 1), (2, "c", "stored", 2), (3, "h", "unchanged", 2), (4, "x", "conflict", 1), (4, "h", "unchanged", 1), (5, "h", "corrupt", 1), (None, "n", "stored", 2), (6, None, "stored", 2)}
    assert {(r.k, r.content_sha256, r.status, r.copies) for r in got} == want and len(got) == len(want)
    path, df = str(tmp_path / "t"), lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    assert [(r.k, r.status) for r in A.write_once(df((2, "c"), (2, "c")), path, ["k"]).collect()] == [(2, "stored")]
    with pytest.raises(ValueError, match="other content"):
        A.write_once(df((1, "a"), (1, "b"), (7, "g")), path, ["k"])
    assert A.write_once(df().limit(0), path, ["k"]).count() == 0
    assert [tuple(r) for r in A.read_once(df((0, "")), path).collect()] == [(2, "c")]


@pytest.mark.parametrize("same", [True, False])
def test_two_writers_never_both_win(spark, tmp_path, monkeypatch, same):
    """Both judge their rows against the same version before either commits."""
    path, both, plain, seen = str(tmp_path / "t"), threading.Barrier(2, timeout=120), ledger.stage, threading.local()

    def stage(df, path, partition_by=None):
        added = plain(df, path, partition_by)
        if not getattr(seen, "waited", False):
            seen.waited = True
            both.wait()
        return added

    monkeypatch.setattr(ledger, "stage", stage)
    out = {}

    def write(name, rows):
        try:
            out[name] = [r.status for r in A.write_once(spark.createDataFrame(rows, "k int, v string"), path, ["k"]).collect()]
        except ValueError as error:
            out[name] = error

    one = [(1, "a"), (2, "b")]
    two = one if same else [(1, "z"), (3, "c")]
    writers = [threading.Thread(target=write, args=x) for x in (("one", one), ("two", two))]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    stored = [tuple(r) for r in A.read_once(spark.createDataFrame([], "k int, v string"), path).orderBy("k").collect()]
    if same:
        assert stored == one and sorted(s for o in out.values() for s in o) == ["stored", "stored", "unchanged", "unchanged"]
    else:
        assert sum(isinstance(o, ValueError) for o in out.values()) == 1 and stored in (one, two)


def test_rows_of_a_beaten_writer_are_never_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    lost = ledger.stage(spark.createDataFrame([(9, "lost")], "k int, v string"), path)
    assert A.read_once(df, path).count() == 0
    A.write_once(df, path, ["k"]).collect()
    assert [r.k for r in A.read_once(df, path).collect()] == [1]
    assert ledger.vacuum(spark, path) == [] and ledger.vacuum(spark, path, -1.0) == [lost]
    assert [r.k for r in A.read_once(df, path).collect()] == [1] and len([n for n in os.listdir(path) if n.startswith("commit=")]) == 1


def parsed(spark, ids, paragraphs):
    """Documents with one section of the given paragraphs."""
    text = "\n\n".join(paragraphs)
    digest = hashlib.sha256(text.encode()).hexdigest()
    section = ("part-i-item-2", "I", "2", "Item 2. Analysis", 0, 0, len(text), text)
    return spark.createDataFrame([(i, "blocks-v1", digest, digest, text, [section]) for i in ids], f"document_id string, {schemas.PARSED_DOCUMENT}")


def counting(folder, broken_at=None):
    """An extractor that leaves a file for each call and raises at one of them."""
    os.makedirs(folder, exist_ok=True)

    def extractor(chunk_id, system, user):
        n = len(os.listdir(folder)) + 1
        open(f"{folder}/{n}-{os.getpid()}-{chunk_id}", "w").close()
        if n == broken_at:
            raise TimeoutError("no answer")
        return {"outcome": "completed", "model": "m", "response_id": chunk_id, "input_tokens": 7, "output_tokens": 3, "raw_response": "{}", "claims": []}

    return extractor


def test_equal_filings_share_their_answers(spark, tmp_path):
    calls, out = str(tmp_path / "calls"), str(tmp_path / "out")
    documents = parsed(spark, ["1-a", "1-b"], ["Net sales rose."])
    statuses, rejected = K.extract(documents, ("v1", "find claims"), counting(calls), out, as_of=AS_OF)
    assert {r.document_id: r.status for r in statuses.collect()} == {"1-a": "stored", "1-b": "stored"} and rejected.count() == 0
    proposals = spark.read.parquet(f"{out}/proposals").collect()
    assert [(len(p.responses), p.input_tokens) for p in proposals] == [(1, 7), (1, 7)] and len(os.listdir(calls)) == 1
    assert spark.read.parquet(f"{out}/checkpoints").count() == 1


def test_a_raising_extractor_costs_one_call(spark, tmp_path):
    calls, out = str(tmp_path / "calls"), str(tmp_path / "out")
    documents = parsed(spark, ["1-a"], [f"{k} " + "x" * 990 for k in range(60)])
    statuses, rejected = K.extract(documents, ("v1", "find claims"), counting(calls, 50), out, max_chars=1000, as_of=AS_OF)
    assert statuses.count() == 0
    reasons = [r.reason for r in rejected.collect()]
    assert len(reasons) == 11 and all("TimeoutError: no answer" in r for r in reasons)
    assert spark.read.parquet(f"{out}/checkpoints").count() == 49 and len(os.listdir(calls)) == 50
    statuses, rejected = K.extract(documents, ("v1", "find claims"), counting(calls + "2"), out, max_chars=1000, as_of=AS_OF)
    assert [r.status for r in statuses.collect()] == ["stored"] and rejected.count() == 0 and len(os.listdir(calls + "2")) == 11
    assert len(spark.read.parquet(f"{out}/proposals").first().responses) == 60


def test_a_task_run_again_finds_its_answers(spark, tmp_path):
    """The first run's rows are lost, as with a lost executor; its journal isn't."""
    calls, journal = str(tmp_path / "calls"), Journal(str(tmp_path / "answers"), "v1")
    pending = spark.createDataFrame([(f"c{k}", f"text {k}") for k in range(5)], "chunk_id string, text string")
    call = lambda e: lambda i, t: e(i, "", t)
    assert X.ask(pending, call(counting(calls, 4)), 1, journal=journal).where("outcome = 'completed'").count() == 3
    rows = X.ask(pending, call(counting(calls)), 1, journal=journal).collect()
    assert [r.outcome for r in rows] == ["completed"] * 5 and len(os.listdir(calls)) == 4 + 2
    assert X.ask(pending, call(counting(calls)), 1, journal=Journal(journal.folder, "v2")).count() == 5 and len(os.listdir(calls)) == 11
