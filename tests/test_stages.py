"""Stages on hand-made fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliate.operators import chunks as C
from foliate.operators import containment
from foliate.operators import evaluate as E
from foliate.operators import extract as X
from foliate.operators import review as R
from foliate.operators import sections as S
from foliate.operators import similar
from foliate.operators.ground import deduplicate, ground
from foliate.operators.html_blocks import block_texts, html_blocks
from foliate.schemas import decision_problem, split_rejected
from foliate.sources import artifacts as A
from foliate.sources import filings as FI


def blocks(spark, texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "doc int, idx int, text string")


def test_page_numbers_hide_no_duplicate(spark):
    assert [r.text for r in S.narrative_blocks(blocks(spark, ["x", "12", "x", "", "y"])).orderBy("block").collect()] == ["x", "y"]


def test_sections_and_ids(spark):
    texts = ["before", "PART I", "Item 2. A", "text", "Item 2. B", "part ii, item 1", "Item 1a. Risk", "Item 3: no", "tail"]
    got = S.sections(S.narrative_blocks(blocks(spark, texts)), order="block").orderBy("order").collect()
    assert [r.section_id for r in got] == ["part-i-item-2", "part-i-item-2-2", "part-ii-item-1a"]
    assert got[1].text.endswith("part ii, item 1") and got[2].text == "Item 1a. Risk\n\nItem 3: no\n\ntail"
    whole = "\n\n".join(texts)
    assert all(whole[r.character_start : r.character_end] == r.text for r in got)
    one, other = S.select_section(S.sections(S.narrative_blocks(blocks(spark, texts)), order="block"), "part-i-item-2")
    assert one.count() == 1 and other.count() == 0
    assert S.select_section(S.sections(S.narrative_blocks(blocks(spark, texts)), order="block"), "item-9")[1].first().reason == "section_missing"


def test_heading_context_resets_at_periods(spark):
    period = "Three Months Ended A Compared with B"
    rows = spark.createDataFrame([(0, i, p) for i, p in enumerate(["Aa", "Bb", "Cc", "Dd", period, "Ee"])], "doc int, idx int, paragraph string")
    got = [r.heading_context for r in C.with_headings(rows).orderBy("idx").collect()]
    assert got[3] == ["Bb", "Cc", "Dd"] and got[5] == [period, "Ee"]


def _ground(spark, section, chunk_start, chunk, quote, scope=None):
    df = spark.createDataFrame([(section, chunk_start, chunk, quote, scope)], "s string, cs int, c string, evidence_quote string, scope_quote string")
    return ground(df, F.col("s"), F.lit(100), F.col("c"), F.col("cs")).first()


def test_grounding_order(spark):
    assert _ground(spark, "ab cd", 0, "ab cd", "zz").evidence_status == "not_found"
    assert _ground(spark, "aaa", 0, "aaa", "aa", "a").evidence_status == "ambiguous"
    assert _ground(spark, "ab cd", 0, "ab cd", "ab", "zz").evidence_status == "not_found"
    assert _ground(spark, "ab cd ab", 6, "ab", "ab").evidence_status == "ambiguous"
    got = _ground(spark, "H one H two q", 8, "two q", "q", "H")
    assert (got.evidence_status, got.evidence_character_start, got.scope_character_start, got.scope_character_end) == ("verified", 112, 106, 107)


def test_ungrounded_claims_with_other_quotes_stay(spark):
    rows = [("d", 0, 0, None, None, "risk", "Revenue", "one"), ("d", 0, 1, None, None, "risk", "Revenue", "two"), ("d", 1, 0, 3, 5, "risk", None, "x"), ("d", 2, 0, 3, 5, "risk", None, "y")]
    df = spark.createDataFrame(rows, "doc string, chunk_ord int, claim_ord int, evidence_character_start int, evidence_character_end int, claim_type string, scope_quote string, evidence_quote string")
    assert sorted(r.evidence_quote for r in deduplicate(df).collect()) == ["one", "two", "x"]


def test_greedy_matching_prefers_score_then_index(spark):
    df = spark.createDataFrame([(0, 1, 0.9), (0, 0, 1.0), (1, 1, 0.8)], "p_index int, e_index int, score double").withColumns({"doc": F.lit(1), "method": F.lit("m"), "evidence_overlap": F.lit(0.0), "statement_similarity": F.lit(0.0), "field_similarity": F.lit(0.0)})
    assert sorted((r.p_index, r.e_index) for r in E.greedy_match(df, ("doc",)).collect()) == [(0, 0), (1, 1)]


def test_evidence_before_its_scope_has_no_span(spark):
    df = spark.createDataFrame([("evidence scope", "evidence", "scope"), ("scope evidence", "evidence", "scope")], "t string, q string, s string")
    assert [r.x for r in df.select(E.evidence_start(F.col("t"), F.col("q"), F.col("s")).alias("x")).collect()] == [None, 6]


def test_fingerprint_is_canonical_json(spark):
    import hashlib

    claim = {"claim_type": "risk", "statement": "a", "metric": None, "scope_quote": None}
    df = spark.createDataFrame([(("risk", "a", None, None),)], "c struct<claim_type: string, statement: string, metric: string, scope_quote: string>")
    want = json.dumps({k: v for k, v in claim.items() if k != "scope_quote"}, sort_keys=True, separators=(",", ":"))
    assert df.select(R.fingerprint(F.col("c"), list(claim)).alias("f")).first().f == hashlib.sha256(want.encode()).hexdigest()


def test_decisions(spark):
    df = spark.createDataFrame([("rejected", None, None), ("accepted", None, "x"), ("needs_edit", None, "x"), ("pending", "other", None)], "d string, r string, c string")
    assert [r.p for r in df.select(decision_problem(F.col("d"), F.col("r"), F.col("c")).alias("p")).collect()] == ["rejected_without_reason", "correction_without_needs_edit", None, "reason_without_rejection"]
    ok, bad = split_rejected(df, decision_problem(F.col("d"), F.col("r"), F.col("c")), "review")
    assert ok.count() == 1 and bad.count() == 3
    with pytest.raises(Exception, match="review: "):
        split_rejected(df, decision_problem(F.col("d"), F.col("r"), F.col("c")), "review", strict=True)[0].collect()


def test_provenance_labels(spark):
    df = spark.range(1).select(F.struct(*[F.lit("a").alias(x) for _, x, _ in R.PROVENANCE]).alias("r"), F.struct(*[F.lit("b" if x == "model" else "a").alias(x) for _, _, x in R.PROVENANCE]).alias("p"))
    assert df.select(R.provenance_mismatches().alias("m")).first().m == ["proposal model"]


def test_html_blocks(spark):
    assert block_texts("<div>lost<p>A <b>b</b>.<p>C</div><table><tr><td><p>gone</table><div style='DISPLAY: none'><p>gone</p></div><ix:header><p>gone</p></ix:header><p>x&nbsp;y</p>") == ["A b .", "C", "x y"]
    assert block_texts("<div><span><p>in</p></span>out</div>") == ["in out", "in"]
    assert block_texts('<script>var t="</p><p>no</p>";</script><li>1<li>2') == ["1", "2"]
    df = spark.createDataFrame([(1, "<p>a</p><p></p>"), (2, None)], "page_id int, html string")
    assert [(r.page_id, r.idx, r.text) for r in html_blocks(df).collect()] == [(1, 0, "a"), (1, 1, "")]


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert {r.status for r in A.write_once(df, path, ["k"]).collect()} == {"stored"}
    more = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert {r.k: r.status for r in A.write_once(more, path, ["k"]).collect()} == {2: "unchanged", 3: "stored"}
    with pytest.raises(ValueError, match="other content"):
        A.write_once(spark.createDataFrame([(1, "z")], "k int, v string"), path, ["k"])
    assert spark.read.parquet(path).count() == 3


def test_regenerate(spark, tmp_path):
    path = str(tmp_path / "t")
    A.regenerate(spark.createDataFrame([("a", 1), ("b", 2)], "v string, k int"), path, "k").collect()
    got = A.regenerate(spark.createDataFrame([("a", 1), ("c", 2)], "v string, k int"), path, "k")
    assert {r.k: r.status for r in got.collect()} == {1: "unchanged", 2: "regenerated"}
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {1: "a", 2: "c"}


def test_archive_states(spark):
    new = spark.createDataFrame([(1, "h"), (2, "h"), (3, "h"), (4, "h")], "k int, content_sha256 string")
    old = spark.createDataFrame([(2, "h", True), (3, "x", True), (4, "h", False)], "k int, content_sha256 string, ok boolean")
    assert {r.k: r.status for r in A.write_once_status(new, old, ["k"], check=F.col("ok")).collect()} == {1: "stored", 2: "unchanged", 3: "conflict", 4: "corrupt"}


def test_submissions(spark, tmp_path):
    body = {"filings": {"recent": {"form": ["10-K", "10-Q", "10-Q"], "accessionNumber": ["0-1", "0-2", "0-3"], "primaryDocument": ["a.htm", "b.htm", "c.htm"], "reportDate": ["2023-12-31", "", "2023-06-30"], "filingDate": ["2024-01-02", "2023-11-01", "2023-08-01"]}}}
    (tmp_path / "CIK0000320193.json").write_text(json.dumps(body))
    spark.dataSource.register(FI.SubmissionsSource)
    rows = FI.decode_submissions(spark.read.format("submissions").option("path", str(tmp_path)).option("ciks", "320193").load())
    got = FI.latest_by_form(rows, "10-Q").first()
    assert got.accession_number == "0-2" and got.reporting_period is None and got.source_url.endswith("/data/320193/02/b.htm")


def test_unknown_prompt_fails(spark):
    prompts = spark.createDataFrame([("v1", "do")], "version string, text string")
    assert len(FI.with_prompt(spark.createDataFrame([("v1",)], "prompt_version string"), prompts).first().prompt_sha256) == 64
    with pytest.raises(Exception, match="unknown prompt version"):
        FI.with_prompt(spark.createDataFrame([("v9",)], "prompt_version string"), prompts).collect()


def test_status_ladder(spark):
    df = spark.createDataFrame([("completed", None, "x"), ("completed", "content_filter", "x"), ("incomplete", "max_output_tokens", None), ("failed", None, "x"), ("completed", None, None)], "s string, r string, p string")
    assert [r.o for r in df.select(X.response_outcome(F.col("s"), F.col("r"), F.col("p")).alias("o")).collect()] == ["completed", "content_filtered", "truncated", "not_completed", "invalid_output"]
    with pytest.raises(ValueError):
        X.check_settings("huge", 2000)
    with pytest.raises(ValueError):
        X.check_settings("low", 100)


def _rounds(spark, tmp_path, script):
    """Two paragraphs of 700 characters in one chunk; the script answers by chunk id."""
    text = "Revenue\n\n" + "A" * 700 + "\n\n" + "B" * 700
    df = spark.createDataFrame([("d", "item2-chunk-001", 0, [], text)], "chunk_key string, chunk_id string, character_start int, heading_context array<string>, text string")

    def extractor(chunk_id, prompt):
        return {"outcome": script.get(chunk_id, "completed"), "model": "test-model", "response_id": chunk_id, "input_tokens": 10, "output_tokens": 5, "raw_response": "{}", "claims": []}

    def save(rows, k):
        rows.write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    return X.run_rounds(df, extractor, save)


def test_only_the_truncated_chunk_is_split(spark, tmp_path):
    first, second = _rounds(spark, tmp_path, {"item2-chunk-001": "truncated"})
    assert [r.was_cut for r in first.collect()] == [True]
    assert sorted(r.chunk_id for r in second.collect()) == ["item2-chunk-001.001", "item2-chunk-001.002"]


def test_filtered_child_is_a_gap(spark, tmp_path):
    _, second = _rounds(spark, tmp_path, {"item2-chunk-001": "content_filtered", "item2-chunk-001.002": "content_filtered"})
    rolled = X.roll_up(second.select("parent_key", "chunk_id", "raw_response", F.array().cast("array<string>").alias("claims"), F.col("outcome").alias("status"), "input_tokens", "output_tokens", "model")).first()
    assert (rolled.status, rolled.failure_reason, rolled.response_id, rolled.input_tokens) == ("content_filtered", "content_filter in item2-chunk-001.002", None, 20)


def test_truncated_without_children_fails(spark, tmp_path):
    *_, last = _rounds(spark, tmp_path, {"item2-chunk-001": "truncated", "item2-chunk-001.001": "truncated"})
    assert {r.chunk_id: r.outcome for r in last.collect()}["item2-chunk-001.001"] == "failed"


def test_resume(spark):
    chunks = spark.createDataFrame([("a", "t1"), ("b", "t2")], "chunk_id string, text string")
    hits, misses = X.split_work(chunks, spark.createDataFrame([("a", "t1")], "chunk_id string, text string"), ("chunk_id", "text"))
    assert [r.chunk_id for r in hits.collect()] == ["a"] and [r.chunk_id for r in misses.collect()] == ["b"]


def test_stream_stores_blocks_once(spark, tmp_path):
    from foliate.streaming.ingest import ingest_blocks, page_stream

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "<p>a</p>")], "page_id bigint, html string").write.parquet(source)
    for k in range(2):
        query = ingest_blocks(page_stream(spark, source, "page_id bigint, html string"), str(tmp_path / "out"), str(tmp_path / f"state{k}"))
        query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize("short", [False, True])
def test_quotes_are_found_the_same_way_at_any_size(spark, tmp_path, monkeypatch, short):
    from foliate.plans import queries

    texts = ["one alpha beta gamma delta", "alphabet betamax", "alpha beta", "  alpha\nbeta  gamma", "", None]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1, "other alpha beta gamma"), (None, "alpha beta gamma")]
    quotes = ["alpha", "lph", "alpha bet", "alpha beta gamma", "beta gam", "beta  gamma", "alpha beta gamma", " ", "a", "nowhere", "no such words"]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k if k != 6 else 3, q) for k, q in enumerate(quotes)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = lambda: sorted(map(repr, queries._quotes(spark, str(tmp_path), short).collect()))
    small = found()
    want = [(i, t, k if k != 6 else 3, q[:12] if short else q) for i, t in docs if t is not None for k, q in enumerate(quotes) if (q[:12] if short else q) in t]
    assert sorted((r.doc_id or -1, r.item_id, r.evidence_quote) for r in queries._quotes(spark, str(tmp_path), short).collect()) == sorted((i or -1, k, q) for i, _, k, q in want)
    monkeypatch.setattr(containment, "KEYS", 2)
    assert found() == small and len(small) > 20


def test_quotes_meet_texts_by_fingerprints(spark):
    """No loop over texts and quotes: every quote of a random text is found, by an equi-join."""
    r = random.Random(6)
    texts = ["".join(r.choice("ab cé𝄞") for _ in range(r.randint(0, 120))) for _ in range(60)]
    quotes = sorted({t[k : k + n] for t in texts for k in (0, 7, max(0, len(t) - 5)) for n in (1, 2, 3, 4, 5, 11, 12, 13, 40)} - {""})
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id int, text string")
    found = containment.containing(docs, spark.createDataFrame([(k, q) for k, q in enumerate(quotes)] + [(-1, ""), (-2, None)], "item_id int, evidence_quote string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = [(x.doc_id, x.item_id) for x in found.collect()]
    want = {(i, k) for i, t in enumerate(texts) for k, q in enumerate(quotes) if q in t}
    assert len(got) == len(want) and set(got) == want


def test_similar_sets_match_brute_force(spark, monkeypatch):
    """Only pairs that bitmaps leave meet with their words; blocks are cut by rows and by words."""
    r = random.Random(8)
    common = [f"w{k}" for k in range(400)]
    sets = []
    for n in (1, 2, 3, 7, 25, 40, 60, 130):
        for _ in range(12):
            sets.append(set(r.sample(common, n)))
            for _ in range(2):  # some of these are similar to it, some just below
                x = set(sets[-1])
                for _ in range(r.randint(0, n // 5 + 1)):
                    x ^= {r.choice(common)}
                sets.append(x)
    sets = [*map(set, {frozenset(s) for s in sets}), set()]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.72}
    df = spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in enumerate(sets)], "class bigint, words string")
    seen = {}
    monkeypatch.setattr(similar, "materialize", lambda frame, tag: seen.setdefault(tag, frame.cache()))
    for rows, words in ((1 << 15, 1 << 23), (5, 1 << 23), (1 << 15, 300)):
        monkeypatch.setattr(similar, "ROWS", rows)
        monkeypatch.setattr(similar, "WORDS", words)
        seen.clear()
        got = [(x.a, x.b) for x in similar.similar(df, 0.72).collect()]
        assert len(got) == len(want) and set(got) == want and len(want) > 50
        assert seen["similar-candidates"].count() < 2 * len(want)
    assert similar.similar(df.where("class < 0"), 0.72).count() == 0


def test_cases_are_matched_where_they_stand(spark):
    """Claims in rows and claims gathered by case give the same pairs; the latter shuffle and write nothing."""
    text = "Sales rose in the north. Costs fell sharply this year. Sales rose in the north again."
    claim = lambda i, statement, quote, scope=None, value="v": {"index": i, "claim_type": "risk", "statement": statement, "evidence_quote": quote, "scope_quote": scope, "metric": "m", "value": value, "period": None}
    p = [claim(0, "sales rose", "Sales rose in the north"), claim(1, "costs fell sharply this year", "Costs fell", value=None), claim(2, "gone", "nowhere"), claim(3, None, "north again", "Costs")]
    e = [claim(0, "up", "ales rose in the north."), claim(1, "costs fell sharply this year", "sharply"), claim(2, "x", "north again", "Costs"), claim(3, "gone", "nowhere", "absent")]
    fields = "claim_type string, statement string, evidence_quote string, scope_quote string, metric string, value string, period string"
    side = lambda claims, n: [{**{k: v for k, v in c.items() if k != "index"}, n: c["index"]} for c in claims]
    cases = spark.createDataFrame([{"k": k, "section_text": text, "predicted": side(p, "p_index"), "expected": side(e, "e_index")} for k in (1, 2)] + [{"k": 3, "section_text": text, "predicted": [], "expected": None}],
                                  f"k int, section_text string, predicted array<struct<{fields}, p_index int>>, expected array<struct<{fields}, e_index int>>".replace("> string", ">"))
    found = E.candidates_of(cases, ("k",))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.k, r.p_index, r.e_index, r.method, round(r.score, 6)) for r in found.collect())
    one = [(0, 0, "evidence_overlap", round(0.85 * 22 / 23, 6)), (1, 1, "field_similarity", 1.0), (2, 3, "exact_evidence", 1.0), (3, 2, "exact_evidence", 1.0)]
    assert got == [(k, *x) for k in (1, 2) for x in one]
    rows = lambda name: cases.select("k", F.explode(name).alias("c")).select("k", "c.*")
    loose = E.candidates(rows("predicted").withColumn("evidence_status", F.lit("verified")), rows("expected"), cases.select("k", "section_text"), ("k",))
    assert sorted((r.k, r.p_index, r.e_index, r.method, round(r.score, 6)) for r in loose.collect()) == got


def test_starts_in_python_equal_the_expression(spark):
    rows = [("aä𝄞b ab b", q, s) for q in ("b", "ä𝄞", "x", None) for s in (None, "a", "𝄞b", "x", "b b")] + [(None, "a", None)]
    got = spark.createDataFrame(rows, "t string, q string, s string").select("t", "q", "s", E.evidence_start(F.col("t"), F.col("q"), F.col("s")).alias("at")).collect()
    assert [E.found_start(r.t, r.q, r.s) for r in got] == [r["at"] for r in got]


@pytest.mark.parametrize("rounds", [8, 1, 0])
def test_greedy_matching_in_rounds_equals_the_fold(spark, tmp_path, monkeypatch, rounds):
    """Ties, several cases, null keys and a chain in which each pair waits for the one before."""
    r = random.Random(4)
    rows = {(c, p, e): r.choice((0.6, 0.7, 0.8, 0.9, 1.0)) for c in (1, 2, None) for p in range(25) for e in r.sample(range(25), 8)}
    rows |= {(3, k // 2, (k + 1) // 2): 1 - k / 100 for k in range(60)}
    df = spark.createDataFrame([(*k, "m", s, 0.0, 0.0, 0.0) for k, s in rows.items()], "k int, p_index int, e_index int, method string, score double, evidence_overlap double, statement_similarity double, field_similarity double")
    want = set()
    for c in (1, 2, None, 3):
        want |= {(c, p, e) for p, e, *_ in E.fold([(p, e, "m", s) for (k, p, e), s in rows.items() if k == c])}
    monkeypatch.setattr(E, "ROUNDS", max(rounds, 1))
    got = [(x.k, x.p_index, x.e_index) for x in E.greedy_match(df, ("k",)).collect()]
    assert len(got) == len(want) and set(got) == want
    assert E.greedy_match(df.limit(0), ("k",)).count() == 0


def test_one_case_of_very_many_candidates(spark):
    """100,000 candidates of one case: a fold over growing arrays would compare them with each other."""
    n = 20_000
    df = spark.range(5 * n).selectExpr("1 AS k", f"CAST(id % {n} AS INT) AS p_index", f"CAST((id * 7 + id DIV {n} * 11) % {n} AS INT) AS e_index", "'m' AS method", "round(0.6 + (hash(id) & 1023) / 4096D, 3) AS score", "0D AS evidence_overlap", "0D AS statement_similarity", "0D AS field_similarity")
    got = {(x.p_index, x.e_index) for x in E.greedy_match(df, ("k",)).collect()}
    rows = [(x.p_index, x.e_index, "m", x.score) for x in df.collect()]
    assert got == {(p, e) for p, e, *_ in E.fold(rows)} and len(got) > n // 2


def test_resplit_makes_its_parents_once(spark, sf_dir):
    """Children are cut from their parents' rows: no join, and the table is scanned once."""
    from foliate.plans import queries as Q

    for query in (Q.split_rounds, Q.chunks_resplit):
        plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Join" not in plan


def test_resplit_takes_the_other_limit_where_the_first_cuts_nothing(spark):
    part = lambda n: "x" * n
    texts = {"cut": "\n\n".join(part(600) for _ in range(6)), "half": "\n\n".join((part(700), part(700))), "whole": part(1800), "short": "\n\n".join((part(400), part(400)))}
    parents = spark.createDataFrame([(k, "c", 10, ["H"], t) for k, t in texts.items()], "chunk_key string, chunk_id string, character_start int, heading_context array<string>, text string")
    rows = sorted((r["parent_key"], r["chunk_id"], r["character_start"], r["character_end"], r["heading_context"]) for r in X.children_of(parents, 1500).collect())
    assert rows == [("cut", "c.001", 10, 1212, ["H"]), ("cut", "c.002", 1214, 2416, ["H"]), ("cut", "c.003", 2418, 3620, ["H"]), ("half", "c.001", 10, 710, ["H"]), ("half", "c.002", 712, 1412, ["H"])]


def test_paragraph_pattern_equals_the_lazy_one(spark):
    import itertools

    from foliate.operators.chunks import PARAGRAPH

    texts = [("".join(t),) for n in range(11) for t in itertools.product("a\n", repeat=n)] + [("ab\ncd\n" * 5000 + "\nx\n\ny",)]
    df = spark.createDataFrame(texts, "t string")
    found = lambda p: F.concat(F.regexp_extract_all("t", F.lit(p), F.lit(0)), F.split("t", p))
    assert df.where(found(PARAGRAPH) != found(r"(?s)[^\n](?:.*?[^\n])?(?=\n{2,}|\z)")).count() == 0


def test_first_violation_in_one_exchange_equals_brute_force(spark):
    r = random.Random(4)
    proposed, reviews, want = [], [], {}
    for doc in range(80):
        mine = [(doc, i, f"f{i}", r.choice(("a", "b", None))) for i in range(r.randint(0, 4))]
        given = [(doc, k, r.choice((i, i, i, i, r.randint(0, 5), None)), r.choice((f, f, f, None)), r.choice((c, c, c, "ab")), r.choice(("accepted", "accepted", "pending", None))) for k, (_, i, f, c) in enumerate(mine)]
        given = given[: len(given) - (r.random() < 0.1)] if given else [(doc, 0, 0, "f0", None, "accepted")] * (r.random() < 0.3)
        proposed += mine
        reviews += given
        known, seen, verdict = {i: (f, c) for _, i, f, c in mine}, set(), None
        for _, _, i, f, c, decision in given:
            meant = known.get(i, (None, None))
            verdict = verdict or ("duplicate_index" if i in seen else "index_out_of_range" if i is not None and i >= len(mine) else "claim_differs" if c != meant[1] else "fingerprint_differs" if f != meant[0] else "pending" if decision == "pending" else None)
            seen.add(i)
        if mine or given:
            want[doc] = "count_differs" if len(mine) != len(given) else verdict
    found = R.first_violation(
        spark.createDataFrame(reviews, "doc long, ord int, claim_index int, fingerprint string, claim string, decision string"), spark.createDataFrame(proposed, "doc long, claim_index int, fingerprint string, claim string")
    )
    assert {x["doc"]: x["violation"] for x in found.collect()} == want and len(set(want.values())) == 7
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Initial Plan")[0] and plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_greedy_match_query_matches_cases_in_their_rows(spark, sf_dir, monkeypatch):
    """No pair is written or shuffled, and of a case only its key and matches come back from Python."""
    from foliate.plans import queries as Q

    def no(*_):
        raise AssertionError("a table was written")

    monkeypatch.setattr(E, "materialize", no)
    found = Q.greedy_match(spark, sf_dir)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == Q.evaluation_report(spark, sf_dir).agg(F.sum("matched_claim_count")).first()[0]


def test_rejected_pairs_compare_no_fields(monkeypatch):
    """Most pairs that share a key are rejected on span and statement; their fields aren't looked at."""
    seen, alike = [], E._alike
    monkeypatch.setattr(E, "_alike", lambda a, b: seen.append((a, b)) or alike(a, b))
    text = "alpha beta gamma. delta epsilon"
    p, e = E._Claim(text, 0, "alpha", None, "alpha beta", "m", "v", None), E._Claim(text, 0, "delta", None, "alpha delta zeta", "m", "v", None)
    assert E.judged(p, e) is None and len(seen) == 1
    assert E.judged(p, E._Claim(text, 1, "alpha", None, "other", "m", "w", None)) == ("exact_evidence", 1.0, 1.0, 0.0, 0.5)
    words = ["bb", "a", "ccc", "aa", "b", "abc"]
    assert E.prefix_tokens(words, 0.5) == sorted(words, key=lambda w: (-len(w), w))[:4]
