"""The stages as commands, from a submission index to a report."""

import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from foliate.functions import text as T
from foliate.operators import extract as X
from foliate.operators import review as R
from foliate.plans import commands as K
from foliate.sources import artifacts as A

AS_OF = datetime(2024, 5, 6, 7, 8, 9)
PAGES = {
    "0000000001": "<p>PART I</p><p>Item 2. Analysis</p><p>Net Sales</p><p>Sales rose 5% to $10 in the café.</p><p>Costs fell.</p><p>Item 3. Other</p><p>none</p>",
    "0000000002": "<p>PART I</p><p>Item 1. Only</p><p>text</p>",
    "0000000003": "<p>12</p>",
}


def test_from_index_to_report(spark, tmp_path):
    def answer(chunk_id, system, user):
        assert system == "find claims" and user.startswith("Section ID: part-i-item-2\nChunk ID: item2-chunk-001\nHeading context: ") and user.endswith("FILING SLICE END")
        claim = {"claim_type": "financial_result", "statement": "Sales rose", "evidence_quote": "Sales rose 5%", "metric": "sales", "value": "$10", "period": None}
        claims = [claim, claim, claim | {"evidence_quote": "not there", "claim_type": "risk"}]
        return {"outcome": "completed", "model": "m1", "response_id": "r1", "input_tokens": 7, "output_tokens": 3, "raw_response": "{}", "claims": claims}

    body = lambda c: json.dumps({"filings": {"recent": {"form": ["10-Q", "10-Q"], "accessionNumber": [f"{c}-24-000002", f"{c}-24-000001"], "primaryDocument": ["a.htm", "b.htm"], "reportDate": ["2024-03-31", ""], "filingDate": ["2024-05-01", "2024-02-01"]}}})
    index = spark.createDataFrame([(c, body(c)) for c in [*PAGES, "0000000004"]], "cik string, body string")
    pages = spark.createDataFrame(list(PAGES.items()), "cik string, page string")
    fetch = lambda filings: filings.join(pages, "cik", "left").withColumn("content", F.col("page").cast("binary")).drop("page")
    archive, parsed, out = (str(tmp_path / x) for x in ("archive", "parsed", "out"))
    for expected in ("stored", "unchanged"):
        statuses, rejected = K.ingest(index, fetch, archive, "10-Q", AS_OF)
        assert {(r.cik, r.status) for r in statuses.collect()} == {(c, expected) for c in PAGES}
        assert [(r.cik, r.reason) for r in rejected.collect()] == [("0000000004", "empty_content")]
    stored = spark.read.parquet(archive).withColumn("cik", F.lpad(F.col("cik").cast("string"), 10, "0"))
    for expected in ("stored", "unchanged"):
        statuses, rejected = K.parse(stored, parsed)
        rows = {r.document_id: r for r in statuses.collect()}
        assert {r.status for r in rows.values()} == {expected} and rows["0000000001-0000000001-24-000002"].section_count == 2
        assert [r.reason for r in rejected.collect()] == ["no_text"]
    documents = spark.read.parquet(parsed)
    for expected in ("stored", "unchanged"):  # the second run is answered by checkpoints
        ask = answer if expected == "stored" else (lambda *_: {}["asked again"])
        statuses, rejected = K.extract(documents, ("v1", "find claims"), ask, out, as_of=AS_OF)
        got = statuses.collect()
        assert [(r.status, r.claim_count, r.verified_claim_count, r.filtered_response_count) for r in got] == [(expected, 2, 1, 0)]
        assert [r.reason for r in rejected.collect()] == ["section_missing"]
    proposals = spark.read.parquet(f"{out}/proposals")
    p = proposals.first()
    text = documents.where(F.col("document_id") == p.document_id).first().text
    claim = p.claims[0]
    assert text[claim.evidence_character_start : claim.evidence_character_end] == "Sales rose 5%" and p.generated_at == AS_OF and (p.model, p.input_tokens, json.loads(p.raw_response)) == ("m1", 7, ["{}"])
    r0 = p.responses[0]
    assert text[r0.chunk_character_start : r0.chunk_character_end].startswith("Item 2. Analysis")

    K.create_review(proposals, "ann", str(tmp_path / "reviews"), AS_OF).collect()
    pending = spark.read.parquet(str(tmp_path / "reviews")).withColumn("case_name", F.lit("case-1"))
    _, rejected = K.finalise(pending, proposals, documents, str(tmp_path / "gold"), AS_OF)
    assert [r.reason for r in rejected.collect()] == ["pending"]
    decided = F.transform("claim_reviews", lambda x: x.withField("decision", F.when(x["claim_index"] == 0, "accepted").otherwise("rejected")).withField("rejection_reason", F.when(x["claim_index"] > 0, F.lit("unsupported"))))
    done = pending.withColumn("claim_reviews", decided)
    assert [r.reason for r in K.finalise(done.withColumn("case_name", F.lit("Bad Name")), proposals, documents, str(tmp_path / "gold"), AS_OF)[1].collect()] == ["bad_case_name"]
    other = done.withColumn("proposal_model", F.lit("m2"))
    assert [r.reason for r in K.finalise(other, proposals, documents, str(tmp_path / "gold"), AS_OF)[1].collect()] == ["provenance differs: proposal model"]
    statuses, rejected = K.finalise(done, proposals, documents, str(tmp_path / "gold"), AS_OF)
    assert [(r.case_name, r.status) for r in statuses.collect()] == [("case-1", "stored")] and rejected.count() == 0
    gold = spark.read.parquet(str(tmp_path / "gold"))
    assert gold.first().review_summary.asDict() == {"accepted": 1, "rejected": 1, "needs_edit": 0, "missed": 0}
    reports, statuses, rejected = K.evaluate(proposals, gold, str(tmp_path / "reports"))
    report = reports.first()
    assert (report.claim_precision, report.claim_recall, report.matched_claim_count, report.exact_claim_match_count, len(report.matches)) == (0.5, 1.0, 1, 1, 1) and rejected.count() == 0
    moved = gold.withColumn("section_text", F.lit("nothing"))
    assert [r.reason for r in K.evaluate(proposals, moved, str(tmp_path / "other"))[2].collect()] == ["evidence_absent"]
    assert [r.reason for r in K.evaluate(proposals, gold.withColumn("section_id", F.lit("x")), str(tmp_path / "other"))[2].collect()] == ["differ: section IDs"]


def test_json_in_ascii(spark):
    texts = ["plain", 'q"\\/', "tab\t\n\r\b\f", "\x01\x1f\x7f", "é ß 中", "😀 x", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.json_string(F.col("t")).alias("j")).collect()
    assert all(r.j == json.dumps(r.t) for r in rows)
    claim = {"claim_type": "risk", "statement": "café 😀", "metric": None, "scope_quote": None, "evidence_character_start": 3}
    df = spark.createDataFrame([(tuple(claim.values()),)], "c struct<claim_type: string, statement: string, metric: string, scope_quote: string, evidence_character_start: int>")
    want = json.dumps({k: v for k, v in claim.items() if k != "scope_quote"}, sort_keys=True, separators=(",", ":"))
    assert df.select(R.fingerprint(F.col("c"), list(claim)).alias("f")).first().f == hashlib.sha256(want.encode()).hexdigest()


def test_checkpoint_ids(spark):
    row = {"chunk_id": "item2-chunk-001", "character_start": 0, "character_end": 5, "prompt_version": "v1", "prompt_sha256": "aa", "source_content_sha256": "bb", "text_content_sha256": "cc"}
    got = X.checkpoint_id(spark.createDataFrame([(*row.values(), "héllo")], "chunk_id string, character_start int, character_end int, prompt_version string, prompt_sha256 string, source_content_sha256 string, text_content_sha256 string, text string")).first()
    named = {"chunk_start": 0, "chunk_end": 5, "chunk_text_sha256": hashlib.sha256("héllo".encode()).hexdigest()} | {k: v for k, v in row.items() if not k.startswith("character")}
    assert got.checkpoint_id == hashlib.sha256(json.dumps(named, sort_keys=True).encode()).hexdigest()[:16]


def test_export_leaves_out_chosen_nulls(spark, tmp_path):
    A.export_json(spark.createDataFrame([("a", None, None)], "x string, y string, z string"), str(tmp_path / "j"), omit=("z",))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "j")).collect()] == [{"x": "a", "y": None}]
