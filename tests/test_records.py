"""Records to JSON and back, and what is rejected."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliate import schemas
from foliate.sources import artifacts as A
from foliate.sources import filings as FI
from foliate.sources import records as RD

HASH = "a" * 64
CLAIM = {"claim_type": "risk", "statement": "s", "evidence_quote": "q", "scope_quote": None, "metric": None, "value": "1", "period": None}
GROUNDED = CLAIM | {"evidence_status": "verified", "evidence_character_start": 1, "evidence_character_end": 2, "scope_character_start": None, "scope_character_end": None}
RESPONSE = {
    "chunk_id": "c", "chunk_character_start": 0, "chunk_character_end": 9, "heading_context": ["A", "B"], "model": "m", "response_id": "r", "input_tokens": 2**40, "output_tokens": None, "raw_response": '{"x": "é"}',
    "proposed_claim_count": 1, "response_status": "completed", "failure_reason": None,
}
PROVENANCE = {"source_content_sha256": HASH, "text_content_sha256": HASH, "parser_version": "p", "section_id": "x"}
TIME = "2024-05-06T07:08:09.000Z"
SECTION = {"section_id": "part-i-item-2", "part": "I", "item_number": "2", "heading": "Item 2.", "order": 0, "character_start": 0, "character_end": 4, "text": "text"}
RECORDS = {
    "documents": (schemas.PARSED_DOCUMENT, {"parser_version": "p", "source_content_sha256": HASH, "text_content_sha256": HASH, "text": "a\n\nb “c”", "sections": [SECTION, SECTION]}),
    "proposals": (schemas.PROPOSAL, {"schema_version": "v", "prompt_version": "v1", "prompt_sha256": HASH, "generated_at": TIME, **PROVENANCE, "model": "m", "response_id": None, "input_tokens": 1, "output_tokens": 2, "raw_response": "[]", "claims": [GROUNDED], "responses": [RESPONSE]}),
    "reviews": (schemas.REVIEW, {"schema_version": "v", "created_at": TIME, "reviewer": "ann", "proposal_response_id": None, "proposal_model": "m", "prompt_version": "v1", "prompt_sha256": HASH, **PROVENANCE, "claim_reviews": [{"claim_index": 0, "claim_fingerprint": HASH, "proposed_claim": GROUNDED, "decision": "needs_edit", "rejection_reason": None, "corrected_claim": CLAIM, "notes": "n"}], "missed_claims": []}),
    "gold_cases": (schemas.GOLD_CASE, {"schema_version": "v", "case_name": "case-1", "created_at": TIME, "reviewer": "ann", **PROVENANCE, "section_text": "t", "created_from_response_id": None, "created_from_model": "m", "created_from_prompt_version": "v1", "created_from_prompt_sha256": HASH, "review_summary": {"accepted": 1, "rejected": 0, "needs_edit": 0, "missed": 0}, "expected_claims": [CLAIM]}),
    "checkpoints": (schemas.CHECKPOINT, {"schema_version": "v", "prompt_version": "v1", "prompt_sha256": HASH, "source_content_sha256": HASH, "text_content_sha256": HASH, "chunk_text_sha256": HASH, "response": RESPONSE, "output": {"claims": [CLAIM]}}),
}


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_round_trip(spark, tmp_path, name):
    ddl, record = RECORDS[name]
    assert set(record) == {f.name for f in StructType.fromDDL(ddl).fields}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(json.dumps(record, indent=2) + "\n", encoding="utf-8")
    good, bad = RD.read_records(spark, str(tmp_path / "in"), ddl)
    assert bad.count() == 0 and good.count() == 1
    A.export_json(good, str(tmp_path / "out"))
    again, bad = RD.read_records(spark, str(tmp_path / "out"), ddl, lines=True)
    assert bad.count() == 0 and again.collect() == good.collect()
    written = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert written == record
    reader = getattr(FI, f"read_{name}")
    assert reader(spark, str(tmp_path / "in")).collect() == good.collect()


def test_rejects(spark):
    ddl, record = RECORDS["proposals"]
    deep = lambda **c: {"claims": [GROUNDED, GROUNDED | c]}
    faulty = {
        "not JSON": "{", "$: no struct": "[]", "$.extra: unknown field": record | {"extra": 1}, "$.claims[1].extra: unknown field": record | deep(extra=None), "$.responses[0].heading_context[1]: no string": record | {"responses": [RESPONSE | {"heading_context": ["A", 1]}]},
        "$.model: no string": record | {"model": 5}, "$.input_tokens: no bigint": record | {"input_tokens": "7"}, "$.claims[1].evidence_character_start: no int": record | deep(evidence_character_start=2**40), "$.claims: no array": record | {"claims": {}},
        "$.claims[0]: no struct": record | {"claims": ["x"]}, "$.generated_at: no timestamp": record | {"generated_at": "yesterday"}, "$.prompt_sha256: no hash": record | {"prompt_sha256": "A" * 64}, "$.text_content_sha256: no hash": {k: v for k, v in record.items() if k != "text_content_sha256"},
    }
    rows = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in faulty.items()] + [("good", json.dumps(record)), ("not JSON", None), ("$: no struct", "null")]
    good, bad = RD.parse_records(spark.createDataFrame(rows, "want string, body string"), ddl)
    assert [r.want for r in good.collect()] == ["good"]
    assert [(r.reason, r.stage) for r in bad.collect()] == [(w, "read") for w, _ in rows if w != "good"]
    none = RD.parse_records(spark.createDataFrame([], "body string"), ddl)
    assert none[0].count() == 0 and none[1].count() == 0


def test_domains(spark):
    x = spark.createDataFrame([("risk", "", HASH), ("other", "a", "A" * 64), (None, None, None)], "t string, s string, h string")
    got = x.select(schemas.in_domain(F.col("t"), schemas.CLAIM_TYPES), schemas.not_empty(F.col("s")), schemas.is_hash(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (False, True, False), (False, False, False)]


def test_exported_records_are_read_back(spark, tmp_path):
    """Indented files, one a record, that leave out null scopes at any depth and keep other nulls."""
    from foliate.plans import commands as K

    ddl, record = RECORDS["proposals"]
    rows, _ = RD.parse_records(spark.createDataFrame([(json.dumps(record),), (json.dumps(record | {"response_id": "r/1", "claims": []}),)], "body string"), ddl)
    K.export(rows.withColumn("document_id", F.lit("7-1")), str(tmp_path / "out"), "proposals")
    files = sorted(p for p in (tmp_path / "out").rglob("*.txt"))
    assert sorted(str(p.parent.relative_to(tmp_path / "out")) for p in files) == ["document_id=7-1/name=20240506T070809.000000Z", "document_id=7-1/name=r-1"]
    first = json.loads(files[0].read_text(encoding="utf-8"))
    assert "scope_quote" not in first["claims"][0] and first["claims"][0]["metric"] is None and first["response_id"] is None and "document_id" not in first
    assert files[0].read_text(encoding="utf-8").startswith('{\n  "schema_version": "v",\n')
    back, bad = RD.read_records(spark, str(tmp_path / "out"), ddl)
    assert bad.count() == 0 and sorted(map(repr, back.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    ddl, record = RECORDS["gold_cases"]
    gold, _ = RD.parse_records(spark.createDataFrame([(json.dumps(record),)], "body string"), ddl)
    K.export(gold.withColumn("document_id", F.lit("7-1")), str(tmp_path / "gold"), "gold")
    back, bad = RD.read_records(spark, str(tmp_path / "gold"), ddl)
    assert bad.count() == 0 and back.select(*gold.columns).collect() == gold.collect()
