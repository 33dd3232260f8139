"""Record layouts and the constraints on their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTION = "struct<section_id: string, part: string, item_number: string, heading: string, `order`: int, character_start: int, character_end: int, text: string>"
FILING = "struct<cik: string, accession_number: string, form_type: string, filed_at: date, reporting_period: date, primary_document: string, source_url: string>"
PROPOSED_CLAIM = "struct<claim_type: string, statement: string, evidence_quote: string, scope_quote: string, metric: string, value: string, period: string>"
GROUNDED_CLAIM = PROPOSED_CLAIM[:-1] + ", evidence_status: string, evidence_character_start: int, evidence_character_end: int, scope_character_start: int, scope_character_end: int>"
RESPONSE = (
    "struct<chunk_id: string, chunk_character_start: int, chunk_character_end: int, heading_context: array<string>, model: string, response_id: string, "
    "input_tokens: bigint, output_tokens: bigint, raw_response: string, proposed_claim_count: int, response_status: string, failure_reason: string>"
)
FILING_ARCHIVE = f"filing {FILING}, content binary, content_sha256 string, content_length_bytes bigint, downloaded_at timestamp"
PARSED_DOCUMENT = f"parser_version string, source_content_sha256 string, text_content_sha256 string, text string, sections array<{SECTION}>"
CHECKPOINT = (
    "schema_version string, prompt_version string, prompt_sha256 string, source_content_sha256 string, text_content_sha256 string, chunk_text_sha256 string, "
    f"response {RESPONSE}, output struct<claims: array<{PROPOSED_CLAIM}>>"
)
PROPOSAL = (
    "schema_version string, prompt_version string, prompt_sha256 string, generated_at timestamp, source_content_sha256 string, text_content_sha256 string, parser_version string, section_id string, "
    f"model string, response_id string, input_tokens bigint, output_tokens bigint, raw_response string, claims array<{GROUNDED_CLAIM}>, responses array<{RESPONSE}>"
)
CLAIM_REVIEW = f"struct<claim_index: int, claim_fingerprint: string, proposed_claim: {GROUNDED_CLAIM}, decision: string, rejection_reason: string, corrected_claim: {PROPOSED_CLAIM}, notes: string>"
REVIEW = (
    "schema_version string, created_at timestamp, reviewer string, proposal_response_id string, proposal_model string, prompt_version string, prompt_sha256 string, parser_version string, "
    f"source_content_sha256 string, text_content_sha256 string, section_id string, claim_reviews array<{CLAIM_REVIEW}>, missed_claims array<{PROPOSED_CLAIM}>"
)
GOLD_CASE = (
    "schema_version string, case_name string, created_at timestamp, reviewer string, source_content_sha256 string, text_content_sha256 string, parser_version string, section_id string, section_text string, "
    "created_from_response_id string, created_from_model string, created_from_prompt_version string, created_from_prompt_sha256 string, "
    f"review_summary struct<accepted: int, rejected: int, needs_edit: int, missed: int>, expected_claims array<{PROPOSED_CLAIM}>"
)

#: Values of the enumerated columns (fixed by the record format).
CLAIM_TYPES = ("financial_result", "business_driver", "management_outlook", "risk", "capital_allocation")
EVIDENCE_STATUSES = ("verified", "ambiguous", "not_found")
RESPONSE_STATUSES = ("completed", "content_filtered")
DECISIONS = ("pending", "accepted", "rejected", "needs_edit")
REJECTION_REASONS = ("unsupported", "not_material", "duplicate", "wrong_scope", "other")
METHODS = ("exact_evidence", "evidence_overlap", "field_similarity")

HEX64 = "^[0-9a-f]{64}$"
CASE_NAME = "^[a-z0-9][a-z0-9-]*$"


def in_domain(x: Column, domain: tuple[str, ...]) -> Column:
    return F.coalesce(x.isin(*domain), F.lit(False))


def is_hash(x: Column) -> Column:
    return F.coalesce(F.regexp_like(x, F.lit(HEX64)), F.lit(False))


def not_empty(x: Column) -> Column:
    return F.coalesce(F.length(x) >= 1, F.lit(False))


def decision_problem(decision: Column, rejection_reason: Column, corrected: Column) -> Column:
    """The first rule of a review decision that is broken, else null."""
    return (
        F.when(~in_domain(decision, DECISIONS), "unknown_decision")
        .when((decision == "rejected") & rejection_reason.isNull(), "rejected_without_reason")
        .when((decision == "needs_edit") & corrected.isNull(), "needs_edit_without_correction")
        .when((decision != "rejected") & rejection_reason.isNotNull(), "reason_without_rejection")
        .when((decision != "needs_edit") & corrected.isNotNull(), "correction_without_needs_edit")
    )


def split_rejected(df: DataFrame, reason: Column, stage: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and the others with it; strict makes any of these fail the job."""
    marked = df.withColumn("reason", F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit(f"{stage}: "), reason))) if strict else reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL").withColumn("stage", F.lit(stage))
