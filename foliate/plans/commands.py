"""The stages as functions over tables: ingest, parse, extract, create_review, finalise, evaluate.

Each takes many documents at once, writes its artifact and returns statuses and rejected rows
(with reason and stage). Times come from as_of, so that a run can be repeated; without it they are
the current time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate import schemas
from foliate.functions.text import artifact_name, safe_name, sha256, sum_if_all
from foliate.operators import chunks as C
from foliate.operators import evaluate as E
from foliate.operators import extract as X
from foliate.operators import review as R
from foliate.operators import sections as S
from foliate.operators.ground import deduplicate, ground_cases
from foliate.operators.html_blocks import html_blocks
from foliate.sources import artifacts as A
from foliate.sources import filings as FI
from foliate.sources.journal import Journal
from foliate.sources.shared import materialize

#: Versions in the records (fixed values).
PROPOSAL_VERSION, CHECKPOINT_VERSION, REVIEW_VERSION, GOLD_VERSION = "item2-claims-v2", "item2-chunk-checkpoint-v1", "item2-review-v1", "item2-gold-v1"
REPORT_VERSION = "item2-evaluation-v1"
PARSER_VERSION = "blocks-v1"
PROVENANCE = ("source_content_sha256", "text_content_sha256", "parser_version", "section_id")


def now(as_of: datetime | None) -> Column:
    """The time a record is given."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def ingest(submissions: DataFrame, fetch: Callable[[DataFrame], DataFrame], path: str, form_type: str | None = None, as_of: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Archive the latest filing of each form: statuses by cik and accession_number, and rejected filings.

    submissions: cik and body of the index; fetch adds the content of each filing.
    """
    latest = FI.latest_by_form(FI.decode_submissions(submissions), form_type)
    files = materialize(fetch(latest), "fetched")  # nothing is fetched twice
    problem = FI.archive_problem(F.col("cik"), F.col("accession_number"), F.col("content"))
    if "fetch_problem" in files.columns:
        problem = F.coalesce("fetch_problem", problem)
    good, bad = schemas.split_rejected(files, problem, "ingest")
    filing = F.struct(*[F.col(c) for c in ("cik", "accession_number", "form_type", "filed_at", "reporting_period", "primary_document", "source_url")])
    rows = good.select(
        "cik", "accession_number", filing.alias("filing"), "content", sha256(F.col("content")).alias("content_sha256"), F.octet_length("content").cast("long").alias("content_length_bytes"), now(as_of).alias("downloaded_at")
    )
    return A.write_once(rows, path, ["cik", "accession_number"], ["cik"], digest=F.col("content_sha256"), check=sha256(F.col("content")) == F.col("content_sha256")), bad


def parse(archive: DataFrame, path: str, parser_version: str = PARSER_VERSION) -> tuple[DataFrame, DataFrame]:
    """Parsed documents by document_id: status, section_count and character_count, and rejected filings."""
    filings = archive.select(F.concat_ws("-", "cik", "accession_number").alias("document_id"), "cik", "accession_number", "content", "content_sha256")
    blocks = materialize(S.narrative_blocks(html_blocks(filings.select("document_id", F.col("content").cast("binary").alias("html")), "document_id"), "document_id"), "blocks")
    found = S.sections(blocks, "document_id", "block")
    fields = ("section_id", "part", "item_number", "heading", "order", "character_start", "character_end", "text")
    packed = found.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(F.col("order").alias("o"), F.struct(*fields).alias("s")))).alias("x"))
    packed = packed.select("document_id", F.transform("x", lambda x: x["s"]).alias("sections"))
    counts = blocks.groupBy("document_id").agg(F.count("*").alias("n_blocks"))
    rows = filings.join(counts, "document_id", "left").join(S.document_text(blocks, "document_id", "block"), "document_id", "left").join(packed, "document_id", "left")
    good, bad = schemas.split_rejected(rows, S.parse_problem(F.octet_length("content"), F.col("n_blocks"), F.size("sections")), "parse")
    documents = good.select("document_id", "cik", "accession_number", F.lit(parser_version).alias("parser_version"), F.col("content_sha256").alias("source_content_sha256"), "text_content_sha256", F.col("doc_text").alias("text"), "sections")
    documents = materialize(documents, "parsed")
    statuses = A.regenerate(documents, path, "document_id")
    sizes = documents.select("document_id", F.size("sections").alias("section_count"), F.length("text").alias("character_count"))
    return statuses.join(sizes, "document_id"), bad.select("document_id", "reason", "stage")


def extract(
    documents: DataFrame, prompt: tuple[str, str], extractor: Callable[[str, str, str], dict], path: str, section_id: str = "part-i-item-2",
    max_chars: int = C.MAX_CHARS, split_chars: int = C.SPLIT_CHARS, as_of: datetime | None = None, chunker: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Proposals by document_id: status, claim_count, verified_claim_count and filtered_response_count
    (slices that no answer covers), and rejected documents.

    prompt is its version and text; extractor(chunk_id, system prompt, user prompt) answers one
    chunk. Checkpoints under path/checkpoints are answers of chunks with the same identity; only
    other chunks are asked for, once for all filings with the same bytes. Answers are kept under
    path/answers as they arrive. Where a chunk has no usable answer its document is rejected; the
    answers of its other chunks are stored all the same, so that a rerun asks for the rest only.
    chunker, where given, cuts sections (document_id, text) in place of C.chunks and returns its columns.
    """
    version, system = prompt
    hits = F.filter("sections", lambda s: s["section_id"] == section_id)
    reason = F.when(F.size(hits) == 0, "section_missing").when(F.size(hits) > 1, "section_repeated")
    chosen = documents.withColumn("section", F.get(hits, F.lit(0)))
    good, bad = schemas.split_rejected(chosen, reason, "extract")
    own = good.select("document_id", "source_content_sha256", "text_content_sha256", "parser_version", F.col("section.section_id").alias("section_id"), F.col("section.character_start").alias("section_start"), F.col("section.text").alias("section_text"))
    texts = own.select("document_id", F.col("section_text").alias("text"))
    made = chunker(texts) if chunker else C.chunks(texts, "document_id", limit=max_chars)
    prompted = made.join(own.drop("section_text"), "document_id").withColumns({"prompt_version": F.lit(version), "prompt_sha256": sha256(F.lit(system))})
    pieces = materialize(X.checkpoint_id(prompted.withColumn("chunk_key", F.concat_ws("/", "document_id", "chunk_id"))), "extract-chunks")
    empty = own.join(pieces.select("document_id").distinct(), "document_id", "left_anti").select("document_id", F.lit("no_chunks").alias("reason"), F.lit("extract").alias("stage"))

    claims = f"array<{schemas.PROPOSED_CLAIM}>"
    shape = documents.sparkSession.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in pieces.select(*X.IDENTITY, "checkpoint_id").dtypes) + f", schema_version string, response {schemas.RESPONSE}, output struct<claims: {claims}>")
    items = X.work_items(pieces)
    _, misses = X.split_work(items, A.read_once(shape, f"{path}/checkpoints"), X.IDENTITY)
    asked = ["chunk_key", "chunk_id", "character_start", "heading_context", "text", "section_id"]
    rounds = X.run_rounds(misses.select(*asked), lambda i, user: extractor(i, system, user), lambda df, k: materialize(df, f"extract-round-{k}"), split_chars, prompt=C.user_prompt(F.col("section_id"), F.col("chunk_id"), F.col("heading_context"), F.col("text")), journal=Journal(f"{path}/answers", f"{version}\n{system}"))
    answers = materialize(X.united(rounds, claims), "extract-answers")
    unusable = None
    for r in rounds:  # an answer that can't be used, anywhere below a chunk, takes out the documents that hold the chunk
        told = F.concat(F.lit("extraction failed for "), "chunk_id", F.coalesce(F.concat(F.lit(": "), F.nullif("diagnostics", F.lit(""))), F.lit("")))
        lost = r.where(~F.col("outcome").isin("completed", "truncated", "content_filtered")).select(F.substring_index("chunk_key", "/", 2).alias("chunk_key"), told.alias("reason"))
        unusable = lost if unusable is None else unusable.union(lost)
    unusable = materialize(items.select(*X.IDENTITY, "chunk_key").join(unusable, "chunk_key"), "extract-unusable")
    failed = pieces.select("document_id", *X.IDENTITY).join(unusable.select(*X.IDENTITY, "reason"), list(X.IDENTITY)).select("document_id", "reason", F.lit("extract").alias("stage")).distinct()
    answered = items.join(answers.drop("chunk_id"), "chunk_key").join(unusable.select("chunk_key").distinct(), "chunk_key", "left_anti")
    response = F.struct(
        "chunk_id", (F.col("section_start") + F.col("character_start")).cast("int").alias("chunk_character_start"), (F.col("section_start") + F.col("character_end")).cast("int").alias("chunk_character_end"), "heading_context", "model",
        "response_id", "input_tokens", "output_tokens", "raw_response", F.size("claims").alias("proposed_claim_count"), F.col("status").alias("response_status"), "failure_reason",
    )
    A.write_once(answered.select(*X.IDENTITY, "checkpoint_id", F.lit(CHECKPOINT_VERSION).alias("schema_version"), response.alias("response"), F.struct("claims").alias("output")), f"{path}/checkpoints", ["checkpoint_id"])

    done = pieces.select(*X.IDENTITY, "document_id", "section_id", "parser_version").join(A.read_once(shape, f"{path}/checkpoints").select(*X.IDENTITY, "response", "output"), list(X.IDENTITY))
    done = done.join(failed.select("document_id").distinct(), "document_id", "left_anti")
    asked = done.select("document_id", F.col("character_start").alias("chunk_start"), F.col("character_end").alias("chunk_end"), F.col("character_start").alias("chunk_ord"), F.posexplode("output.claims").alias("claim_ord", "c")).select("document_id", F.struct("chunk_start", "chunk_end", "chunk_ord", "claim_ord", "c.*").alias("c"))
    cases = asked.groupBy("document_id").agg(F.collect_list("c").alias("claims")).join(own.select("document_id", "section_start", "section_text"), "document_id")
    grounded = ground_cases(cases).select("document_id", F.explode("grounded").alias("c")).select("document_id", "c.*")
    kept = deduplicate(grounded, "document_id")
    fields = [*R.PROPOSED, "evidence_status", "evidence_character_start", "evidence_character_end", "scope_character_start", "scope_character_end"]
    listed = kept.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_ord", "claim_ord", F.struct(*fields).alias("c")))), lambda x: x["c"]).alias("claims"))
    ordered = F.array_sort(F.collect_list(F.struct("character_start", "response")))
    provenance = ["document_id", "prompt_version", "prompt_sha256", "source_content_sha256", "text_content_sha256", "parser_version", "section_id"]
    whole = done.groupBy(*provenance).agg(
        F.transform(ordered, lambda x: x["response"]).alias("responses"), F.collect_set("response.model").alias("models"), sum_if_all(F.col("response.input_tokens")).alias("input_tokens"), sum_if_all(F.col("response.output_tokens")).alias("output_tokens")
    )
    single, several = schemas.split_rejected(whole, F.when(F.size("models") != 1, "models_differ"), "extract")
    proposals = single.join(listed, "document_id", "left").select(
        "document_id", F.lit(PROPOSAL_VERSION).alias("schema_version"), *provenance[1:], now(as_of).alias("generated_at"), F.get("models", F.lit(0)).alias("model"), F.lit(None).cast("string").alias("response_id"), "input_tokens", "output_tokens",
        F.to_json(F.transform("responses", lambda r: r["raw_response"])).alias("raw_response"), F.coalesce("claims", F.array().cast(f"array<{schemas.GROUNDED_CLAIM}>")).alias("claims"), "responses",
    )
    proposals = materialize(proposals, "proposals")
    checked, wrong = schemas.split_rejected(proposals, claim_problem(F.col("claims")), "extract")
    statuses = A.write_once(checked, f"{path}/proposals", ["document_id", "prompt_version"], ["prompt_version"], digest=A.content_hash(checked.drop("generated_at"), ["document_id", "prompt_version"]))
    counts = proposals.select(
        "document_id", F.size("claims").alias("claim_count"), F.size(F.filter("claims", lambda c: c["evidence_status"] == "verified")).alias("verified_claim_count"),
        F.size(F.filter("responses", lambda r: r["response_status"] == "content_filtered")).alias("filtered_response_count"),
    )
    rejected = bad.select("document_id", "reason", "stage").union(empty).union(several.select("document_id", "reason", "stage")).union(wrong.select("document_id", "reason", "stage")).union(failed)
    return statuses.join(counts, "document_id"), rejected


def claim_problem(claims: Column) -> Column:
    """The first kind of claim fault in a list, else null: type or status outside its domain, empty statement or quote."""
    bad = lambda test: F.exists(claims, test)
    return (
        F.when(bad(lambda c: ~schemas.in_domain(c["claim_type"], schemas.CLAIM_TYPES)), "unknown_claim_type").when(bad(lambda c: ~schemas.in_domain(c["evidence_status"], schemas.EVIDENCE_STATUSES)), "unknown_evidence_status")
        .when(bad(lambda c: ~schemas.not_empty(c["statement"]) | ~schemas.not_empty(c["evidence_quote"])), "empty_claim")
    )


def create_review(proposals: DataFrame, reviewer: str, path: str, as_of: datetime | None = None) -> DataFrame:
    """A pending review of each proposal; statuses by document_id and prompt_version."""
    if not reviewer:
        raise ValueError("a review has a reviewer")
    fields = [f.name for f in proposals.schema["claims"].dataType.elementType.fields]
    rows = proposals.select(
        "document_id", F.lit(REVIEW_VERSION).alias("schema_version"), now(as_of).alias("created_at"), F.lit(reviewer).alias("reviewer"), F.col("response_id").alias("proposal_response_id"), F.col("model").alias("proposal_model"),
        "prompt_version", "prompt_sha256", "parser_version", "source_content_sha256", "text_content_sha256", "section_id", R.template(F.col("claims"), fields).alias("claim_reviews"),
        F.array().cast(f"array<{schemas.PROPOSED_CLAIM}>").alias("missed_claims"),
    )
    return A.write_once(rows, path, ["document_id", "prompt_version"], digest=A.content_hash(rows.drop("created_at"), ["document_id", "prompt_version"]))


def finalise(reviews: DataFrame, proposals: DataFrame, documents: DataFrame, path: str, as_of: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Gold cases of finished reviews (with a column case_name): statuses by case_name, and rejected reviews.

    The first fault counts: case name, provenance, review rules, decisions, section, evidence.
    """
    fields = [f.name for f in proposals.schema["claims"].dataType.elementType.fields]
    both = reviews.alias("r").join(proposals.alias("p"), ["document_id", "prompt_version"]).join(documents.select("document_id", "sections").alias("d"), "document_id")
    rows = both.select(
        "document_id", "r.case_name", F.struct("r.*").alias("r"), F.struct("p.*").alias("p"),
        F.get(F.filter("d.sections", lambda s: s["section_id"] == F.col("r.section_id")), F.lit(0)).alias("section"),
    )
    rows = materialize(rows, "finalise")
    reviewed = rows.select(F.col("case_name").alias("doc"), F.posexplode("r.claim_reviews").alias("ord", "x"))
    items = reviewed.select("doc", "ord", "x.claim_index", F.col("x.claim_fingerprint").alias("fingerprint"), F.to_json("x.proposed_claim").alias("claim"), "x.decision")
    proposed = rows.select(F.col("case_name").alias("doc"), F.posexplode("p.claims").alias("claim_index", "c")).select("doc", "claim_index", F.to_json("c").alias("claim"), R.fingerprint(F.col("c"), fields).alias("fingerprint"))
    violation = R.first_violation(items, proposed)
    decisions = reviewed.withColumn("problem", schemas.decision_problem(F.col("x.decision"), F.col("x.rejection_reason"), F.col("x.corrected_claim"))).groupBy("doc").agg(F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col("ord"))).alias("decision_problem"))
    left = F.filter(F.transform("r.claim_reviews", lambda x: R.decided_claim(x["decision"], R.as_proposed(x["proposed_claim"]), x["corrected_claim"])), lambda c: c.isNotNull())
    rows = rows.withColumn("expected", F.concat(left, "r.missed_claims"))
    claims = rows.select(F.col("case_name").alias("doc"), F.col("section.text").alias("section_text"), F.posexplode("expected").alias("ord", "c")).select("*", "c.*")
    evidence = R.gold_problem(claims, F.col("section_text")).groupBy("doc").agg(F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col("ord"))).alias("evidence_problem"))
    judged = rows.join(violation.withColumnRenamed("doc", "case_name"), "case_name", "left").join(decisions.withColumnRenamed("doc", "case_name"), "case_name", "left").join(evidence.withColumnRenamed("doc", "case_name"), "case_name", "left")
    differs = R.provenance_mismatches()
    reason = F.coalesce(
        F.when(~F.coalesce(F.regexp_like("case_name", F.lit(schemas.CASE_NAME)), F.lit(False)), "bad_case_name"), F.when(F.size(differs) > 0, F.concat(F.lit("provenance differs: "), F.array_join(differs, ", "))),
        "violation", "decision_problem", F.when(F.col("section").isNull(), "section_missing"), "evidence_problem",
    )
    good, bad = schemas.split_rejected(judged, reason, "finalise")
    count = lambda d: F.size(F.filter("r.claim_reviews", lambda x: x["decision"] == d)).alias(d)
    gold = good.select(
        "document_id", F.lit(GOLD_VERSION).alias("schema_version"), "case_name", now(as_of).alias("created_at"), "r.reviewer", "r.source_content_sha256", "r.text_content_sha256", "r.parser_version", "r.section_id",
        F.col("section.text").alias("section_text"), F.col("p.response_id").alias("created_from_response_id"), F.col("p.model").alias("created_from_model"), F.col("p.prompt_version").alias("created_from_prompt_version"),
        F.col("p.prompt_sha256").alias("created_from_prompt_sha256"), F.struct(count("accepted"), count("rejected"), count("needs_edit"), F.size("r.missed_claims").alias("missed")).alias("review_summary"), F.col("expected").alias("expected_claims"),
    )
    return A.write_once(gold, path, ["case_name"], digest=A.content_hash(gold.drop("created_at"), ["case_name"])), bad.select("document_id", "case_name", "reason", "stage")


def score_problem(matches: Column) -> Column:
    """Whether an index is negative or a score lies outside 0 to 1, else null."""
    scores = ("score", "evidence_overlap", "statement_similarity", "field_similarity")
    return F.when(F.exists(matches, lambda m: (m["predicted_claim_index"] < 0) | (m["expected_claim_index"] < 0)), "negative_index").when(
        F.exists(matches, lambda m: ~F.array_min(F.array(*[m[s].between(0, 1) for s in scores]))), "score_out_of_range")


def evaluate(proposals: DataFrame, gold: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reports of proposals against the gold cases of their documents: reports, statuses and rejected cases.

    A pair is rejected where hashes or section differ, or where evidence is absent from the gold
    section. Cases have one proposal each: callers choose the prompt version.
    """
    both = gold.alias("g").join(proposals.alias("p"), "document_id")
    labels = (("source hashes", "source_content_sha256"), ("text hashes", "text_content_sha256"), ("section IDs", "section_id"))
    differs = R.mismatches(tuple((label, F.col(f"p.{c}"), F.col(f"g.{c}")) for label, c in labels))
    rows = both.select("document_id", "g.case_name", "g.section_text", "g.expected_claims", "p.claims", F.col("p.response_id").alias("proposal_response_id"), "p.model", "p.prompt_version", "p.prompt_sha256", F.when(F.size(differs) > 0, F.concat_ws(", ", differs)).alias("differs"))
    good, bad = schemas.split_rejected(materialize(rows, "evaluate"), F.when(F.col("differs").isNotNull(), F.concat(F.lit("differ: "), "differs")), "evaluate")
    key = ("case_name",)
    predicted = good.select("case_name", F.posexplode("claims").alias("p_index", "c")).select("case_name", "p_index", "c.*")
    expected = good.select("case_name", F.posexplode("expected_claims").alias("e_index", "c")).select("case_name", "e_index", "c.*")
    sides = [predicted.where("evidence_status = 'verified'").select("case_name", *R.PROPOSED), expected.select("case_name", *R.PROPOSED)]
    absent = E.located(sides[0].union(sides[1]), good, key).where("span_problem IS NOT NULL").groupBy("case_name").agg(F.min("span_problem").alias("reason"))
    absent = materialize(absent, "evaluate-absent")
    good = good.join(absent, "case_name", "left_anti")
    predicted, expected = (df.join(absent, "case_name", "left_anti") for df in (predicted, expected))
    matches = E.greedy_match(E.candidates(predicted, expected, good, key), key)
    p, e = predicted.select("case_name", "p_index", F.struct(*R.PROPOSED).alias("p")), expected.select("case_name", "e_index", F.struct(*R.PROPOSED).alias("e"))
    matches = matches.join(p, ["case_name", "p_index"]).join(e, ["case_name", "e_index"]).withColumns({"type_equal": F.col("p.claim_type") == F.col("e.claim_type"), "exact_claim": F.col("p").eqNullSafe(F.col("e"))})
    listed = matches.groupBy("case_name").agg(F.array_sort(F.collect_list(F.struct(F.col("p_index").alias("predicted_claim_index"), F.col("e_index").alias("expected_claim_index"), "method", "score", "evidence_overlap", "statement_similarity", "field_similarity"))).alias("matches"))
    base = good.select("case_name", "document_id", F.lit(REPORT_VERSION).alias("schema_version"), "proposal_response_id", "model", "prompt_version", "prompt_sha256")
    reports = materialize(E.report(base, predicted, expected, matches, key).join(listed, "case_name", "left"), "reports")
    sound, odd = schemas.split_rejected(reports, score_problem(F.col("matches")), "evaluate")
    statuses = A.write_once(sound, path, ["case_name", "schema_version", "prompt_version"], ["case_name", "schema_version"])
    lost = absent.select("case_name", "reason", F.lit("evaluate").alias("stage"))
    return sound, statuses, bad.select("case_name", "reason", "stage").union(lost).union(odd.select("case_name", "reason", "stage"))


def export(artifacts: DataFrame, path: str, kind: str) -> None:
    """Write stored artifacts as JSON files, one for each record, in a folder named by what tells them apart."""
    by = {"documents": ["document_id"], "proposals": ["document_id", "name"], "reviews": ["document_id", "name"], "gold": ["document_id", "case_name"], "reports": ["case_name", "name"]}[kind]
    names = {"proposals": artifact_name(F.col("response_id"), F.col("generated_at")), "reviews": artifact_name(F.col("proposal_response_id"), F.col("created_at")), "reports": safe_name(F.col("prompt_version"))}
    named = artifacts.drop("commit").withColumns({"name": names[kind]} if kind in names else {})
    if kind == "gold":  # a case is named inside its record, too
        named = named.withColumn("folder", F.col("case_name"))
        by = ["document_id", "folder"]
    A.export_records(named, path, by)
