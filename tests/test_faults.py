"""Bad values and failed fetches are rows with a reason; claims of a section are grounded in one scan."""

import http.server
import random
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foliate import schemas
from foliate.operators import chunks as C
from foliate.operators import extract as X
from foliate.operators import ground as G
from foliate.plans import commands as K
from foliate.sources import filings as FI

AS_OF = datetime(2024, 5, 6)


def test_grounding_by_section_equals_grounding_by_claim(spark):
    r = random.Random(9)
    rows, claims = [], []
    for k in range(40):
        text = "".join(r.choice("aab ñ𝄞") for _ in range(r.randint(0, 40)))
        mine = []
        for j in range(12):
            a, b = sorted(r.randint(0, len(text)) for _ in range(2))
            cut = lambda: text[(x := r.randint(0, max(0, len(text) - 1))) : x + r.randint(1, 4)]  # noqa: E731, B023
            mine.append((a, b, cut() or "a", r.choice((None, cut() or "b", "zz")), j))
        rows.append((k, text, 100 * k, mine))
        claims += [(k, text, 100 * k, *c) for c in mine]
    struct = "chunk_start int, chunk_end int, evidence_quote string, scope_quote string, nth int"
    cases = spark.createDataFrame(rows, f"k int, section_text string, section_start int, claims array<struct<{struct.replace(' int', ': int').replace(' string', ': string')}>>")
    flat = spark.createDataFrame(claims, "k int, section_text string, section_start int, " + struct).withColumn("chunk", F.substring(F.col("section_text"), F.col("chunk_start") + 1, F.col("chunk_end") - F.col("chunk_start")))
    fields = ("evidence_status", "evidence_character_start", "evidence_character_end", "scope_character_start", "scope_character_end")
    want = {(x.k, x.nth): tuple(x[f] for f in fields) for x in G.ground(flat, F.col("section_text"), F.col("section_start"), F.col("chunk"), F.col("chunk_start")).collect()}
    got = {(x.k, x.nth): tuple(x[f] for f in fields) for x in G.ground_cases(cases).select("k", F.explode("grounded").alias("c")).select("k", "c.*").collect()}
    assert got == want and {w[0] for w in want.values()} == {"verified", "ambiguous", "not_found"}
    odd = spark.createDataFrame([(1, None, 0, [(0, 5, "a", None, 0)]), (2, "abc", 0, [(0, 3, None, None, 0), (0, 3, "", "a", 1)]), (3, "abc", 0, None)], cases.schema)
    assert {(x.k, x.c.evidence_status) for x in G.ground_cases(odd).select("k", F.explode("grounded").alias("c")).collect()} == {(1, "not_found"), (2, "not_found")}


def test_bad_claims_and_scores(spark):
    good = dict(claim_type="risk", statement="s", evidence_quote="q", evidence_status="verified")
    faults = [({}, None), ({"claim_type": "other"}, "unknown_claim_type"), ({"claim_type": None}, "unknown_claim_type"), ({"evidence_status": "maybe"}, "unknown_evidence_status"), ({"statement": ""}, "empty_claim"), ({"evidence_quote": None}, "empty_claim")]
    df = spark.createDataFrame([(k, [good, good | f]) for k, (f, _) in enumerate(faults)], "k int, claims array<struct<claim_type: string, statement: string, evidence_quote: string, evidence_status: string>>")
    assert [r.p for r in df.orderBy("k").select(K.claim_problem(F.col("claims")).alias("p")).collect()] == [w for _, w in faults]
    match = dict(predicted_claim_index=0, expected_claim_index=0, score=1.0, evidence_overlap=0.0, statement_similarity=0.5, field_similarity=1.0)
    faults = [({}, None), ({"predicted_claim_index": -1}, "negative_index"), ({"expected_claim_index": -2}, "negative_index"), ({"score": 1.01}, "score_out_of_range"), ({"field_similarity": -0.1}, "score_out_of_range"), ({"evidence_overlap": float("nan")}, "score_out_of_range")]
    df = spark.createDataFrame([(k, [match, match | f]) for k, (f, _) in enumerate(faults)], "k int, m array<struct<predicted_claim_index: int, expected_claim_index: int, score: double, evidence_overlap: double, statement_similarity: double, field_similarity: double>>")
    assert [r.p for r in df.orderBy("k").select(K.score_problem(F.col("m")).alias("p")).collect()] == [w for _, w in faults]


def test_settings_and_sizes(spark):
    with pytest.raises(ValueError, match="1000"):
        C.chunks(spark.createDataFrame([], "doc string, text string"), limit=999)
    for effort, tokens in (("extreme", 2000), (None, 1023)):
        with pytest.raises(ValueError):
            X.check_settings(effort, tokens)
    X.check_settings("high", 1024)


def test_documents_that_cannot_be_parsed(spark, tmp_path):
    pages = {"1": b"", "2": b"<p>12</p>", "3": b"<p>text without an item</p>", "4": None, "5": b"<!-- nothing -->"}
    archive = spark.createDataFrame([("7", k, v, "h") for k, v in pages.items()], "cik string, accession_number string, content binary, content_sha256 string")
    statuses, rejected = K.parse(archive, str(tmp_path / "parsed"))
    assert statuses.count() == 0
    assert {r.document_id: r.reason for r in rejected.collect()} == {"7-1": "empty_content", "7-2": "no_text", "7-3": "no_sections", "7-4": "empty_content", "7-5": "no_text"}


def test_sections_without_text_have_no_chunks(spark, tmp_path):
    section = ("part-i-item-2", "I", "2", "Item 2.", 0, 0, 2, " \n")
    documents = spark.createDataFrame([("d", "p", "a" * 64, "b" * 64, " \n", [section]), ("e", "p", "a" * 64, "c" * 64, "", []), ("f", "p", "a" * 64, "d" * 64, "", [section, section])], f"document_id string, {schemas.PARSED_DOCUMENT}")
    statuses, rejected = K.extract(documents, ("v1", "find"), lambda *_: {}, str(tmp_path / "out"), as_of=AS_OF)
    assert statuses.count() == 0 and {r.document_id: r.reason for r in rejected.collect()} == {"d": "no_chunks", "e": "section_missing", "f": "section_repeated"}


def test_answers_that_cannot_be_used_say_why(spark, tmp_path):
    text = "Net sales rose."
    documents = spark.createDataFrame([("d", "p", "a" * 64, "b" * 64, text, [("part-i-item-2", "I", "2", "Item 2.", 0, 0, len(text), text)])], f"document_id string, {schemas.PARSED_DOCUMENT}")
    told = spark.range(1).select(X.diagnostics(F.lit("incomplete"), F.lit("max_output_tokens"), F.lit(9), F.lit(None), F.lit("ab")).alias("d")).first().d
    assert told == "status=incomplete, reason=max_output_tokens, input_tokens=9, output_tokens=unknown, output_characters=2"
    for outcome in ("not_completed", "invalid_output", "truncated"):
        _, rejected = K.extract(documents, ("v1", "find"), lambda *_, o=outcome: {"outcome": o, "model": "m", "diagnostics": told}, str(tmp_path / outcome), as_of=AS_OF)
        assert [r.reason for r in rejected.collect()] == [f"extraction failed for item2-chunk-001: {told}"]


def test_another_chunker(spark, tmp_path):
    """A chunk for each half of a section; offsets and texts are the chunker's."""
    text = "Net sales rose. Costs fell."
    documents = spark.createDataFrame([("d", "p", "a" * 64, "b" * 64, text, [("part-i-item-2", "I", "2", "Item 2.", 0, 0, len(text), text)])], f"document_id string, {schemas.PARSED_DOCUMENT}")
    halves = lambda df: df.select("document_id", F.posexplode(F.split("text", r"(?<=\.) ")).alias("chunk_no", "text")).select(
        "document_id", F.concat(F.lit("half-"), F.col("chunk_no").cast("string")).alias("chunk_id"), "chunk_no", (F.col("chunk_no") * 16).cast("int").alias("character_start"), (F.col("chunk_no") * 16 + F.length("text")).cast("int").alias("character_end"), F.array().cast("array<string>").alias("heading_context"), "text")
    claim = {"claim_type": "risk", "statement": "s", "evidence_quote": "Costs fell"}
    answer = lambda i, *_: {"outcome": "completed", "model": "m", "claims": [claim] if i == "half-1" else []}
    statuses, rejected = K.extract(documents, ("v1", "find"), answer, str(tmp_path / "out"), as_of=AS_OF, chunker=halves)
    assert [(r.claim_count, r.verified_claim_count) for r in statuses.collect()] == [(1, 1)] and rejected.count() == 0
    p = spark.read.parquet(str(tmp_path / "out" / "proposals")).first()
    assert [r.chunk_id for r in p.responses] == ["half-0", "half-1"] and text[p.claims[0].evidence_character_start : p.claims[0].evidence_character_end] == "Costs fell"


class Pages(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        found = {"/a.htm": b"<p>a</p>", "/empty.htm": b""}.get(self.path)
        agent = self.headers.get("User-Agent")
        self.send_response(404 if found is None else 200 if agent == "me" else 403)
        self.end_headers()
        self.wfile.write(found or b"")

    def log_message(self, *args):
        pass


def test_one_bad_url_costs_one_row(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    filings = spark.createDataFrame([(k, u) for k, u in enumerate((f"{base}/a.htm", f"{base}/gone.htm", f"{base}/empty.htm", "no url", None))], "k int, source_url string")
    got = {r.k: (r.content, (r.fetch_problem or "").split(":")[0]) for r in FI.download(filings, "me", 5.0).collect()}
    assert got == {0: (b"<p>a</p>", ""), 1: (None, "HTTPError"), 2: (None, "empty filing"), 3: (None, "ValueError"), 4: (None, "ValueError")}
    server.shutdown()
