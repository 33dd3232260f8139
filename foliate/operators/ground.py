"""Claims to verbatim spans: verified, ambiguous or not found."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions.text import count_of, find, find_last


def ground(claims: DataFrame, section: Column, section_start: Column, chunk: Column, chunk_start: Column, quote: str = "evidence_quote", scope: str = "scope_quote") -> DataFrame:
    """Add evidence_status and, where verified, document-absolute spans of evidence and scope.

    In this order: a quote that isn't in its chunk is not found; one that is there again, overlaps
    included, is ambiguous; with a scope that is neither in the chunk nor earlier in the section
    it is not found; without a scope, a quote that the section holds more than once is ambiguous.
    """
    q, s = F.col(quote), F.col(scope)
    staged = claims.withColumns({
        "_at": find(chunk, q), "_more": count_of(section, q), "_in": find(chunk, s), "_back": find_last(section, s, chunk_start),
    })
    staged = staged.withColumns({
        "_again": F.when(F.col("_at") >= 0, F.call_function("locate", q, chunk, F.col("_at") + 2) - 1),
        "_scope": F.when(F.col("_in") >= 0, chunk_start + F.col("_in")).when(F.col("_back") >= 0, F.col("_back")),
    })
    status = (
        F.when(F.col("_at") < 0, "not_found")
        .when(F.col("_again") >= 0, "ambiguous")
        .when(s.isNotNull() & F.col("_scope").isNull(), "not_found")
        .when(s.isNull() & (F.col("_more") > 1), "ambiguous")
        .otherwise("verified")
    )
    staged = staged.withColumn("evidence_status", status)
    ok = F.col("evidence_status") == "verified"
    start = (section_start + chunk_start + F.col("_at")).cast("int")
    scope_start = (section_start + F.col("_scope")).cast("int")
    return staged.withColumns({
        "evidence_character_start": F.when(ok, start), "evidence_character_end": F.when(ok, start + F.length(q)),
        "scope_character_start": F.when(ok & s.isNotNull(), scope_start), "scope_character_end": F.when(ok & s.isNotNull(), scope_start + F.length(s)),
    }).drop("_at", "_more", "_in", "_back", "_again", "_scope")


def occurrences(text: str, needles: set[str]) -> dict[str, list[int]]:
    """Where each needle begins in a text, overlaps included, by one scan for all of them."""
    import ahocorasick

    found: dict[str, list[int]] = {n: [] for n in needles}
    automaton = ahocorasick.Automaton()
    for n in needles:
        if n:
            automaton.add_word(n, n)
    if len(automaton):
        automaton.make_automaton()
        for last, n in automaton.iter(text):
            found[n].append(last - len(n) + 1)
    return found


def several(starts: list[int], length: int) -> bool:
    """Whether two of the occurrences don't overlap."""
    return len(starts) > 1 and starts[-1] - starts[0] >= length


def judge_claim(found: dict[str, list[int]], quote: str | None, scope: str | None, first: int, last: int) -> tuple[str, int | None, int | None]:
    """Status of a claim of the chunk from first to last, and where quote and scope begin in the section: ground's rules."""
    at = found[quote] if quote else []
    k = bisect_left(at, first)
    inside = at[k : k + 2]
    while inside and inside[-1] + len(quote) > last:
        inside.pop()
    if not inside:
        return "not_found", None, None
    if len(inside) > 1:
        return "ambiguous", None, None
    if scope is None:
        return ("ambiguous", None, None) if several(at, len(quote)) else ("verified", inside[0], None)
    near = found[scope] if scope else []
    k = bisect_left(near, first)
    if k < len(near) and near[k] + len(scope) <= last:
        return "verified", inside[0], near[k]
    k = bisect_left(near, first - len(scope) + 1)
    return ("verified", inside[0], near[k - 1]) if k and scope else ("not_found", None, None)


def ground_cases(cases: DataFrame, text: str = "section_text", start: str = "section_start", claims: str = "claims", quote: str = "evidence_quote", scope: str = "scope_quote") -> DataFrame:
    """ground for the claims of whole sections: one row holds a section's text once, and all its claims.

    claims is an array of structs with quote, scope, and chunk_start and chunk_end, the chunk's place in
    the section. The result has, for text and claims, an array `grounded` of the same structs with
    evidence_status and the document-absolute spans. A text is scanned once, whatever the number of
    its claims; a null text or quote finds nothing, nor does an empty quote or scope.
    """
    element = cases.schema[claims].dataType.elementType
    rest = [c for c in cases.columns if c not in (text, claims)]
    spans = ("evidence_character_start", "evidence_character_end", "scope_character_start", "scope_character_end")
    names = ("evidence_status", *spans)
    added = pa.struct([("evidence_status", pa.string()), *[(c, pa.int32()) for c in spans]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, base, own in zip(*(batch.column(c).to_pylist() for c in (text, start, "_asked")), strict=True):
                found = occurrences(body or "", {x for c in own or () for x in (c["q"], c["s"]) if x is not None})
                rows = []
                for c in own or ():
                    status, at, near = judge_claim(found, c["q"], c["s"], c["a"], c["b"])
                    ok = status == "verified"
                    ends = (base + at, base + at + len(c["q"])) if ok else (None, None)
                    rows.append(dict(zip(names, (status, *ends, *((base + near, base + near + len(c["s"])) if ok and near is not None else (None, None))), strict=True)))
                out.append(rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], batch.column(claims), pa.array(out, pa.list_(added))], names=[*rest, claims, "_found"])

    ddl = ", ".join(f"`{c}` {cases.schema[c].dataType.simpleString()}" for c in [*rest, claims])
    asked = F.transform(claims, lambda c: F.struct(c[quote].alias("q"), c[scope].alias("s"), c["chunk_start"].cast("int").alias("a"), c["chunk_end"].cast("int").alias("b")))
    found = cases.withColumn("_asked", asked).mapInArrow(run, f"{ddl}, _found array<struct<evidence_status: string, " + ", ".join(f"{c}: int" for c in spans) + ">>")
    fields = [f.name for f in element.fields if f.name not in ("evidence_status", *spans)]
    both = F.zip_with(claims, "_found", lambda c, f: F.struct(*[c[n].alias(n) for n in fields], *[f[n].alias(n) for n in ("evidence_status", *spans)]))
    return found.select(*rest, both.alias("grounded"))


def deduplicate(claims: DataFrame, key: str = "doc", order: tuple[str, ...] = ("chunk_ord", "claim_ord")) -> DataFrame:
    """The first claim of each span, type and scope; claims without a span are told apart by their quote."""
    identity = [key, "evidence_character_start", "evidence_character_end", "claim_type", "scope_quote", F.when(F.col("evidence_character_start").isNull(), F.col("evidence_quote"))]
    return claims.withColumn("_r", F.row_number().over(W.partitionBy(*identity).orderBy(*order))).where("_r = 1").drop("_r")
