"""Human review: templates, validation and gold cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions.text import count_of, find, json_string, sha256

NUMBERS = ("evidence_character_start", "evidence_character_end", "scope_character_start", "scope_character_end")
PROPOSED = ("claim_type", "statement", "evidence_quote", "scope_quote", "metric", "value", "period")
#: Labels of the provenance comparison and the columns they compare (fixed values).
PROVENANCE = (
    ("proposal response ID", "proposal_response_id", "response_id"), ("proposal model", "proposal_model", "model"), ("prompt version", "prompt_version", "prompt_version"),
    ("prompt hash", "prompt_sha256", "prompt_sha256"), ("parser version", "parser_version", "parser_version"), ("source hash", "source_content_sha256", "source_content_sha256"),
    ("text hash", "text_content_sha256", "text_content_sha256"), ("section ID", "section_id", "section_id"),
)


def as_proposed(claim: Column) -> Column:
    return F.struct(*[claim[c].alias(c) for c in PROPOSED])


def fingerprint(claim: Column, fields: list[str]) -> Column:
    """SHA-256 of the claim as ASCII JSON with sorted keys; null scope fields are left out, other nulls stay."""
    parts = []
    for f in sorted(fields):
        value = json_string(claim[f].cast("string")) if f not in NUMBERS else claim[f].cast("string")
        inner = F.concat(F.lit(f'"{f}":'), F.coalesce(value, F.lit("null")))
        parts.append(F.when(claim[f].isNotNull(), inner) if f.startswith("scope_") else inner)
    return sha256(F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}")))


def template(claims: Column, fields: list[str]) -> Column:
    """claim_reviews of a fresh review: every claim pending."""
    return F.transform(claims, lambda c, i: F.struct(
        i.alias("claim_index"), fingerprint(c, fields).alias("claim_fingerprint"), c.alias("proposed_claim"), F.lit("pending").alias("decision"),
        F.lit(None).cast("string").alias("rejection_reason"), F.when(F.lit(False), as_proposed(c)).alias("corrected_claim"), F.lit(None).cast("string").alias("notes"),
    ))


def mismatches(pairs: tuple[tuple[str, Column, Column], ...]) -> Column:
    """Labels of the pairs that differ, nulls compared as values, in order."""
    return F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), F.lit(label)) for label, a, b in pairs]))


def provenance_mismatches(review: str = "r", proposal: str = "p") -> Column:
    return mismatches(tuple((label, F.col(f"{review}.{a}"), F.col(f"{proposal}.{b}")) for label, a, b in PROVENANCE))


def first_violation(reviews: DataFrame, proposed: DataFrame, key: str = "doc") -> DataFrame:
    """The first broken rule of each case, null where none is.

    reviews: key, ord, claim_index, fingerprint, claim, decision; proposed: key, claim_index, fingerprint, claim.
    Rules, in order: as many reviews as claims; then for each review in turn: index not seen
    before, index in range, claim unchanged, fingerprint right, no longer pending.

    Both sides meet in one exchange, by case, and texts go there as SHA-256 digests.
    """
    short = lambda df, c: F.unhex(sha256(F.col(c))) if df.schema[c].dataType.simpleString() == "string" else F.col(c)
    same = lambda df: (key, "claim_index", F.struct(short(df, "claim").alias("claim"), short(df, "fingerprint").alias("fingerprint")).alias("said"))
    own = reviews.select(*same(reviews), F.lit(1).alias("side"), "ord", F.coalesce(F.col("decision") == "pending", F.lit(False)).alias("pending"))
    rows = own.unionByName(proposed.select(*same(proposed), F.lit(0).alias("side")), allowMissingColumns=True)
    # The window by case comes first, so that its exchange serves the other one and the aggregate.
    rows = rows.withColumn("n_claims", F.count_if(F.col("side") == 0).over(W.partitionBy(key)))
    so_far = W.partitionBy(key, "claim_index").orderBy("side", "ord").rowsBetween(W.unboundedPreceding, 0)
    meant = F.collect_list(F.when((F.col("side") == 0) & F.col("claim_index").isNotNull(), F.col("said"))).over(so_far)
    rows = rows.withColumn("nth", F.count_if(F.col("side") == 1).over(so_far)).withColumn("meant", meant)
    differs = lambda c: F.when(F.size("meant") == 0, F.col(f"said.{c}").isNotNull()).otherwise(F.exists("meant", lambda m: ~m[c].eqNullSafe(F.col(f"said.{c}"))))
    broken = (
        F.when(F.col("nth") > 1, "duplicate_index").when(F.col("claim_index") >= F.col("n_claims"), "index_out_of_range")
        .when(differs("claim"), "claim_differs").when(differs("fingerprint"), "fingerprint_differs").when(F.col("pending"), "pending")
    )
    rows = rows.withColumn("_b", F.when(F.col("side") == 1, broken))
    cases = rows.groupBy(key).agg(
        F.count_if(F.col("side") == 0).alias("n_claims"), F.count_if(F.col("side") == 1).alias("n_reviews"), F.min_by("_b", F.when(F.col("_b").isNotNull(), F.col("ord"))).alias("row_violation")
    )
    return cases.select(key, F.when(F.col("n_claims") != F.col("n_reviews"), "count_differs").otherwise(F.col("row_violation")).alias("violation"))


def decided_claim(decision: Column, proposed: Column, corrected: Column) -> Column:
    """The claim that a decision leaves: the proposed, the corrected or none."""
    return F.when(decision == "accepted", proposed).when(decision == "needs_edit", corrected)


def gold_claims(reviews: DataFrame, missed: DataFrame, key: str = "doc") -> DataFrame:
    """Expected claims in order: those that reviews leave, then the missed ones. Columns key, ord, claim."""
    kept = reviews.select(key, F.lit(0).alias("part"), F.col("claim_index").alias("pos"), decided_claim(F.col("decision"), F.col("claim"), F.col("corrected")).alias("claim")).where("claim IS NOT NULL")
    both = kept.unionByName(missed.select(key, F.lit(1).alias("part"), F.col("pos"), F.col("claim")))
    return both.select(key, (F.row_number().over(W.partitionBy(key).orderBy("part", "pos")) - 1).alias("ord"), "claim")


def review_summary(reviews: DataFrame, missed: DataFrame, key: str = "doc") -> DataFrame:
    counts = reviews.groupBy(key).agg(*[F.count_if(F.col("decision") == d).alias(d) for d in ("accepted", "rejected", "needs_edit")])
    extra = missed.groupBy(key).agg(F.count("*").alias("missed"))
    return counts.join(extra, key, "full").select(key, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("accepted", "rejected", "needs_edit", "missed")])


def gold_problem(claims: DataFrame, section: Column, key: str = "doc", order: str = "ord") -> DataFrame:
    """claims with `problem`: repeated (scope, quote), scope not exactly once, or no evidence behind it."""
    q, s = F.col("evidence_quote"), F.col("scope_quote")
    nth = F.row_number().over(W.partitionBy(key, "scope_quote", "evidence_quote").orderBy(order))
    behind = F.substring(section, find(section, s) + F.length(s) + 1, F.length(section))
    hits = F.when(s.isNull(), count_of(section, q)).otherwise(count_of(behind, q))
    return claims.withColumn("_nth", nth).withColumn(
        "problem", F.when(F.col("_nth") > 1, "duplicate_evidence").when(s.isNotNull() & (count_of(section, s) != 1), "scope_not_unique").when(hits < 1, "evidence_outside_scope")
    ).drop("_nth")
