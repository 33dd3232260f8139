"""Sections to bounded chunks with heading context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions.text import is_heading, is_period, pad_number, strip

MAX_CHARS = 12_000
SPLIT_CHARS = 6_000
MIN_CHARS = 1_000
#: A paragraph (a fixed pattern): from a character that is no line feed, lazily, up to blank lines or the end;
#: (?s)[^\n](?:.*?[^\n])?(?=\n{2,}|\z) by lines instead of characters, which takes back none of them.
PARAGRAPH = r"[^\n](?:(?:[^\n]++|\n++[^\n]++)(?:\n[^\n]++)*+)?(?=\n{2,}|\z)"


def _pieces(text: Column) -> Column:
    """array<struct<gap, raw>> of the paragraphs, with what stands between each and the one before."""
    raw = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.filter(F.arrays_zip(F.split(text, PARAGRAPH).alias("gap"), raw.alias("raw")), lambda p: p["raw"].isNotNull())


def paragraphs(sections: DataFrame, key: str = "doc", text: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """One row for each paragraph that holds more than white space: key, idx, start, end, raw,
    paragraph (stripped), gap (what stands before it) and the columns to carry.

    Offsets are a running sum over a section's rows, which carry their own text only.
    """
    rows = sections.select(key, *carry, F.posexplode(_pieces(F.col(text))).alias("piece", "p")).select("*", "p.gap", "p.raw").drop("p")
    w = W.partitionBy(key).orderBy("piece")
    end = F.sum(F.length("gap") + F.length("raw")).over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int")
    rows = rows.withColumn("end", end).withColumn("start", (F.col("end") - F.length("raw")).cast("int"))
    # A paragraph of white space only is no row, but part of the gap before the next one.
    blank = ~F.regexp_like("raw", F.lit(r"(?U)[^\s\x1c-\x1f]"))
    rows = rows.withColumn("rank", F.count_if(~blank).over(w.rowsBetween(W.unboundedPreceding, -1)))
    before = F.array_join(F.collect_list(F.when(blank, F.concat("gap", "raw"))).over(W.partitionBy(key, "rank").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)), "")
    rows = rows.withColumn("gap", F.concat(before, "gap")).where(~blank).withColumn("idx", F.col("rank").cast("int")).drop("piece", "rank")
    return rows.withColumn("paragraph", strip(F.col("raw")))


def with_headings(rows: DataFrame, key: str = "doc") -> DataFrame:
    """Heading flag, period flag, and the last three headings since the last period heading, the own one included.

    Each heading knows the two before it; other rows look back at the last heading, so nothing grows with a document.
    """
    w = W.partitionBy(key).orderBy("idx")
    flagged = rows.withColumns({"is_period": is_period(F.col("paragraph")), "heading": F.when(is_heading(F.col("paragraph")), F.col("paragraph"))})
    flagged = flagged.withColumn("epoch", F.count_if(F.col("is_period") & F.col("heading").isNotNull()).over(w))
    among = W.partitionBy(key, "epoch", F.col("heading").isNotNull()).orderBy("idx")
    own = F.filter(F.array(F.lag("heading", 2).over(among), F.lag("heading", 1).over(among), F.col("heading")), lambda h: h.isNotNull())
    flagged = flagged.withColumn("_own", F.when(F.col("heading").isNotNull(), own))
    so_far = F.last("_own", ignorenulls=True).over(W.partitionBy(key, "epoch").orderBy("idx").rowsBetween(W.unboundedPreceding, 0))
    return flagged.withColumn("heading_context", F.coalesce(so_far, F.array().cast("array<string>"))).drop("_own", "epoch")


def chunk_starts(items: Column, limit: Column) -> Column:
    """Of paragraphs (start, end, is_period) in order, the places of those that begin a chunk.

    A new chunk begins at a period heading, or where start of chunk to end of paragraph would
    exceed the limit; a paragraph is never cut.
    """
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).cast("int").alias("first"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        fresh = (s["at"] == 0) | p["is_period"] | (p["end"] - s["first"] > limit)
        return F.struct((s["at"] + 1).alias("at"), F.when(fresh, p["start"]).otherwise(s["first"]).cast("int").alias("first"), F.when(fresh, F.concat(s["out"], F.array(s["at"]))).otherwise(s["out"]).alias("out"))

    return F.aggregate(items, zero, step)["out"]


def _cut(sections: DataFrame, key: str, text: str, limit: Column, prefix: Column, carry: dict[str, Column], other: Column | None = None) -> DataFrame:
    """Rows of chunks(), with n_chunks (chunks of their section) and the columns to carry.

    other: a limit that takes the place of the first one where that cuts nothing and other isn't null.
    """
    own = {"_limit": limit.cast("int"), "_prefix": prefix} | ({} if other is None else {"_other": other.cast("int")}) | carry
    rows = with_headings(paragraphs(sections, key, text, carry=tuple(c.alias(n) for n, c in own.items())), key)
    ordered = F.array_sort(F.collect_list(F.struct("idx", "start", "end", "is_period", "heading_context", "gap", "raw")))
    packed = rows.groupBy(key).agg(ordered.alias("items"), *[F.first(n).alias(n) for n in own])
    places = packed.withColumn("_places", F.transform("items", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["is_period"].alias("is_period"))))
    packed = places.withColumn("starts", chunk_starts(F.col("_places"), F.col("_limit")))
    if other is not None:
        again = (F.size("starts") < 2) & F.col("_other").isNotNull()
        packed = packed.withColumn("starts", F.when(again, chunk_starts(F.col("_places"), F.col("_other"))).otherwise(F.col("starts")))
    cut = F.transform("starts", lambda s, k: F.slice("items", s + 1, F.coalesce(F.get("starts", k + 1), F.size("items")) - s))
    flat = packed.select(key, "_prefix", *carry, F.size("starts").alias("n_chunks"), F.posexplode(cut).alias("chunk_no", "own"))
    first, body = F.element_at("own", 1), F.transform("own", lambda p, k: F.when(k == 0, p["raw"]).otherwise(F.concat(p["gap"], p["raw"])))
    return flat.select(
        key, F.concat("_prefix", pad_number(F.col("chunk_no") + 1)).alias("chunk_id"), "chunk_no", first["start"].alias("character_start"), F.element_at("own", -1)["end"].alias("character_end"),
        first["heading_context"].alias("heading_context"), F.array_join(body, "").alias("text"), "n_chunks", *carry,
    )


def chunks(sections: DataFrame, key: str = "doc", text: str = "text", limit: Column | int = MAX_CHARS, prefix: Column | str = "item2-chunk-") -> DataFrame:
    """key, chunk_id, chunk_no, character_start, character_end, heading_context, text; offsets within the section.

    A chunk's text is put together from its own paragraphs; paragraphs of a section meet in one
    row, as the section itself does, and no row repeats a section's text.
    """
    if isinstance(limit, int) and limit < MIN_CHARS:
        raise ValueError(f"a chunk has {MIN_CHARS} characters at least")
    limit = F.lit(limit) if isinstance(limit, int) else limit
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return _cut(sections, key, text, limit, prefix, {}).drop("n_chunks")


def adaptive_limit(text: Column) -> Column:
    return F.greatest(F.lit(MIN_CHARS), F.floor(F.length(text) / 2)).cast("int")


def resplit(parents: DataFrame, key: str = "chunk_key", limit: Column | int = SPLIT_CHARS, other: Column | None = None) -> DataFrame:
    """Children of chunks: ids parent.NNN, offsets within the section; none where a parent wouldn't be cut.

    parents: key (one row each), chunk_id, character_start, heading_context, text. A child without
    headings has its parent's. Where limit cuts nothing, the limit other is tried, unless it is null.
    A parent's columns go along with its paragraphs, so parents are made once and join nothing.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    own = {"parent_id": F.col("chunk_id"), "_start": F.col("character_start"), "_context": F.col("heading_context")}
    parts = _cut(parents, key, "text", limit, F.concat("chunk_id", F.lit(".")), own, other).where("n_chunks > 1")
    return parts.select(
        key, "chunk_id", "chunk_no", (F.col("character_start") + F.col("_start")).alias("character_start"), (F.col("character_end") + F.col("_start")).alias("character_end"),
        F.when(F.size("heading_context") > 0, F.col("heading_context")).otherwise(F.col("_context")).alias("heading_context"), "text", "parent_id",
    )


def user_prompt(section_id: Column, chunk_id: Column, heading_context: Column, text: Column, section: str = "Item 2") -> Column:
    """What the extractor is asked about a chunk (a fixed format)."""
    heading = F.coalesce(F.nullif(F.array_join(heading_context, " > "), F.lit("")), F.lit(section))
    return F.concat_ws(
        "\n", F.concat(F.lit("Section ID: "), section_id), F.concat(F.lit("Chunk ID: "), chunk_id), F.concat(F.lit("Heading context: "), heading), F.lit("FILING SLICE START"), text, F.lit("FILING SLICE END")
    )
