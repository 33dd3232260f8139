"""Blocks of text to documents with offsets and to addressable sections.

All windows share one partitioning, by document, so one exchange serves them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions.text import sha256, strip_right

#: A heading that names the current part, and one that starts an item (fixed values).
PART = r"(?iU)^PART\s+([IVX]+)\b"
ITEM = r"(?iU)^Item\s+(\d+[A-Z]?)\.\s*(.*)$"
PART_LENGTH = 160
ITEM_LENGTH = 240


def narrative_blocks(blocks: DataFrame, key: str = "doc", order: str = "idx") -> DataFrame:
    """Drop empty blocks and page numbers, then blocks equal to the one kept before; number the rest."""
    kept = blocks.where((F.col("text") != "") & ~F.regexp_like("text", F.lit(r"(?U)^\d+$")))
    w = W.partitionBy(key).orderBy(order)
    kept = kept.withColumn("_before", F.lag("text").over(w)).where(~F.col("text").eqNullSafe(F.col("_before"))).drop("_before")
    return kept.withColumn("block", F.row_number().over(w) - 1)


def with_offsets(blocks: DataFrame, key: str = "doc", order: str = "idx") -> DataFrame:
    """Start and end of each block in its document's text, where a blank line parts blocks."""
    before = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0)).cast("int")
    return blocks.withColumn("start", start).withColumn("end", F.col("start") + F.length("text"))


def document_text(blocks: DataFrame, key: str = "doc", order: str = "idx") -> DataFrame:
    """The text of each document and its hash."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t"))))
    return blocks.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("doc_text")).withColumn("text_content_sha256", sha256(F.col("doc_text")))


def with_parts(blocks: DataFrame, key: str = "doc", order: str = "idx", part: str = PART) -> DataFrame:
    """The part named by a block, and the one that is current at it."""
    own = F.when(F.length("text") <= PART_LENGTH, F.nullif(F.regexp_extract("text", part, 1), F.lit("")))
    named = blocks.withColumn("own_part", F.upper(own))
    return named.withColumn("part", F.last("own_part", ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def sections(blocks: DataFrame, key: str = "doc", order: str = "idx", part: str = PART, item: str = ITEM) -> DataFrame:
    """Sections between item headings: section_id, part, item_number, heading, order, character_start, character_end, text.

    Text before the first item heading belongs to none; a part heading never starts an item. A
    running count of the headings numbers each block's section; a section is put together from its
    own blocks, so no row ever carries more text than one section, and work follows the text.
    """
    placed = with_parts(with_offsets(blocks, key, order), key, order, part)
    number = F.when(F.col("own_part").isNull() & (F.length("text") <= ITEM_LENGTH), F.nullif(F.regexp_extract("text", item, 1), F.lit("")))
    running = F.count("item_number").over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    numbered = placed.withColumn("item_number", F.upper(number)).withColumn("order", (running - 1).cast("int")).where("order >= 0")
    of_heading = [F.max(F.when(F.col("item_number").isNotNull(), F.col(c))).alias(c) for c in ("item_number", "part", "start")]
    heading = F.max(F.when(F.col("item_number").isNotNull(), F.col("text"))).alias("heading")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t")))), lambda x: x["t"]), "\n\n")
    cut = numbered.groupBy(key, "order").agg(*of_heading, heading, strip_right(whole).alias("text"))
    base = F.concat(F.coalesce(F.concat(F.lit("part-"), F.lower("part"), F.lit("-")), F.lit("")), F.lit("item-"), F.lower("item_number"))
    cut = cut.withColumn("base_id", base).withColumn("nth", F.row_number().over(W.partitionBy(key, "base_id").orderBy("order")))
    return cut.select(
        key,
        F.when(F.col("nth") == 1, F.col("base_id")).otherwise(F.concat("base_id", F.lit("-"), "nth")).alias("section_id"),
        "part", "item_number", "heading", "order", F.col("start").alias("character_start"), (F.col("start") + F.length("text")).alias("character_end"), "text",
    )


def select_section(found: DataFrame, section_id: str, key: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Documents with exactly one section of that id, and the others with their reason."""
    counts = found.groupBy(key).agg(F.count_if(F.col("section_id") == section_id).alias("n"))
    one = found.where(F.col("section_id") == section_id).join(counts.where("n = 1").select(key), key, "left_semi")
    return one, counts.where("n <> 1").select(key, F.when(F.col("n") == 0, "section_missing").otherwise("section_repeated").alias("reason"))


def first_section(found: DataFrame, section_id: str, key: str = "doc") -> DataFrame:
    """The first section of that id, where there may be several."""
    rank = F.row_number().over(W.partitionBy(key, "section_id").orderBy("order"))
    return found.where(F.col("section_id") == section_id).withColumn("_r", rank).where("_r = 1").drop("_r")


def parse_problem(n_bytes, n_blocks, n_sections):
    """Why a document can't be used, else null."""
    return F.when(F.coalesce(n_bytes, F.lit(0)) == 0, "empty_content").when(F.coalesce(n_blocks, F.lit(0)) == 0, "no_text").when(F.coalesce(n_sections, F.lit(0)) == 0, "no_sections")
