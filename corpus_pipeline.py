"""Documents to packed sequences: quality rules, toxicity, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of docs, whatever they are called. Rows are judged for themselves where a
stage can do so, hence null ids, repeated rows and clashing column names need no special care:

- quality, toxicity: rows that fail go; a null or empty text fails the quality rules.
- near_dup: of each group the document with the least doc_id stays, once. Rows without a doc_id
  can't be named by a group and stay, one for each text.
- pii: spans in text are replaced by their kinds; n_chars, where there is such a column, follows.
- packing: one row for each piece of a document.

An empty table passes through all stages as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm.common import materialize, table
from foliate.llm.near_dup import near_duplicates
from foliate.llm.packing import pack_documents
from foliate.llm.pii import detect_pii
from foliate.llm.quality import keep_good
from foliate.llm.toxicity import score_toxicity, train


def _carried(made: DataFrame, names: list[str]) -> DataFrame:
    return made.select(*[F.col(f"_c{k}").alias(n) for k, n in enumerate(names)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model, passages=False, carry=docs.columns)
    return _carried(scored.where("predicted = 0"), docs.columns)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    # Columns go by their places here, so that no column of docs can clash with a helper.
    places = {n: f"c{k}" for k, n in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in places.items()]).withColumn("same", F.md5(F.col(places["text"]).cast("binary")))
    key = places["doc_id"]
    named = rows.join(kept, rows[key] == kept["kept_id"], "left_semi").dropDuplicates([key, "same"])
    nameless = rows.where(F.col(key).isNull()).dropDuplicates(["same"])
    return named.union(nameless).select(*[F.col(c).alias(n) for n, c in places.items()])


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = detect_pii(docs, carry=docs.columns)
    out = {f.name: F.col(f"_c{k}") for k, f in enumerate(docs.schema.fields)}
    out["text"] = F.col("redacted")
    if "n_chars" in out:
        out["n_chars"] = F.length("redacted").cast(docs.schema["n_chars"].dataType)
    return found.select(*[c.alias(n) for n, c in out.items()])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_dup", near_dup), ("pii", pii), ("packing", packing)]

#: SQL has no word for most of these stages; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
