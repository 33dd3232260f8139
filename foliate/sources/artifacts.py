"""Write-once and regenerated tables, with a status for each row.

Write-once tables are ledgers: writers may run at the same time, and none stores a key that another
has stored. Regenerated tables are plain Parquet, where one writer at a time is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions.text import sha256
from foliate.sources import ledger
from foliate.sources.shared import materialize

#: Attempts of a writer whose versions others take.
ATTEMPTS = 20


def content_hash(df: DataFrame, keys: list[str]) -> Column:
    """Hash of all columns but the keys, nulls included."""
    return sha256(F.to_json(F.struct(*[c for c in df.columns if c not in keys]), {"ignoreNullFields": "false"}))


def write_once_status(incoming: DataFrame, existing: DataFrame, keys: list[str], digest: str = "content_sha256", check: Column | None = None) -> DataFrame:
    """stored (absent), unchanged (same digest), conflict (other digest) or corrupt (check fails) for each row.

    existing: keys, digest and whatever `check`, true for sound rows, reads.
    """
    sound = F.lit(True) if check is None else F.coalesce(check, F.lit(False))
    old = existing.select(*keys, F.col(digest).alias("_old"), sound.alias("_sound"), F.lit(True).alias("_there"))
    status = F.when(F.col("_there").isNull(), "stored").when(~F.col("_sound"), "corrupt").when(F.col("_old").eqNullSafe(F.col(digest)), "unchanged").otherwise("conflict")
    return incoming.join(old, keys, "left").withColumn("status", status).drop("_old", "_sound", "_there")


def batch_status(incoming: DataFrame, existing: DataFrame, keys: list[str], digest: str = "content_sha256", check: Column | None = None) -> DataFrame:
    """write_once_status for a batch that may hold a key several times: one row for each key and digest,
    with its number of copies.

    Equal rows are one row. Of a new key with several digests none can be stored: all are conflicts.
    Copies are dropped before rows of a key meet, so a key with very many equal rows is no hot group.
    """
    first = [F.first(c, ignorenulls=False).alias(c) for c in incoming.columns if c not in (*keys, digest)]
    once = incoming.groupBy(*keys, digest).agg(F.count("*").alias("copies"), *first)
    claims = once.groupBy(*keys).agg(F.count("*").alias("_claims"))
    same = [once[k].eqNullSafe(claims[k]) for k in keys]
    both = once.join(claims, same).select(once["*"], "_claims")
    judged = write_once_status(both, existing, keys, digest, check)
    return judged.withColumn("status", F.when((F.col("status") == "stored") & (F.col("_claims") > 1), "conflict").otherwise(F.col("status"))).drop("_claims")


def upsert_status(incoming: DataFrame, existing: DataFrame, keys: list[str], digest: str = "text_content_sha256") -> DataFrame:
    """stored, unchanged or regenerated."""
    old = existing.select(*keys, F.col(digest).alias("_old"), F.lit(True).alias("_there"))
    status = F.when(F.col("_there").isNull(), "stored").when(F.col("_old").eqNullSafe(F.col(digest)), "unchanged").otherwise("regenerated")
    return incoming.join(old, keys, "left").withColumn("status", status).drop("_old", "_there")


def read_or_empty(df: DataFrame, path: str) -> DataFrame:
    try:
        return df.sparkSession.read.schema(df.schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return df.sparkSession.createDataFrame([], df.schema)


def read_once(df: DataFrame, path: str, commits: list[str] | None = None) -> DataFrame:
    """The committed rows of a write-once table with the columns of df; none where there is no table."""
    found = ledger.read(df.sparkSession, path, df.schema, commits)
    return df.sparkSession.createDataFrame([], df.schema) if found is None else found.select(*df.columns)


def write_once(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, digest: Column | None = None, check: Column | None = None) -> DataFrame:
    """Append rows with new keys in one commit; same rows are left alone, other rows under a known key
    are an error, as are stored rows for which check isn't true, and keys that the batch itself holds
    with different contents.

    Rows are the same where digest is (default: all columns but the keys). Returns keys and status, a
    row for each key. Judged rows are written out first, so a lost executor never reads the table
    that is appended to. A writer that another one overtakes judges its rows again, against what the
    other has committed: equal rows are then unchanged, others an error.
    """
    spark = df.sparkSession
    digest = content_hash(df, keys) if digest is None else digest
    incoming = df.withColumn("_h", digest)
    for _ in range(ATTEMPTS):
        base, commits = ledger.snapshot(spark, path)
        old = read_once(df, path, commits).withColumn("_h", digest).withColumn("_ok", F.lit(True) if check is None else check)
        judged = materialize(batch_status(incoming, old, keys, "_h", F.col("_ok")), "write-once")
        clash = judged.where("status IN ('conflict', 'corrupt')").select(*keys, "status").take(1)
        if clash:
            raise ValueError(f"stored with other content: {clash[0].asDict()}")
        new = judged.where("status = 'stored'").select(*df.columns)
        if new.isEmpty() or ledger.commit(spark, path, base, commits, ledger.stage(new, path, partition_by)):
            return judged.select(*keys, "status")
        incoming = judged.select(*df.columns, "_h")  # written out: df isn't computed again
    raise RuntimeError(f"other writers took all of {ATTEMPTS} versions of {path}")


def regenerate(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Overwrite those partitions whose rows are new or differ; returns partition and status.

    df holds one row for each value of the partition column. Judged rows are written out and read
    back before the table is touched.
    """
    old = read_or_empty(df, path)
    digest = content_hash(df, [partition])
    judged = materialize(upsert_status(df.withColumn("_h", digest), old.withColumn("_h", digest), [partition], "_h"), "regenerate")
    changed = judged.where("status <> 'unchanged'").select(*df.columns)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return judged.select(partition, "status")


def export_json(df: DataFrame, path: str, omit: tuple[str, ...] = ()) -> None:
    """One JSON object a row; columns in omit are left out where null, other nulls are written."""
    kept = [F.when(F.col(c).isNotNull() if c in omit else F.lit(True), F.substring(F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"}), F.lit(2), F.length(F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"})) - 2)) for c in df.columns]
    df.select(F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*kept)), ","), F.lit("}")).alias("value")).write.text(path)


#: Fields that records leave out where they are null, at any depth (fixed by the record format).
OPTIONAL = ("scope_quote", "scope_character_start", "scope_character_end")


def _without(value, omit: frozenset):
    """A JSON value without the null fields of those names."""
    if isinstance(value, dict):
        return {k: _without(v, omit) for k, v in value.items() if v is not None or k not in omit}
    return [_without(v, omit) for v in value] if isinstance(value, list) else value


def export_records(df: DataFrame, path: str, by: list[str], omit: tuple[str, ...] = OPTIONAL) -> None:
    """One indented JSON file for each record, under a folder for each value of the columns `by`.

    Null fields are written, but for those in omit. The columns `by` name the folder and aren't in the
    file. read_records reads the files back.
    """
    left_out = frozenset(omit)

    def pretty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [json.dumps(_without(json.loads(x), left_out), indent=2, ensure_ascii=False) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=batch.schema.names)

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in by]), {"ignoreNullFields": "false"})
    df.select(*by, body.alias("value")).mapInArrow(pretty, f"{fields}, value string").write.partitionBy(*by).text(path)
