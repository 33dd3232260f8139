"""Stored JSON records, read strictly: a record that doesn't fit its layout is an error row, not a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, IntegerType, LongType, StringType, StructType, TimestampType

from foliate import schemas

#: JSON types that a field may hold, by its type: what schema_of_variant says, as patterns.
_HELD = {StringType: "STRING", BooleanType: "BOOLEAN", IntegerType: "BIGINT", LongType: "BIGINT", DateType: "STRING", TimestampType: "STRING"}
_DOUBLE = r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*"


def _variant(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _told(path: Column, what: str) -> Column:
    return F.array(F.concat(path, F.lit(f": {what}")))


def faults(v: Column, kind: DataType, path: Column | None = None) -> Column:
    """array<string> of what is wrong with a JSON value of that type: unknown fields and wrong types, at
    every depth, each with its path. JSON null fits every type."""
    path = F.lit("$") if path is None else path
    held = F.schema_of_variant(v)
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        entries = _variant(v, "map<string,variant>")
        known = F.array(*[F.lit(f.name) for f in kind.fields])
        unknown = F.transform(F.array_sort(F.array_except(F.map_keys(entries), known)), lambda k: F.concat(path, F.lit("."), k, F.lit(": unknown field")))
        inner = [F.coalesce(faults(F.element_at(entries, F.lit(f.name)), f.dataType, F.concat(path, F.lit(f".{f.name}"))), none) for f in kind.fields]
        found, fits = F.concat(unknown, *inner), held.startswith("OBJECT")
    elif isinstance(kind, ArrayType):
        items = _variant(v, "array<variant>")
        found = F.flatten(F.transform(items, lambda x, k: F.coalesce(faults(x, kind.elementType, F.concat(path, F.lit("["), k.cast("string"), F.lit("]"))), none)))
        fits = held.startswith("ARRAY")
    else:
        fits = F.regexp_like(held, F.lit(f"^({_HELD.get(type(kind), _DOUBLE)})$"))
        if isinstance(kind, (DateType, TimestampType, IntegerType)):
            fits = fits & _variant(v, kind.simpleString()).isNotNull()
        found = none
    return F.when(v.isNull() | (held == "VOID"), none).when(~F.coalesce(fits, F.lit(False)), _told(path, f"no {kind.simpleString().split('<')[0]}")).otherwise(found)


def judge_records(bodies: DataFrame, ddl: str, body: str = "body") -> DataFrame:
    """bodies with reason (the first fault with its path, else null) and record (null where there is a fault).

    Faults are: what isn't JSON or isn't one object, a field that the record hasn't (at any depth), a
    value of another type, a hash that is none. Each step is a column of its own, so a text is parsed
    once for its faults and, without any, once for its record.
    """
    row = StructType.fromDDL(ddl)
    parsed = bodies.withColumn("_v", F.try_parse_json(F.col(body)))
    first = F.when(F.col("_v").isNull(), "not JSON").when(F.schema_of_variant("_v") == "VOID", "$: no struct").otherwise(F.get(faults(F.col("_v"), row), F.lit(0)))
    judged = parsed.withColumn("_fault", first).drop("_v")
    record = judged.withColumn("record", F.when(F.col("_fault").isNull(), F.from_json(body, row)))
    hashes = [F.when(F.col("record").isNotNull() & ~schemas.is_hash(F.col(f"record.{f.name}")), F.lit(f"$.{f.name}: no hash")) for f in row.fields if f.name.endswith("_sha256")]
    told = record.withColumn("reason", F.coalesce("_fault", *hashes)).drop("_fault")
    return told.withColumn("record", F.when(F.col("reason").isNull(), F.col("record")))


def parse_records(bodies: DataFrame, ddl: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Records of JSON texts, beside the other columns of bodies, and rejected texts with reason and stage, by judge_records."""
    others = [c for c in bodies.columns if c != body]
    judged = judge_records(bodies, ddl, body)
    good = judged.where("reason IS NULL").select(*others, "record.*")
    return good, judged.where("reason IS NOT NULL").select(*others, body, "reason", F.lit("read").alias("stage"))


def read_records(spark: SparkSession, path: str, ddl: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """parse_records of the files at path: one record a file, or one a line."""
    return parse_records(spark.read.text(path, wholetext=not lines).withColumnRenamed("value", "body"), ddl)
