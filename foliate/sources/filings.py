"""Submission indexes, filings and stored records as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from foliate import schemas
from foliate.functions.text import pad_cik, sha256

SUBMISSIONS = "filings struct<recent: struct<form: array<string>, accessionNumber: array<string>, primaryDocument: array<string>, reportDate: array<string>, filingDate: array<string>>>"
INDEX_URL = "https://data.sec.gov/submissions/CIK{cik}.json"
ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data/"
TIMEOUT_SECONDS = 10.0


def archive_url(cik: Column, accession: Column, document: Column) -> Column:
    number = F.coalesce(F.nullif(F.ltrim(cik, F.lit("0")), F.lit("")), F.lit("0"))
    return F.concat(F.lit(ARCHIVE_URL), number, F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def decode_submissions(bodies: DataFrame, cik: str = "cik", body: str = "body") -> DataFrame:
    """One row for each filing of the index, in its order (pos)."""
    parsed = bodies.select(pad_cik(F.col(cik)).alias("cik"), F.from_json(body, SUBMISSIONS, {"mode": "FAILFAST"}).alias("b")).select("cik", "b.filings.recent.*")
    names = ("form", "accessionNumber", "primaryDocument", "reportDate", "filingDate")
    rows = parsed.select("cik", F.posexplode(F.arrays_zip(*names)).alias("pos", "f"))
    return rows.select(
        "cik", "pos", F.col("f.form").alias("form_type"), F.col("f.accessionNumber").alias("accession_number"), F.col("f.primaryDocument").alias("primary_document"),
        F.to_date("f.filingDate").alias("filed_at"), F.to_date(F.nullif(F.col("f.reportDate"), F.lit(""))).alias("reporting_period"),
        archive_url(F.col("cik"), F.col("f.accessionNumber"), F.col("f.primaryDocument")).alias("source_url"),
    )


def latest_by_form(filings: DataFrame, form_type: str | None = None, keys: tuple[str, ...] = ("cik", "form_type"), order: str = "pos") -> DataFrame:
    """The first filing of each form in index order."""
    if form_type is not None:
        filings = filings.where(F.col("form_type") == form_type)
    return filings.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_r = 1").drop("_r")


def archive_problem(cik: Column, accession: Column, content: Column) -> Column:
    """Why a filing can't be archived, else null."""
    return (
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "empty_content").when(~F.coalesce(F.regexp_like(cik, F.lit("^[0-9]+$")), F.lit(False)), "bad_cik")
        .when(~F.coalesce(F.regexp_like(accession, F.lit("^[0-9-]+$")), F.lit(False)), "bad_accession")
    )


def integrity(files: DataFrame, metadata: DataFrame, keys: list[str]) -> DataFrame:
    """sound, missing_metadata, missing_file or hash_mismatch for each archived filing."""
    a = files.select(*keys, sha256(F.col("content")).alias("_found"))
    b = metadata.select(*keys, F.col("content_sha256").alias("_said"), F.lit(True).alias("_there"))
    both = a.join(b, keys, "full")
    status = F.when(F.col("_there").isNull(), "missing_metadata").when(F.col("_found").isNull(), "missing_file").when(F.col("_found") == F.col("_said"), "sound").otherwise("hash_mismatch")
    return both.select(*keys, status.alias("status"))


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """Archived HTML files: path, content."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _records(ddl: str):
    def read(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(ddl).json(path, multiLine=True, mode="FAILFAST")

    return read


read_documents = _records(schemas.PARSED_DOCUMENT)
read_proposals = _records(schemas.PROPOSAL)
read_reviews = _records(schemas.REVIEW)
read_gold_cases = _records(schemas.GOLD_CASE)
read_checkpoints = _records(schemas.CHECKPOINT)


def unknown_fields(body: Column, known: tuple[str, ...]) -> Column:
    """Keys of a JSON object that its record doesn't have."""
    return F.array_except(F.map_keys(F.from_json(body, "map<string, string>")), F.array(*[F.lit(k) for k in known]))


def with_prompt(rows: DataFrame, prompts: DataFrame, version: str = "prompt_version") -> DataFrame:
    """Join the prompt (version, text) and its hash; an unknown version fails the job."""
    known = F.broadcast(prompts.select(F.col("version").alias(version), F.col("text").alias("prompt_text"), sha256(F.col("text")).alias("prompt_sha256")))  # a registry of a few rows
    missing = F.raise_error(F.concat(F.lit("unknown prompt version: "), F.coalesce(version, F.lit("null"))))
    return rows.join(known, version, "left").withColumn("prompt_sha256", F.when(F.col("prompt_sha256").isNull(), missing).otherwise(F.col("prompt_sha256")))


class SubmissionsSource(DataSource):
    """spark.read.format("submissions"): cik and JSON body, one partition for each cik.

    Options: ciks (comma-separated), user_agent, timeout_seconds; or path to a folder of
    CIK##########.json files for work offline.
    """

    @classmethod
    def name(cls) -> str:
        return "submissions"

    def schema(self) -> str:
        return "cik string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _SubmissionsReader(dict(self.options))


class _SubmissionsReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        ciks = [c.strip() for c in self.options.get("ciks", "").split(",") if c.strip()]
        if not ciks or not all(c.isdigit() for c in ciks):
            raise ValueError("option ciks takes numbers")
        return [InputPartition(c.zfill(10)) for c in ciks]

    def read(self, partition: InputPartition):
        cik = partition.value
        if folder := self.options.get("path"):
            with open(f"{folder}/CIK{cik}.json", encoding="utf-8") as f:
                yield cik, f.read()
            return
        import urllib.request

        request = urllib.request.Request(INDEX_URL.format(cik=cik), headers={"User-Agent": self.options["user_agent"]})
        with urllib.request.urlopen(request, timeout=float(self.options.get("timeout_seconds", TIMEOUT_SECONDS))) as answer:
            yield cik, answer.read().decode()


def download(filings: DataFrame, user_agent: str, timeout: float = TIMEOUT_SECONDS) -> DataFrame:
    """filings with content and fetch_problem: why there is no content, else null. Redirects are followed.

    One url that can't be read costs its own row only; ingest rejects it with the problem.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in filings.schema.fields) + ", content binary, fetch_problem string"

    def fetch(url: str | None) -> tuple[bytes | None, str | None]:
        import urllib.request

        try:
            request = urllib.request.Request(url or "", headers={"User-Agent": user_agent, "Accept": "text/html"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                body = answer.read()
        except (OSError, ValueError) as error:  # no answer, a status that says so, or no url
            return None, f"{type(error).__name__}: {error}"
        return (body, None) if body else (None, "empty filing")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [fetch(url) for url in batch.column("source_url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([b for b, _ in found], pa.binary()), pa.array([p for _, p in found], pa.string())], names=[*batch.schema.names, "content", "fetch_problem"])

    return filings.mapInArrow(run, schema)
