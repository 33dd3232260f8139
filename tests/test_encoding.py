"""Bytes of pages to text."""

import codecs
import hashlib

import pytest
from pyspark.sql import functions as F

from foliate.functions.encoding import decode_html
from foliate.operators.html_blocks import block_texts, decoded, html_blocks
from foliate.plans import commands as K
from foliate.sources import filings as FI

TEXT = "Umsätze – “rose” 5 € naïve"
META = '<meta charset="{}">'


@pytest.mark.parametrize(
    "content, text, name",
    [
        (codecs.BOM_UTF8 + TEXT.encode(), TEXT, "utf-8"), (codecs.BOM_UTF16_LE + TEXT.encode("utf-16-le"), TEXT, "utf-16-le"), (codecs.BOM_UTF16_BE + TEXT.encode("utf-16-be"), TEXT, "utf-16-be"),
        (codecs.BOM_UTF32_LE + TEXT.encode("utf-32-le"), TEXT, "utf-32-le"), (("<p>" + TEXT).encode("utf-16-le"), "<p>" + TEXT, "utf-16-le"), (("<p>" + TEXT).encode("utf-16-be"), "<p>" + TEXT, "utf-16-be"),
        (TEXT.encode(), TEXT, "utf-8"), (TEXT.encode("cp1252"), TEXT, "cp1252"), (b"a\x81\x9d\xe9", "a\x81\x9dé", "cp1252"), (b"", "", "utf-8"), (b"plain", "plain", "utf-8"),
        ((META.format("ISO-8859-1") + TEXT).encode("cp1252"), META.format("ISO-8859-1") + TEXT, "cp1252"), ((META.format("koi8-r") + "Привет").encode("koi8-r"), META.format("koi8-r") + "Привет", "koi8-r"),
        ('<?xml version="1.0" encoding="Shift_JIS"?><p>売上'.encode("cp932"), '<?xml version="1.0" encoding="Shift_JIS"?><p>売上', "cp932"),
        ("<meta http-equiv='content-type' content='text/html; charset=gb2312'><p>收入".encode("gb18030"), "<meta http-equiv='content-type' content='text/html; charset=gb2312'><p>收入", "gb18030"),
        # Wrong declarations: what they name can't read the page, or isn't known, or stands in a comment.
        ((META.format("utf-8") + TEXT).encode("cp1252"), META.format("utf-8") + TEXT, "cp1252"), ((META.format("x-none") + TEXT).encode(), META.format("x-none") + TEXT, "utf-8"),
        ((META.format("hex") + TEXT).encode(), META.format("hex") + TEXT, "utf-8"), ((META.format("utf-16") + TEXT).encode(), META.format("utf-16") + TEXT, "utf-8"),
        (("<!-- " + META.format("koi8-r") + " -->" + TEXT).encode(), "<!-- " + META.format("koi8-r") + " -->" + TEXT, "utf-8"), ((META.format("koi8-r") + META.format("utf-8") + "é").encode("koi8-r", "replace"), None, "koi8-r"),
    ],
)
def test_decoding(content, text, name):
    got = decode_html(content)
    assert got[1] == name and (text is None or got[0] == text)


def test_faults_behind_a_mark_are_replaced():
    assert decode_html(codecs.BOM_UTF8 + b"a\xff") == ("a�", "utf-8")


def test_pages_in_four_encodings(spark, tmp_path):
    """From files of bytes to the same blocks and sections."""
    page = "<html><head>{}</head><body><p>PART I</p><p>Item 2. Analysis</p><p>Umsätze “rose” naïvely</p></body></html>"
    files = {
        "utf8": page.format("").encode(), "mark": codecs.BOM_UTF16_LE + page.format("").encode("utf-16-le"),
        "meta": page.format('<meta charset="windows-1252">').encode("cp1252"), "none": page.format("").encode("cp1252"),
    }
    for name, content in files.items():
        (tmp_path / f"{name}.html").write_bytes(content)
    rows = FI.read_html(spark, str(tmp_path)).withColumn("name", F.regexp_extract("path", r"(\w+)\.html$", 1))
    assert {r.name: r.content for r in rows.collect()} == files
    found = {}
    for r in html_blocks(rows, "name", "content").orderBy("name", "idx").collect():
        found.setdefault(r.name, []).append(r.text)
    assert found == dict.fromkeys(files, ["PART I", "Item 2. Analysis", "Umsätze “rose” naïvely"])
    assert {r.name: r.encoding for r in decoded(rows, "name").collect()} == {"utf8": "utf-8", "mark": "utf-16-le", "meta": "cp1252", "none": "cp1252"}
    archive = rows.select(F.lit("1").alias("cik"), F.col("name").alias("accession_number"), "content", F.sha2("content", 256).alias("content_sha256"))
    statuses, rejected = K.parse(archive, str(tmp_path / "parsed"))
    assert statuses.count() == 4 and rejected.count() == 0
    parsed = spark.read.parquet(str(tmp_path / "parsed")).collect()
    assert len({r.text_content_sha256 for r in parsed}) == 1 and {r.source_content_sha256 for r in parsed} == {hashlib.sha256(c).hexdigest() for c in files.values()}


def test_only_spaces_go_from_styles():
    assert block_texts("<p style='display : none'>a</p><p style='display:\tnone'>b</p><p style='Visibility:Hidden'>c</p>") == ["b"]


def test_null_pages_have_no_blocks(spark):
    df = spark.createDataFrame([(1, None), (2, b"")], "page_id int, html binary")
    assert html_blocks(df).count() == 0 and [tuple(r) for r in decoded(df, "page_id", "html").orderBy("page_id").collect()] == [(1, None, None), (2, "", "utf-8")]


@pytest.mark.parametrize("made", ["decoded", "html_blocks"])
def test_pages_reach_workers_in_bounded_batches(spark, made):
    """A worker's memory follows a batch, so not the rows of a table."""
    from foliate.arrow import ARROW_BYTES, ARROW_ROWS

    rows, size = (f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    pages = spark.createDataFrame([(1, bytearray(b"<p>a")), (2, None)], "page_id long, content binary")
    run = (lambda: decoded(pages)) if made == "decoded" else (lambda: html_blocks(pages, html="content"))
    before = {k: spark.conf.get(k) for k in (rows, size)}
    try:
        spark.conf.set(rows, "10000")
        spark.conf.set(size, "67108864b")
        assert run().count() == (2 if made == "decoded" else 1)
        assert (spark.conf.get(rows), spark.conf.get(size)) == (str(ARROW_ROWS), f"{ARROW_BYTES}b")
        spark.conf.set(rows, "7")  # what the user has set stays
        run()
        assert spark.conf.get(rows) == "7"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
