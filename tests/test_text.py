"""Text expressions against plain Python statements of the same rules."""

import random
import re

from pyspark.sql import functions as F

from foliate.functions import text as T
from foliate.operators import chunks as C


def one(spark, **columns):
    exprs = list(columns.values())
    return spark.range(1).select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()


def test_positions_match_python(spark):
    r = random.Random(5)
    rows = [("".join(r.choice("ab😀 ") for _ in range(r.randint(0, 12))), "".join(r.choice("ab") for _ in range(r.randint(1, 2))), r.randint(0, 12)) for _ in range(300)]
    df = spark.createDataFrame(rows, "t string, q string, e int")
    t, q = F.col("t"), F.col("q")
    got = df.select("t", "q", "e", T.find(t, q).alias("f"), T.find_last(t, q, F.col("e")).alias("l"), T.count_of(t, q).alias("n")).collect()
    for x in got:
        assert (x.f, x.l, x.n) == (x.t.find(x.q), x.t.rfind(x.q, 0, x.e), x.t.count(x.q))


def test_white_space(spark):
    x = F.lit("  a b\x1c c \n")
    got = one(spark, a=T.collapse_space(x), b=T.strip_right(x), c=T.strip(x))
    assert got.c0 == "a b c" and got.c1 == "  a b\x1c c" and got.c2 == "a b\x1c c"


def test_tokens_and_similarity(spark):
    got = one(spark, a=T.tokens(F.lit("Straße für")), b=T.jaccard(T.tokens(F.lit("a b c")), T.tokens(F.lit("B c d"))), c=T.jaccard(T.tokens(F.lit("")), T.tokens(F.lit("a"))))
    assert got.c0 == ["strasse", "f", "r"] and got.c1 == 0.5 and got.c2 == 0.0


def test_headings(spark):
    cases = {"2025 Results": False, "Products & Services": False, "iPhone": False, "Operating Expenses": True, "PART I": False, "Item 2": False, "ALL UPPER": True, "Ends with.": False,
             "Three Months Ended x Compared with y": True, "Use of the Capital": True, "a\nB": False, "123": False, "X" * 121: False}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", T.is_heading(F.col("x")).alias("h"))
    assert {r.x: r.h for r in df.collect()} == cases


def test_percent_is_half_even(spark):
    df = spark.createDataFrame([(0.1225,), (0.1235,), (0.0025,), (None,)], "x double").select(T.percent(F.col("x")).alias("p"))
    assert [r.p for r in df.collect()] == ["12.2%", "12.3%", "0.2%", "n/a"]


def test_numbers_and_names(spark):
    got = one(spark, a=T.pad_cik(F.lit("320193")), b=T.pad_cik(F.lit("12345678901")), c=T.pad_cik(F.lit("12a")), d=T.pad_number(F.lit(7)), e=T.pad_number(F.lit(1234)), f=T.artifact_name(F.lit("a/b c"), F.lit("2024-01-02 03:04:05.000006").cast("timestamp")), g=T.artifact_name(F.lit(""), F.lit("2024-01-02 03:04:05.000006").cast("timestamp")))
    assert list(got) == ["0000320193", "12345678901", None, "007", "1234", "a-b-c", "20240102T030405.000006Z"]


def test_sum_if_all(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (3, 1), (3, 2)], "k int, x int")
    assert {r.k: r.s for r in df.groupBy("k").agg(T.sum_if_all(F.col("x")).alias("s")).collect()} == {1: None, 3: 3}
    assert df.where("k = 9").agg(T.sum_if_all(F.col("x")).alias("s")).first().s == 0


def test_f1(spark):
    got = one(spark, a=T.f1(F.lit(0.0), F.lit(0.0)), b=T.f1(F.lit(None).cast("double"), F.lit(1.0)), c=T.f1(F.lit(0.5), F.lit(1.0)))
    assert got.c0 == 0.0 and got.c1 is None and abs(got.c2 - 2 / 3) < 1e-12


def test_paragraphs_match_python(spark):
    pattern = re.compile(r"[^\n](?:.*?[^\n])?(?=\n{2,}|\Z)", re.S)
    r = random.Random(7)
    texts = ["a\n\nb", "ab\n\ncd\n", "abc\n", " ab \n\ncd", ""] + ["".join(r.choice(["a", "bc", "\n", "\n\n", " "]) for _ in range(r.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    got = {}
    for x in C.paragraphs(df).orderBy("doc", "idx").collect():
        got.setdefault(x.doc, []).append((x.start, x.end))
    for i, t in enumerate(texts):
        assert got.get(i, []) == [m.span() for m in pattern.finditer(t) if m[0].strip()], t


def test_packing_matches_a_loop(spark):
    r = random.Random(3)
    docs, want = [], {}
    for d in range(40):
        at, spans, parts = 0, [], []
        for _ in range(r.randint(1, 12)):
            p = "x" * r.randint(2, 700)
            spans.append((at, at + len(p)))
            parts.append(p)
            at += len(p) + 2
        docs.append((d, "\n\n".join(parts)))
        out, first = [], None
        for s, e in spans:
            if first is None or e - first > 1000:
                out.append([s, e])
                first = s
            out[-1][1] = e
        want[d] = [tuple(x) for x in out]
    got = {}
    for x in C.chunks(spark.createDataFrame(docs, "doc int, text string"), limit=1000).orderBy("doc", "chunk_no").collect():
        got.setdefault(x.doc, []).append((x.character_start, x.character_end))
        assert x.text == dict(docs)[x.doc][x.character_start : x.character_end]
    assert got == want
