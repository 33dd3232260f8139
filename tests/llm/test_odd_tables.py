"""Repeated rows, null ids, empty tables and clashing names, operator by operator."""

import collections

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from foliate.llm import bpe, packing, quality, sharding, toxicity, url_filter  # noqa: E402

TEXTS = ["the of and to in a is that it was for on", "one two", None, "", "x" * 3000, "the of and to in a is that it was for on"]
CLASHING = "doc_id bigint, text string, kept boolean, score string, held_out string, size int, shard string, slot string, host string, ids string, n_tokens string, piece int, `a.b` int"


def odd(spark):
    """Each row twice, with a null id among them, and columns named like the operators' own."""
    rows = [(None if k == 1 else k, t, True, "s", "h", 1, "x", "y", "z", "i", "n", 7, 9) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows * 2, CLASHING)


def test_quality_of_repeated_rows(spark):
    got = quality.apply_rules(odd(spark)).select("doc_id", "n_words", "base_failed").collect()
    assert len(got) == 2 * len(TEXTS) and set(collections.Counter(map(tuple, got)).values()) == {2}


def test_packing_of_repeated_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd(spark), path).collect()
    tokens, whole = collections.Counter(), collections.Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
        whole[r.doc_id] = max(whole[r.doc_id], r.doc_tokens)
    assert tokens == {k: 2 * n for k, n in whole.items()} and set(tokens) == {0, None, 2, 3, 4, 5}
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert packing.pack_documents(odd(spark).limit(0), path).count() == 0


def test_toxicity_of_clashing_columns(spark):
    labels = spark.createDataFrame([(k, 1, int(k % 2)) for k in range(6)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(odd(spark), labels)
    got = toxicity.score_toxicity(odd(spark), model, carry=odd(spark).columns).collect()
    assert len(got) == 2 * len(TEXTS) and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("text", ["plain words", "İstanbul İİ tail", "aİb cİ", "ǅ İ x", ""])
def test_word_spans_are_places_in_the_text(text):
    spans = toxicity.word_spans(text)
    assert len(spans) == len(toxicity._WORD.findall(text.lower()))
    for (a, b), word in zip(spans, toxicity._WORD.findall(text.lower()), strict=True):
        assert 0 <= a < b <= len(text) and word in text[a:b].lower()


def test_sharding_of_odd_tables(spark):
    got = sharding.shard_documents(odd(spark)).collect()
    assert len(got) == 2 * len(TEXTS)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) == 1
    assert sharding.shard_documents(odd(spark).limit(0)).count() == 0


def test_url_filter_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "http://a.Example.net/en/", "h", "p")] * 3 + [(None, None, "h", "p")], "page_id bigint, url string, host string, path string")
    got = url_filter.filter_urls(df).collect()
    assert collections.Counter((r.page_id, r.host, r.rule) for r in got) == {(1, "a.example.net", "example.net/en/"): 3, (None, "", None): 1}
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_bpe_of_odd_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = bpe.encode_texts(odd(spark), path).collect()
    assert len(got) == 2 * len(TEXTS) and all(r.decoded == (TEXTS[1 if r.doc_id is None else r.doc_id] or "") and len(r.ids) == r.n_tokens for r in got)
    digests = bpe.encode_texts(odd(spark), path, digests=True)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and digests.distinct().count() == len(TEXTS)
    assert bpe.encode_texts(odd(spark).limit(0), path).count() == 0 and bpe.encode_texts(odd(spark).limit(0), path, digests=True).count() == 0


def test_columns_with_dots_pass_the_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, odd(spark), "/root/testdata/sf0.001").columns == odd(spark).columns, name
    assert F.col("`a.b`") is not None
