"""Alignment, whitening and language against brute force, on small fixtures."""

import collections
import hashlib
import math
import pathlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from foliate.llm import alignment, language, whitening  # noqa: E402

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "one", "The quick brown fox", "The quick brown fox", " lead and trail ", "two  spaces   three", "a\n  b\n c\td", "\n\n", "x" * 5000, "é 😀 中文 字 <|endoftext|> <s> </s> <unk> <0x41>",
    "a▁b mark", "no break　space \x1c sep", "1234567890" * 30, "!!?? ... ---", "tab\t \tend ", "́combining ̈x", "Ñandú straße " * 50,
]


def aligned_by_brute_force(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    pair = alignment.TokenPair(*FILES)
    ta, tb = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    ta.encode_special_tokens = True
    documents, held = [], collections.Counter()
    for t in texts:
        a, b = (ta.encode(" " + t, add_special_tokens=False).ids, tb.encode(t)) if t else ([], [])
        parts = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if not t or not (b"".join(parts[0]) == b"".join(parts[1]) == (" " + t).encode()):
            documents.append(None)
            continue
        ends = [np.cumsum(list(map(len, x))).tolist() for x in parts]
        found, before = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            found.append(tuple([i for i, e in zip(ids, own, strict=True) if before < e <= cut] for ids, own in zip((a, b), ends, strict=True)))
            before = cut
        documents.append((len(a), len(b), found))
        held.update({(x, y) for g in found for x in g[0] for y in g[1]})
    top = collections.Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for d in documents:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for g in d[2] for x in g[0] for y in g[1]]
        said = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in d[2])
        out.append((d[0], d[1], len(d[2]), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(said.encode()).hexdigest()))
    return out, held


@pytest.mark.parametrize("block_chars", [20, 8 << 20])
def test_alignment_matches_brute_force(spark, block_chars):
    rows = [(None if k == 3 else k, t, 7, [1]) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, places array<int>").repartition(2)
    out, links = alignment.align(docs, *FILES, block_chars=block_chars)
    got = {(-1 if r.doc_id is None else r.doc_id): tuple(r)[1:] for r in out.collect()}
    want, held = aligned_by_brute_force(TEXTS)
    assert got == {(-1 if k == 3 else k): w for k, w in enumerate(want)}
    assert want[4][0] > 0 and want[12] == (0, 0, 0, 0, 0, 0, "")
    assert {(r.a, r.b): r.docs for r in links.collect()} == dict(held)


def test_alignment_of_the_table_matches_brute_force(spark, sf_dir):
    import __spark_entry__ as entry

    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op11_alignment"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == dict(zip([r.doc_id for r in rows], aligned_by_brute_force([r.text for r in rows])[0], strict=True))


def test_no_row_of_the_last_passes_stands_for_a_stretch(spark, sf_dir):
    """What blocks fetch goes in few rows, so that disk doesn't hold a row for each stretch of each block."""
    from foliate.sources.shared import shared_folder

    folder = pathlib.Path(shared_folder(spark).removeprefix("file://")) / "foliate"
    before = set(folder.glob("alignment-*"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out, links = alignment.align(docs, *FILES)
    assert out.count() == docs.count() and links.count()
    distinct = len({s for r in docs.select("text").collect() for s in alignment.stretches(r.text or "")})
    rows = {p: spark.read.parquet(str(p)).count() for p in set(folder.glob("alignment-*")) - before}
    assert rows
    assert sum(n for p, n in rows.items() if not p.name.startswith(("alignment-counts", "alignment-books"))) < distinct / 4


def test_alignment_of_an_empty_table(spark):
    out, links = alignment.align(spark.createDataFrame([], "doc_id long, text string"), *FILES)
    assert out.count() == 0 and links.count() == 0


def test_long_words_of_the_table_are_encoded_by_the_tree(spark, sf_dir, monkeypatch):
    """The production leaf joins halves on the registered table, and the ids are the library's."""
    from tokenizers import Tokenizer

    from foliate.llm import bpe

    encoder, library, joins = bpe.ByteBpe(FILES[0]), Tokenizer.from_file(FILES[0]), []
    plain = encoder.join
    monkeypatch.setattr(encoder, "join", lambda a, b: joins.append(1) or plain(a, b))
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("text").collect()]
    assert [encoder.encode(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(joins) > 100


def test_words_of_the_table_are_merged_side_by_side(spark, sf_dir, monkeypatch):
    """The library gets few pieces of ordinary text, one by one words were what op9 cost."""
    from foliate.llm import bpe

    encoder, asked = bpe.ByteBpe(FILES[0]), []
    plain = bpe.encode_many
    monkeypatch.setattr(bpe, "encode_many", lambda t, sep, sep_id, pieces, *more: asked.extend(pieces) or plain(t, sep, sep_id, pieces, *more))
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    list(encoder.digests(texts))
    assert len(asked) < 0.02 * len(set().union(*map(encoder.pieces, texts)))


def test_words_merged_side_by_side_are_exact():
    from tokenizers import Tokenizer

    from foliate.llm import bpe

    library, r = Tokenizer.from_file(FILES[0]), random.Random(3)
    parts = ["a", "the", "ing", "Heit", "z", "\u00e9", "\u00ff", "\u00c0", "\u024f", "\u0250", "\u00d7", "\u00f7", "\u00aa", "\u00b2", "\u00a0", "\u0085", "\u0301", "7", "12", "\u0663", ".", ",", "$$$", "_", "'", "'ll", "-", "\x00", "\x7f", "\x0b", "\x1c", " ", "  ", "\n", "\n\n", "\t", " \n", "\r\n", "\u4e2d", "\U0001f600", "<|endoftext|>"]
    texts = ["".join(r.choice(parts[:k]) for _ in range(r.randint(0, 25))) for k in (8, 27, len(parts)) for _ in range(3000)]
    texts += ["".join(r.choice(parts[:8] + [" ", "\n", ".", " \n "]) for _ in range(r.randint(0, 300))) for _ in range(500)] + ["".join(map(chr, range(k, k + 200))) for k in range(0, 0x3000, 97)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for leaf in (3, bpe.LEAF, 40):
        encoder = bpe.ByteBpe(FILES[0], leaf=leaf)
        assert [encoder.encode(t) for t in texts[::5]] == want[::5]
        got = list(encoder.digests(texts))
        assert [n for n, _, _ in got] == [len(ids) for ids in want]
        assert [x for _, x, _ in got] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in want]
        assert [x for _, _, x in got] == [hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest() for ids in want]


def test_places_pack_into_bytes():
    r = random.Random(7)
    for values in ([], [0], [127, 128, 16383, 16384, 2097151, 2097152, (1 << 28) - 1], [r.randrange(1 << r.randint(1, 28)) for _ in range(500)]):
        data = alignment.packed(np.array(values, dtype=np.int64))
        assert alignment.unpacked(data).tolist() == values and (not values or len(data) <= 4 * len(values))


def test_stretches_join_to_the_text():
    r = random.Random(5)
    for _ in range(300):
        t = "".join(r.choice("ab \n\t▁é") for _ in range(r.randint(1, 30)))
        assert "".join(" " + x for x in alignment.stretches(t)) == " " + t


def test_residues_give_exact_integers():
    moduli = whitening.primes(1 << 90)
    assert math.prod(moduli) > 1 << 90 and max(moduli) < 1 << whitening.PRIME_BITS and len(set(moduli)) == len(moduli)
    for v in (0, 1, -1, (1 << 89) - 3, -(1 << 88) - 7):
        assert whitening.from_residues([v % p for p in moduli], moduli) == v


def exact_scatter(x):
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    y = [[n * v - s for v, s in zip(r, sums, strict=True)] for r in x]
    return sums, y, [[sum(r[i] * r[j] for r in y) for j in range(dims)] for i in range(dims)]


def test_whitening_matches_its_definition(spark):
    r = random.Random(3)
    vectors = [[r.gauss(0, 1), r.gauss(0, 5), r.gauss(2, 1), r.uniform(-500, 500)] for _ in range(60)]
    odd = [None, [], [1.0, None, 2.0, 3.0], [math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(k, v, 1) for k, v in enumerate(vectors + vectors[:20] + [vectors[0]] * 50 + odd)] + [(None, vectors[1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(3)
    got = whitening.whiten(df).collect()
    assert len(got) == (60 + 20 + 50 + 1) * 4 and sum(g.vec_id is None for g in got) == 4
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    sums, y, scatter = exact_scatter(x)
    n = len(x)
    model = whitening.fit_whitening(df.select(whitening.quantized(F.col("embedding")).alias("x")).where("size(x) = 4"))
    assert (model.n, model.sums, model.scatter) == (n, sums, scatter)
    values, own = np.linalg.eigh(np.array([[v / n**3 for v in row] for row in scatter]))
    values, own = values[::-1], own[:, ::-1]
    white = np.array(y, dtype=float) / n @ own / np.sqrt(values)
    by = {(g.vec_id, g.component): g for g in got}
    for c in range(4):
        column = np.array([by[k, c + 1].whitened for k in range(60)])
        assert np.abs(column * np.sign(column @ white[:, c]) - white[:, c]).max() < 1e-9
        assert abs(by[0, c + 1].explained - values[c] / values.sum()) < 1e-12
    assert all(g.n == n and g.identity_error < 1e-9 for g in got) and all(int(by[k, 1].deviation) == sum(v * v for v in y[k]) for k in range(60))
    assert by[60, 2].whitened == by[0, 2].whitened


def test_whitening_of_entries_beyond_64_bits(spark):
    big = [[float(1 << 55), 1.0], [-float(1 << 54), 2.0], [3.0, 4.0]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(big)], "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(df.select(whitening.quantized(F.col("embedding")).alias("x")))
    assert model.scatter == exact_scatter([[math.floor(64 * c) + 1_000_000 for c in v] for v in big])[2]
    assert {g.vec_id for g in whitening.whiten(df).collect()} == {0, 1, 2}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_without_variance_has_no_rows(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def code_length(training, data):
    """Bits of data by the definition, one byte at a time."""
    seen = collections.defaultdict(collections.Counter)
    for t in training:
        for k in range(language.ORDER, len(t)):
            for order in range(language.ORDER + 1):
                seen[t[k - order : k]][t[k]] += 1
    bits = 0.0
    for k in range(language.ORDER, len(data)):
        for order in range(language.ORDER, -1, -1):
            own = seen.get(data[k - order : k])
            if own is None:
                continue
            total, kinds = sum(own.values()), len(own)
            if data[k] in own:
                bits -= math.log2(own[data[k]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_match_their_definition(spark, monkeypatch):
    words = {"xx": "alo beru cita dano", "yy": "olin pjert kwist zun", "zz": "aaa bb"}
    r = random.Random(2)
    rows = [(k, " ".join(r.choice(words[lang].split()) for _ in range(r.randint(1, 40))), lang) for k, lang in enumerate(["xx", "yy", "zz"] * 20)]
    docs = spark.createDataFrame([*rows, (None, "never learnt", "ww"), (900, None, "vv"), (901, "no language", None)], "doc_id long, text string, lang string")
    trees = language.train(docs)
    assert trees.languages == ["xx", "yy", "zz"]
    learnt = {lang: {language.padded(t).tobytes() for k, t, x in rows if x == lang and zlib.crc32(str(k).encode()) % 4 != 2} for lang in words}
    monkeypatch.setattr(language, "_AT_ONCE", 7)
    for text in ("alo beru", "pjert, kwist? 12", "q", "aaa zun ÑANDÚ", "alo " * 30):
        data = language.padded(text)
        want = [code_length(learnt[x], data.tobytes()) for x in trees.languages]
        assert np.allclose(trees.bits(data), want, rtol=1e-5), text


def test_language_of_odd_tables(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    rows = [(k, t, lang, "s", 1) for k, (t, lang) in enumerate([("the of and to", "en"), ("der die das und", "de")] * 8)]
    odd = [(100, None, "en", "s", 1), (101, "", "en", "s", 1), (102, "123 !?", "en", "s", 1), (103, "der die", None, "s", 1), (103, "der die", None, "s", 1), (None, "the of", "en", "s", 1), (104, "das und " * 50_000, None, "s", 1)]
    docs = spark.createDataFrame(rows + odd, schema)
    got = [tuple(r) for r in language.identify(docs, language.train(docs)).collect()][len(rows) :]
    assert [g[:2] for g in got] == [(100, "und"), (101, "und"), (102, "und"), (103, "de"), (103, "de"), (None, "en"), (104, "de")] and all(0 <= g[2] <= 1 for g in got)
    empty = spark.createDataFrame([], schema)
    assert language.identify(empty, language.train(empty)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.train(empty)).collect()} == {"und"}


def test_language_held_out(spark, sf_dir):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang")
    rows = entry.queries()["op13_language"](spark, sf_dir.replace("0.001", "0.01")).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == docs.count()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
