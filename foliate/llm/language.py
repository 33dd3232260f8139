"""Language of whole texts by prediction by partial matching over bytes.

Texts are coded in lower case, with one space for all that stands between letters. Every language has a tree of byte contexts of up to ORDER bytes, with counts from a bounded sample.
A byte costs, in its longest context that a language has seen, -log2(n / (N + D)) bits if it came
there n times among N bytes of D kinds, else the escape of -log2(D / (N + D)) bits and its cost in
the context shorter by one byte; without any context a byte costs 8 bits. A text's language is the
one that codes it in the fewest bits. Counts are frozen after the fit, so costs of contexts are
worked out once, for all languages side by side, and a text is scored by table look-ups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, release_memory, releasing, table, text_or_empty

#: Bytes of the longest context.
ORDER = 4
#: Most bytes of text a language is fitted on.
SAMPLE_BYTES = 400 << 10
#: Most cells of the cost tables (contexts times languages): many languages get smaller samples.
CELLS = 32 << 20
#: Characters of a piece of text, as samples are drawn.
PIECE = 1024
#: Bytes that are scored in one go: bounds a worker's memory.
_AT_ONCE = 1 << 17
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def held_out(id_: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keys_of(data: np.ndarray, length: int, first: int, last: int) -> np.ndarray:
    """The `length` bytes that end at each position from first to last, as one integer."""
    out = np.zeros(last - first, dtype=np.int64)
    for back in range(length - 1, -1, -1):
        out = (out << 8) | data[first - back : last - back]
    return out


def padded(text: str) -> np.ndarray:
    """Bytes of a text in lower case, with one space for all between letters, behind ORDER zero bytes,
    so that every byte has a full context."""
    return np.frombuffer(b"\0" * ORDER + _OTHER.sub(" ", text.lower()).encode("utf-8", "replace"), dtype=np.uint8)


@dataclass
class ContextTrees:
    """languages; for each order from 0 on: sorted strings of context and byte with their costs in
    bits for each language, and sorted contexts with the costs of leaving them."""

    languages: list[str]
    strings: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Code length of the bytes behind the padding, for each language."""
        total = np.zeros(len(self.languages))
        for first in range(ORDER, len(data), _AT_ONCE):
            part = data[max(0, first - ORDER) : min(len(data), first + _AT_ONCE)].astype(np.int64)
            total += self._bits(part)
        return total

    def _bits(self, data: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages))
        keys = keys_of(data, ORDER + 1, ORDER, len(data))
        for order in range(ORDER, -1, -1):
            at, there = _places(self.strings[order], keys)
            total += self.costs[order][at[there]].sum(axis=0, dtype=np.float64)
            keys = keys[~there]
            if not len(keys):
                return total
            at, there = _places(self.contexts[order], keys >> 8)
            total += self.escapes[order][at[there]].sum(axis=0, dtype=np.float64)
            keys &= (1 << (8 * order)) - 1 if order else 0
        return total + 8.0 * len(keys)

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language with the fewest bits (ties: the first by name) and its posterior probability
        where all are equally likely beforehand; und and 0 without a letter or without languages."""
        if not self.languages or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        bits = self.bits(padded(text))
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())


def _places(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands among the known ones, and whether it does."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def build(counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> ContextTrees:
    """Trees from, for each language and order, the strings (context and byte) and how often they came."""
    languages = sorted(counts)
    trees = ContextTrees(languages, [], [], [], [])
    for order in range(ORDER + 1):
        strings = np.unique(np.concatenate([counts[x][order][0] for x in languages] or [np.empty(0, dtype=np.int64)]))
        contexts = np.unique(strings >> 8)
        n = np.zeros((len(strings), len(languages)))
        for k, x in enumerate(languages):
            own, times = counts[x][order]
            n[np.searchsorted(strings, own), k] = times
        of = np.searchsorted(contexts, strings >> 8)
        total, kinds = np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages)))
        np.add.at(total, of, n)
        np.add.at(kinds, of, n > 0)
        escape = np.log2((total + kinds) / np.maximum(kinds, 1), where=kinds > 0, out=np.zeros_like(total))
        if order:
            shorter = trees.costs[-1][np.searchsorted(trees.strings[-1], strings & ((1 << (8 * order)) - 1))]
        else:
            shorter = np.full(n.shape, 8.0)
        seen = np.log2((total + kinds)[of] / np.maximum(n, 1), where=n > 0, out=np.zeros_like(n))
        trees.strings.append(strings)
        trees.costs.append(np.where(n > 0, seen, escape[of] + shorter))
        trees.contexts.append(contexts)
        trees.escapes.append(escape)
    trees.costs = [x.astype(np.float32) for x in trees.costs]
    trees.escapes = [x.astype(np.float32) for x in trees.escapes]
    return trees


def language_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_bytes: int) -> DataFrame:
    """lang and text of the pieces that are fitted on, written out: of each language a random sample
    of about sample_bytes, drawn by a hash of text and place from all pieces of PIECE characters."""
    usable = docs.where(F.col(lang_col).isNotNull() & (F.col(text_col) != "") & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    usable = usable.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["bytes"] for r in usable.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}  # one row for each language
    each = min(sample_bytes, max(1, CELLS // max(1, 2 * len(sizes) ** 2)))
    share = F.create_map(*[x for lang, size in sizes.items() for x in (F.lit(lang), F.lit(each / size))])[F.col("lang")] if sizes else F.lit(0.0)
    drawn = lambda at: F.pmod(F.xxhash64("hash", at), F.lit(1 << 40)) < F.col("share") * float(1 << 40)
    hashed = usable.withColumns({"hash": F.xxhash64("text"), "share": share})
    places = F.filter(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int")), drawn)
    pieces = F.transform(places, lambda at: F.substring(F.col("text"), at * PIECE + 1, F.lit(PIECE)))
    picked = hashed.select("lang", F.explode(pieces).alias("text")).distinct()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(picked.repartition(min(parts, 16), "text"), "language-sample")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES) -> ContextTrees:
    """Context trees of all languages in lang_col, from rows that aren't held out.

    Strings of context and byte are counted on executors; the driver gets the counts of a sample
    whose size is a parameter. Null languages, null or empty texts and rows without an id teach
    nothing; without rows there are no languages.
    """
    prepare(docs.sparkSession)
    sample = language_sample(docs, id_col, text_col, lang_col, sample_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                texts.setdefault(lang, []).append(padded(text).astype(np.int64))
            for lang, found in texts.items():
                for order in range(ORDER + 1):
                    own, times = np.unique(np.concatenate([keys_of(x, order + 1, ORDER, len(x)) for x in found]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array([order] * len(own), pa.int32()), pa.array(own), pa.array(times)], names=["lang", "order", "string", "times"])

    counted = sample.mapInArrow(releasing(count), "lang string, order int, string long, times long").groupBy("lang", "order", "string").agg(F.sum("times").alias("times"))
    rows = counted.toArrow()  # bounded by the sample
    langs, order = rows.column("lang").to_numpy(), rows.column("order").to_numpy()
    string, times = rows.column("string").to_numpy(), rows.column("times").to_numpy()
    counts = {}
    for lang in set(langs.tolist()):
        own = langs == lang
        counts[lang] = [(string[own & (order == k)], times[own & (order == k)]) for k in range(ORDER + 1)]
    trees = build(counts)
    del rows, counts
    release_memory()
    return trees


def identify(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row's whole text.

    A text that is null or has no letter is `und` with score 0. Very long texts are scored whole, in
    parts; repeated rows each for themselves; ties go to the first language by name; an empty table
    gives an empty result. No other column is read. No shuffle.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: ContextTrees = shared.value
        for batch in batches:
            said = [own.judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(releasing(run), f"doc_id {kind}, lang_pred string, score double")


def op13_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
