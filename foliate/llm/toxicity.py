"""Toxic passages by maximum-scoring segments of token log-odds.

Fit, on a bounded sample of labelled rows: every word gets the log-odds of toxic against other
text under Dirichlet priors that are nested along its prefixes, so a rare word leans on the words
that begin as it does. Occurrences count once for each pair of neighbouring words, so copies of a
passage don't make its ordinary words look toxic. A drift is taken off, which makes ordinary text
score below zero.

Score: one linear scan finds all maximal scoring segments of a text (Ruzzo and Tompa). Segment
scores of clean text follow an extreme-value law whose two constants are fitted on clean training
rows; a text's evidence is the summed log significance of its segments, and a logistic curve that
is set on rows whose words weren't counted turns it into a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, release_memory, releasing, table, text_or_empty

#: Most labelled rows of each class that the model is fitted on.
SAMPLE_PER_CLASS = 3000
#: Most bytes of text of each class in that sample.
SAMPLE_BYTES = 32 << 20
#: Strength of each prior in the chain of prefixes, in occurrences.
PRIOR = 6.0
PREFIXES = (2, 3, 4, 5, 6, 7, 8)
DRIFT = 0.6
THRESHOLD = 0.7
#: Segments whose expected number in clean text of that length is at most this are passages.
SIGNIFICANT = 0.05
#: Word scores kept by a worker process.
_KEPT = 400_000

_WORD = re.compile(r"[^\W\d_]+")


class _Scores(dict):
    """Scores of words, worked out when first asked for."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.words)
        self.model = model

    def __missing__(self, word: str) -> float:
        score = self.model.backed_off(word)
        if len(self) < _KEPT:
            self[word] = score
        return score


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    scale: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    intercept: float = -4.0

    def backed_off(self, word: str) -> float:
        for n in reversed(PREFIXES):
            if len(word) >= n and (s := self.prefixes.get(word[:n])) is not None:
                return s
        return -DRIFT

    def evidence(self, segments: list[tuple[int, int, float]], tokens: int) -> float:
        """Summed log significance of the segments that stand out in clean text of as many tokens;
        where none does, that of the best one, which is negative."""
        if not segments:
            return -8.0
        base = self.log_k + math.log(max(1, tokens))
        logs = [self.scale * s - base for _, _, s in segments]
        return sum(x for x in logs if x > 0) or max(-8.0, *logs)

    def probability(self, z: float) -> float:
        x = self.slope * z + self.intercept
        return 1 / (1 + math.exp(-x)) if x > -30 else math.exp(x)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in linear time.

    Runs of scores that aren't positive only enter through their sums, so the scan steps over the
    positive ones.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[list] = []  # first, end, sum before, sum after, nearest earlier candidate with a smaller sum before
    for i in at.tolist():
        first, end, low, high = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([first, end, low, high, j])
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def _occurrences(sample: DataFrame) -> DataFrame:
    """word and, for toxic and other text of all rows and of each half, the distinct neighbourhoods
    in which it stands: bad, good, bad0, good0, bad1, good1. Counted on executors with partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            code: dict[str, int] = {"": 0}
            streams = [np.fromiter((code.setdefault(w, len(code)) for w in _WORD.findall(t.lower())), dtype=np.int64) for t in batch.column(0).to_pylist()]
            names = list(code)
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in names), dtype=np.uint64, count=len(names))
            for s, y, fold in zip(streams, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                h = hashes[np.concatenate(([0], s, [0]))]
                around = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[2:] * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)
                order = np.lexsort((around, s))
                s, around = s[order], around[order]
                new = np.append(True, (np.diff(s) != 0) | (np.diff(around) != 0))[: len(s)]
                n = int(new.sum())
                columns = [pa.array([names[k] for k in s[new].tolist()], pa.string()), pa.array(around[new]), pa.array(np.full(n, y, dtype=np.int32)), pa.array(np.full(n, 1 << fold, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "around", "toxic", "half"])

    once = sample.select("text", "toxic", "fold").mapInArrow(releasing(run), "word string, around long, toxic int, half int").groupBy("word", "around", "toxic").agg(F.bit_or("half").alias("half"))
    counts = {}
    for name, half in (("", 3), ("0", 1), ("1", 2)):
        there = F.col("half").bitwiseAND(half) > 0
        counts |= {f"bad{name}": F.count_if(there & (F.col("toxic") == 1)), f"good{name}": F.count_if(there & (F.col("toxic") == 0))}
    return once.groupBy("word").agg(*[c.alias(n) for n, c in counts.items()])


def log_odds(words: list[str], bad: np.ndarray, good: np.ndarray) -> tuple[dict[str, float], dict[str, float]]:
    """Scores of words and of prefixes; words are sorted, bad and good are their occurrences.

    A word whose own score says no more than its prefixes do, and a prefix with the same words as
    the one before it, are left out.
    """
    there = np.flatnonzero(bad + good > 0)
    words, bad, good = [words[k] for k in there.tolist()], bad[there], good[there]
    root = (bad.sum() + 1) / (bad.sum() + good.sum() + 2)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.array([w[: PREFIXES[-1]] for w in words], dtype=f"U{PREFIXES[-1]}")
    p, seen = np.full(len(words), root), np.full((2, len(words)), np.nan)  # of words, without their own counts
    level, above = np.full(len(words), root), np.full((2, len(words)), np.nan)  # of each word's prefix at this length
    prefixes: dict[str, float] = {}

    def score(x: np.ndarray) -> np.ndarray:
        return np.log(x / (1 - x)) - math.log(root / (1 - root)) - DRIFT

    for n in PREFIXES:
        own = np.flatnonzero(sizes >= n)
        if not len(own):
            break
        cut = starts[own].astype(f"U{n}")  # words with a common prefix are neighbours
        first = np.flatnonzero(np.append(True, cut[1:] != cut[:-1]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(own))))
        total = np.stack([np.add.reduceat(c[own].astype(float), first)[group] for c in (bad, good)])
        news = (total != above[:, own]).any(axis=0)
        level[own] = np.where(news, (total[0] + PRIOR * level[own]) / (total.sum(axis=0) + PRIOR), level[own])
        above[:, own] = total
        for k in first[news[first]].tolist():
            prefixes[str(cut[k])] = float(score(level[own[k]]))
        rest = total - np.stack([bad[own], good[own]])
        moved = (rest != seen[:, own]).any(axis=0)
        p[own] = np.where(moved, (rest[0] + PRIOR * p[own]) / (rest.sum(axis=0) + PRIOR), p[own])
        seen[:, own] = rest
    scores = score((bad + PRIOR * p) / (bad + good + PRIOR))
    backed = np.where(sizes >= PREFIXES[0], score(level), -DRIFT)
    return {words[k]: float(scores[k]) for k in np.flatnonzero(np.abs(scores - backed) > 0.02).tolist()}, prefixes


def segments_of(text: str, scores: dict[str, float]) -> tuple[list[tuple[int, int, float]], int]:
    words = _WORD.findall(text.lower())
    values = np.fromiter(map(scores.__getitem__, words), dtype=np.float64, count=len(words))
    times: dict[str, int] = {}
    for k in np.flatnonzero(values > 0).tolist():  # the nth occurrence of a word in a text counts one nth
        times[words[k]] = n = times.get(words[k], 0) + 1
        values[k] /= n
    return maximal_segments(values), len(words)


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words of the lower-cased text stand in the text itself; few characters get longer in lower case."""
    lower = text.lower()
    spans = [m.span() for m in _WORD.finditer(lower)]
    if len(lower) == len(text):
        return spans
    ends = list(accumulate(len(c.lower()) for c in text))
    return [(bisect_right(ends, a), bisect_left(ends, b) + 1) for a, b in spans]


def held_out(id_: Column) -> Column:
    """Rows whose labels are never read: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int, class_bytes: int) -> tuple[DataFrame | None, float]:
    """text, toxic and fold (0 or 1) of the labelled rows that are fitted on, written out, and the
    share of toxic rows among all labelled ones.

    Of each class the per_class rows with the least hashes of their ids, as far as they have
    class_bytes together; texts beyond a 64th of that, and repeats of a text, are left out.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None, 0.0
    order = F.xxhash64("id")
    ids = usable.where("toxic = 1").orderBy(order, "id").limit(per_class).union(usable.where("toxic = 0").orderBy(order, "id").limit(per_class))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= class_bytes // 64)
    rows = materialize(rows.join(F.broadcast(ids), "id").groupBy("text").agg(F.min(F.struct("id", "toxic")).alias("x")).select("x.*", "text"), "toxic-rows")  # 2 * per_class ids
    so_far = F.sum(F.octet_length("text")).over(W.orderBy(order, "id", "text").rowsBetween(W.unboundedPreceding, 0))
    of_class = [rows.where(F.col("toxic") == y).orderBy(order, "id", "text").limit(per_class).withColumn("bytes", so_far).where(F.col("bytes") <= class_bytes) for y in (0, 1)]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = of_class[0].union(of_class[1]).select("text", "toxic", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(2)).cast("int").alias("fold"))
    return materialize(sample.repartition(min(parts, 64)), "toxic-sample"), counts[1] / sum(counts.values())


def _segment_table(sample: DataFrame, halves: list[Model]) -> DataFrame:
    """toxic, n (tokens) and segments (scores) of each text under the counts of the other half."""
    shared = sample.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [_Scores(m) for m in shared.value]
        for batch in batches:
            found = [segments_of(t, scores[1 - fold]) for t, fold in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(1), pa.array([n for _, n in found], pa.int64()), pa.array([[s for _, _, s in x] for x, _ in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "n", "segments"])

    out = materialize(sample.mapInArrow(releasing(run), "toxic int, n long, segments array<double>"), "toxic-segments")
    shared.destroy()  # the table is written
    return out


def _calibrate(model: Model, segments: DataFrame, prevalence: float) -> None:
    """Set the constants of the extreme-value law and of the logistic curve; at most a few numbers
    for each sampled row come to the driver."""
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    clean = segments.where("toxic = 0").select(best.alias("best"), F.greatest("n", F.lit(1)).alias("n")).toPandas()
    if not len(clean):
        return
    # Extreme-value law: P(max < s) = exp(-K n exp(-scale s)); two quantiles give both constants.
    middle, high = np.quantile(clean["best"], [0.5, 0.95])
    model.scale = float(np.clip((math.log(math.log(2)) - math.log(-math.log(0.95))) / max(high - middle, 1e-3), 0.5, 4.0))
    model.log_k = float(np.median(model.scale * clean["best"] - np.log(clean["n"])) + math.log(math.log(2)))
    # Model.evidence as an expression over the kept segments.
    logs = F.transform("segments", lambda s: F.lit(model.scale) * s - F.lit(model.log_k) - F.log(F.greatest("n", F.lit(1)).cast("double")))
    summed = F.aggregate(F.filter(logs, lambda x: x > 0), F.lit(0.0), lambda a, x: a + x)
    z = F.when(F.size("segments") == 0, F.lit(-8.0)).when(summed > 0, summed).otherwise(F.greatest(F.lit(-8.0), F.array_max(logs)))
    held = segments.select(z.alias("z"), "toxic").toPandas().sort_values("z", ascending=False)
    z, t = held["z"].to_numpy(), held["toxic"].to_numpy(dtype=float)
    # The logistic curve passes THRESHOLD where F1, at the labelled prevalence, is best on unseen rows.
    hits = np.cumsum(t) * prevalence / max(1.0, t.sum())
    false = np.cumsum(1 - t) * (1 - prevalence) / max(1.0, (1 - t).sum())
    k = int(np.where(np.append(np.diff(z) < 0, True), 2 * hits / (hits + false + prevalence), 0).argmax())
    cut = (z[k] + z[min(k + 1, len(z) - 1)]) / 2
    model.intercept = math.log(THRESHOLD / (1 - THRESHOLD)) - model.slope * float(cut)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS, class_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most per_class labelled rows and class_bytes of each class (see labelled_sample).

    Texts stay on executors: they count words and score halves; the driver gets the sample's words
    with their counts and two numbers a row. Without rows of both classes the model is empty.
    """
    prepare(docs.sparkSession)
    sample, prevalence = labelled_sample(docs, labels, id_col, text_col, per_class, class_bytes)
    if sample is None:
        return Model()
    counted = _occurrences(sample).toArrow().sort_by("word")
    words = counted.column("word").to_pylist()
    counts = {c: counted.column(c).to_numpy() for c in counted.column_names[1:]}
    del counted
    if not len(words) or not counts["bad"].sum() or not counts["good"].sum():
        return Model()
    halves = [Model(*log_odds(words, counts[f"bad{k}"], counts[f"good{k}"])) for k in (0, 1)]
    segments = _segment_table(sample, halves)
    del halves
    model = Model(*log_odds(words, counts["bad"], counts["good"]))
    del words, counts
    _calibrate(model, segments, prevalence)
    release_memory()
    return model


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", passages: bool = True, carry: list[str] | None = None) -> DataFrame:
    """doc_id, score, predicted (1 from THRESHOLD on) and, with passages, the significant ones:
    passages array<struct<start, end, score>> in code points. `carry` names columns to keep.

    A null or empty text has the score of a text without evidence. Repeated rows are scored each
    for itself; an empty table gives an empty result; texts are scanned whole. No shuffle.
    """
    prepare(docs.sparkSession)
    carry = carry or []
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        scores = _Scores(own)
        for batch in batches:
            said, found = [], []
            for text in batch.column(1).to_pylist():
                segments, n = segments_of(text, scores)
                said.append(own.probability(own.evidence(segments, n)))
                if passages:
                    limit = math.log(SIGNIFICANT)
                    worth = [s for s in segments if own.scale * s[2] - own.log_k - math.log(max(1, n)) >= -limit]
                    at = word_spans(text) if worth else []
                    found.append([dict(start=at[a][0], end=at[b - 1][1], score=s) for a, b, s in worth])
            columns = [batch.column(0), pa.array(said, pa.float64()), pa.array([int(s >= THRESHOLD) for s in said], pa.int32())]
            names = ["doc_id", "score", "predicted"]
            if passages:
                columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(columns + [batch.column(2 + k) for k in range(len(carry))], names=names + [f"_c{k}" for k in range(len(carry))])

    extra = "".join(f", _c{k} {kinds[c]}" for k, c in enumerate(carry))
    schema = f"doc_id {kinds[id_col]}, score double, predicted int" + (", passages array<struct<start: int, end: int, score: double>>" if passages else "") + extra
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(carry)])
    return source.mapInArrow(releasing(run), schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, passages=False).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
