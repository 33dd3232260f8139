"""Exact similarity join of word sets, by bitmaps of their hashed words.

A set's bitmap holds the parity of its words' hashes, so two sets differ in at least as many words
as their bitmaps differ in bits, and pairs whose bitmaps are too far apart can't be similar. Sets
are dealt to blocks by size; blocks of near sizes meet, bitmaps only, and the sets themselves are
fetched once for each pair of blocks, for the pairs that the bitmaps leave.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.sources.shared import materialize

#: Size steps between sizes that differ by the factor of the threshold.
FINE = 4
#: Most sets and words of a block: bounds a task's memory.
ROWS, WORDS = 1 << 15, 1 << 23
#: Bits of a bitmap for each word, at least; and for a set, at least (a power of two).
BITS, LEAST_BITS = 1.3, 64
#: Pairs of sets that are compared in one call.
_AT_ONCE = 1 << 16


def parities(hashes: np.ndarray, lengths: np.ndarray, widths: np.ndarray) -> list[bytes]:
    """Of each set (so many of the hashes) the bitmap of its width."""
    first = np.concatenate(([0], np.cumsum(widths)))
    at = np.repeat(first[:-1], lengths) + (hashes.view(np.uint64) & np.repeat(widths - 1, lengths).astype(np.uint64)).astype(np.int64)
    data = np.packbits((np.bincount(at, minlength=first[-1]) & 1).astype(np.uint8)).tobytes()
    return [data[a // 8 : b // 8] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (n, 64-bit words) at a smaller width; parities of both halves add up."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def close_pairs(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and y, both ascending in their sizes nx and ny, that may have the similarity; same: y is x, each pair once."""
    words = min(x.shape[1], y.shape[1])
    x, yt = folded(x, words), np.ascontiguousarray(folded(y, words).T)
    apart = (1 - least) / (1 + least)
    step = max(1, _AT_ONCE // max(1, len(ny)))
    for at in range(0, len(nx), step):
        own, n = x[at : at + step], nx[at : at + step]
        a, b = np.searchsorted(ny, least * n[0] - 1e-6), np.searchsorted(ny, n[-1] / least + 1e-6, side="right")
        a = max(a, at + 1) if same else a
        if a >= b:
            continue
        bits = np.zeros((len(own), b - a), dtype=np.uint32)
        for w in range(words):
            bits += np.bitwise_count(own[:, w, None] ^ yt[None, w, a:b])
        i, j = np.nonzero(bits <= (n[:, None] + ny[None, a:b]) * apart + 1e-6)
        i, j = i + at, j + a
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def similar(sets: DataFrame, least: float, id_col: str = "class", words_col: str = "words") -> DataFrame:
    """All pairs (a < b) of ids whose sets have a Jaccard similarity of `least` or more.

    words: a set's distinct words, joined by single spaces; rows without one are linked with nothing.
    Ids are unique. The result is exact: bitmaps only leave out what can't be similar. Bitmaps are
    compared for all sets of near sizes, so the work grows with the square of their number.
    """
    kind = sets.schema[id_col].dataType.simpleString()
    words = F.split("words", " ")
    scale = FINE / -math.log(least)
    rows = sets.select(F.col(id_col).alias("id"), F.col(words_col).alias("words")).where("words <> ''").withColumn("size", F.size(words))
    rows = rows.withColumn("step", F.floor(F.log(F.col("size").cast("double")) * scale + 1e-9).cast("int"))
    # One row for each step, some hundred at most; sizes that can be linked are at most FINE steps apart.
    steps = {r.step: max(-(-r.n // ROWS), -(-r.words // WORDS)) for r in rows.groupBy("step").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()}
    if not steps:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    first, parts = [0], [steps.get(s, 0) for s in range(max(steps) + 1)]
    for n in parts:
        first.append(first[-1] + n)
    last = len(parts) - 1
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("step"))
    block = at(first[:-1]) + F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), at(parts))).cast("int")
    width = at([max(LEAST_BITS, 1 << math.ceil(math.log2(BITS * math.exp(s / scale)))) for s in range(last + 1)])
    met = F.sequence(at([first[max(0, s - FINE)] for s in range(last + 1)]), at([first[min(last, s + FINE) + 1] - 1 for s in range(last + 1)]))

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hashes")
            made = parities(hashes.flatten().to_numpy(), hashes.value_lengths().to_numpy(), batch.column("width").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "size", "block", "met")), pa.array(made, pa.binary())], names=["id", "size", "block", "met", "bitmap"])

    marked = rows.select("id", "size", block.alias("block"), met.alias("met"), width.alias("width"), F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"))
    marked = marked.mapInArrow(bitmaps, f"id {kind}, size int, block int, met array<int>, bitmap binary")
    lower, upper = F.least("block", "other").cast("long"), F.greatest("block", "other").cast("long")
    meeting = marked.select("id", "size", "block", "bitmap", F.explode("met").alias("other")).select("id", "size", "block", "bitmap", (lower * (1 << 31) + upper).alias("pair"))

    def compare(group: pa.Table) -> pa.Table:
        pair = group.column("pair")[0].as_py()
        group = group.select(["id", "size", "block", "bitmap"]).sort_by([("size", "ascending")])
        sides = [group.filter(pc.equal(group.column("block"), b)) for b in (pair >> 31, pair & ((1 << 31) - 1))]
        ids, sizes = [s.column("id").combine_chunks() for s in sides], [s.column("size").to_numpy().astype(np.float64) for s in sides]
        found = []
        if all(len(n) for n in sizes):
            x, y = (np.frombuffer(b"".join(s.column("bitmap").to_pylist()), dtype=np.uint64).reshape(len(n), -1) for s, n in zip(sides, sizes, strict=True))
            found = list(close_pairs(x, sizes[0], y, sizes[1], least, pair >> 31 == pair & ((1 << 31) - 1)))
        i, j = (np.concatenate([np.empty(0, dtype=np.int64), *(f[k] for f in found)]) for k in (0, 1))
        return pa.table({"pair": pa.array(np.full(len(i), pair)), "a": ids[0].take(pa.array(i)), "b": ids[1].take(pa.array(j))})

    left = materialize(meeting.groupBy("pair").applyInArrow(compare, f"pair long, a {kind}, b {kind}"), "similar-candidates")
    members = left.select(F.col("pair").alias("of"), F.explode(F.array("a", "b")).alias("id")).distinct().join(rows.select("id", "words"), "id").select("of", "id", "words")

    def verify(own: pa.Table, pairs: pa.Table) -> pa.Table:
        split = pc.split_pattern(own.column("words").combine_chunks(), " ")
        ends, codes = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        seen, codes = np.zeros(len(codes.dictionary), dtype=bool), codes.indices.to_numpy()
        place = {v: k for k, v in enumerate(own.column("id").to_pylist())}
        keep, current = [], None
        pairs = pairs.sort_by("a")
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            if a != current:
                seen[:] = False
                mine = codes[ends[place[a]] : ends[place[a] + 1]]
                seen[mine], current = True, a
            other = codes[ends[place[b]] : ends[place[b] + 1]]
            shared = int(seen[other].sum())
            keep.append(shared / (len(mine) + len(other) - shared) >= least)
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = members.groupBy("of").cogroup(left.groupBy("pair")).applyInArrow(verify, f"a {kind}, b {kind}")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
