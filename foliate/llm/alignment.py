"""Alignment of two tokenizers' tokens by their byte ranges, corpus-wide.

Neither vocabulary merges across a space that follows a non-space, so a text is a row of stretches
that are aligned each for itself, and each distinct one once. Of every distinct stretch both sides'
tokens are exploded with their ends, those that end at one place meet by grouping on stretch and end,
and a running count of the places where both end numbers the groups. A group links all its A tokens
with all its B tokens.

Documents are gathered in blocks of BLOCK_CHARS characters with a list of their stretches, as
places in it; a text beyond that is a block of its own. A block fetches the tokens of its stretches,
in groups, in a few compressed rows, and no row repeats them for a document. It gives its documents'
sums and texts of groups and its pairs, which are counted once a document; their corpus-wide counts
come back to the block for the last sums.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.llm.bpe import byte_alphabet
from foliate.llm.common import ARROW_ROWS, discard, materialize, one_thread, prepare, release_memory, releasing, session_settings, shared_folder, table, text_or_empty

#: Characters of text of a block: bounds a task's memory.
BLOCK_CHARS = 32 << 20
#: The mark that piece vocabularies have for a space (fixed by the file format).
MARK = "▁"
_RAGGED = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")
#: What a document or a stretch is summed up by.
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
#: Those of them that need no count of pairs.
KNOWN = COUNTS[:4]
#: Characters of stretches that are encoded in one string.
JOINED = 1 << 13
#: Bytes of stretches that are sent to their blocks at once, each block its own in one row.
SENT_BYTES = 16 << 20
#: Rows of an Arrow batch of stretches, which are short; its bytes are bounded too.
STRETCH_ROWS = 10_000
#: Joins and windows on a stretch reuse its partitioning, a table's shuffles go once it is written, kinds of rows are written apart without a sort, and lists are collected from rows that the window has sorted.
_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "2", "spark.sql.execution.useObjectHashAggregateExec": "false"}
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _write(df: DataFrame, tag: str) -> DataFrame:
    rows = {_ROWS: str(STRETCH_ROWS)} if df.sparkSession.conf.get(_ROWS) == str(ARROW_ROWS) else {}
    with session_settings(df.sparkSession, _SETTINGS | rows):
        return materialize(df, tag)


def _write_apart(df: DataFrame, tag: str, by: str, values: tuple[str, ...]) -> list[DataFrame]:
    """A table written once, and its rows of each value of a column, each in a folder of its own."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/foliate/{tag}-{uuid.uuid4().hex}"
    with session_settings(spark, _SETTINGS):
        df.write.partitionBy(by).parquet(path)
    schema = df.drop(by).schema
    there = {r[0] for r in spark.read.schema(df.schema).parquet(path).select(by).distinct().collect()}
    return [spark.read.schema(schema).parquet(f"{path}/{by}={v}") if v in there else spark.createDataFrame([], schema) for v in values]


def stretches(text: str) -> list[str]:
    """The text behind a space, cut before spaces that follow a non-space; each without its own first space."""
    if not text:
        return []
    full = " " + text
    return [x[1:] for x in _CUT.split(full)] if _RAGGED.search(full) else text.split(" ")


class TokenPair:
    """Both tokenizers: ids of stretches, and each token's length in bytes."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.load(open(byte_path, encoding="utf-8"))
        self.byte_bpe = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.byte_bpe.encode_special_tokens = True
        code = {c: b for b, c in enumerate(byte_alphabet())}
        self.a_bytes = {i: bytes(code[c] for c in s) for s, i in spec["model"]["vocab"].items() if all(c in code for c in s)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.match(x)) else x.replace(MARK, " ").encode() for x in names]
        self.space = self.pieces.piece_to_id(MARK)

        self.a_lengths = np.zeros(max(self.a_bytes) + 1, dtype=np.int32)
        self.a_lengths[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_lengths = np.array([len(x) for x in self.b_bytes], dtype=np.int32)

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a space and the text."""
        b = self.pieces.encode(text, num_threads=1) if text else [self.space]  # nothing is encoded as nothing, without the space before it
        return self.byte_bpe.encode(" " + text, add_special_tokens=False).ids, b

    def _sound(self, text: str, a: list[int], b: list[int]) -> bool:
        own = (" " + text).encode()
        return b"".join([self.a_bytes[i] for i in a]) == own == b"".join([self.b_bytes[i] for i in b])

    def encode(self, keys: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Of stretches: whether both sides' bytes are the stretch's; then for A and B all ids one after
        the other, and how many each stretch has (none where the bytes differ).

        Stretches share a string, as their ids stay apart there; those that end in white space, or
        share a string whose bytes differ, are encoded alone.
        """
        sound = np.zeros(len(keys), dtype=bool)
        ids: list[list[np.ndarray]] = [[], []]
        sizes = [np.zeros(len(keys), dtype=np.int32) for _ in range(2)]
        first = 0
        while first < len(keys):
            last, chars = first, 0
            while last < len(keys) and (chars < JOINED or last == first) and keys[last] and not keys[last][-1].isspace():
                chars += len(keys[last]) + 1
                last += 1
            last = max(last, first + 1)
            text = " ".join(keys[first:last])
            both = self._ids(text)
            if self._sound(text, *both):
                ends = np.cumsum([len(k.encode()) + 1 for k in keys[first:last]])
                for side, (own, lengths) in enumerate(zip(both, (self.a_lengths, self.b_lengths), strict=True)):
                    flat = np.array(own, dtype=np.int32)
                    ids[side].append(flat)
                    sizes[side][first:last] = np.diff(np.searchsorted(np.cumsum(lengths[flat]), ends) + 1, prepend=0)
                sound[first:last] = True
            elif last > first + 1:
                for k in range(first, last):
                    both = self._ids(keys[k])
                    if self._sound(keys[k], *both):
                        sound[k] = True
                        for side in range(2):
                            ids[side].append(np.array(both[side], dtype=np.int32))
                            sizes[side][k] = len(both[side])
            first = last
        return sound, [np.concatenate(x or [np.empty(0, dtype=np.int32)]) for x in ids], sizes


_loaded: dict[tuple[str, str], TokenPair] = {}


def load(byte_path: str, piece_path: str) -> TokenPair:
    """One pair for each two files and process."""
    one_thread()
    if (byte_path, piece_path) not in _loaded:
        _loaded[byte_path, piece_path] = TokenPair(byte_path, piece_path)
    return _loaded[byte_path, piece_path]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 28 as bytes of seven bits each, the lowest first; all but a number's last have the high bit."""
    v = values.astype(np.int64)
    size = 1 + (v >= 1 << 7) + (v >= 1 << 14) + (v >= 1 << 21)
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for k in range(4):
        there = size > k
        out[first[there] + k] = ((v[there] >> (7 * k)) & 127) | ((size[there] > k + 1) << 7)
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    last = np.flatnonzero(b < 128)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    out = np.zeros(len(last), dtype=np.int64)
    for k in range(4):
        there = first + k <= last
        out[there] |= (b[first[there] + k] & 127) << (7 * k)
    return out


def shut(rows: pa.Table) -> bytes:
    """Rows as bytes of a compressed Arrow stream: a block's rows travel together, and columns of few values cost little."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def opened(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def blocks(docs: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """Documents: block, part (numbers its rows) and data (shut: doc_id and places, packed, of its stretches
    in the block's list) of several documents each; lists: block, place, stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part, chars = TaskContext.get().partitionId() << 32, 0, 0
        places: defaultdict[str, int] = defaultdict(count().__next__)
        names = ["of", "block", "part", "data", "place", "stretch"]

        def held(ids: pa.Array, own: list[bytes]) -> Iterator[pa.RecordBatch]:
            data = shut(pa.table({"doc_id": ids, "places": pa.array(own, pa.binary())}))
            yield pa.RecordBatch.from_arrays([pa.array(["documents"]), pa.array([block]), pa.array([part], pa.int32()), pa.array([data], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string())], names=names)

        def listed() -> Iterator[pa.RecordBatch]:
            keys = list(places)
            for at in range(0, len(keys), 1 << 16):
                own = keys[at : at + (1 << 16)]
                n = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(["lists"] * n), pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(own, pa.string())], names=names)

        for batch in batches:
            first, own = 0, []
            for k, text in enumerate(batch.column(1).to_pylist()):
                if chars and chars + len(text) > block_chars:
                    if own:
                        yield from held(batch.column(0).slice(first, k - first), own)
                    yield from listed()
                    places, block, part, chars, first, own = defaultdict(count().__next__), block + 1, 0, 0, k, []
                chars += len(text)
                own.append(packed(np.fromiter(map(places.__getitem__, stretches(text)), dtype=np.int64)))
            if own:
                yield from held(batch.column(0).slice(first), own)
                part += 1
        if places:
            yield from listed()

    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    made = source.mapInArrow(releasing(run), "of string, block long, part int, data binary, place int, stretch string")
    held, listed = _write_apart(made, "alignment-blocks", "of", ("documents", "lists"))
    return held.select("block", "part", "data"), listed.select("block", "place", "stretch")


def tokenized(lists: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Of each distinct stretch: sid, blocks and places (where it is listed), and tokens and ends: A's ids,
    then B's as -1 - id, each with the place of its last byte; both null where a side's bytes aren't the stretch's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(byte_path, piece_path)
        number = TaskContext.get().partitionId() << 40

        def encoded(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            n = len(starts)
            sound, ids, sizes = pair.encode(rows.column("stretch").take(pa.array(starts)).to_pylist())
            ends = []
            for own, size, lengths in zip(ids, sizes, (pair.a_lengths, pair.b_lengths), strict=True):
                total = np.concatenate(([0], np.cumsum(lengths[own], dtype=np.int64)))
                last = np.cumsum(size)
                ends.append(total[1:] - np.repeat(total[last - size], size))
            size = sizes[0] + sizes[1]
            order = np.argsort(np.concatenate([np.repeat(np.arange(n), s) for s in sizes]), kind="stable")
            at = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32), mask=np.append(~sound, False))
            columns = [pa.array(np.arange(number, number + n))]
            runs = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
            columns += [pa.ListArray.from_arrays(runs, rows.column(c).combine_chunks()) for c in ("block", "place")]
            columns += [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x)[order].astype(np.int32))) for x in ((ids[0], -1 - ids[1]), ends)]
            number += n
            return pa.RecordBatch.from_arrays(columns, names=["sid", "blocks", "places", "tokens", "ends"])

        rest: list[pa.RecordBatch] = []  # rows of the last stretch, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([*rest, batch]).combine_chunks()
            own = rows.column("stretch").chunk(0)
            starts = np.concatenate(([0], 1 + np.flatnonzero(pc.not_equal(own.slice(1), own.slice(0, len(own) - 1)).to_numpy(zero_copy_only=False))))
            if len(starts) > 1:
                yield encoded(rows.slice(0, starts[-1]), starts[:-1])
            rest = rows.slice(starts[-1]).to_batches()
        if rest:
            yield encoded(pa.Table.from_batches(rest), np.zeros(1, dtype=np.int64))

    equal = lists.select("stretch", "block", "place").repartition("stretch").sortWithinPartitions("stretch")
    return _write(equal.mapInArrow(releasing(run), "sid long, blocks array<long>, places array<int>, tokens array<int>, ends array<int>"), "alignment-tokens")


def groups(tokens: DataFrame, key: str = "sid") -> DataFrame:
    """key and found: end, g, a and b of each place where a token ends, in order; g numbers the groups
    between places where tokens of both sides end, a and b are the ids of the tokens that end there.
    """
    rows = tokens.select(key, F.explode(F.arrays_zip("tokens", "ends")).alias("t")).select(key, F.col("t.ends").alias("end"), F.col("t.tokens").alias("token"))
    both = rows.groupBy(key, "end").agg(F.max(F.when(F.col("token") >= 0, F.col("token"))).alias("a"), F.max(F.when(F.col("token") < 0, -1 - F.col("token"))).alias("b"))
    cuts = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull())
    numbered = both.withColumn("g", F.coalesce(cuts.over(W.partitionBy(key).orderBy("end").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    return numbered.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("end", "g", "a", "b"))).alias("found"))


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each first on, size of them, one after the other."""
    return np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)


def for_blocks(found: DataFrame) -> DataFrame:
    """block and data (shut: places, sizes and tokens) from blocks, places and found (null: unsound, size -1).

    Tokens go as 2 * id for A and 2 * id + 1 for B, group by group and A first, so a group starts where
    A follows B. They are cut in two halves of 16 bits, of which the high one costs little.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            lists, ends = rows.column("blocks").chunk(0), rows.column("found").chunk(0)
            g, a, b = (ends.flatten().field(c) for c in ("g", "a", "b"))
            n = pc.fill_null(pc.list_value_length(ends), 0).to_numpy().astype(np.int64)
            stretch, g = np.repeat(np.arange(len(n)), n), g.to_numpy().astype(np.int64)
            new = np.append(True, (stretch[1:] != stretch[:-1]) | (g[1:] != g[:-1]))[: len(g)]
            group = np.cumsum(new)
            sides = [(x.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(x, 0).to_numpy().astype(np.int64)) for x in (a, b)]
            order = np.argsort(np.concatenate([2 * group[there] + k for k, (there, _) in enumerate(sides)]), kind="stable")
            tokens = np.concatenate([2 * x[there] + k for k, (there, x) in enumerate(sides)])[order]
            sizes = np.bincount(np.concatenate([stretch[there] for there, _ in sides]), minlength=len(n))
            first = np.cumsum(sizes) - sizes
            said = np.where(ends.is_valid().to_numpy(zero_copy_only=False), sizes, -1)
            of, own = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()
            place = rows.column("places").chunk(0).flatten().to_numpy()
            by = np.argsort(own, kind="stable")
            for at in np.split(by, 1 + np.flatnonzero(np.diff(own[by]))):
                mine = tokens[_spans(first[of[at]], sizes[of[at]])]
                columns = {"place": place[at], "size": said[of[at]].astype(np.int32), "low": (mine & 0xFFFF).astype(np.uint16), "high": (mine >> 16).astype(np.uint16)}
                data = shut(pa.table({c: pa.array([v]) for c, v in columns.items()}))
                yield pa.RecordBatch.from_arrays([pa.array(own[at[:1]]), pa.array([data], pa.binary())], names=["block", "data"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SENT_BYTES:
                yield from sent()
                held, size = [], 0
        if size:
            yield from sent()

    return found.mapInArrow(releasing(run), "block long, data binary")


def linked(group: np.ndarray, side: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens, group by group: each group's pairs (a * width + b), times and group, by group.

    Ids that repeat in a group are counted and not multiplied out.
    """
    n = np.bincount(group)
    alone = n[group] == 2  # one of each side
    a, b = alone & (side == 0), alone & (side == 1)
    found = [(ids[a] * width + ids[b], np.ones(int(a.sum()), dtype=np.int64), group[a])]
    if not alone.all():
        most = int(ids.max()) + 1
        parts = [np.unique(group[x] * most + ids[x], return_counts=True) for x in (~alone & (side == k) for k in (0, 1))]
        (own, own_times), (other, other_times) = parts
        size = np.bincount(other // most, minlength=len(n))
        first = np.cumsum(size) - size
        of = own // most
        at, met = np.repeat(np.arange(len(own)), size[of]), _spans(first[of], size[of])
        found.append(((own % most)[at] * width + (other % most)[met], own_times[at] * other_times[met], of[at]))
    pairs, times, groups_ = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(groups_, kind="stable")
    return pairs[order], times[order], groups_[order]


def _read(data: pa.Scalar, width: int, said: pa.Array) -> tuple[np.ndarray, ...]:
    """Of a row of for_blocks: places, whether sound, text of the groups (each behind ';'), KNOWN, numbers of pairs; pairs and times."""
    place, size, low, high = (opened(data).column(c).combine_chunks().flatten().to_numpy() for c in ("place", "size", "low", "high"))
    n = np.maximum(size, 0).astype(np.int64)
    tokens = low.astype(np.int64) + (high.astype(np.int64) << 16)
    ids, side, stretch = tokens >> 1, tokens & 1, np.repeat(np.arange(len(n)), n)
    starts = np.append(True, (side[1:] < side[:-1]) | (stretch[1:] != stretch[:-1]))[: len(side)]
    turns = np.append(False, side[1:] > side[:-1])[: len(side)] & ~starts
    group = np.cumsum(starts) - 1
    pieces = said.take(pa.array(3 * ids + np.where(starts, 0, np.where(turns, 1, 2))))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pieces), "")
    of = stretch[starts]
    na, nb = (np.bincount(group[side == k], minlength=len(of)) for k in (0, 1))
    count_by = lambda x: np.bincount(of, weights=x, minlength=len(n)).astype(np.int64)
    pairs, times, by = linked(group, side, ids, width) if len(ids) else (ids, ids, ids)
    return place, size >= 0, texts, np.array([count_by(na), count_by(nb), np.bincount(of, minlength=len(n)), count_by(na * nb)]), np.bincount(of[by], minlength=len(n)), pairs, times


def _parts(docs: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """A block's documents, several at once, the places of all their stretches, and where each document's begin and the last end."""
    for data in docs.sort_by("part").column("data"):
        part = opened(data)
        lists = part.column("places").combine_chunks()
        joined = b"".join(lists.to_pylist())
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(lists).to_numpy())))
        ended = np.concatenate(([0], np.cumsum(np.frombuffer(joined, dtype=np.uint8) < 128)))
        yield part, unpacked(joined), ended[ends]


def _once(values: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """Each of the values once; stamp has room for the largest and any content."""
    at = np.arange(len(values))
    stamp[values] = at
    return values[stamp[values] == at]


def _gather(docs: pa.Table, rows: pa.Table, width: int, ids: int, kind: pa.DataType) -> pa.Table:
    """A block's pairs with a number and how many of its documents hold them, and its book (shut): by document
    what can be said before pairs are counted corpus-wide, by place the numbers of its pairs and their times.
    """
    _loaded.clear()  # workers that have encoded go on here
    release_memory()
    block = docs.column("block")[0].as_py()
    said = pa.array([f"{c}{i}" for i in range(ids) for c in ";|,"], pa.string())
    read = [_read(x, width, said) for x in rows.column("data")]
    empty = np.empty(0, dtype=np.int64)
    joined = lambda k: np.concatenate([x[k] for x in read] or [empty])
    place = joined(0)
    row = np.zeros(len(place), dtype=np.int32)  # of each place
    row[place] = np.arange(len(place), dtype=np.int32)
    texts = pa.concat_arrays([x[2] for x in read] or [pa.array([], pa.string())]).take(pa.array(row))
    sound = joined(1).astype(bool)[row]
    values = np.concatenate([x[3] for x in read] or [np.empty((len(KNOWN), 0), dtype=np.int64)], axis=1)[:, row]
    sizes = joined(4).astype(np.int64)
    inside = _spans((np.cumsum(sizes) - sizes)[row], sizes[row]).astype(np.int32)
    sizes = sizes[row]
    first = np.cumsum(sizes) - sizes
    times = joined(6)[inside]
    listed = pa.array(joined(5), kind).dictionary_encode()
    keys, own = listed.dictionary, listed.indices.to_numpy()[inside]
    del read, inside, listed, said, place, row
    held = np.zeros(len(keys), dtype=np.int64)
    stamps = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    sums: list[list[np.ndarray]] = [[] for _ in KNOWN]
    said = []
    for _, places, ends in _parts(docs):
        n = np.diff(ends)
        good = (n > 0) & (np.diff(np.concatenate(([0], np.cumsum(~sound[places])))[ends]) == 0)
        for known, value in zip(sums, values, strict=True):
            known.append(np.where(good, np.diff(np.concatenate(([0], np.cumsum(value[places])))[ends]), 0))
        for k, (begin, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if not good[k]:
                said.append("")
                continue
            at = places[begin:end]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), texts.take(pa.array(at))), "")
            said.append(hashlib.sha256(memoryview(text.buffers()[2])[1:]).hexdigest())
            at = _once(at, stamps[0])
            n = sizes[at]
            held[_once(own[_spans(first[at], n)], stamps[1])] += 1
    by_document = pa.table({**{c: pa.array(np.concatenate(v)) for c, v in zip(KNOWN, sums, strict=True)}, "groups_sha256": pa.array(said, pa.string())})
    by_place = pa.table({"size": pa.array(sizes.astype(np.int32))})
    by_pair = pa.table({"number": pa.array(own), "times": pa.array(times)})
    used = np.flatnonzero(held)
    n = len(used)
    book = pa.array([None] * n + [shut(x) for x in (by_document, by_place, by_pair)], pa.binary())
    number = pa.array(np.concatenate((used, np.arange(3))).astype(np.int32))
    return pa.table({
        "of": pa.array(["pairs"] * n + ["books"] * 3), "block": pa.array(np.full(n + 3, block)), "number": number, "pair": pa.concat_arrays([keys.take(pa.array(used)), pa.nulls(3, kind)]),
        "docs": pa.concat_arrays([pa.array(held[used]), pa.nulls(3, pa.int64())]), "data": book,
    })


def _assemble(docs: pa.Table, rows: pa.Table) -> pa.Table:
    """The documents of a block from its book and its pairs' corpus-wide counts."""
    there = rows.column("data").is_valid()
    by_document, by_place, by_pair = (opened(x) for x in rows.filter(there).sort_by("number").column("data"))
    counted = rows.filter(pc.invert(there))
    number, times = by_pair.column("number").to_numpy(), by_pair.column("times").to_numpy()
    last = np.cumsum(by_place.column("size").to_numpy(), dtype=np.int64)
    first = np.concatenate(([0], last[:-1])) if len(last) else last
    good = by_document.column("n_groups").to_numpy() > 0
    sums: dict[str, list[np.ndarray]] = {"n_best": [], "count_sum": []}
    scores = {}
    for name, column in (("n_best", "best"), ("count_sum", "docs")):
        weight = np.zeros(int(number.max(initial=-1)) + 1, dtype=np.int64)
        weight[counted.column("number").to_numpy()] = counted.column(column).to_numpy()
        total = np.concatenate(([0], np.cumsum(times * weight[number])))
        scores[name] = total[last] - total[first]
    ids = []
    for part, places, ends in _parts(docs):
        ids.append(part.select(["doc_id"]))
        for name, score in scores.items():
            total = np.concatenate(([0], np.cumsum(score[places])))
            sums[name].append(np.diff(total[ends]))
    out = pa.concat_tables(ids).append_column("n_best", pa.array(np.where(good, np.concatenate(sums["n_best"]), 0)))
    out = out.append_column("count_sum", pa.array(np.where(good, np.concatenate(sums["count_sum"]), 0)))
    for name in (*KNOWN, "groups_sha256"):
        out = out.append_column(name, by_document.column(name))
    return out.select(["doc_id", *COUNTS, "groups_sha256"])


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; and links: a, b, docs
    (documents that hold the pair linked), best (whether no other b has more with that a).

    Null and empty texts, and those whose tokens' bytes aren't the text's, have zeros and ''. Very long
    texts are aligned whole. Each of several repeated rows counts as a document of its own; ids may be
    null; an empty table gives empty results; no other column is read.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    pair = load(byte_path, piece_path)
    width = len(pair.b_bytes)
    small = "int" if len(pair.a_lengths) * width < 1 << 31 else "long"  # a pair's number
    held, lists = blocks(docs, id_col, text_col, block_chars)
    tokens = tokenized(lists, byte_path, piece_path)
    discard(lists)
    own = groups(tokens.where("tokens is not null").select("sid", "tokens", "ends").repartition("sid"))
    found = tokens.select("sid", "blocks", "places").join(own, "sid", "left").select("blocks", "places", "found")
    sent = _write(for_blocks(found), "alignment-stretches")
    discard(tokens)

    ids = max(len(pair.a_lengths), width)
    arrow = pa.int32() if small == "int" else pa.int64()
    gathered = held.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(lambda d, r: _gather(d, r, width, ids, arrow), f"of string, block long, number int, pair {small}, docs long, data binary")
    pairs, books = _write_apart(gathered, "alignment-books", "of", ("pairs", "books"))
    discard(sent)

    counts = _write(pairs.groupBy("pair").agg(F.sum("docs").alias("docs")), "alignment-counts")
    a = F.floor(F.col("pair") / width).cast("int")
    top = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("top"))
    links = counts.withColumn("a", a).join(top, "a").select("pair", "a", F.pmod("pair", F.lit(width)).cast("int").alias("b"), "docs", (F.col("docs") == F.col("top")).alias("best"))

    known = pairs.select("block", "number", "pair").join(links.select("pair", "docs", F.col("best").cast("long").alias("best")), "pair").select("block", "number", "docs", "best", F.lit(None).cast("binary").alias("data"))
    rows = known.unionByName(books.select("block", "number", "data"), allowMissingColumns=True)
    out = held.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(_assemble, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string")
    return out, links.drop("pair")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]
