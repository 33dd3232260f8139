"""Hierarchical multi-length packing of tokenized documents.

Every document becomes its ids and an end id. Stretches of a full window leave at once. What
remains of a document is routed to the smallest context size (tier) that holds it, and each tier
is packed into sequences of exactly its size, longest pieces first: gaps are filled with the
longest pieces of shorter tiers that fit, and what no whole piece fills is filled with the head
of a short piece, whose rest stays. All sequences of a tier thus have the tier's length, a power
of two, and need no padding; the rest at the end is cut into powers of two. Sequences of equal
length are dealt to step groups of equal tokens, so that attention costs are even.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.bpe import CACHE, OTHER, SIDE, Merges, TwoGenerations, byte_alphabet, byte_kinds, packed_ends, words_of
from foliate.llm.common import one_thread, prepare, releasing, table, text_or_empty

#: Context sizes, longest first; each a power of two.
TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Tokens that are gathered before they are packed; bounds a task's memory.
BUFFER = 1 << 20
#: Tokens of a step group.
STEP = 1 << 15


#: What the word splitter of these files does (fixed by the format): no word mixes letters with anything else.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

#: Bytes of a word that is merged side by side with others, at most.
LONGEST = 32


def _plain_kinds() -> np.ndarray:
    """Plain pieces here have ASCII letters and signs and letters from U+00C0 to U+00FF, which NFC keeps and whose lower case is 32 behind."""
    kinds = byte_kinds()
    kinds[list(b"0123456789 \t\n\r")] = OTHER
    kinds[0xC4:0xCA] = OTHER
    return kinds


_PLAIN = _plain_kinds()


class WordIds:
    """Ids of a text under a vocabulary file whose pre-tokenizer drops white space, as little-endian bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        spec |= {"truncation": None, "padding": None}
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        added = spec["added_tokens"]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added))
        self.sep, self.sep_id = added[-1]["content"], added[-1]["id"]
        self.cache = TwoGenerations(2 * CACHE)
        # Where each word ends with a marked id, pieces need no special token between them.
        self.bare, self.merges, self.ends = None, None, np.zeros(1 + max(spec["model"]["vocab"].values()), dtype=bool)
        if _ends_marked(spec):
            self.bare = Tokenizer.from_str(json.dumps(spec | {"added_tokens": []}))
            suffix = spec["model"]["end_of_word_suffix"]
            if not spec["model"].get("ignore_merges") and not spec["model"].get("continuing_subword_prefix"):
                self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"], byte_alphabet(), suffix)
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        # Spaces and line feeds part words for certain; other white space stays inside a piece.
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        self.cache.trim()
        young = self.cache.young
        young[""] = b""
        gone = self.cache.missing(set().union(*cut).difference(young))
        plain = rest = [p for p in gone if not self.special.search(p)]
        if self.merges:
            rest = [p for k in range(0, len(rest), SIDE) for p in self._merge(rest[k : k + SIDE])]
        if self.bare:
            words, counts, rest = counted(rest)
            young.update(zip(words, self._packed_words(words, counts), strict=True))
        young.update(zip(rest, self._packed(rest), strict=True))
        for p in set(gone).difference(plain):
            young[p] = pack_ids(self.tokenizer.encode(p, add_special_tokens=False).ids)
        for pieces in cut:
            yield b"".join(map(young.__getitem__, pieces))

    def _merge(self, pieces: list[str]) -> list[str]:
        """Encode the plain pieces without long words side by side; return the others."""
        left = [p for p in pieces if "\0" in p]
        pieces = [p for p in pieces if "\0" not in p] if left else pieces
        if not pieces:
            return left
        data, plain, starts, sizes, piece = words_of(pieces, _PLAIN)
        plain[piece[sizes > LONGEST]] = False
        mine = plain[piece]
        starts, sizes, piece = starts[mine], sizes[mine], piece[mine]
        capital = (data >= 65) & (data <= 90)
        capital[1:] |= (data[:-1] == 0xC3) & (data[1:] < 0x9F)
        data = data + np.uint8(32) * capital
        found = [self.merges.encode(data, starts[k : k + SIDE], sizes[k : k + SIDE]) for k in range(0, len(starts), SIDE)]
        counts = np.concatenate([np.empty(0, dtype=np.int64), *[n for _, n in found]])
        packed, young, at = b"".join([x.astype("<u4").tobytes() for x, _ in found]), self.cache.young, 0
        for p, ok, end in zip(pieces, plain.tolist(), packed_ends(counts, piece, len(pieces)), strict=True):
            if ok:
                young[p] = packed[at:end]
                at = end
            else:
                left.append(p)
        return left

    def _packed_words(self, pieces: list[str], counts: list[int], joined: int = 1000) -> Iterator[bytes]:
        """Ids of each piece for itself, given the fewest words that it can have; many share a call, set apart by spaces.

        No piece has fewer words than said, so if all together have no more, each has just as many.
        """
        parts = [pieces[k : k + joined] for k in range(0, len(pieces), joined)]
        for k, e in enumerate(self.bare.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids, last = np.array(e.ids, dtype="<u4"), np.cumsum(counts[k * joined : (k + 1) * joined])
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != last[-1]:
                yield from self._packed(parts[k])
                continue
            raw, start = ids.tobytes(), 0
            for end in (4 * (ends[last - 1] + 1)).tolist():
                yield raw[start:end]
                start = end

    def _packed(self, pieces: list[str], joined: int = 1000) -> Iterator[bytes]:
        """Ids of each piece for itself; many share a call, set apart by a special token that none holds."""
        texts = [self.sep.join(pieces[k : k + joined]) + self.sep for k in range(0, len(pieces), joined)]
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids, start = np.array(e.ids, dtype="<u4"), 0
            raw = ids.tobytes()
            for end in (4 * np.flatnonzero(ids == self.sep_id)).tolist():
                yield raw[start:end]
                start = end + 4


def _ends_marked(spec: dict) -> bool:
    """Whether words are split as in _SPLIT and the last id of each, and no other, bears the suffix."""
    model = spec["model"]
    suffix, vocab = model.get("end_of_word_suffix"), model["vocab"]
    return bool(
        suffix and spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
        and model["type"] == "BPE" and not model.get("dropout") and all(c in vocab and c + suffix in vocab for c in byte_alphabet())
    )


def counted(pieces: list[str]) -> tuple[list[str], list[int], list[str]]:
    """The pieces of letters, or of letters and ASCII punctuation behind them; the fewest words of each (1, 2); the other pieces.

    Punctuation parts from a letter that both Python and the library know: Latin, Greek, Cyrillic.
    """
    words, counts, rest = [], [], []
    for p in pieces:
        letters = p.rstrip(punctuation)
        if not letters.isalpha():
            rest.append(p)
        elif len(letters) == len(p):
            words.append(p)
            counts.append(1)
        elif letters[-1] < "\u0530":
            words.append(p)
            counts.append(2)
        else:
            rest.append(p)
    return words, counts, rest


def pack_ids(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


_loaded: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    """One encoder for each file and process. A task has one core: threads of the library would only contend for it."""
    one_thread()
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


#: A piece: length, document (index into the task's documents), start in the document.
Piece = tuple[int, int, int]


def pack(pieces: list[Piece], tiers: tuple[int, ...] = TIERS, last: bool = True) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Sequences (context, pieces), and the pieces left over unless this is the last call.

    Pieces are shorter than the longest tier. Each tier takes, longest first, pieces that exceed
    the next shorter tier; every sequence is filled to its context exactly.
    """
    pool = sorted(pieces)
    total = sum(p[0] for p in pool)
    out: list[tuple[int, list[Piece]]] = []
    for tier, below in zip(tiers, [*tiers[1:], 0], strict=True):
        while total >= tier and pool[-1][0] > below:
            chosen, gap = [], tier
            while gap:
                k = bisect_right(pool, (gap, 1 << 62, 0)) - 1
                if k >= 0:
                    p = pool.pop(k)
                    chosen.append(p)
                    gap -= p[0]
                else:  # all are longer than the gap: the shortest gives its head
                    n, doc, start = pool.pop(0)
                    chosen.append((gap, doc, start))
                    insort(pool, (n - gap, doc, start + gap))
                    gap = 0
            out.append((tier, chosen))
            total -= tier
    if not last:
        return out, pool
    return out + _tail(pool), []


def _tail(pool: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """What fills no tier: sequences of decreasing powers of two."""
    left, out = sum(p[0] for p in pool), []
    queue = pool[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        chosen, gap = [], size
        while gap:
            n, doc, start = queue.pop(0)
            take = min(n, gap)
            chosen.append((take, doc, start))
            if take < n:
                queue.insert(0, (n - take, doc, start + take))
            gap -= take
        out.append((size, chosen))
        left -= size
    return out


def trimmed(held: dict[int, tuple[object, bytes, int]], pool: list[Piece]) -> dict[int, tuple[object, bytes, int]]:
    """Of the held documents (id, ids as bytes, where these start) only what the pool's pieces need."""
    out = {}
    for n, doc, start in pool:  # a document has one piece here at most
        key, data, first = held[doc]
        out[doc] = (key, data if len(data) == 4 * n else data[4 * (start - first) : 4 * (start - first + n)], start)
    return out


def step_groups(sequences: list[tuple[int, list[Piece]]], step: int = STEP) -> list[int]:
    """A group for each sequence: same context, step / context sequences, even attention costs."""
    group, first = [0] * len(sequences), 0
    by_context: dict[int, list[int]] = {}
    for k, (context, _) in enumerate(sequences):
        by_context.setdefault(context, []).append(k)
    for context, own in sorted(by_context.items(), reverse=True):
        size = max(1, step // context)
        groups = -(-len(own) // size)
        cost = {k: sum(p[0] * p[0] for p in sequences[k][1]) for k in own}
        heap = [(0, 0, g) for g in range(groups)]
        for k in sorted(own, key=lambda k: (-cost[k], k)):
            spent, n, g = heapq.heappop(heap)
            group[k] = first + g
            if n + 1 < size:
                heapq.heappush(heap, (spent + cost[k], n + 1, g))
        first += groups
    return group


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS,
    with_ids: bool = True,
) -> DataFrame:
    """Pack all documents; one row for each piece.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group and,
    unless with_ids=False, ids array<int>. Each partition is packed for itself, so nothing is
    shuffled and no task holds more than BUFFER tokens and one batch; sequence ids carry the
    partition's number. A null text is empty and still has its end id; a very long text gives many
    full sequences, which leave with its batch, so that only its rest is held; repeated rows are packed each for itself; an empty table gives an empty
    result. Other columns are neither read nor returned.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    window, end = tiers[0], pack_ids([end_id])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group"]
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = load(path)
        base = TaskContext.get().partitionId() << 36
        counts = {"sequence": 0, "group": 0}
        held: dict[int, tuple[object, bytes, int]] = {}  # document: id, ids as bytes from some start on, that start
        totals: dict[int, int] = {}
        pool: list[Piece] = []
        kept, number, id_type = 0, 0, None

        def rows(sequences: list[tuple[int, list[Piece]]]) -> Iterator[pa.RecordBatch]:
            groups = step_groups(sequences)
            columns: list[list] = [[] for _ in range(9 + with_ids)]
            for (context, pieces), group in zip(sequences, groups, strict=True):
                offset = 0
                for n, doc, start in pieces:
                    key, data, first = held[doc]
                    own = data[4 * (start - first) : 4 * (start - first + n)]
                    values = (key, start, n, zlib.crc32(own), totals[doc], base + counts["sequence"], offset, context, base + counts["group"] + group)
                    for column, value in zip(columns, values, strict=False):
                        column.append(value)
                    if with_ids:
                        columns[9].append(memoryview(own).cast("I").tolist())
                    offset += n
                counts["sequence"] += 1
                if len(columns[0]) >= 4096:
                    yield batch_of(columns)
                    columns = [[] for _ in range(9 + with_ids)]
            counts["group"] += max(groups, default=-1) + 1
            if columns[0]:
                yield batch_of(columns)

        def batch_of(columns: list[list]) -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64(), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names + ["ids"] * with_ids)

        for batch in batches:
            id_type = batch.column(0).type
            full: list[tuple[int, list[Piece]]] = []
            for key, data in zip(batch.column(0).to_pylist(), words.ids(batch.column(1).to_pylist()), strict=True):
                data += end
                n = len(data) // 4
                held[number], totals[number] = (key, data, 0), n
                full += [(window, [(window, number, s)]) for s in range(0, n - window + 1, window)]
                if rest := n % window:
                    pool.append((rest, number, n - rest))
                    kept += rest
                number += 1
            yield from rows(full)
            if kept >= BUFFER:
                done, pool = pack(pool, tiers, last=False)
                yield from rows(done)
                kept = sum(p[0] for p in pool)
            held, totals = trimmed(held, pool), {p[1]: totals[p[1]] for p in pool}
        yield from rows(pack(pool, tiers)[0])

    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(releasing(run), schema + (", ids array<int>" if with_ids else ""))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group")
