"""Exact BPE encoding of whole texts, and decoding.

A text is cut where no merge can cross: before a space that a non-space follows. Each piece is
encoded once and kept in a bounded cache. The pieces that a batch of texts adds are cut into words
and their merges applied side by side, the next one of every word at a time. A word longer than LEAF
is encoded by tree concatenation: halves are encoded for themselves, all leaves of a word in one
batch, and at each join a window around it is encoded again and widened until its first
and last ids are those that the two sides have there. Adjacent ids that the merges would keep
apart stay apart whatever surrounds them, so agreement at both ends makes the whole exact.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foliate.llm.common import one_thread, prepare, table, text_or_empty

#: A word of more bytes is encoded by tree concatenation; long words of ordinary text are.
LEAF = 16
#: Ids on either side of a join that are encoded again at first.
WINDOW = 8
#: Pieces in each of the two generations of the cache.
CACHE = 150_000
#: Pieces, and words, that are merged side by side at once.
SIDE = 1 << 15

_CUT = re.compile(r"(?= \S)")
_UNSAFE = re.compile(r" (?:\s|\Z)")

#: Kinds of bytes by which plain pieces are cut into words: ends of pieces, letters, digits, signs, white space.
_END, _LETTER, _DIGIT, _SIGN, _SPACE, OTHER = range(6)


def byte_kinds() -> np.ndarray:
    """The kind of each byte: plain are ASCII without apostrophes (contractions) and most controls, and letters from U+00C0 to U+027F."""
    kinds = np.full(256, OTHER, dtype=np.uint8)
    for b in range(33, 127):
        kinds[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _SIGN
    kinds[ord("'")] = OTHER
    kinds[list(b" \t\n\r")] = _SPACE
    kinds[0x80:0xC0] = kinds[0xC3:0xCA] = _LETTER
    kinds[0] = _END
    return kinds


_KINDS = byte_kinds()


def plain_words(data: np.ndarray, kinds: np.ndarray = _KINDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces in UTF-8, each with a zero byte behind it: which are plain, starts of words and of the zero bytes, and which of these starts are zero bytes.

    The words of a plain piece are those of the splitting pattern of byte-level vocabularies.
    """
    kind = kinds[data]
    other = kind == OTHER
    other[1:] |= (data[:-1] == 0xC3) & ((data[1:] & 0xDF) == 0x97)  # the signs for times and divided by
    end = kind == _END
    ends = np.flatnonzero(end)
    plain = ~np.logical_or.reduceat(other, np.concatenate(([0], ends[:-1] + 1)))
    space = kind == _SPACE
    start = np.ones(len(data), dtype=bool)
    # A word goes on while the kind stays; a single space goes with what follows it.
    start[1:] = (kind[1:] != kind[:-1]) | end[:-1]
    start[1:] &= ~((data[:-1] == 32) & ~space[1:] & ~end[1:])
    # The last of several white spaces is left to what follows.
    start[1:-1] |= space[1:-1] & ~space[2:] & ~end[2:]
    starts = np.flatnonzero(start)
    return plain, starts, end[starts]


def words_of(pieces: list[str], kinds: np.ndarray = _KINDS) -> tuple[np.ndarray, ...]:
    """For pieces without zero bytes: their bytes, which are plain, and of each word of a plain one its start, bytes and piece."""
    data = np.frombuffer(("\0".join(pieces) + "\0").encode(), dtype=np.uint8)
    plain, starts, ends = plain_words(data, kinds)
    piece = (np.cumsum(ends) - ends)[~ends]
    sizes = np.diff(starts, append=len(data))[~ends]
    mine = plain[piece]
    return data, plain, starts[~ends][mine], sizes[mine], piece[mine]


def packed_ends(counts: np.ndarray, piece: np.ndarray, pieces: int) -> list[int]:
    """Where the ids of each piece end, in bytes of 4 for an id, given how many each word has."""
    return (4 * np.cumsum(np.bincount(piece, weights=counts, minlength=pieces).astype(np.int64))).tolist()


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take code points from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class TwoGenerations:
    """A bounded cache: when the young generation is full it becomes the old one."""

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: Iterable) -> list:
        """Of the distinct keys, those that are not kept; the others become young."""
        young, old, gone = self.young, self.old, []
        for key in set(keys).difference(young):
            if key in old:
                young[key] = old[key]
            else:
                gone.append(key)
        return gone

    def trim(self) -> None:
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young


class Merges:
    """The merges of a byte-level vocabulary, applied to many short words side by side. suffix: what the last byte of a word bears."""

    def __init__(self, vocab: dict[str, int], merges: list, alphabet: list[str], suffix: str = "") -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.size = max(vocab.values()) + 1
        self.none = len(pairs)  # a rank behind all others
        rank = {vocab[a] * self.size + vocab[b]: k for k, (a, b) in enumerate(pairs)}
        keys = sorted(rank)
        self.keys = np.array([*keys, np.iinfo(np.int64).max], dtype=np.int64)
        self.ranks = np.array([*map(rank.get, keys), self.none], dtype=np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.first = np.array([vocab[c] for c in alphabet], dtype=np.int32)
        self.last = np.array([vocab[c + suffix] for c in alphabet], dtype=np.int32)
        self.bytes = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256))
        self.last_bytes = self.rank(np.repeat(self.first, 256), np.tile(self.last, 256))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], np.int32(self.none))

    def encode(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that start there and have so many bytes, one word's after another's, and how many each has.

        Words of equal width make a table with a row for each place. In each round every word takes its
        merge of lowest rank, the leftmost of several, so all are narrower by one and meet those that
        have this width from the start; words without a merge are done.
        """
        counts, done = np.zeros(len(starts), dtype=np.int64), []
        widest = int(sizes.max(initial=1))
        ids, ranks, owner = np.empty((widest, 0), dtype=np.int32), np.empty((widest - 1, 0), dtype=np.int32), np.empty(0, dtype=np.int64)
        for width in range(widest, 0, -1):
            new = np.flatnonzero(sizes == width)
            raw = data[starts[new] + np.arange(width)[:, None]]
            pair = raw[:-1].astype(np.int32) * 256 + raw[1:]
            fresh, pairs = self.first[raw], self.bytes[pair]
            fresh[-1:], pairs[-1:] = self.last[raw[-1:]], self.last_bytes[pair[-1:]]
            ids, ranks = np.concatenate((ids, fresh), axis=1), np.concatenate((ranks, pairs), axis=1)
            owner = np.concatenate((owner, new))
            row = np.arange(width, dtype=np.int32)[:, None]
            best, place = np.divmod((ranks * np.int32(width) + row[:-1]).min(axis=0, initial=self.none * width), np.int32(width))
            go = best < self.none
            counts[owner[~go]] = width
            done.append((owner[~go], ids[:, ~go]))
            if width == 1:
                break
            ids, ranks, owner, best, place = ids[:, go], ranks[:, go], owner[go], best[go], place[go]
            made = self.made[best]
            ids = np.where(row[:-1] <= place, ids[:-1], ids[1:])
            ids[place, np.arange(len(owner))] = made
            ranks = np.where(row[:-2] < place, ranks[:-1], ranks[1:])
            k = np.flatnonzero(place > 0)
            ranks[place[k] - 1, k] = self.rank(ids[place[k] - 1, k], made[k])
            k = np.flatnonzero(place < width - 2)
            ranks[place[k], k] = self.rank(made[k], ids[place[k] + 1, k])
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        first = np.cumsum(counts) - counts
        for words, found in done:
            out[first[words] + np.arange(len(found))[:, None]] = found
        return out, counts


def encode_many(tokenizer, sep: str, sep_id: int, pieces: list[str], joined: int = 1000) -> Iterator[list[int]]:
    """Ids of each piece for itself; many pieces share a call, set apart by a special token that none of them holds."""
    texts = [sep.join(pieces[k : k + joined]) + sep for k in range(0, len(pieces), joined)]
    for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
        ids, start = e.ids, 0
        for end in np.flatnonzero(np.array(ids, dtype=np.int64) == sep_id).tolist():
            yield ids[start:end]
            start = end + 1


class ByteBpe:
    """A byte-level BPE vocabulary file: encode, decode, and pieces with their digests."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.leaf = leaf
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        self.alphabet = byte_alphabet()
        code = {c: b for b, c in enumerate(self.alphabet)}
        self.to_byte = code
        self.table: dict[int, bytes] = {i: bytes(code[c] for c in s) for s, i in spec["model"]["vocab"].items()}
        self.chars: dict[int, str] = {i: s for s, i in spec["model"]["vocab"].items()}
        self.table |= {i: s.encode() for s, i in self.specials.items()}
        # What each id stands for, and its decimal digits with a comma, in 8 bytes.
        size = max(self.table) + 1
        self.stands = np.array([self.table.get(i) for i in range(size)], dtype=object)
        self.digits = np.array([f"{i},".encode() for i in range(size)], dtype="S8").view(np.uint64)
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"], self.alphabet) if self._is_plain(spec) else None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.sep, self.sep_id = next(iter(self.specials.items()))
        # The same merges over one unsplit run of byte characters.
        self.raw = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None}))
        # The splitting pattern of byte-level vocabularies (fixed by the file format).
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.cache = TwoGenerations(CACHE)

    def _is_plain(self, spec: dict) -> bool:
        """Whether words are cut by the pattern and merged by rank only, so that merges can be applied side by side."""
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        return (
            not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and all(c in model["vocab"] for c in self.alphabet)
        )

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Ordinary stretches and special tokens of a text, in order."""
        if self._special is None or not any(s in text for s in self.specials):
            yield text, None
            return
        for k, part in enumerate(self._special.split(text)):
            if part:
                yield (part, self.specials[part]) if k % 2 else (part, None)

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut before each space that a non-space follows."""
        if _UNSAFE.search(text):
            return [x for x in _CUT.split(text) if x]
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]

    def encode(self, text: str) -> list[int]:
        return next(self.ids([text])).tolist()

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        cut = [[(self.pieces(part), special) for part, special in self.segments(t)] for t in texts]
        self.cache.trim()
        self._learn(set().union(*(pieces for parts in cut for pieces, special in parts if special is None)))
        kept = self.cache.young.__getitem__
        for parts in cut:
            yield np.frombuffer(b"".join([self._packed([special]) if special is not None else b"".join(map(kept, pieces)) for pieces, special in parts]), dtype="<u4")

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.table[i] for i in ids]).decode("utf-8", "replace")

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text: number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
        for ids in self.ids(texts):
            joined = self.digits[ids].tobytes().translate(None, b"\0")[:-1]
            decoded = b"".join(self.stands[ids].tolist()).decode("utf-8", "replace").encode()
            yield len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def digest(self, text: str) -> tuple[int, str, str]:
        return next(self.digests([text]))

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that the cache lacks."""
        gone = self.cache.missing(pieces)
        if self.merges:
            gone = [p for k in range(0, len(gone), SIDE) for p in self._merge(gone[k : k + SIDE])]
        short = [p for p in gone if len(p) <= self.leaf]
        for p, ids in zip(short, encode_many(self.tokenizer, self.sep, self.sep_id, short), strict=True):
            self.cache.young[p] = self._packed(ids)
        for p in gone:
            if len(p) > self.leaf:
                self.cache.young[p] = self._packed(self._encode_unsplit(p))

    def _merge(self, pieces: list[str]) -> list[str]:
        """Encode the plain pieces side by side, long words by the tree; return the others."""
        rest = [p for p in pieces if "\0" in p]
        pieces = [p for p in pieces if "\0" not in p] if rest else pieces
        if not pieces:
            return rest
        data, plain, starts, sizes, piece = words_of(pieces)
        short = sizes <= self.leaf
        counts = np.zeros(len(starts), dtype=np.int64)
        found = [self.merges.encode(data, starts[short][k : k + SIDE], sizes[short][k : k + SIDE]) for k in range(0, int(short.sum()), SIDE)]
        trees = [self.tree("".join([self.alphabet[b] for b in data[at : at + n].tolist()])) for at, n in zip(starts[~short].tolist(), sizes[~short].tolist(), strict=True)]
        counts[short] = np.concatenate([np.empty(0, dtype=np.int64), *[n for _, n in found]])
        counts[~short] = [len(x) for x in trees]
        ids = np.empty(int(counts.sum()), dtype="<u4")
        of_short = np.repeat(short, counts)
        ids[of_short] = np.concatenate([np.empty(0, dtype=np.uint32), *[x for x, _ in found]])
        ids[~of_short] = [i for x in trees for i in x]
        packed, young, at = ids.tobytes(), self.cache.young, 0
        for p, ok, end in zip(pieces, plain.tolist(), packed_ends(counts, piece, len(pieces)), strict=True):
            if ok:
                young[p] = packed[at:end]
                at = end
            else:
                rest.append(p)
        return rest

    def _encode_unsplit(self, piece: str) -> list[int]:
        """A piece without a safe cut: split it as the library does; long words go through the tree."""
        ids: list[int] = []
        short: list[str] = []

        def flush() -> None:
            for x in encode_many(self.tokenizer, self.sep, self.sep_id, short):
                ids.extend(x)
            short.clear()

        for word in self.words.findall(piece):
            if len(word) <= self.leaf:
                # A word alone is split as it is in its place: white space stays white space only.
                short.append(word)
            else:
                flush()
                ids.extend(self.tree("".join(self.alphabet[b] for b in word.encode())))
        flush()
        return ids

    def tree(self, run: str) -> list[int]:
        """Ids of one unsplit run of byte characters, by halves."""
        leaves = [run]
        while len(leaves[0]) > self.leaf:
            leaves = [half for x in leaves for half in (x[: len(x) // 2], x[len(x) // 2 :])]
        parts = [e.ids for e in self.raw.encode_batch_fast([x for x in leaves if x], add_special_tokens=False)]
        while len(parts) > 1:
            parts = [self.join(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        k = WINDOW
        while True:
            a, b = left[-k:], right[:k]
            mid = self.raw.encode("".join(self.chars[i] for i in a + b), add_special_tokens=False).ids
            if (mid[0] == a[0] or len(a) == len(left)) and (mid[-1] == b[-1] or len(b) == len(right)):
                return left[: len(left) - len(a)] + mid + right[len(b) :]
            k *= 2


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """One encoder for each file and process."""
    one_thread()
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Encode every whole text with the vocabulary file at path, and decode the ids again.

    Returns doc_id, n_tokens and either ids array<int> and decoded string, or with digests=True
    ids_sha256 and decoded_sha256. A null text is empty and has no ids; very long texts are encoded
    whole; each of several repeated rows gets its row; an empty table gives an empty result. Other
    columns are neither read nor returned. No shuffle.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if digests:
                n, ids, back = zip(*bpe.digests(texts), strict=True) if texts else ((), (), ())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                ids = [i.tolist() for i in bpe.ids(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.select(docs[id_col].alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(encode, f"doc_id {kind}, n_tokens long, {out}")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)
