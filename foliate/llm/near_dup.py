"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

1. Words become 64-bit hashes, five in a row a shingle. Texts with equal word sequences form one
   class; everything below is between classes, so copies are never expanded into pairs.
2. Circulant MinHash: a permutation sigma scatters the shingles, a permutation pi is read at
   sigma(x) + k for k = 0, 1, ...: each circular shift gives one more signature coordinate.
3. ROWS coordinates form a band, BANDS bands a signature. Classes that share a band are a bucket.
   Two classes at the threshold share none with probability (1 - 0.75**4)**32 < 6e-6.
4. Each class of a bucket is compared with the bucket's pivot only; verified links give components.
   Where a bucket still spans several components, the classes outside its largest one are compared
   with those of the other components: first signatures and then, of classes that these leave, full
   sets, in blocks inside a task. A block gives one link to each component at most, so no stage
   makes more rows than classes. Buckets of mutual copies cost one comparison a member.
5. A comparison first looks at set sizes and signatures (a link estimated under EST_FLOOR is more
   than five standard deviations off), then intersects the full sets of shingle hashes.
6. Components by alternating large-star and small-star joins, in rounds that are written out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, releasing, table, text_or_empty

SHINGLE = 5
THRESHOLD = 75
BANDS = 32
ROWS = 4
COORDINATES = BANDS * ROWS
#: Pairs whose signatures agree in a smaller share of coordinates are no links.
EST_FLOOR = 0.52
#: Shingles whose coordinates are computed at once.
_BLOCK = 256
_MAX_ROUNDS = 60
#: Most bytes, on average, of a block of classes that are compared inside a task.
BLOCK_BYTES = 1 << 20
#: Cells of the membership tables that such a comparison holds at once.
_CELLS = 2_000_000
#: Shares that a large group's rows are dealt into where they meet the group's size.
SALTS = 32

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _scatter(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str) -> tuple[bytes, np.ndarray]:
    """Key of the word sequence, and the sorted distinct hashes of its shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space
    key = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    if not words:
        return key, np.empty(0, dtype=np.uint64)
    if len(words) < SHINGLE:
        return key, np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - SHINGLE + 1
    mixed = h[:n] * _MULTIPLIERS[0]
    for k in range(1, SHINGLE):
        mixed += _scatter(h[k : k + n] * _MULTIPLIERS[k])
    return key, np.unique(_scatter(mixed))


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Circulant MinHash: the least pi(sigma(x) + k) for each shift k, low 16 bits."""
    sigma = (_scatter(shingles) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)
    least = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(sigma), _BLOCK):
        y = sigma[at : at + _BLOCK, None] + shifts
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(13)
        y *= np.uint32(0xC2B2AE35)
        y ^= y >> np.uint32(16)
        np.minimum(least, y.min(axis=0), out=least)
    return least.astype("<u2")


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, n_shingles and signature of every row; no signature where there are no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, signs = [], [], []
            for text in batch.column(1).to_pylist():
                key, found = shingle_set(text)
                keys.append(key)
                sizes.append(len(found))
                signs.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signs, pa.binary())], names=["doc_id", "key", "n_shingles", "sig"]
            )

    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(releasing(run), f"doc_id {kind}, key binary, n_shingles long, sig binary")


def _sets(texts: DataFrame) -> DataFrame:
    """key and sorted shingle hashes (8 bytes each) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())], names=["key", "shingles"])

    return texts.mapInArrow(releasing(run), "key binary, shingles binary")


def _linked(pairs: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b, sa, sb) whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, _, x, y in _row_by_row(batch):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= threshold * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(releasing(run), "a binary, b binary")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """The pairs (a, b) of class keys that are links, written out."""
    x = classes.select(F.col("key").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("siga"), F.col("id").alias("ida"))
    y = classes.select(F.col("key").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sigb"), F.col("id").alias("idb"))
    places = F.sequence(F.lit(0), F.lit(COORDINATES - 1))
    agree = F.size(F.filter(places, lambda i: F.substring(F.col("siga"), i * 2 + 1, F.lit(2)) == F.substring(F.col("sigb"), i * 2 + 1, F.lit(2))))
    near = (
        pairs.join(x, "a").join(y, "b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold)
        .where(agree >= int(EST_FLOOR * COORDINATES))
        .select("a", "b", "ida", "idb")
    )
    near = materialize(near, "near-pairs")
    sets = _needed_sets(near.select(F.explode(F.array("ida", "idb")).alias("id")).distinct(), docs, id_col, text_col)
    joined = (
        near.select("a", "b")
        .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
    )
    return materialize(_linked(joined, threshold), "near-links")


def _both_ways(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """Edges (u, v) between each two columns in ends, made where a row stands: a union would plan rows anew for each."""
    made = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends])
    return rows.select(F.explode(made).alias("edge")).select("edge.u", "edge.v")


def components(links: DataFrame) -> DataFrame:
    """key and component (the least key that can be reached) of every key in links (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, seen = materialize(edges, "near-edges"), None
    for _ in range(_MAX_ROUNDS):
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        both = _both_ways(edges, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = materialize(_both_ways(large.join(down, "u"), ("u", "m"), ("v", "m")).where("u <> v").distinct(), "near-edges")
    else:
        raise RuntimeError("components didn't settle")
    ends = edges.groupBy("u").agg(F.min("v").alias("component"))
    return ends.select(F.col("u").alias("key"), "component").union(ends.select(F.col("component").alias("key"), "component").distinct())


def _open(placed: DataFrame, bucket: list[str]) -> DataFrame:
    """Rows of the buckets that span several components, with the bucket's largest one."""
    sizes = placed.groupBy(*bucket, "component").count()
    largest = sizes.groupBy(*bucket).agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("k")).where("k > 1").select(*bucket, F.col("top.component").alias("largest"))
    return placed.join(largest, bucket)


def _block_pairs(rows: DataFrame, payload: str, block: int, body, schema: str, narrow: DataFrame | None = None) -> DataFrame:
    """Run body over pairs of blocks of each group g: classes outside the largest component x all.

    rows: g, key, component, outside and the payload; narrow: g and bytes (the payload's) of the same
    rows, by which groups are measured without the joins that fetch payloads. A block has about
    `block` classes by hash, or fewer where their payloads are large, so that a pair of blocks stays
    within a few MB; every pair is a row of its own, dealt by the pair, so a large group is shared
    out. A group of more than one block learns its size by a salted join, so its rows never meet in
    a task.
    """
    measured = rows.select("g", F.octet_length(payload).alias("bytes")) if narrow is None else narrow
    sizes = measured.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("parts")).where("parts > 1")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", F.lit("salt")), F.lit(SALTS)).cast("int"))
    sized = salted.join(sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cell = F.struct("key", "component", "outside", F.col(payload).alias("data"))
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    blocks = materialize(sized.groupBy("g", part.alias("part")).agg(F.collect_list(cell).alias("cells"), F.bool_or("outside").alias("asks")), "near-blocks")
    asking = blocks.where("asks").select("g", F.col("part").alias("q"), F.filter("cells", lambda c: c["outside"]).alias("asked"))
    pairs = asking.join(blocks.select("g", "part", "cells"), "g")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "g", "q", "part").select("g", "asked", "cells").mapInArrow(releasing(body), schema)


def _row_by_row(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch, one at a time: only one row's sets are Python objects."""
    for i in range(batch.num_rows):
        yield [column[i].as_py() for column in batch.columns]


def _columns(cells: list[dict]) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    return [c["key"] for c in cells], np.array([c["component"] for c in cells], dtype=object), [c["data"] for c in cells]


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of block pairs whose signatures allow a link to another component."""
    for batch in batches:
        out: set[tuple[bytes, bytes]] = set()
        for g, asked, cells in _row_by_row(batch):
            (ka, ca, xa), (kb, cb, xb) = _columns(asked), _columns(cells)
            a, b = (np.frombuffer(b"".join(x), dtype="<u2").reshape(len(x), -1) for x in (xa, xb))
            for i in range(len(ka)):
                hits = np.flatnonzero(((b == a[i]).sum(axis=1) >= int(EST_FLOOR * COORDINATES)) & (cb != ca[i]))
                if len(hits):
                    out.add((g, ka[i]))
                    out.update((g, kb[k]) for k in hits.tolist())
        columns = list(zip(*out, strict=True)) if out else [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["g", "key"])


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sorted sets in a with all in b, some common values at a time."""
    values, counts = np.unique(np.concatenate(a + b), return_counts=True)
    values = values[counts > 1]
    del counts
    out = np.zeros((len(a), len(b)), dtype=np.int64)

    def table(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        made = np.zeros((len(sets), len(some)), dtype=np.float32)
        for k, s in enumerate(sets):
            s = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], "right")]
            at = np.searchsorted(some, s)
            made[k, at[some[at] == s]] = 1
        return made

    step = max(1, _CELLS // (len(a) + len(b)))
    for first in range(0, len(values), step):
        some = values[first : first + step]
        out += np.rint(table(a, some) @ table(b, some).T).astype(np.int64)
    return out


def _exact(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for _, asked, cells in _row_by_row(batch):
                (ka, ca, xa), (kb, cb, xb) = _columns(asked), _columns(cells)
                a, b = ([np.frombuffer(x, dtype=np.uint64) for x in xs] for xs in (xa, xb))
                both = shared_counts(a, b)
                na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
                linked = 100 * both >= threshold * (na[:, None] + nb[None, :] - both)
                for i in range(len(ka)):
                    met: set[bytes] = set()  # one link to a component will do
                    for k in np.flatnonzero(linked[i] & (cb != ca[i])).tolist():
                        if cb[k] not in met:
                            met.add(cb[k])
                            out.append((ka[i], kb[k]))
            columns = list(zip(*out, strict=True)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

    return run


def _needed_sets(needed: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and shingles of the documents whose id is in needed, written out."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(needed, "id").select("text")
    return materialize(_sets(source).dropDuplicates(["key"]), "near-sets")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    A null text, or one without words, has no shingles and is linked with nothing: its
    component_id is its own doc_id. component_id is the least doc_id of the group; a row with a null
    doc_id joins those with an equal word sequence only, and has a null component_id where none of
    them has an id; kept compares null-safe.
    Repeated rows share their group, and all rows with its least doc_id are kept. Very long texts
    are hashed whole. An empty table gives an empty result. Other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = materialize(features(docs, id_col, text_col), "near-features")
    classes = materialize(
        rows.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "near-classes"
    )
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.substring(F.col("sig"), j * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    parts = classes.where("id IS NOT NULL").select("key", F.posexplode(bands).alias("j", "band"))
    buckets = parts.groupBy("j", "band").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(parts.join(buckets, ["j", "band"]).select("j", "band", "n", "key"), "near-members")

    # A bucket's pivot is the class that meets most others in all its buckets: of a group of edited
    # copies that is the text they were made from, which they are closer to than to each other.
    degrees = members.groupBy("key").agg(F.sum("n").alias("degree"))
    pivots = members.join(degrees, "key").groupBy("j", "band").agg(F.max(F.struct("degree", "key")).alias("top")).select("j", "band", F.col("top.key").alias("pivot"))
    tried = members.join(pivots, ["j", "band"]).where("key <> pivot").select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()
    tried = materialize(tried, "near-tried")
    links = verify(tried, classes, docs, id_col, text_col, threshold)
    groups = materialize(components(links), "near-groups")

    # Buckets that still span several components, gathered by their largest one: the classes outside
    # it meet all others, block by block.
    placed = members.join(groups, "key", "left").select("j", "band", "key", F.coalesce("component", "key").alias("component"))
    open_ = _open(materialize(placed, "near-placed"), ["j", "band"])
    rows_ = open_.select(F.col("largest").alias("g"), "key", "component", (F.col("component") != F.col("largest")).alias("outside")).distinct()
    rows_ = materialize(rows_, "near-open")
    signed = rows_.join(classes.select("key", "sig"), "key")
    likely = _block_pairs(signed, "sig", 256, _likely, "g binary, key binary", rows_.select("g", F.lit(2 * COORDINATES).alias("bytes")))
    near = materialize(likely.distinct(), "near-likely")
    needed = near.join(classes.select("key", "id", (F.col("n_shingles") * 8).alias("bytes")), "key")
    sets = _needed_sets(needed.select("id").distinct(), docs, id_col, text_col)
    full = materialize(needed.drop("id").join(rows_, ["g", "key"]), "near-open")
    found_links = _block_pairs(full.join(sets, "key"), "shingles", 128, _exact(threshold), "a binary, b binary", full)
    links = links.union(materialize(found_links, "near-links"))
    groups = components(links)

    found = classes.select("key", "id").join(groups, "key", "left").select("key", "id", F.coalesce("component", "key").alias("component"))
    found = materialize(found, "near-found")
    least = found.groupBy("component").agg(F.min("id").alias("component_id"))
    named = found.join(least, "component").select("key", "component_id")
    linked = rows.where("n_shingles > 0").join(named, "key").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op5_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
