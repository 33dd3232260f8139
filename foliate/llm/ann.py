"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard of vectors.

Equal vectors become one node that keeps its least ids. Nodes are dealt to shards of about
SHARD_NODES by hash. In a shard, nodes enter a graph in growing batches: a greedy beam search
from the medoid proposes neighbours, robust pruning keeps a proposal only while no kept
neighbour is closer to it by the factor ALPHA, and edges are added both ways, pruned again where
a node has more than DEGREE. Queries go in rounds of bounded bytes to all tasks, each of which
beam-searches them on the graphs of its shards; the best are scored exactly and merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, releasing, table

SHARD_NODES = 2048
DEGREE = 48
BUILD_BEAM = 72
SEARCH_BEAM = 96
#: Slots of each node besides DEGREE, for edges to nodes that no path reaches.
SPARE = 8
ALPHA = 1.2
#: Queries that are searched together.
BLOCK = 2048
#: Most bytes of queries that are broadcast at once; they never stand beside every shard in a table.
ROUND_BYTES = 8 << 20
_SEARCHED = 256


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components that aren't zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `beam` nodes with the largest products, best first (-1 where there are fewer)."""
    n, many = len(x), len(queries)
    rows = np.arange(many)
    ids = np.full((many, beam), -1, dtype=np.int64)
    sims = np.full((many, beam), -np.inf, dtype=np.float32)
    done = np.ones((many, beam), dtype=bool)
    seen = np.zeros((many, n + 1), dtype=bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    seen[:, start] = True
    seen[:, n] = True  # stands for "no neighbour"
    while True:
        open_ = np.where(done, -np.inf, sims)
        best = open_.argmax(axis=1)
        active = np.flatnonzero(open_[rows, best] > -np.inf)
        if not len(active):
            return ids, sims
        best = best[active]
        done[active, best] = True
        near = graph[ids[active, best]]
        near = np.where(near < 0, n, near)
        near = np.where(seen[active[:, None], near], n, near)
        seen[active[:, None], near] = True
        fresh = near < n
        got = np.einsum("brd,bd->br", x[np.where(fresh, near, 0)], queries[active])
        all_sims = np.concatenate([sims[active], np.where(fresh, got, -np.inf)], axis=1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        sims[active], ids[active], done[active] = (np.take_along_axis(a, top, axis=1) for a in (all_sims, all_ids, all_done))


def robust_prune(x: np.ndarray, node: int, proposed: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Nearest first; a proposal goes when a kept neighbour is closer to it by the factor alpha."""
    proposed = np.unique(proposed[(proposed >= 0) & (proposed != node)])
    if not len(proposed):
        return proposed
    v = x[proposed]
    apart = 2 - 2 * (v @ x[node])
    order = np.argsort(apart, kind="stable")
    proposed, v, apart = proposed[order], v[order], apart[order]
    between = 2 - 2 * (v @ v.T)
    alive = np.ones(len(proposed), dtype=bool)
    kept: list[int] = []
    for k in range(len(proposed)):
        if alive[k]:
            kept.append(k)
            if len(kept) == degree:
                break
            alive &= alpha * alpha * between[k] > apart
    return proposed[kept]


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7) -> tuple[np.ndarray, int]:
    """Adjacency (n, degree), padded with -1, and the node where searches start."""
    n = len(x)
    graph = np.full((n, degree), -1, dtype=np.int32)
    start = int((x @ x.mean(axis=0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([start], order[order != start]))
    at = 1
    while at < n:
        batch = order[at : at + max(1, min(at, _SEARCHED))]
        found, _ = beam_search(x, graph, start, x[batch], beam)
        back: dict[int, list[int]] = {}
        for node, near in zip(batch.tolist(), found, strict=True):
            kept = robust_prune(x, node, near, degree, alpha)
            graph[node, : len(kept)] = kept
            for other in kept.tolist():
                back.setdefault(other, []).append(node)
        for node, more in back.items():
            own = graph[node][graph[node] >= 0]
            joined = np.concatenate([own, np.array(more)])
            if len(joined) > degree:
                joined = robust_prune(x, node, joined, degree, alpha)
            graph[node] = -1
            graph[node, : len(joined)] = joined
        at += len(batch)
    return connect(x, graph, start), start


def connect(x: np.ndarray, graph: np.ndarray, start: int, spare: int = SPARE) -> np.ndarray:
    """Give each node that no path from start reaches an edge from the nearest reached node with a spare slot."""
    n, degree = graph.shape
    graph = np.concatenate([graph, np.full((n, spare), -1, dtype=np.int32)], axis=1)
    reached = np.zeros(n, dtype=bool)

    def walk(nodes: list[int]) -> None:
        reached[nodes] = True
        while nodes:
            near = graph[nodes].ravel()
            near = np.unique(near[near >= 0])
            nodes = near[~reached[near]].tolist()
            reached[nodes] = True

    walk([start])
    while not reached.all():
        lost = int(np.flatnonzero(~reached)[0])
        free = np.flatnonzero(reached & (graph[:, degree:] < 0).any(axis=1))
        owner = int(free[(x[free] @ x[lost]).argmax()])
        graph[owner, degree + int(np.flatnonzero(graph[owner, degree:] < 0)[0])] = lost
        walk([lost])
    return graph


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """Distinct vectors with their `keep` least distinct ids; ids of one vector are thinned under a salt first."""
    v = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & usable(v)).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector"))
    rows = rows.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64("vector", F.lit(1)), "salt": F.pmod(F.xxhash64("id"), F.lit(64))})
    rows = rows.groupBy("h", "g", "salt", "id").agg(F.first("vector").alias("vector"))
    for key in (["h", "g", "salt"], ["h", "g"]):
        rows = rows.withColumn("r", F.row_number().over(W.partitionBy(*key).orderBy("id"))).where(F.col("r") <= keep).drop("r")
    return rows.groupBy("h", "g").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard_nodes: int = SHARD_NODES, beam: int = SEARCH_BEAM) -> DataFrame:
    """The k nearest rows of vectors by cosine for each row of queries: query_id, rank, vec_id, score.

    The row with the query's own id is no candidate; ties go to the smaller id; scores are double
    cosines of the original vectors. Vectors that are null, zero or hold null or non-finite
    components take no part, on either side, and neither do rows without an id; candidates of another
    length than a query's don't count for it. Repeated rows count once for their id; an empty table
    gives an empty result. Other columns aren't read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    nodes = materialize(nodes_of(vectors, id_col, vector_col, k + 1), "ann-nodes")
    n = nodes.count()
    shards = max(1, -(-n // shard_nodes))
    index = materialize(_index(nodes, shards), "ann-index")
    v = F.col(vector_col)
    asked = queries.where(F.col(id_col).isNotNull() & usable(v)).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector")).dropDuplicates(["id"])
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("numbers")).first()
    # A block has BLOCK queries, or fewer if their vectors are so long that it would exceed a round.
    blocks, rounds = max(1, -(-size["n"] // BLOCK)), max(1, -(-(8 * size["numbers"] + 48 * size["n"]) // ROUND_BYTES))
    blocks = -(-blocks // rounds) * rounds
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("block", F.size("vector").alias("width"))
        .agg(F.collect_list(F.struct("id", "vector")).alias("asked"))  # about BLOCK queries
    )
    packed = materialize(packed, "ann-asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each query the task's k best rows, as (-score, id): at most a round's queries.
        merged: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                width = one.column("width")[0].as_py()
                original = np.frombuffer(one.column("vectors")[0].as_py(), dtype=np.float64).reshape(-1, width)
                graph = np.frombuffer(one.column("graph")[0].as_py(), dtype=np.int32).reshape(len(original), -1)
                ids, start = one.column("ids")[0].as_py(), one.column("start")[0].as_py()
                want = one.column("asked")[0].as_py()
                x, q = unit(original), np.array([w["vector"] for w in want], dtype=np.float64)
                norms = np.sqrt((original * original).sum(axis=1))
                for at in range(0, len(q), _SEARCHED):
                    found, sims = beam_search(x, graph, start, unit(q[at : at + _SEARCHED]), max(beam, k + 1))
                    for w, vec, near, sim in zip(want[at : at + _SEARCHED], q[at : at + _SEARCHED], found, sims, strict=True):
                        # Rounding of single precision can swap near ties: more than k + 1 are scored exactly.
                        near = near[np.argsort(-sim, kind="stable")]
                        near = near[near >= 0]
                        if len({i for c in near[: 4 * (k + 1)].tolist() for i in ids[c]}) > k:  # an id may have several vectors
                            near = near[: 4 * (k + 1)]
                        scores = (original[near] @ vec) / (norms[near] * np.sqrt((vec * vec).sum()))
                        best = {i: -s for s, i in merged.get(w["id"], ())}
                        for c, s in zip(near.tolist(), scores.tolist(), strict=True):
                            for i in ids[c]:
                                if i != w["id"]:
                                    best[i] = max(s, best.get(i, s))
                        merged[w["id"]] = sorted((-s, i) for i, s in best.items())[:k]
        out = [(q, i, -s) for q, near in merged.items() for s, i in near]
        columns = list(zip(*out, strict=True)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    # A round ends before the next begins, so the driver holds one round's queries, however many there are.
    found = None
    for turn in range(rounds):
        pairs = index.join(F.broadcast(packed.where(F.col("block") % rounds == turn)), "width")
        got = materialize(pairs.select("width", "vectors", "graph", "ids", "start", "asked").mapInArrow(releasing(search), "query_id long, vec_id long, score double"), "ann-found")
        found = got if found is None else found.union(got)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _index(nodes: DataFrame, shards: int) -> DataFrame:
    """One row for each shard and vector length: its vectors, their ids and the graph."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("h")
        width = group.column("width")[0].as_py()
        original = np.array(group.column("vector").to_pylist(), dtype=np.float64)
        graph, start = build_graph(unit(original))
        return pa.table(
            {"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "width": pa.array([width], pa.int32()), "vectors": pa.array([original.tobytes()], pa.binary()), "graph": pa.array([graph.tobytes()], pa.binary()),
             "ids": pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))), "start": pa.array([start], pa.int32())}
        )

    dealt = nodes.withColumns({"shard": F.pmod("g", F.lit(shards)).cast("int"), "width": F.size("vector")}).select("shard", "width", "h", "ids", "vector")
    return dealt.groupBy("shard", "width").applyInArrow(build, "shard int, width int, vectors binary, graph binary, ids array<array<bigint>>, start int")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)
