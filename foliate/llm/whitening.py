"""Whitening of embeddings with an exact scatter matrix.

Vectors become whole numbers x. Over the distinct ones, y = n * x - S is n times the centred vector
and a whole number too. Its scatter, the sum of y y', may exceed any machine word, so it is formed
in a residue number system: each partition multiplies its rows modulo several primes (the products
of a block stay below 2 ** 53, where doubles are exact), Spark adds the residues up, and Chinese
remaindering gives back the exact integers. So the covariance, scatter / n ** 3, is rounded once and
doesn't depend on how rows are spread; its eigenvectors come from one double-precision solver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import materialize, prepare, releasing, table

#: Steps of a unit and the offset of x.
SCALE, OFFSET = 64, 1_000_000
#: Entries whose x would leave a 64-bit integer count as not finite.
LARGEST = float(1 << 56)
COMPONENTS = 16
#: Residues are below 2 ** PRIME_BITS, so BLOCK products of two add up below 2 ** 53.
PRIME_BITS, BLOCK = 20, 1 << 13
#: Components whose variance is below this share of the largest one hold rounding only.
FLAT = 1e-14


def primes(bound: int) -> list[int]:
    """The largest primes below 2 ** PRIME_BITS whose product exceeds the bound."""
    out, product, p = [], 1, 1 << PRIME_BITS
    while product <= bound:
        p -= 1
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            out.append(p)
            product *= p
    return out


def from_residues(residues: list[int], moduli: list[int]) -> int:
    """The integer of least absolute value with these residues."""
    x, product = 0, 1
    for r, p in zip(residues, moduli, strict=True):
        x += product * ((r - x) * pow(product, -1, p) % p)
        product *= p
    return x - product if 2 * x > product else x


def quantized(vector: Column) -> Column:
    """x of a vector; null where it is null or empty or holds null, non-finite or too large entries."""
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.when(sound & (F.size(vector) > 0), F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass
class Whitening:
    """n, sums and exact scatter (of n * x - sums) of the fit list; eigenvectors in columns, with their
    eigenvalues, trace and identity_error of the whitened fit list; span: largest |n * x - sums|."""

    n: int
    sums: list[int]
    scatter: list[list[int]]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    span: int
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, as 64-bit integers where all fit and as Python's otherwise."""
        if self.span < 1 << 62 and self.n * (int(abs(x).max(initial=0)) + 1) < 1 << 62 and max(map(abs, self.sums)) < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ (self.vectors / (self.n * np.sqrt(self.values)))


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """n, sums by dimension and the largest |x|, added up in decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, largest = 0, [0] * dims, 0
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            n += len(x)
            if len(x):
                part = int(abs(x).max())
                largest = max(largest, part)
                wide = x if part * len(x) < 1 << 62 else x.astype(object)
                sums = [s + int(v) for s, v in zip(sums, wide.sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([str(s) for s in sums]), pa.array([str(largest)] * dims)], names=["dim", "n", "s", "largest"])

    parts = fit.mapInArrow(releasing(run), "dim int, n long, s string, largest string")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max(F.col("largest").cast("decimal(38,0)")).alias("largest")).orderBy("dim").collect()
    return (rows[0]["n"], [int(r["s"]) for r in rows], int(rows[0]["largest"])) if rows else (0, [0] * dims, 0)


def residue_scatter(fit: DataFrame, n: int, sums: list[int], moduli: list[int]) -> list[list[int]]:
    """The exact sum of y y' over the fit list, y = n * x - sums, where the product of the moduli is over twice its largest entry."""
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(moduli), dims, dims), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for at in range(0, len(x), BLOCK):
                for k, p in enumerate(moduli):
                    y = ((x[at : at + BLOCK] % p) * (n % p) - np.array([s % p for s in sums], dtype=np.int64)) % p
                    y = y.astype(np.float64)
                    total[k] = (total[k] + (y.T @ y).astype(np.int64)) % p
        k, i, j = np.nonzero(np.ones_like(total)) if total.size else (np.empty(0, dtype=np.int64),) * 3
        upper = i <= j
        k, i, j = k[upper], i[upper], j[upper]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (k, i, j, total[k, i, j])], names=["k", "i", "j", "r"])

    rows = fit.mapInArrow(releasing(run), "k long, i long, j long, r long").groupBy("i", "j", "k").agg(F.sum("r").alias("r")).collect()  # dims ** 2 for each prime
    residues: dict[tuple[int, int], list[int]] = {}
    for r in rows:
        residues.setdefault((r["i"], r["j"]), [0] * len(moduli))[r["k"]] = r["r"] % moduli[r["k"]]
    out = [[0] * dims for _ in range(dims)]
    for (i, j), own in residues.items():
        out[i][j] = out[j][i] = from_residues(own, moduli)
    return out


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity."""
    dims, kept = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept, kept))
        for batch in batches:
            w = model.project(model.centred(_matrix(batch.column(0), dims)))
            total += w.T @ w
        i, j = np.indices((kept, kept)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = fit.mapInArrow(releasing(run), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # at most COMPONENTS ** 2
    return max((abs(r["v"] / model.n - (r["i"] == r["j"])) for r in rows), default=0.0)


def fit_whitening(vectors: DataFrame, x_col: str = "x", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a column of quantized vectors of one length, over its distinct vectors; None without rows.

    Copies are dropped by Spark's two-phase aggregation, so a vector that makes up most rows meets
    itself first within its partitions. Components without variance are left out.
    """
    fit = materialize(vectors.select(F.col(x_col).alias("x")).distinct(), "whitening-fit")
    first = fit.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    n, sums, largest = _sums(fit, first["d"])
    span = n * largest + max(map(abs, sums))
    moduli = primes(2 * n * span**2 + 1)
    scatter = residue_scatter(fit, n, sums, moduli)
    covariance = np.array([[v / n**3 for v in row] for row in scatter])
    values, own = np.linalg.eigh(covariance)
    values, own = values[::-1], own[:, ::-1]
    kept = min(components, int((values > max(values[0], 0.0) * FLAT).sum()) if values[0] > 0 else 0)
    trace = sum(scatter[i][i] for i in range(len(sums))) / n**3
    model = Whitening(n, sums, scatter, own[:, :kept].copy(), values[:kept].copy(), trace, span)
    if kept:
        model.identity_error = _identity_error(fit, model)
    return model


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation decimal(38,0), whitened, explained, identity_error of each row
    and component; deviation is null beyond 38 digits.

    Rows whose vector is null or empty or holds null, non-finite or too large entries (LARGEST) are
    dropped, as are vectors that differ in length from most (ties: the longest stay). Repeated rows
    and null ids get their rows. Without variance, as with one distinct vector, there is no component
    and no row; an empty table gives an empty result. No other column is read.
    """
    prepare(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("vec_id"), quantized(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = lengths["d"]
    rows = rows.where(F.size("x") == dims)
    model = fit_whitening(rows, components=components)
    kept = len(model.values)
    shared = (model.trace, model.identity_error)
    explained = model.values / shared[0] if shared[0] else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = model.centred(_matrix(batch.column(1), dims))
            white = model.project(y)
            wide = y if y.dtype != object and int(abs(y).max(initial=0)) ** 2 * dims < 1 << 63 else y.astype(object)
            deviation = [str(v) for v in (wide * wide).sum(axis=1).tolist()]
            at = np.repeat(np.arange(len(y)), kept)
            columns = [
                batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(y))), pa.array(np.full(len(at), model.n, dtype=np.int64)), pa.array(deviation, pa.string()).take(pa.array(at)),
                pa.array(white.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(at), shared[1])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = rows.mapInArrow(releasing(run), schema.replace("decimal(38,0)", "string"))
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """deviation is null where it needs more than a long."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
