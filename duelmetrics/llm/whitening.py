"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries become whole numbers, so the count n, the sums S and the products G of the different
vectors are exact, and so is C = n * G - S * S', which is n * n times the covariance. The
characteristic polynomial of C is computed modulo enough primes, each by a Hessenberg reduction
in a task of its own, and put together by Chinese remaindering. All its roots are real, so the
number of roots beyond a point is the number of sign changes of the polynomial moved there
(Descartes' rule is exact then); bisection isolates the largest roots and refines them to REFINE
bits. Null-space inverse iteration with DIGITS decimal digits gives each root's component.

What the driver holds depends on the dimension alone: C, one row of coefficients per prime, and
the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

SCALE = 256
#: Roots closer than 2**-SAME of the trace are one multiple root; roots are known to 2**-REFINE of it.
SAME, REFINE, DIGITS = 100, 170, 90
_LIMB, _LIMBS = 40, 5

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "deviation_digits string")


@dataclass
class Whitening:
    """Components (rows), largest first, of ``n`` different vectors with ``sums``; roots are eigenvalues of C."""

    n: int
    sums: list[int]
    roots: list[Decimal]
    components: np.ndarray
    trace: int
    largest: int

    def explained(self) -> list[float]:
        return [float(root / self.trace) for root in self.roots]

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(deviations, exact; whitened, one column per component) of whole vectors."""
        wide = 4 * self.n * self.n * max(1, self.largest) ** 2 * max(1, x.shape[1])
        x = x if wide < 2 ** 63 else x.astype(object)
        centred = self.n * x - np.array(self.sums, x.dtype)
        scale = np.array([float(root.sqrt()) for root in self.roots])
        return (centred * centred).sum(axis=1), centred.astype(np.float64) @ self.components.T / scale


def whole(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """((vec_id, x), dimension): x holds floor(256 * entry) as little-endian numbers of the least of 2, 4, 8 bytes.

    Dropped are vectors that are null or empty, hold a null, non-finite or for a long too large entry, or haven't the
    most frequent dimension (of equally frequent ones the smallest). Null and repeated ids stay.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", lambda c: F.coalesce(F.abs(c) < 2.0 ** 63 / SCALE, F.lit(False))))  # NaN is larger
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = size["size"] if size else 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False) * SCALE).astype("<i8").reshape(-1, size)
            most = np.maximum(x.max(axis=1), ~x.min(axis=1))
            out = np.empty(len(x), object)
            for width, least, limit in (("<i2", -1, 2 ** 15), ("<i4", 2 ** 15 - 1, 2 ** 31), ("<i8", 2 ** 31 - 1, 2 ** 64)):
                some = np.flatnonzero((most > least) & (most < limit))
                out[some] = [row.tobytes() for row in x[some].astype(width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.tolist(), pa.binary())], names=["vec_id", "x"])

    return rows.where(F.size("v") == size).mapInArrow(encode, "vec_id long, x binary"), size


def _numbers(column: pa.Array, size: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), size), np.int64)
    widths = np.array([len(v) // size for v in values])
    for width in set(widths.tolist()):
        some = np.flatnonzero(widths == width)
        out[some] = np.frombuffer(b"".join(values[k] for k in some), f"<i{width}").reshape(-1, size)
    return out


def products(x: np.ndarray) -> np.ndarray:
    """X' X in whole numbers of any size: products of 16-bit limbs are exact in doubles up to 2**21 rows."""
    bits = max(int(x.max()), ~int(x.min())).bit_length() + 1
    count = max(1, -(-bits // 16))
    limbs = [((x >> (16 * k)) & 0xFFFF if k < count - 1 else x >> (16 * k)).astype(np.float64) for k in range(count)]
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for j, a in enumerate(limbs):
        for k, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << (16 * (j + k)))
    return total


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray, int]:
    """(n, sums, products, largest absolute entry) of the vectors of ``fit``, exact."""
    upper = np.triu_indices(size)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, largest, sums, total = 0, 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            for lo in range(0, batch.num_rows, 65536):
                x = _numbers(batch.column(0).slice(lo, 65536), size)
                n, largest = n + len(x), max(largest, int(x.max()), -int(x.min()))
                sums, total = sums + x.astype(object).sum(axis=0), total + products(x)
        if n:
            values = [n, *sums.tolist(), *total[upper].tolist()]
            limbs = [[v >> (_LIMB * k) if k == _LIMBS - 1 else (v >> (_LIMB * k)) & ((1 << _LIMB) - 1) for v in values] for k in range(_LIMBS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), *(pa.array(col, pa.int64()) for col in limbs),
                                              pa.array([float(largest)] * len(values))], names=["place", *names, "largest"])

    names = [f"l{k}" for k in range(_LIMBS)]
    parts = fit.select("x").mapInArrow(partial, "place int, " + ", ".join(f"{n} long" for n in names) + ", largest double")
    sums = parts.groupBy("place").agg(*(F.sum(n).alias(n) for n in names), F.max("largest").alias("largest")).collect()
    values = [0] * (1 + size + len(upper[0]))
    for row in sums:
        values[row.place] = sum(row[n] << (_LIMB * k) for k, n in enumerate(names))
    total = np.zeros((size, size), object)
    total[upper] = values[1 + size:]
    total.T[upper] = values[1 + size:]
    return values[0], values[1:1 + size], total, math.ceil(sums[0].largest) if sums else 0


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than ``bits`` bits."""
    def is_prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            y = pow(base, odd, p)
            if y not in (1, p - 1) and all((y := y * y % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, product, p = [], 1, 2 ** 31 - 1
    while product.bit_length() <= bits:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest power first, of det(x * I - matrix) modulo the prime ``p`` < 2**31."""
    h, d = (matrix % p).astype(np.int64), len(matrix)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d]


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients, lowest power first, of det(x * I - matrix) for a positive semidefinite whole matrix."""
    d = len(matrix)
    # The elementary symmetric functions of roots >= 0 are at most those of d equal roots with their sum.
    chosen = primes(((d + int(matrix.trace())) // d + 1).bit_length() * d + 1)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"p": batch.p, "c": [polynomial_modulo(matrix, int(p)).tolist() for p in batch.p]})

    tasks = min(len(chosen), max(1, spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(tasks)
    rows = listed.mapInPandas(reduce, "p long, c array<long>").collect()
    product = math.prod(chosen)
    out = [0] * (d + 1)
    for row in rows:
        rest = product // row.p
        rest *= pow(rest, -1, row.p)
        out = [have + c * rest for have, c in zip(out, row.c)]
    out = [c % product for c in out]
    return [c - product if 2 * c > product else c for c in out]


def roots_beyond(coefficients: list[int], m: int, s: int) -> int:
    """Number of roots above m / 2**s of a polynomial whose roots are all real, each as often as it occurs."""
    d = len(coefficients) - 1
    c = [x << (s * (d - k)) for k, x in enumerate(coefficients)]
    for lo in range(d):
        for k in range(d - 1, lo - 1, -1):
            c[k] += m * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _above(coefficients: list[int], m: int, s: int) -> int:
    """The polynomial's sign at m / 2**s."""
    value, scale = 0, 1
    for c in reversed(coefficients):
        value = value * m + c * scale
        scale <<= s
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], trace: int, count: int) -> list[tuple[int, int, int]]:
    """(m, s, group) for the ``count`` largest positive roots: each root, and those of its group, is m / 2**s to REFINE bits.

    Roots that no 2**-SAME of the trace tells apart share their group.
    """
    positive = roots_beyond(coefficients, 0, 0)
    count = min(count, positive)
    out: list[tuple[int, int, int]] = []
    start = trace.bit_length()
    while len(out) < count:
        before = len(out)  # roots above the interval
        s, lo, hi, above, below = 0, 0, 1 << start, positive, 0
        # ``above`` roots lie beyond lo and ``below`` beyond hi.
        while above - below > 1:
            if hi - lo == 1:
                if s > SAME - start:
                    break
                s, lo, hi = s + 1, 2 * lo, 2 * hi
            middle = (lo + hi) // 2
            beyond = roots_beyond(coefficients, middle, s)
            if beyond > before:
                lo, above = middle, beyond
            else:
                hi, below = middle, beyond
        many = above - before
        right = (-1) ** before  # the sign between the root and those above it
        while s <= REFINE - start or hi - lo > 1:
            if hi - lo == 1:
                s, lo, hi = s + 1, 2 * lo, 2 * hi
            middle = (lo + hi) // 2
            if many == 1:
                is_above = _above(coefficients, middle, s) == right
            else:
                is_above = roots_beyond(coefficients, middle, s) <= before
            lo, hi = (lo, middle) if is_above else (middle, hi)
        out += [(hi, s, before)] * many
    return out[:count]


def null_vectors(matrix: list[list[int]], m: int, s: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors that ``matrix`` stretches by m / 2**s, by inverse iteration."""
    with localcontext() as context:
        context.prec = DIGITS
        root, d = Decimal(m) / Decimal(2 ** s), len(matrix)
        a = np.array([[Decimal(x) for x in row] for row in matrix], object)
        for k in range(d):
            a[k, k] -= root
        tiny = (abs(root) + 1) * Decimal(10) ** -(DIGITS - 5)
        order = np.arange(d)
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            if not a[k, k]:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        rng = np.random.default_rng(17)
        vectors = [np.array([Decimal(int(x)) for x in rng.integers(1, 1000, d)], object) for _ in range(count)]
        for _ in range(4):
            done: list[np.ndarray] = []
            for v in vectors:
                v = v[order]
                for k in range(1, d):
                    v[k] -= a[k, :k] @ v[:k]
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1:] @ v[k + 1:] if k + 1 < d else 0)) / a[k, k]
                v = v / max(map(abs, v))
                for _ in range(2):
                    for u in done:
                        v = v - (u @ v) * u
                    v = v / (v @ v).sqrt()
                done.append(v)
            vectors = done
        return [[float(x) for x in (v if max(v, key=abs) > 0 else -v)] for v in vectors]


def fit(spark: SparkSession, different: DataFrame, size: int, components: int = 4) -> Whitening | None:
    """The whitening of the vectors of ``different`` (column x); None if there is none or all are alike."""
    n, sums, total, largest = scatter(different, size)
    s = np.array(sums, object)
    matrix = n * total - np.outer(s, s)
    trace = int(matrix.trace()) if size else 0
    if trace <= 0:
        return None
    found = largest_roots(polynomial(spark, matrix), trace, components)
    groups = {g: [r for r in found if r[2] == g] for g in dict.fromkeys(r[2] for r in found)}
    listed = [(g, str(rows[0][0]), rows[0][1], len(rows)) for g, rows in groups.items()]
    entries = [list(map(int, row)) for row in matrix]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": b.g, "v": [null_vectors(entries, int(m), int(s), int(c)) for m, s, c in zip(b.m, b.s, b.c)]})

    rows = spark.createDataFrame(listed, "g int, m string, s int, c int").repartition(len(listed)).mapInPandas(solve, "g int, v array<array<double>>")
    vectors = [v for row in sorted(rows.collect(), key=lambda r: r.g) for v in row.v]
    with localcontext() as context:
        context.prec = DIGITS
        return Whitening(n, sums, [Decimal(m) / Decimal(2 ** s) for m, s, _ in found], np.array(vectors), trace, largest)


def _identity_error(different: DataFrame, size: int, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened vectors of ``different``, minus the identity."""
    names = [f"w{k}" for k in range(len(model.roots))]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, w = model.project(_numbers(batch.column(0), size))
                yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in range(len(names))], names=names)

    rows = stage(different.mapInArrow(project, ", ".join(f"{n} double" for n in names)), "whitened")
    mean = rows.agg(*(F.avg(n).alias(n) for n in names)).first()
    centred = {n: F.col(n) - F.lit(mean[n]) for n in names}
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
    cov = rows.agg(*(F.avg(centred[a] * centred[b]) for a, b in pairs)).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(cov, pairs))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits) per usable row and component.

    Usable rows are those of ``whole``; the fit takes each different whole vector once. Only
    components with a positive eigenvalue exist, so vectors of one dimension have one, and
    vectors that are all alike, or an empty table, give an empty result. Where the exact
    deviation doesn't fit a long it is null, and deviation_digits has it. Components of equal
    eigenvalues are some orthonormal basis, the same for all rows.
    """
    spark = vectors.sparkSession
    encoded, size = whole(vectors, vec_id, embedding)
    rows = stage(encoded, "whole-vectors")
    different = stage(rows.select("x").distinct(), "different-vectors")
    model = fit(spark, different, size, components)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    explained, error, count = model.explained(), _identity_error(different, size, model), len(model.roots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            deviation, w = model.project(_numbers(batch.column(1), size))
            exact = [int(x) for x in deviation]
            for k in range(count):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.full(len(w), k + 1, np.int32)), pa.array(np.full(len(w), model.n)),
                    pa.array([x if x < 2 ** 63 else None for x in exact], pa.int64()), pa.array(w[:, k]),
                    pa.array(np.full(len(w), explained[k])), pa.array(np.full(len(w), error)), pa.array(map(str, exact), pa.string())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return rows.mapInArrow(project, SCHEMA)
