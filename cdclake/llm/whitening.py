"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter ``M = n * sum(x xT) - S ST``, which is
``n * n`` times the covariance, is an exact integer matrix.  Its characteristic
polynomial is found modulo many primes, each a Spark row: reduce to Hessenberg form,
run the recurrence, and combine the residues by Chinese remaindering.  All its roots
are real, so the sign changes of the polynomial moved to ``a`` count the roots above
``a`` exactly; bisection isolates every wanted root, again one Spark row each, and
inverse iteration in long decimals gives the null space at it.

What is collected is bounded by the number of entries of a vector, never by rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: ``floor(SCALE * entry)`` beyond these is taken for them; so far every whole number is a double.
LARGEST = 1 << 53
#: Bits to which roots are bisected, relative to the trace; closer roots are one of higher multiplicity.
ROOT_BITS = 256
#: Digits of inverse iteration.
DIGITS = 110
#: Rows whose products are added at once: sums of 2**13 products of 20-bit limbs are exact doubles.
_ROWS = 1 << 13
_LIMB = 20
_HALF = 62


def finite(column: Column) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    return column.isNotNull() & F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def whole_matrix(vectors: pa.Array, dims: int | None = None) -> np.ndarray:
    """``floor(SCALE * entry)`` of lists of finite doubles as rows; missing last entries are 0."""
    lengths = np.diff(vectors.offsets.to_numpy())
    dims = int(lengths.max(initial=0)) if dims is None else dims
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * float(SCALE))
    values = np.clip(values, -LARGEST, LARGEST).astype(np.int64)
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    matrix = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    matrix[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return matrix


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of at most ``_ROWS`` rows, exactly, as Python integers."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 1 << 53:
        plain = y.astype(float)
        return (plain.T @ plain).astype(np.int64).astype(object)
    limbs = [((y >> (_LIMB * k)) & ((1 << _LIMB) - 1) if k < 2 else y >> (_LIMB * k)).astype(float) for k in range(3)]
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            total += (left.T @ right).astype(np.int64).astype(object) << (_LIMB * (a + b))
    return total


def scatter(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums of entries and ``n * sum(y yT) - S ST`` of a column ``__vec``, ``y`` being ``x - SHIFT``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(0, object), np.zeros((0, 0), object)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                y = whole_matrix(batch.column(0).slice(at, _ROWS))
                d = y.shape[1]
                if d > len(sums):  # Python integers throughout: they never overflow
                    had, sums, squares = (sums, squares), np.zeros(d, object), np.zeros((d, d), object)
                    sums[: len(had[0])], squares[: len(had[0]), : len(had[0])] = had
                n += len(y)
                sums[:d] += y.astype(object).sum(axis=0) if np.abs(y).max(initial=0) > 1 << 49 else y.sum(axis=0).astype(object)
                squares[:d, :d] += products(y)
        cells = [(-1, -1, n)] + [(-1, j, int(s)) for j, s in enumerate(sums)]
        cells += [(i, j, int(squares[i, j])) for i in range(len(sums)) for j in range(i, len(sums))]
        exact = pa.decimal128(38, 0)
        yield pa.record_batch(
            [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
             pa.array([Decimal(c[2] >> _HALF) for c in cells], exact), pa.array([Decimal(c[2] & ((1 << _HALF) - 1)) for c in cells], exact)],
            ["i", "j", "high", "low"],
        )

    cells = vectors.select("__vec").mapInArrow(add, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = {(r["i"], r["j"]): (int(r["high"]) << _HALF) + int(r["low"]) for r in cells.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n = found.get((-1, -1), 0)
    d = sum(1 for i, j in found if i == -1) - 1
    sums = [found[-1, j] for j in range(d)]
    return n, sums, [[n * found[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]


# ------------------------------------------------------- characteristic polynomial


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31, until their product exceeds ``bound``."""

    def is_prime(p: int) -> bool:  # these bases decide all numbers below 3,215,031,751
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    found, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(candidate):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo ``p`` with zeros below its first subdiagonal."""
    a = a.copy()
    d = len(a)
    for j in range(d - 2):
        below = np.flatnonzero(a[j + 1 :, j])
        if not len(below):
            continue
        pivot = j + 1 + int(below[0])
        if pivot != j + 1:
            a[[j + 1, pivot]] = a[[pivot, j + 1]]
            a[:, [j + 1, pivot]] = a[:, [pivot, j + 1]]
        factors = a[j + 2 :, j] * pow(int(a[j + 1, j]), -1, p) % p
        a[j + 2 :] = (a[j + 2 :] - factors[:, None] * a[j + 1]) % p
        a[:, j + 1] = (a[:, j + 1] + (a[:, j + 2 :] * factors % p).sum(axis=1)) % p
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of ``det(x - a)`` modulo ``p``, constant first."""
    h = hessenberg(a, p)
    d = len(h)
    leading = np.zeros((d + 1, d + 1), np.int64)  # row k: the polynomial of the first k rows and columns
    leading[0, 0] = 1
    for k in range(d):
        weights = np.empty(k + 1, np.int64)  # of leading[i]: h[i, k] times the subdiagonal from i to k
        run = 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * run % p
            run = run * int(h[i, i - 1]) % p if i else run
        moved = np.roll(leading[k], 1)
        leading[k + 1] = (moved - (weights[:, None] * leading[: k + 1] % p).sum(axis=0)) % p
    return leading[d]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of ``det(x - m)``, constant first, of an integer matrix without negative eigenvalues.

    No coefficient exceeds the product of ``1 + m[i][i]``, so primes beyond twice that determine them.
    """
    bound = 1
    for i in range(len(m)):
        bound *= 1 + m[i][i]
    primes = primes_beyond(2 * bound)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = batch.column(0).to_pylist()
            residues = [polynomial_modulo(np.array([[c % p for c in row] for row in m], np.int64), p).tolist() for p in mine]
            yield pa.record_batch([batch.column(0), pa.array(residues, pa.list_(pa.int64()))], ["prime", "residues"])

    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    modulus = 1
    for p in primes:
        modulus *= p
    total = [0] * (len(m) + 1)
    for prime, residues in rows.mapInArrow(reduce, "prime long, residues array<long>").collect():
        rest = modulus // prime
        unit = rest * pow(rest, -1, prime)
        total = [(t + r * unit) % modulus for t, r in zip(total, residues, strict=True)]
    return [t - modulus if 2 * t > modulus else t for t in total]


# ------------------------------------------------------------- roots and vectors


def roots_above(coefficients: list[int], a: int) -> int:
    """How many roots are greater than ``a``, counted with multiplicity, of a polynomial with real roots only."""
    moved = list(coefficients)
    for i in range(len(moved) - 1):
        for j in range(len(moved) - 2, i - 1, -1):
            moved[j] += a * moved[j + 1]
    signs = [c > 0 for c in moved if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def isolated_root(coefficients: list[int], nth: int, top: int) -> tuple[int, int, int]:
    """``root, first, multiplicity`` of the ``nth`` greatest root, which is in ``(root - 1, root]``.

    Roots between the same whole numbers are one; ``first`` is the place of the
    greatest of them.  ``top`` is a whole number that no root exceeds.
    """
    low, high = -1, top
    above_low, above_high = len(coefficients) - 1, 0
    while high - low > 1 and above_low - above_high > 1:
        middle = (low + high) // 2
        above = roots_above(coefficients, middle)
        if above >= nth:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    if high - low > 1:  # one simple root: from here on signs tell
        def sign(x: int) -> int:
            value = 0
            for c in reversed(coefficients):
                value = value * x + c
            return (value > 0) - (value < 0)

        beyond = 1 if above_high % 2 == 0 else -1  # the sign just above the root
        while high - low > 1:
            middle = (low + high) // 2
            if sign(middle) in (0, beyond):
                high = middle
            else:
                low = middle
    return high, above_high + 1, above_low - above_high


def _solved(lower: list[list[Decimal]], order: list[int], right: list[Decimal]) -> list[Decimal]:
    d = len(order)
    x = [right[i] for i in order]
    for i in range(d):
        row = lower[i]
        x[i] -= sum((row[k] * x[k] for k in range(i) if row[k]), Decimal(0))
    for i in range(d - 1, -1, -1):
        row = lower[i]
        x[i] = (x[i] - sum((row[k] * x[k] for k in range(i + 1, d)), Decimal(0))) / row[i]
    return x


def null_space(m: list[list[int]], root: Decimal, size: int) -> list[list[Decimal]]:
    """An orthonormal basis of the ``size`` eigenvectors of ``m`` at ``root``, by inverse iteration."""
    d = len(m)
    a = [[Decimal(c) for c in row] for row in m]
    for i in range(d):
        a[i][i] -= root
    norm = max(abs(c) for row in a for c in row) or Decimal(1)
    order = list(range(d))
    for j in range(d):  # both triangles in place, the greatest pivot of each column
        pivot = max(range(j, d), key=lambda i: abs(a[i][j]))
        a[j], a[pivot], order[j], order[pivot] = a[pivot], a[j], order[pivot], order[j]
        if abs(a[j][j]) < norm.scaleb(-DIGITS):
            a[j][j] = norm.scaleb(-DIGITS)
        tail = a[j][j + 1 :]
        for i in range(j + 1, d):
            if a[i][j]:
                factor = a[i][j] = a[i][j] / a[j][j]
                a[i][j + 1 :] = [x - factor * y for x, y in zip(a[i][j + 1 :], tail, strict=True)]

    def orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
        done: list[list[Decimal]] = []
        for v in vectors:
            for _ in range(2):
                for u in done:
                    along = sum(x * y for x, y in zip(u, v, strict=True))
                    v = [x - along * y for x, y in zip(v, u, strict=True)]
                length = sum(x * x for x in v).sqrt()
                v = [x / length for x in v]
            done.append(v)
        return done

    draw = np.random.default_rng(11)
    basis = [[Decimal(int(x)) for x in draw.integers(-(10**6), 10**6, d) * 2 + 1] for _ in range(size)]
    for _ in range(3):
        basis = orthonormal([_solved(a, order, v) for v in basis])
    return basis


def component(m: list[list[int]], coefficients: list[int], nth: int) -> tuple[Decimal, list[float]]:
    """The ``nth`` greatest eigenvalue of ``m`` and its unit eigenvector, the entry of greatest size positive."""
    trace = sum(m[i][i] for i in range(len(m)))
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << (bits * (len(m) - k)) for k, c in enumerate(coefficients)]
    root, first, multiplicity = isolated_root(scaled, nth, trace << bits)
    with localcontext(Context(prec=DIGITS)):
        value = Decimal(root) / (1 << bits)
        vector = null_space(m, value, multiplicity)[nth - first]
        lead = max(range(len(vector)), key=lambda i: (abs(vector[i]), -i))
        sign = 1 if vector[lead] > 0 else -1
        return value, [float(sign * x) for x in vector]


# ------------------------------------------------------------------- whitening


@dataclass
class Whitening:
    """``n`` rows, sums of ``x - SHIFT``, and of every component its unit vector, eigenvalue and share of the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centre(self) -> tuple[list[int], np.ndarray]:
        """The mean of every entry as a whole number and what remains over ``n``."""
        whole = [s // self.n for s in self.sums]
        return whole, np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole, strict=True)])

    def project(self, y: np.ndarray) -> np.ndarray:
        whole, rest = self.centre()
        return ((y - np.array(whole, np.int64)).astype(float) - rest) @ self.vectors.T / np.sqrt(self.eigenvalues)

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """The sum of ``(n * x - S) ** 2`` over the entries, as Python integers."""
        whole = [s // self.n for s in self.sums]
        rest = [s - self.n * w for s, w in zip(self.sums, whole, strict=True)]
        off = y - np.array(whole, np.int64)
        largest, d = int(np.abs(off).max(initial=0)), max(1, y.shape[1])
        wide = off if largest * max(largest, self.n) * d < 1 << 62 else off.astype(object)
        squares, mixed = (wide * wide).sum(axis=1), (wide * np.array(rest, wide.dtype)).sum(axis=1)
        return self.n * self.n * squares.astype(object) - 2 * self.n * mixed.astype(object) + sum(r * r for r in rest)


def _vectors(table: DataFrame, vec_col: str, keep: list[str]) -> DataFrame:
    vec = table[vec_col].cast("array<double>")
    return table.filter(finite(vec)).select(*keep, vec.alias("__vec"))


def fit(table: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The components of all usable vectors; None where there is none.

    Vectors that are null or hold a null, NaN or infinity are not used.  Of vectors
    of different lengths the shorter ones have 0 for their missing entries.  Only
    components with an eigenvalue above 0 exist, so equal vectors have none.
    """
    spark = table.sparkSession
    n, sums, m = scatter(_vectors(table, vec_col, []))
    if n == 0:
        return None
    trace = sum(m[i][i] for i in range(len(m)))
    coefficients = characteristic_polynomial(spark, m) if trace else [0] * len(m) + [1]
    wanted = min(components, roots_above(coefficients, 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in batch.column(0).to_pylist():
                value, vector = component(m, coefficients, nth)
                with localcontext(Context(prec=DIGITS)):
                    facts = [float(value / n / n), float(value / trace)]
                yield pa.record_batch([pa.array([nth]), *(pa.array([f]) for f in facts), pa.array([vector], pa.list_(pa.float64()))], ["nth", "e", "share", "vector"])

    numbers = spark.range(1, wanted + 1, 1, max(1, wanted))
    found = sorted(numbers.mapInArrow(solve, "nth long, e double, share double, vector array<double>").collect()) if wanted else []
    vectors = np.array([r["vector"] for r in found]).reshape(len(found), len(m))
    return Whitening(n, sums, vectors, np.array([r["e"] for r in found]), np.array([r["share"] for r in found]))


def identity_error(table: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k = len(model.eigenvalues)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.project(whole_matrix(batch.column(0), len(model.sums)))
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "total"])

    rows = _vectors(table, vec_col, []).mapInArrow(add, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    total = np.zeros((k + 1, k))
    for i, j, value in rows.collect():
        total[i, j] = value / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def _written(model: Whitening, keep: list[str], batch: pa.RecordBatch) -> pa.RecordBatch:
    y = whole_matrix(batch.column(len(keep)), len(model.sums))
    k = len(model.eigenvalues)
    rows = pa.array(np.repeat(np.arange(len(y)), k))
    fits = 10**38
    deviations = pa.array([Decimal(v) if v < fits else None for v in model.deviations(y)], pa.decimal128(38, 0))
    return pa.record_batch(
        [*(batch.column(i).take(rows) for i in range(len(keep))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
         deviations.take(rows), pa.array(model.project(y).ravel()), pa.array(np.tile(model.explained, len(y)))],
        [*keep, "component", "deviation", "whitened", "explained"],
    )


def whiten(table: DataFrame, model: Whitening | None, keep: list[str], vec_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component: ``keep``, ``component, deviation, whitened, explained``.

    ``deviation`` is exact as decimal(38,0), null beyond that.  Other columns are
    ignored, rows that repeat are written each; null ids stay null; without usable
    vectors, or where these are all equal, there are no rows.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*keep).schema)
    schema = f"{fields}, component int, deviation decimal(38,0), whitened double, explained double"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None and len(model.eigenvalues):
            yield from map(partial(_written, model, keep), batches)

    return _vectors(table, vec_col, keep).mapInArrow(apply, schema)
