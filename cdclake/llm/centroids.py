"""Clustering around centroids with progressive search in Walsh-Hadamard coefficients.

Vectors and centroids are whole numbers, and so are their Walsh-Hadamard transforms.
The transform keeps squared distances up to the factor 64, so the squared differences
of the coefficients, added from the coarsest to the finest, only grow towards 64 times
the distance.  After each step the leading centroid's whole distance is a bound; what
is strictly above it is out, what is left is finished to all 64 coefficients.  The
result is exact, ties included.

A round sends the centroids (16 x 64 numbers) to the tasks and gets exact sums back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.whitening import finite
from cdclake.session import materialized

DIMS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
#: ``floor(SCALE * component)`` beyond these is taken for them; so far every whole number is a double.
LARGEST = 1 << 53
#: Up to this size of components all coefficient sums fit 64 bits; beyond it Python's integers are used.
_SHORT = 1 << 24
_ROWS = 2048
#: Where the steps through the coefficients end.
_STEPS = (1, 2, 4, 8, 16, 32, 64)


def _sequency() -> np.ndarray:
    """The Hadamard rows by their number of sign changes, coarse to fine."""
    h = np.ones((1, 1), int)
    while len(h) < DIMS:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


_ORDER = _sequency()


def transformed(y: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of whole-number rows, coarse to fine."""
    y = y.copy()
    half = 1
    while half < DIMS:
        pairs = y.reshape(len(y), -1, 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(y), DIMS)
        half *= 2
    return y[:, _ORDER]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row, the smaller number on ties, and the squared distance."""
    hv, hc = transformed(vectors), transformed(centroids)
    n, k = len(hv), len(hc)
    each = np.arange(n)
    zero = hv.dtype.type(0) if hv.dtype != object else 0
    partial = np.full((n, k), zero, hv.dtype)
    bound = None
    row, number = (x.ravel() for x in np.indices((n, k)))  # candidates that are left, by row
    begin = 0
    for end in _STEPS:
        difference = hv[row, begin:end] - hc[number, begin:end]
        partial[row, number] += (difference * difference).sum(axis=1)
        begin = end
        if end == DIMS:
            break
        # The leader among those left, of each row; its whole distance is a bound that the best can't exceed.
        value = partial[row, number]
        order = np.lexsort((number, value.astype(float), row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        rest = hv[:, end:] - hc[number[first], end:]
        whole = value[first] + (rest * rest).sum(axis=1)
        bound = whole if bound is None else np.minimum(bound, whole)
        stay = value <= bound[row]
        row, number = row[stay], number[stay]
    best = np.full(n, -1)
    least = np.full(n, zero, hv.dtype)
    for c in range(k - 1, -1, -1):  # the smaller number overwrites on ties
        mine = row[number == c]
        mine = mine[(best[mine] < 0) | (partial[mine, c] <= least[mine])]
        best[mine], least[mine] = c, partial[mine, c]
    assert (best[each] >= 0).all()
    return best, least // DIMS


def whole_rows(vectors: pa.Array, largest_centroid: int = 0) -> np.ndarray:
    """``floor(SCALE * component)`` of lists of 64 finite doubles, as Python integers where sums could pass 64 bits."""
    values = np.clip(np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * float(SCALE)), -LARGEST, LARGEST)
    rows = values.astype(np.int64).reshape(-1, DIMS)
    return rows if max(int(np.abs(rows).max(initial=0)), largest_centroid) <= _SHORT else rows.astype(object)


def _pieces(batches: Iterator[pa.RecordBatch], centroids: list[list[int]], at: int):
    largest = max((abs(x) for c in centroids for x in c), default=0)
    for batch in batches:
        for begin in range(0, batch.num_rows, _ROWS):
            part = batch.slice(begin, _ROWS)
            y = whole_rows(part.column(at), largest)
            yield part, y, *nearest(y, np.array(centroids, y.dtype))


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floors of the means of their vectors, empty ones unchanged."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), DIMS), object), np.zeros(len(centroids), np.int64)
        for _, y, cluster, _ in _pieces(batches, centroids, 0):
            for c in np.unique(cluster):
                sums[c] += y[cluster == c].sum(axis=0).astype(object)
            counts += np.bincount(cluster, minlength=len(centroids))
        cluster, place = (x.ravel() for x in np.indices(sums.shape))
        yield pa.record_batch(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array([Decimal(int(x)) for x in sums.ravel()], pa.decimal128(38, 0)), pa.array(counts[cluster])],
            ["cluster", "place", "total", "n"],
        )

    parts = vectors.select("__vec").mapInArrow(add, "cluster int, place int, total decimal(38,0), n long")
    moved = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        if r["n"]:
            moved[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return moved


def _assigned(vectors: DataFrame, centroids: list[list[int]], id_col: str) -> DataFrame:
    kind = vectors.schema[id_col].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in _pieces(batches, centroids, 1):
            exact = pa.array([Decimal(int(x)) for x in distance], pa.decimal128(38, 0)) if distance.dtype == object else pa.array(distance).cast(pa.decimal128(38, 0))
            yield pa.record_batch([part.column(0), pa.array(cluster, pa.int32()), exact], [id_col, "cluster", "distance"])

    return vectors.select(id_col, "__vec").mapInArrow(apply, f"`{id_col}` {kind}, cluster int, distance decimal(38,0)")


def cluster(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """A row per usable vector: ``id_col``, ``cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Usable are vectors of exactly 64 components, none of them null, NaN or infinite;
    the rest is left out.  Centroids start as the vectors with the smallest SHA-256 of
    ``1:<id>`` (then the smallest components, among rows that repeat an id); rows
    without an id start none.  With fewer vectors than clusters there are as many
    clusters as vectors with an id; without any there are no rows.  Distances and their sums are exact
    decimal(38,0).  Other columns are ignored, rows that repeat are assigned each.
    """
    spark = table.sparkSession
    vec = table[vec_col].cast("array<double>")
    vectors = table.filter(finite(vec) & (F.size(vec) == DIMS)).select(id_col, vec.alias("__vec"))
    mark = F.sha2(F.concat(F.lit("1:"), F.col(id_col).cast("string")), 256)
    starts = vectors.filter(F.col(id_col).isNotNull()).orderBy(mark, "__vec").limit(clusters).select("__vec").collect()
    centroids = [whole_rows(pa.array([r[0]], pa.list_(pa.float64())))[0].tolist() for r in starts]
    if not centroids:
        vectors = vectors.limit(0)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(vectors, centroids)

    assigned = materialized(_assigned(vectors, centroids, id_col), "assigned")
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = [
        (c, Decimal(inertia.get(c, 0)), Decimal(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, centroid in enumerate(centroids)
    ]
    of_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    # One row per cluster, whatever the number of vectors.
    return assigned.join(F.broadcast(of_cluster), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
