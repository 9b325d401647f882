"""Quality scores by compression with dictionaries of good and of bad text.

Two Zstandard dictionaries are built from labelled text.  A document is cut into
blocks, every block is compressed with either dictionary, and the difference of
the sizes over their sum says which text it resembles.  How well a text compresses
without a dictionary is the second figure: endless repetition shrinks to nothing
with any dictionary.  A logistic curve, fitted on labelled rows that are not in
the dictionaries, turns the figures into the probability of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.session import materialized

#: Bounds of the labelled sample: rows of each label, and UTF-8 bytes of a row that may be in it.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1 << 15
DICTIONARY = 112 << 10
BLOCK = 4096
LEVEL = 3


class Sizes:
    """Compressed sizes of texts with either dictionary and without one."""

    def __init__(self, good: bytes, bad: bytes):
        def with_dictionary(content: bytes) -> zstandard.ZstdCompressor:
            if not content:
                return zstandard.ZstdCompressor(level=LEVEL, **plain)
            made = zstandard.ZstdCompressionDict(content)
            made.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_dict_id=False, **plain)

        plain = {"write_content_size": False, "write_checksum": False}
        self.by = [with_dictionary(good), with_dictionary(bad), with_dictionary(b"")]

    def figures(self, text: str | None) -> tuple[float, float, float, float]:
        """Normalised difference (higher: nearer to good), plain size per byte, log of the bytes, is it empty."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return 0.0, 0.0, 0.0, 1.0
        sizes = np.zeros(3)
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            sizes += [len(c.compress(block)) for c in self.by]
        good, bad, alone = sizes
        return (bad - good) / (bad + good), alone / len(data), float(np.log(len(data))), 0.0


def _inputs(figures: np.ndarray) -> np.ndarray:
    """What the curve sees of the figures."""
    difference, ratio, length, empty = figures.T
    full = 1 - empty
    return np.stack(
        [np.ones(len(figures)), 10 * difference, full * (ratio - 0.5) * 4, full * (ratio - 0.5) ** 2 * 16,
         10 * difference * (length - 7), full * (length - 7), full * np.minimum(ratio, 0.25) * 8, empty],
        axis=1,
    )


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method; ``counts`` says how many rows each row stands for."""
    weights = np.zeros(x.shape[1])
    if len(y) == 0:
        return weights
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (p - y)) + penalty * weights
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    weights: np.ndarray

    def scores(self, texts: list[str | None], sizes: Sizes) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = _inputs(np.array([sizes.figures(t) for t in texts]))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the plain text where there is too little to train on."""
    if sum(map(len, texts)) > 8 * DICTIONARY:
        return zstandard.train_dictionary(DICTIONARY, texts, level=LEVEL).as_bytes()
    return b"\n".join(texts)[-DICTIONARY:]


def fit(texts: list[str], labels: list[int], totals: dict[int, int] | None = None) -> QualityModel:
    """A model from labelled texts: of each label, every second builds the dictionary, the rest fit the curve.

    ``totals`` are the labels' numbers of rows where the texts are a sample of them:
    the curve then gives probabilities among all rows, not in the sample.
    """
    parts: dict[int, list[bytes]] = {0: [], 1: []}
    rest_texts, rest_labels = [], []
    for text, label in zip(texts, labels, strict=True):
        if len(parts[label]) <= sum(1 for x in rest_labels if x == label):
            parts[label].append(text.encode("utf-8", "surrogatepass"))
        else:
            rest_texts.append(text)
            rest_labels.append(label)
    good, bad = _dictionary(parts[1]), _dictionary(parts[0])
    sizes = Sizes(good, bad)
    figures = np.array([sizes.figures(t) for t in rest_texts]).reshape(-1, 4)
    y = np.array(rest_labels, float)
    sampled = {label: max(1, labels.count(label)) for label in (0, 1)}
    counts = np.array([(totals or sampled).get(label, 1) / sampled[label] for label in rest_labels])
    return QualityModel(good, bad, _logistic(_inputs(figures), y, counts * len(y) / max(counts.sum(), 1e-9)))


def _place(column: str) -> Column:
    """A place in [0, 1] that depends on the id alone."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 40)) / F.lit(float(1 << 40))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> QualityModel:
    """A model from the ``docs`` that ``labels`` (``doc_id, quality``) marks 0 or 1.

    Documented bound: of each label the ``rows`` documents with the smallest hash
    of their id, of at most ``SAMPLE_BYTES`` each.  A document with both labels is
    left out, repeated labels count once.  Without labels every score is 0.5.
    """
    docs = docs.select("doc_id", "text")
    marked = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("__most"))
        .filter("quality = __most")
        .drop("__most")
    )
    short = F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES
    ids = docs.filter(short & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    able = materialized(ids.join(marked, "doc_id").withColumn("place", _place("doc_id")), "labelled")
    totals = {r["quality"]: r["n"] for r in able.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    # Places are spread evenly, so a bound on them leaves about 1.2 times the rows wanted.
    bound = F.lit(1.0)
    for label, n in totals.items():
        bound = F.when(F.col("quality") == label, F.lit(min(1.0, 1.2 * rows / n))).otherwise(bound)
    texts = (
        docs.filter(short)
        .join(F.broadcast(able.filter(F.col("place") <= bound)), "doc_id")
        .groupBy("doc_id", "quality", "place")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(r["place"], r["quality"], r["text"]) for b in batches for r in b.to_pylist()]
        seen.sort(key=lambda r: (r[0], r[2]))
        seen = [r for label in (0, 1) for r in [x for x in seen if x[1] == label][:rows]]
        model = fit([r[2] for r in seen], [r[1] for r in seen], totals)
        yield pa.record_batch(
            [pa.array([model.good], pa.binary()), pa.array([model.bad], pa.binary()), pa.array([model.weights.tolist()], pa.list_(pa.float64()))],
            ["good", "bad", "weights"],
        )

    row = texts.repartition(1).mapInArrow(train, "good binary, bad binary, weights array<double>").first()
    return QualityModel(bytes(row["good"]), bytes(row["bad"]), np.array(row["weights"])) if row else QualityModel(b"", b"", np.zeros(8))


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score``, the probability of label 1, of every whole text; null is empty."""
    fields = docs.select(*keep).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            texts = batch.column(len(keep))
            for at in range(0, len(texts), 256):
                part = batch.slice(at, 256)
                scores = model.scores(part.column(len(keep)).to_pylist(), sizes)
                yield pa.record_batch([*part.columns[:-1], pa.array(scores, pa.float64())], [*keep, "score"])

    return docs.select(*keep, docs[text_col].alias("__text")).mapInArrow(apply, schema)
