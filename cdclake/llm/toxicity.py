"""Toxicity scores by weak supervision.

Many crude voters look at a text: lexicons of words, beginnings and ends of words,
each dealt into parts that may say toxic, one voter per lexicon that says clean where
nothing of it is found, and patterns of shouting, symbols and repetition.  Who says
nothing is no evidence.  A generative model of the votes with a hidden true
label estimates, by expectation maximisation, how often each voter says what under
either truth, given what the voter it depends on most says (a tree of the strongest
correlations); the given labels are one more voter, which may err.  Its posterior
labels train a linear classifier, which scores texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.session import materialized

#: Bounds of the labelled sample: rows of each label, and UTF-8 bytes of a row that may be in it.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1 << 15
#: Kinds of lexicon entries: whole words, and so many first (positive) or last (negative) letters.
KINDS = (0, 3, 4, 5, 6, -3, -4, -5)
#: Entries of a lexicon, the voters it is dealt to, and the toxic rows that an entry needs.
ENTRIES = 90
PARTS = 3
SUPPORT = 3
#: Log odds that an entry has at least, less its standard error.
ODDS = 2.0
#: That a kind's lexicon finds nothing is a vote for clean in texts of so many words.
ENOUGH_WORDS = 5
ROUNDS = 30

ABSTAIN, CLEAN, TOXIC = 0, 1, 2

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARKS = re.compile(r"[!?]")
_SYMBOLS = re.compile(r"[#$%&*@<>|~^=+\\/]")
_UPPER = re.compile(r"[A-Z]")
_LETTERS = re.compile(r"[A-Za-z]")


def grams(words: set[str], kind: int) -> set[str]:
    """Words, or their first or last letters where they have more than these."""
    if kind == 0:
        return words
    if kind > 0:
        return {w[:kind] for w in words if len(w) > kind}
    return {w[kind:] for w in words if len(w) > -kind}


def patterns(text: str, n_words: int, n_distinct: int) -> list[float]:
    """Shares of capitals, exclamation, symbols and repetition."""
    size, letters = max(1, len(text)), len(_LETTERS.findall(text))
    return [
        len(_UPPER.findall(text)) / max(1, letters),
        min(1.0, 20 * len(_MARKS.findall(text)) / size),
        min(1.0, 10 * len(_SYMBOLS.findall(text)) / size),
        1 - n_distinct / max(1, n_words),
    ]


#: From these shares on the patterns' voters say toxic.
PATTERN_BOUNDS = (0.4, 0.3, 0.3, 0.7)


@dataclass
class Seen:
    """What the voters and the classifier see of a text: lexicon entries by kind, pattern shares, number of words."""

    found: list[list[int]]
    shares: list[float]
    n_words: int


@dataclass
class Lexicons:
    entries: list[list[str]] = field(default_factory=lambda: [[] for _ in KINDS])

    def __post_init__(self) -> None:
        self.place = [{e: i for i, e in enumerate(some)} for some in self.entries]

    def see(self, text: str | None) -> Seen:
        text = text or ""
        words = _WORD.findall(text.lower())
        distinct = set(words)
        found = [[at[g] for g in grams(distinct, kind) & at.keys()] for kind, at in zip(KINDS, self.place, strict=True)]
        return Seen(found, patterns(text, len(words), len(distinct)), len(words))

    def votes(self, seen: Seen) -> list[int]:
        said = []
        for found in seen.found:
            parts = {i % PARTS for i in found}
            said += [TOXIC if p in parts else ABSTAIN for p in range(PARTS)]
            said.append(CLEAN if not found and seen.n_words >= ENOUGH_WORDS else ABSTAIN)
        return said + [TOXIC if s >= b else ABSTAIN for s, b in zip(seen.shares, PATTERN_BOUNDS, strict=True)]

    def inputs(self, seen: Seen) -> np.ndarray:
        """The classifier's inputs: a constant, entries found, their numbers by kind, shares, words, emptiness."""
        row = np.zeros(self.width())
        at = 1
        row[0] = 1
        for found, some in zip(seen.found, self.entries, strict=True):
            row[[at + i for i in found]] = 1
            at += len(some)
        tail = [np.log1p(len(found)) for found in seen.found]
        tail += [*seen.shares, np.log1p(seen.n_words) / 10, float(seen.n_words == 0)]
        row[at:] = tail
        return row

    def width(self) -> int:
        return 1 + sum(map(len, self.entries)) + len(KINDS) + len(PATTERN_BOUNDS) + 2


def mine(texts: list[str], labels: list[int]) -> Lexicons:
    """The entries of each kind that speak most for label 1, by the rows they stand in."""
    words = [set(_WORD.findall(t.lower())) for t in texts]
    toxic = [w for w, y in zip(words, labels, strict=True) if y]
    clean = [w for w, y in zip(words, labels, strict=True) if not y]
    entries = []
    for kind in KINDS:
        of_toxic = Counter(g for w in toxic for g in grams(w, kind))
        able = {g for g, n in of_toxic.items() if n >= SUPPORT}
        of_clean = Counter(g for w in clean for g in grams(w, kind) & able)
        worth = []
        for g in able:
            a, b = of_toxic[g] + 0.5, of_clean[g] + 0.5
            odds = np.log(a / (len(toxic) + 1)) - np.log(b / (len(clean) + 1)) - np.sqrt(1 / a + 1 / b)
            if odds >= ODDS:
                worth.append((-odds * of_toxic[g], g))
        entries.append([g for _, g in sorted(worth)[:ENTRIES]])
    return Lexicons(entries)


# ------------------------------------------------------------------ label model


def _counts(votes: np.ndarray, weight: np.ndarray, i: int, j: int) -> np.ndarray:
    """Weighted numbers of rows by the votes of ``i`` and ``j``."""
    return np.bincount(votes[:, i] * 3 + votes[:, j], weight, 9).reshape(3, 3)


def correlations(votes: np.ndarray, posterior: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For every two voters the information that one has of the other beyond the hidden label."""
    m = votes.shape[1]
    shared = np.zeros((m, m))
    total = weight.sum()
    for i in range(m):
        for j in range(i):
            for share in (posterior, 1 - posterior):
                both = _counts(votes, weight * share, i, j) + 1e-3
                alone = both.sum(axis=1, keepdims=True) * both.sum(axis=0, keepdims=True) / both.sum()
                shared[i, j] += (both * np.log(both / alone)).sum() / total
            shared[j, i] = shared[i, j]
    return shared


def _entropy(votes: np.ndarray, weight: np.ndarray) -> float:
    share = np.bincount(votes, weight, 3) / weight.sum()
    return float(-(share * np.log(np.maximum(share, 1e-12))).sum())


def dependency_tree(shared: np.ndarray) -> list[int]:
    """For each voter the one it depends on: a spanning tree of the strongest correlations, rooted at voter 0 (-1)."""
    m = len(shared)
    parent, best = [-1] * m, shared[0].copy()
    nearest, inside = np.zeros(m, int), np.zeros(m, bool)
    inside[0] = True
    for _ in range(m - 1):
        best[inside] = -1
        i = int(best.argmax())
        parent[i], inside[i] = int(nearest[i]), True
        closer = shared[i] > best
        best[closer], nearest[closer] = shared[i][closer], i
    return parent


@dataclass
class LabelModel:
    """``prior`` of label 1, and per voter the chances of its votes by label and the vote of its parent."""

    prior: float
    parent: list[int]
    tables: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.full((len(votes), 2), np.log([1 - self.prior, self.prior]))
        for i, p in enumerate(self.parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            log += np.where(votes[:, i] == ABSTAIN, 0, np.log(self.tables[i][:, given, votes[:, i]])).T
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))

    def accuracies(self, votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each voter is right where it doesn't abstain, under the posterior."""
        q = self.posterior(votes)[:, None]
        right = np.where(votes == TOXIC, q, np.where(votes == CLEAN, 1 - q, 0)) * weight[:, None]
        return right.sum(axis=0) / np.maximum((weight[:, None] * (votes != ABSTAIN)).sum(axis=0), 1e-9)


def fit_label_model(votes: np.ndarray, weight: np.ndarray) -> LabelModel:
    """Expectation maximisation from the majority of the votes; voter 0 is the tree's root.

    In the first majority voters that say the same share one voice, so that many
    copies of a poor voter don't make themselves the truth.
    """
    m = votes.shape[1]
    shared = correlations(votes, np.full(len(votes), 0.5), weight)
    own = np.array([_entropy(votes[:, i], weight) for i in range(m)])
    alike = shared / np.maximum(np.minimum(own[:, None], own[None, :]), 1e-9)
    voice = 1 / (1 + np.clip(alike, 0, 1).sum(axis=1))
    for_toxic, against = (votes == TOXIC) @ voice, (votes == CLEAN) @ voice
    q = (for_toxic + 0.1) / (for_toxic + against + 0.5)
    q = np.where(votes[:, 0] == TOXIC, np.sqrt(q), np.where(votes[:, 0] == CLEAN, q**2, q))
    parent = [-1] * m
    model = LabelModel(0.5, parent, np.full((m, 2, 3, 3), 1 / 3))
    for step in range(ROUNDS):
        if step in (0, 3, 8):
            parent = dependency_tree(correlations(votes, q, weight))
        tables = np.empty((m, 2, 3, 3))
        for i, p in enumerate(parent):
            for y, share in enumerate((1 - q, q)):
                if p < 0:
                    cells = np.tile(np.bincount(votes[:, i], weight * share, 3), (3, 1))
                else:
                    cells = _counts(votes, weight * share, p, i)
                # Votes that were not seen beside the parent's lean on how the voter votes at all.
                alone = np.bincount(votes[:, i], weight * share, 3) + 0.1
                cells = cells + alone / alone.sum()
                tables[i, y] = cells / cells.sum(axis=1, keepdims=True)
        prior = float(np.clip((weight * q).sum() / max(weight.sum(), 1e-9), 1e-4, 1 - 1e-4))
        model = LabelModel(prior, parent, tables)
        before, q = q, model.posterior(votes)
        if step > 8 and np.abs(q - before).max(initial=0) < 1e-6:
            break
    return model


# ------------------------------------------------------------ linear classifier


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 0.3, steps: int = 25) -> np.ndarray:
    """Logistic weights for soft labels by Newton's method."""
    coefficients = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ coefficients)
        gradient = x.T @ (weight * (p - target)) + ridge * coefficients
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        coefficients = coefficients - step
        if np.abs(step).max() < 1e-6:
            break
    return coefficients


@dataclass
class ToxicityModel:
    lexicons: Lexicons
    coefficients: np.ndarray

    def scores(self, texts: list[str | None]) -> list[float]:
        if not texts:
            return []
        return _sigmoid(np.array([self.lexicons.inputs(self.lexicons.see(t)) for t in texts]) @ self.coefficients).tolist()


def fit(texts: list[str], labels: list[int], totals: dict[int, int] | None = None) -> ToxicityModel:
    """A model from labelled texts; ``totals`` are the labels' numbers of rows where the texts are a sample of them."""
    lexicons = mine(texts, labels)
    if not texts:
        return ToxicityModel(lexicons, np.zeros(lexicons.width()))
    seen = [lexicons.see(t) for t in texts]
    y = np.array(labels)
    sampled = {label: max(1, int((y == label).sum())) for label in (0, 1)}
    weight = np.array([(totals or sampled).get(label, 1) / sampled[label] for label in labels])
    weight *= len(y) / weight.sum()
    votes = np.array([[TOXIC if label else CLEAN, *lexicons.votes(s)] for label, s in zip(labels, seen, strict=True)])
    model = fit_label_model(votes, weight)
    x = np.array([lexicons.inputs(s) for s in seen])
    return ToxicityModel(lexicons, _linear(x, model.posterior(votes), weight))


# ------------------------------------------------------------------------ Spark


def _place(column: str) -> Column:
    """A place in [0, 1] that depends on the id alone."""
    return F.pmod(F.xxhash64(F.lit("toxicity"), F.col(column)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from the ``docs`` that ``labels`` (``doc_id, toxic``) marks 0 or 1.

    Documented bound: of each label the ``rows`` documents with the smallest hash
    of their id, ties by text, of at most ``SAMPLE_BYTES`` each.  A document with
    both labels is left out, repeated labels count once, of rows that repeat an id the smallest
    text counts.  Without labels every score is 0.5; where all labels are equal, scores follow them.
    """
    docs = docs.select("doc_id", "text")
    marked = (
        labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__most"))
        .filter("toxic = __most")
        .drop("__most")
    )
    short = F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES
    ids = docs.filter(short & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    able = materialized(ids.join(marked, "doc_id").withColumn("place", _place("doc_id")), "toxic-labelled")
    totals = {r["toxic"]: r["n"] for r in able.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # Places are spread evenly, so a bound on them leaves about 1.2 times the rows wanted, which is what is broadcast.
    bound = F.lit(1.0)
    for label, n in totals.items():
        bound = F.when(F.col("toxic") == label, F.lit(min(1.0, 1.2 * rows / n))).otherwise(bound)
    texts = (
        docs.filter(short)
        .join(F.broadcast(able.filter(F.col("place") <= bound)), "doc_id")
        .groupBy("doc_id", "toxic", "place")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sorted(((r["place"], r["toxic"], r["text"]) for b in batches for r in b.to_pylist()), key=lambda r: (r[0], r[2]))
        seen = [r for label in (0, 1) for r in [x for x in seen if x[1] == label][:rows]]
        model = fit([r[2] for r in seen], [r[1] for r in seen], totals)
        kinds = pa.list_(pa.list_(pa.string()))
        yield pa.record_batch([pa.array([model.lexicons.entries], kinds), pa.array([model.coefficients.tolist()], pa.list_(pa.float64()))], ["entries", "coefficients"])

    row = texts.repartition(1).mapInArrow(train, "entries array<array<string>>, coefficients array<double>").first()
    if row is None:
        return fit([], [])
    return ToxicityModel(Lexicons([list(some) for some in row["entries"]]), np.array(row["coefficients"]))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score``, the probability of label 1, of every whole text.

    Null counts as empty, which has a score too; other columns are ignored and rows
    that repeat are scored each.
    """
    fields = docs.select(*keep).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                scores = model.scores(part.column(len(keep)).to_pylist())
                yield pa.record_batch([*part.columns[:-1], pa.array(scores, pa.float64())], [*keep, "score"])

    return docs.select(*keep, docs[text_col].alias("__text")).mapInArrow(apply, schema)
