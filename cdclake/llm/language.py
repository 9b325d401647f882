"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams.  A document's
own list is compared to each profile by the out-of-place distance: the sum of how
far each of its n-grams stands from its place in the profile, or a fixed penalty
where it is not there.  The nearest profile names the language.

N-grams of one to three characters are taken inside words with one space on either
side; letters are lower-cased, marks count as letters, everything else is a space.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300
UNKNOWN = "und"

_CODES = sys.maxunicode + 1
#: Characters that are looked at in one go; longer texts are taken in pieces that overlap.
_PIECE = 1 << 20
#: Distinct n-grams of a language that a task holds before it hands them on.
_HELD = 1 << 20
#: Characters of a language that are counted together when profiles are fitted.
_JOINED = 1 << 19
#: Runs of this many symbols are counted in tables, if they have at most so many different ones.
_DENSE = 1 << 15
_ALPHABET = 150


@cache
def _kinds() -> np.ndarray:
    """Per code point: 2 for letters, 1 for marks, 0 for the rest."""
    first = (unicodedata.category(chr(c))[0] for c in range(_CODES))
    return np.fromiter((2 if k == "L" else 1 if k == "M" else 0 for k in first), np.int8, _CODES)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams, return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, place, np.concatenate([p[1] for p in parts]))
    return grams, counts


def _run_counts(run: np.ndarray, new: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of the symbols from ``new`` on, whose beginnings may lie before; 0 is the space."""
    start = max(0, new - 2)
    if len(run) < _DENSE:
        one, two = run[new:], run[new - 1 : -1] * _CODES + run[new:]
        a, b, c = run[start:-2], run[start + 1 : -1], run[start + 2 :]
        three = ((a * _CODES + b) * _CODES + c)[b > 0]
        return _counted(np.concatenate([one[one > 0], two + _CODES**3, three + 2 * _CODES**3]))
    # A long run has few different symbols: renumber them and count by place instead of sorting.
    here = np.zeros(_CODES, bool)
    here[run] = here[0] = True
    symbols = np.flatnonzero(here)
    n = len(symbols)
    if n > _ALPHABET:
        half = len(run) // 2
        return _merged([_run_counts(run[:half], new), _run_counts(run[half - 2 :], 2)])
    number = np.zeros(_CODES, np.int32)
    number[symbols] = np.arange(n)
    run = number[run].astype(np.int64)
    one = np.bincount(run[new:], minlength=n)
    one[0] = 0
    two = np.bincount(run[new - 1 : -1] * n + run[new:], minlength=n * n)
    a, b, c = run[start:-2], run[start + 1 : -1], run[start + 2 :]
    three = np.bincount(((a * n + b) * n + c)[b > 0], minlength=n**3)
    at = [np.flatnonzero(x) for x in (one, two, three)]
    grams = [
        symbols[at[0]],
        symbols[at[1] // n] * _CODES + symbols[at[1] % n] + _CODES**3,
        (symbols[at[2] // n**2] * _CODES + symbols[at[2] // n % n]) * _CODES + symbols[at[2] % n] + 2 * _CODES**3,
    ]
    return np.concatenate(grams), np.concatenate([x[i] for x, i in zip((one, two, three), at, strict=True)])


def gram_counts(text: str, piece: int = _PIECE) -> tuple[np.ndarray, np.ndarray] | None:
    """The n-grams of a whole text as sorted numbers, and their counts; None without a letter."""
    kinds, parts, letters = _kinds(), [], False
    tail = np.zeros(1, np.int64)  # the space before the text; then the last two symbols so far
    for at in range(0, len(text), piece):
        end = at + piece >= len(text)
        points = np.frombuffer(text[at : at + piece].lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        kind = kinds[points]
        letters = letters or bool((kind == 2).any())
        symbols = np.where(kind > 0, points, 0)
        if end:
            symbols = np.append(symbols, 0)
        before = np.concatenate([tail[-1:], symbols[:-1]])
        symbols = symbols[(symbols > 0) | (before > 0)]  # one space between words
        run = np.concatenate([tail, symbols])
        parts.append(_run_counts(run, len(tail)))
        tail = run[-2:]
    return _merged(parts) if letters else None


def top_grams(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by number."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Language profiles in the form in which documents are compared to them."""

    def __init__(self, ranked: dict[str, np.ndarray], size: int = PROFILE):
        self.languages = sorted(ranked)
        self.size = size
        self.grams = np.unique(np.concatenate([*ranked.values(), np.zeros(0, np.int64)]))
        self.places = np.full((len(self.grams) + 1, len(ranked)), -1, np.int64)
        for k, language in enumerate(self.languages):
            self.places[np.searchsorted(self.grams, ranked[language]), k] = np.arange(len(ranked[language]))

    def closest(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the closeness to all languages; 0 if close to none."""
        counted = gram_counts(text) if text else None
        if counted is None or not self.languages:
            return UNKNOWN, 0.0
        own = top_grams(*counted, self.size)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        places = self.places[at]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None]))
        near = len(own) * self.size - apart.sum(axis=0)
        best = int(np.argmax(near))
        total = int(near.sum())
        return self.languages[best], float(near[best] / total) if total else 0.0


def fit_profiles(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from every row with a text and a ``lang``.

    Counts cover all rows.  Each task hands on at most ``size`` n-grams per
    language for the ranking, and ``size`` per language come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[str]] = {}
        held: dict[str, list] = {}

        def add(lang: str) -> Iterator[pa.RecordBatch]:
            if (counted := gram_counts("\n".join(waiting.pop(lang)))) is None:
                return
            merged = _merged([*held.pop(lang, []), counted])
            if len(merged[0]) > _HELD:
                yield _gram_rows(lang, *merged)
            else:
                held[lang] = [merged]

        length: dict[str, int] = {}
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1).to_pylist()
            for at, lang in enumerate(langs):
                waiting.setdefault(lang, []).append(text := texts[at].as_py())
                length[lang] = length.get(lang, 0) + len(text)
                if length[lang] > _JOINED:
                    yield from add(lang)
                    length[lang] = 0
        for lang in list(waiting):
            yield from add(lang)
        for lang, mine in held.items():
            yield _gram_rows(lang, *_merged(mine))

    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    ranked: dict[str, list[tuple[int, int]]] = {}
    for row in counts.withColumn("place", place).filter(F.col("place") <= size).collect():
        ranked.setdefault(row["lang"], []).append((row["place"], row["gram"]))
    return Profiles({lang: np.array([g for _, g in sorted(pairs)], np.int64) for lang, pairs in ranked.items()}, size)


def _gram_rows(lang: str, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))), pa.array(grams), pa.array(counts)],
        ["lang", "gram", "n"],
    )


def identify(docs: DataFrame, profiles: Profiles, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, which replace columns of these names.

    ``und`` with score 0 where the text is null or has no letter, or no language
    was learned.  A score of 0 with a language says that no n-gram is in any
    profile; ties go to the first language by name.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema}
    schema = ", ".join([*(f"`{c}` {t}" for c, t in kinds.items()), "lang_pred string", "score double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            found = [profiles.closest(texts[at].as_py()) for at in range(len(texts))]
            columns = [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.record_batch(columns, [*keep, "lang_pred", "score"])

    return docs.select(*keep, docs[text_col].alias("__text")).mapInArrow(predict, schema)


def recognised(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text has a language: a letter, and an n-gram of a profile."""
    at_text = docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (profiles.closest(text.as_py()) for text in batch.column(at_text))
            yield batch.filter(pa.array([lang != UNKNOWN and score > 0 for lang, score in found], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
