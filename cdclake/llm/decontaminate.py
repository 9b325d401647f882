"""Benchmark decontamination by winnowing.

Of every window of ``WINDOW`` consecutive k-grams the smallest hash is kept as a
fingerprint.  What is kept depends on the window's words alone, so two texts that
share ``KGRAM + WINDOW - 1`` words in a row share a fingerprint there.  With k-grams of 5
words and windows of 6, that is every run of 10 words.  A document's fingerprints that the
benchmark has too are extended to the runs of 10 words around them, each told by its
hash and its words; these are joined with the benchmark's, so that texts which share a
common fingerprint but no run are never paired.  Shorter items are looked for whole.

The benchmark's side of the join is its different runs, whichever items have them; items
are put to documents at the end, once for every set of runs that documents have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.words import ALPHANUMERIC, Words, gram_hashes, grams_at, pieces
from cdclake.session import materialized

KGRAM = 5
WINDOW = 6
#: The shared run of words that makes a hit.
SPAN = KGRAM + WINDOW - 1
#: Bits of the filters of benchmark fingerprints and runs that every task gets; they spare rows
#: of the join and decide nothing, so their size is fixed whatever the benchmark's.
FILTER_BITS = 1 << 24


def winnowed(words: Words, hashes: np.ndarray) -> np.ndarray:
    """First words of the k-grams that are kept as fingerprints."""
    grams = gram_hashes(hashes, KGRAM)
    n = len(grams) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = words.doc[:n] == words.doc[SPAN - 1 : SPAN - 1 + n]
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    return np.unique((np.arange(n) + view.argmin(axis=1))[whole])


class Filter:
    """A bit for each of the benchmark's marks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def passing(self, marks: np.ndarray) -> np.ndarray:
        low = marks & np.uint64(FILTER_BITS - 1)
        return (self.bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) > 0


def _runs(words: Words, spans: list[int], filters: tuple[Filter, Filter] | None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """First words, hashes and length of the runs around fingerprints, and of those of short items' lengths.

    With ``filters`` of the benchmark's fingerprints and runs only what may be in it.
    """
    hashes = words.hashes()
    kept = winnowed(words, hashes)
    if filters:
        kept = kept[filters[0].passing(gram_hashes(hashes, KGRAM)[kept])]
    at = np.unique((kept[:, None] - np.arange(WINDOW)).ravel())
    at = at[(at >= 0) & (at + SPAN <= len(hashes))]
    at = at[words.doc[at] == words.doc[at + SPAN - 1]] if len(at) else at
    found = [(at, grams_at(hashes, at, SPAN), SPAN)]
    for span in spans:
        n = len(hashes) - span + 1
        whole = np.flatnonzero(words.doc[:n] == words.doc[span - 1 :]) if n > 0 else np.zeros(0, np.int64)
        found.append((whole, gram_hashes(hashes, span)[whole], span))
    for at, marks, span in found:
        if filters:
            ok = filters[1].passing(marks)
            at, marks = at[ok], marks[ok]
        yield at, marks.view(np.int64), span


_RUN = [("pos", pa.int32()), ("span", pa.int32()), ("mark", pa.int64()), ("words", pa.string())]
_RUN_SQL = "pos int, span int, mark long, words string"


def benchmark_runs(items: DataFrame) -> DataFrame:
    """``item_id`` and the runs of ``SPAN`` words of every item, or the one run of a shorter item, with their first words' places."""
    schema = pa.schema([("item_id", pa.string()), *_RUN])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                ids, words = piece.column(0).to_pylist(), Words(piece.column(1), ALPHANUMERIC)
                first = np.cumsum(words.counts) - words.counts
                spans = sorted({int(n) for n in words.counts if 0 < n < SPAN})
                rows = [
                    {"item_id": ids[doc], "pos": p - int(first[doc]), "span": span, "mark": mark, "words": words.text(p, p + span)}
                    for at, marks, span in _runs(words, spans, None)
                    for p, mark, doc in zip(at.tolist(), marks.tolist(), words.doc[at].tolist(), strict=True)
                    if span in (SPAN, words.counts[doc])
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return items.select(F.col("item_id").cast("string"), "text").mapInArrow(mark, f"item_id string, {_RUN_SQL}")


def _benchmark_grams(items: DataFrame) -> DataFrame:
    """``mark`` of the items' fingerprints."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0):
                words = Words(piece.column(0), ALPHANUMERIC)
                hashes = words.hashes()
                kept = gram_hashes(hashes, KGRAM)[winnowed(words, hashes)]
                yield pa.record_batch([pa.array(np.unique(kept).view(np.int64))], ["mark"])

    return items.select("text").mapInArrow(mark, "mark long")


def _filter_of(marks: DataFrame) -> Filter:
    """A bit for each mark; at most ``FILTER_BITS / 64`` numbers come to the driver."""
    low = F.col("mark").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = marks.select(F.shiftright(low, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(mark & 63 as int))").alias("bit"))
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in words.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        bits[row["at"]] = np.int64(row["bits"]).view(np.uint64)
    return Filter(bits)


def _found(docs: DataFrame, items: DataFrame, runs: DataFrame) -> DataFrame:
    """Per document ``row, doc_id, text_mark, n_words`` and the runs in ``found`` that the benchmark may have."""
    spans = sorted(r["span"] for r in runs.filter(F.col("span") < SPAN).select("span").distinct().collect())
    filters = docs.sparkSession.sparkContext.broadcast((_filter_of(_benchmark_grams(items)), _filter_of(runs)))
    fields = pa.list_(pa.struct(_RUN))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                words = Words(piece.column(1), ALPHANUMERIC)
                first = np.cumsum(words.counts) - words.counts
                found: list[list[dict]] = [[] for _ in range(piece.num_rows)]
                for at, marks, span in _runs(words, spans, filters.value):
                    for p, mark, doc in zip(at.tolist(), marks.tolist(), words.doc[at].tolist(), strict=True):
                        found[doc].append({"pos": p - int(first[doc]), "span": span, "mark": mark, "words": words.text(p, p + span)})
                yield pa.record_batch(
                    [piece.column(0), piece.column(2), pa.array(words.counts), pa.array(found, fields)], ["doc_id", "text_mark", "n_words", "found"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    struct = _RUN_SQL.replace(", ", ",").replace(" ", ":")
    scanned = docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(scan, f"doc_id {kind}, text_mark long, n_words long, found array<struct<{struct}>>")
    # Written once: the row's number stays the same however often the table is read.
    return materialized(scanned.withColumn("row", F.monotonically_increasing_id()), "winnowed")


def _hits(found: DataFrame, runs: DataFrame) -> DataFrame:
    """``row, pos, span`` of the documents' runs that the benchmark has, and ``run``, the run's number."""
    mine = found.filter(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    # Equal words: the hash only brings them together. One row for each run of the benchmark.
    return mine.join(runs, ["mark", "span", "words"]).select("row", "pos", "span", "run")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text_mark, n_words, n_hit, items`` (ids as sorted strings).

    A word is hit inside any run of ``SPAN`` words that an item has too, or inside an
    occurrence of a whole shorter item.  Null texts have no words; items without words
    never match; items without an id hit words but are not listed.  Rows that repeat
    stay apart; ``text_mark`` is the text's ``xxhash64``.  Only ``doc_id``, ``text`` and ``item_id``, ``text`` are read.
    """
    rows, sets = _contamination(docs, items)
    return rows.join(sets, "runs_mark", "left").select(
        "doc_id", "text_mark", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def contamination_digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`contamination` with ``n_items`` and ``items_sha256`` (of the ids, comma-joined) in place of the list.

    They are made once for every different set of runs, not once per document.
    """
    rows, sets = _contamination(docs, items)
    digests = sets.select("runs_mark", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    return rows.join(materialized(digests, "digests"), "runs_mark", "left").select(
        "doc_id", "text_mark", "n_words", "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
    )


def _contamination(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document ``runs_mark``, the digest of its set of runs, and per such set the ``items`` with any of them."""
    held = materialized(benchmark_runs(items).select("item_id", "mark", "span", "words").distinct(), "benchmark-runs")
    runs = held.select("mark", "span", "words").distinct().withColumn("run", F.monotonically_increasing_id())
    runs = materialized(runs, "runs")
    found = _found(docs, items, runs)
    hits = _hits(found, runs)
    per_row = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.col("pos").alias("begin"), (F.col("pos") + F.col("span")).alias("end")))).alias("places"),
        F.sort_array(F.collect_set("run")).alias("runs"),
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(acc["to"], r["begin"]))).alias("n"),
            F.greatest(acc["to"], r["end"]).alias("to"),
        ),
    )["n"]
    mark = F.sha2(F.concat_ws(",", F.transform("runs", lambda r: r.cast("string"))), 256)
    per_row = materialized(per_row.select("row", covered.cast("long").alias("n_hit"), "runs", mark.alias("runs_mark")), "hits")

    # Every different set of runs once; a set and an item meet once, however many runs they share.
    different = per_row.groupBy("runs_mark").agg(F.first("runs").alias("runs")).select("runs_mark", F.explode("runs").alias("run"))
    owners = held.filter("item_id IS NOT NULL").join(runs, ["mark", "span", "words"]).select("run", "item_id").distinct()
    sets = different.join(owners, "run").select("runs_mark", "item_id").distinct()
    sets = materialized(sets.groupBy("runs_mark").agg(F.sort_array(F.collect_list("item_id")).alias("items")), "item-sets")
    rows = found.select("row", "doc_id", "text_mark", "n_words").join(per_row.select("row", "n_hit", "runs_mark"), "row", "left")
    return rows.select("doc_id", "text_mark", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "runs_mark"), sets


def uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that share no run of words with an item."""
    hit = _contamination(docs, items)[0].filter("n_hit > 0").select(F.col("doc_id").alias("__hit_doc_id"), F.col("text_mark").alias("__hit_text_mark")).distinct()
    hit = materialized(hit, "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__hit_doc_id"]) & (F.xxhash64(docs["text"]) == hit["__hit_text_mark"]), "left_anti")
