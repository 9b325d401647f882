"""Near-duplicates by dart-throwing MinHash and banding.

A text is the weighted set of its shingles of five words.  Darts are thrown by
hashing at the plane of weight and rank above every shingle, one per unit of area
on average; those below the shingle's weight are the text's.  Each dart belongs to
one coordinate of the signature, which keeps its earliest dart, the one of least
rank.  Two texts agree in a coordinate with a chance equal to their weighted
Jaccard similarity.  The work is proportional to the text, not to text times
coordinates.

Texts that agree in all coordinates of a band meet in a bucket.  In a small bucket
every two are compared; in a large one all are compared with one leader, the most central.  Every link
is verified on the whole shingle sets, and linked texts form classes.  The first bands
link most copies; later ones compare only texts that are in different classes by then.

Where a large bucket's texts stay in different classes (a family of texts that share
much, but less than is asked for), it is deepened: its texts are dealt by more and more
coordinates, in many orders of them, until they share small buckets.  A pair of
similarity s stays together down to depth d in an order with a chance of about s ** d;
with the number of orders that follows from that the pairs to compare grow with the
texts, not with their square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import e, factorial, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.words import ALPHANUMERIC, Words, gram_hashes, mixed, pieces
from cdclake.session import materialized

SHINGLE = 5
#: Similarity from which texts are linked, as a fraction, so that it is compared in whole numbers.
SIMILAR = (4, 5)
#: With 30 bands of 5, a pair of similarity 0.8 shares no bucket with a chance of 7e-6.
BANDS = 30
ROWS = 5
#: Bands that are compared before texts are put into classes for the first time.
FIRST_BANDS = 6
#: Buckets up to this size have all their pairs compared; deepened ones up to the second.
SMALL = 8
DEEP_SMALL = 8
#: Orders of the coordinates in which large buckets are deepened, and the depths that are looked at.
ORDERS = 96
DEPTHS = (8, 10, 12, 15, 19, 24, 32, 40)

_POISSON = np.cumsum([1 / (e * factorial(j)) for j in range(18)])
_UNIT = 2.0**-64
#: Texts that are signed together: however short a text, some thousand cells are looked at.
_SIGNED_ROWS = 512
_ID, _MARK = "__verdict_doc_id", "__verdict_text_mark"


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and multiplicity of every different shingle, sorted by text and shingle.

    A text of fewer than five words is one shingle; one without words has none.
    """
    hashes = words.hashes()
    grams = gram_hashes(hashes, SHINGLE)
    whole = words.doc[: len(grams)] == words.doc[SHINGLE - 1 :] if len(grams) else np.zeros(0, bool)
    doc, shingle = [words.doc[: len(grams)][whole]], [grams[whole]]
    first = np.cumsum(words.counts) - words.counts
    for n in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            doc.append(short)
            shingle.append(gram_hashes(hashes, n)[first[short]])
    doc, shingle = np.concatenate(doc), np.concatenate(shingle)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return doc[at], shingle[at], np.diff(np.append(at, len(doc)))


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """Signatures of ``texts`` weighted sets: for each coordinate the id of its earliest dart.

    The plane above an element is cut into unit cells; a cell's hash says how many
    darts fell into it, and each dart's hash where.  Ranks are searched upwards until
    every coordinate of every set has a dart; empty sets have zeros.
    """
    signature = np.zeros((texts, k), np.uint64)
    total = np.bincount(doc, weight, texts)
    enough = k * log(k) + 2 * k
    ranks = np.ceil(enough / np.maximum(total, 1e-9))  # unit ranks to look at in one go
    lowest = np.zeros(texts)
    open_texts = total > 0
    earliest = np.full((texts, k), np.inf)
    while open_texts.any():
        mine = open_texts[doc]
        columns = np.ceil(weight[mine]).astype(np.int64)
        cells = columns * ranks[doc[mine]].astype(np.int64)
        owner = np.repeat(np.flatnonzero(mine), cells)
        nth = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells)
        column = nth % np.repeat(columns, cells)
        rank = lowest[doc[owner]] + nth // np.repeat(columns, cells)
        cell = mixed(mixed(element[owner] + column.astype(np.uint64)) ^ mixed(rank.astype(np.uint64) + np.uint64(77)))
        number = np.searchsorted(_POISSON, cell * _UNIT, side="right")
        thrown = np.repeat(np.arange(len(cell)), number)
        nth = np.arange(len(thrown)) - np.repeat(np.cumsum(number) - number, number)
        dart = mixed(cell[thrown] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        height = column[thrown] + mixed(dart ^ np.uint64(1)) * _UNIT
        time = rank[thrown] + mixed(dart ^ np.uint64(2)) * _UNIT
        below = height < weight[owner[thrown]]
        dart, time, whose = dart[below], time[below], doc[owner[thrown[below]]]
        place = whose * k + (mixed(dart ^ np.uint64(3)) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, time, place))
        place, dart, time = place[order], dart[order], time[order]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        place, dart, time = place[first], dart[first], time[first]
        free = ~np.isfinite(earliest.ravel()[place])
        earliest.ravel()[place[free]] = time[free]
        signature.ravel()[place[free]] = dart[free]
        lowest += ranks
        open_texts = open_texts & ~np.isfinite(earliest).all(axis=1)
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band of a signature, different for different bands."""
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, np.uint64)
        for r in range(rows):
            key = mixed(key ^ signature[:, b * rows + r]) + np.uint64(b + 1)
        keys[:, b] = key
    return keys.view(np.int64)


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: str = "set",
    bands: int = BANDS,
    rows: int = ROWS,
    small: int = SMALL,
) -> DataFrame:
    """One row per document: ``doc_id, text_mark, class_id, class_size, kept``.

    Texts are linked when their shingles' Jaccard similarity is 0.8 or more; with
    ``weights="count"`` a shingle weighs its multiplicity, with ``"set"`` one.
    ``class_id`` is the smallest id of the linked texts, which stays.  Texts of equal sets are one.
    Texts without words, null ones too, are one class.  Ids may be null or repeat:
    a null id stays only in a class without ids, and rows that repeat an id and its
    text (``text_mark``, its ``xxhash64``) stay or go together.  Other columns are
    ignored; an empty table gives no rows.
    """
    rows_in = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.col(text_col)).alias("mark")
    )
    signed = materialized(_signed(rows_in, weights, bands, rows), "signed")
    nodes = signed.groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("min_id"), F.count("*").alias("n_docs"), F.first("size").alias("size"),
        F.min(F.struct("doc_id", "mark")).alias("sample"), F.first("bands").alias("bands"),
    )
    nodes = materialized(nodes, "nodes")

    met = _met(nodes)
    sets = materialized(_sets(nodes.join(met.select("node").distinct(), "node"), rows_in, weights), "sets")
    links, roots = None, None
    for chosen in (F.col("band") < FIRST_BANDS, F.col("band") >= FIRST_BANDS):
        links, roots = _linked(_meetings(met.filter(chosen), roots, small), sets, links)
    apart = _apart(met.filter(F.col("n") > small), roots)
    if not apart.isEmpty():
        deep = deep_pairs(sets.join(apart, "node"), bands * rows)
        links, roots = _linked(deep, sets, links)
    return _classes(signed, nodes, roots)


def _signed(rows_in: DataFrame, weights: str, bands: int, rows: int) -> DataFrame:
    """``doc_id, mark`` with a row number, the digest and size of the shingle set and the bands' keys."""
    k = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1, rows=_SIGNED_ROWS):
                doc, shingle, count = shingle_sets(Words(piece.column(1), ALPHANUMERIC))
                counted = count if weights == "count" else np.ones(len(doc), np.int64)
                keys = band_keys(dart_signatures(doc, shingle, counted.astype(float), piece.num_rows, k), bands, rows)
                ends = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                digests = [
                    hashlib.blake2b(shingle[a:b].tobytes() + counted[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(ends[:-1], ends[1:], strict=True)
                ]
                size = np.bincount(doc, counted, piece.num_rows).astype(np.int64)
                full = np.diff(ends) > 0
                offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))
                yield pa.record_batch(
                    [piece.column(0), piece.column(2), pa.array(digests, pa.binary()), pa.array(size), lists], ["doc_id", "mark", "digest", "size", "bands"]
                )

    kind = rows_in.schema["doc_id"].dataType.simpleString()
    made = rows_in.mapInArrow(sign, f"doc_id {kind}, mark long, digest binary, size long, bands array<long>")
    return made.withColumn("row", F.monotonically_increasing_id())


def _met(nodes: DataFrame) -> DataFrame:
    """The entries of shared buckets: ``key, band, node, size``, the bucket's number ``n`` and its ``leader``.

    The leader is the node that meets the most others over all bands.  In a family of
    texts that come from one, each with changes of its own, that one agrees with more of
    them than they with each other, so the star around it has the links.
    """
    entries = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    shared = materialized(entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    met = materialized(entries.join(shared, "key"), "entries")
    central = met.groupBy("node").agg(F.sum("n").alias("meets"))
    leaders = met.join(central, "node").groupBy("key").agg(F.max(F.struct("meets", "node", "size")).alias("leader"))
    return materialized(met.join(leaders.select("key", F.struct("leader.node", "leader.size").alias("leader")), "key"), "led-entries")


def _possible(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    up, down = SIMILAR
    return (a * down >= b * up) & (b * down >= a * up)


def _meetings(met: DataFrame, roots: DataFrame | None, small: int) -> DataFrame:
    """Pairs ``a, b`` to compare, each once, of nodes in different classes: all of a small bucket, one per member of a large one."""
    root = F.col("node")
    if roots is not None:
        met = met.join(_root_of("node", roots, "root"), "node", "left")
        root = F.coalesce("root", "node")
    met = met.withColumn("root", root)
    few = met.filter(F.col("n") <= small)
    a, b = (few.select("key", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "size", "root"))) for side in "ab")
    both = a.join(b, "key").filter("a_node < b_node AND a_root <> b_root").filter(_possible(F.col("a_size"), F.col("b_size")))
    stars = met.filter(F.col("n") > small).select(
        F.col("leader.node").alias("a_node"), F.col("leader.size").alias("a_size"),
        F.col("node").alias("b_node"), F.col("size").alias("b_size"), F.col("root").alias("b_root"),
    ).filter("a_node <> b_node").filter(_possible(F.col("a_size"), F.col("b_size")))
    if roots is not None:
        leaders = _root_of("a_node", roots, "a_root")
        stars = stars.join(leaders, "a_node", "left").filter(F.coalesce("a_root", "a_node") != F.col("b_root"))
    pairs = both.select("a_node", "b_node").union(stars.select("a_node", "b_node")).distinct()
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _linked(pairs: DataFrame, sets: DataFrame, links: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The links with those among ``pairs``, and the classes by them."""
    found = materialized(_verified(materialized(pairs, "pairs"), sets), "links")
    if links is not None:
        found = links.unionByName(found)
    return found, components(found)


def _sets(nodes: DataFrame, rows_in: DataFrame, weights: str) -> DataFrame:
    """``node, size`` and the sorted shingles of each node; the n-th of a shingle's occurrences is one of its own by ``count``."""
    wanted = nodes.select("node", "size", F.col("sample.doc_id").alias("sample_id"), F.col("sample.mark").alias("mark"))
    found = rows_in.join(wanted, "mark").filter(F.col("doc_id").eqNullSafe(F.col("sample_id")))
    texts = found.groupBy("node", "size").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                doc, shingle, count = shingle_sets(Words(piece.column(2), ALPHANUMERIC))
                if weights == "count":
                    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    doc, shingle = np.repeat(doc, count), np.repeat(shingle, count)
                    shingle = np.where(nth > 0, mixed(shingle + nth.astype(np.uint64)), shingle)
                    order = np.lexsort((shingle, doc))
                    doc, shingle = doc[order], shingle[order]
                offsets = np.searchsorted(doc, np.arange(piece.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingle.view(np.int64)))
                yield pa.record_batch([*piece.columns[:2], lists], ["node", "size", "shingles"])

    return texts.mapInArrow(cut, "node long, size long, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar, by their whole shingle sets."""
    up, down = SIMILAR

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_lists(batch.column(c)) for c in (2, 3))
            similar = []
            for i in range(batch.num_rows):
                one, other = x[0][x[1][i] : x[1][i + 1]], y[0][y[1][i] : y[1][i + 1]]
                both = len(np.intersect1d(one, other, assume_unique=True))
                similar.append(down * both >= up * (len(one) + len(other) - both))
            yield pa.record_batch(batch.columns[:2], ["a", "b"]).filter(pa.array(similar, pa.bool_()))

    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(compare, "a long, b long")


def _parts(batch: pa.RecordBatch, column: int, limit: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``_SIGNED_ROWS`` rows and ``limit`` shingles, or one row."""
    ends = np.cumsum(np.diff(batch.column(column).offsets.to_numpy()))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = min(max(at + 1, int(np.searchsorted(ends, done + limit, side="right"))), at + _SIGNED_ROWS)
        yield batch.slice(at, stop - at)
        at = stop


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every linked node, the root being the smallest node it is linked to by any way.

    Smallest roots spread along links, and roots are replaced by their own roots, so
    that the rounds grow with the logarithm of a chain.  Each round is a written table.
    """
    both = materialized(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links-both")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).withColumn("root", F.least("node", "root"))
    roots = materialized(roots, "roots")
    while True:
        heard = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard"))
        spread = materialized(
            roots.join(heard, "node").select("node", F.least("root", "heard").alias("root"), F.col("root").alias("before")), "spread"
        )
        above = spread.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = spread.join(above, "root").select("node", F.least("root", "above").alias("root"), "before")
        jumped = materialized(jumped, "roots")
        if jumped.filter("root <> before").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")


def _root_of(column: str, roots: DataFrame, name: str) -> DataFrame:
    return roots.select(F.col("node").alias(column), F.col("root").alias(name))


def _apart(large: DataFrame, roots: DataFrame) -> DataFrame:
    """``node, root`` of large buckets whose members are not all in one class yet."""
    rooted = large.select("key", "node").join(_root_of("node", roots, "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialized(rooted.select("key", "node", "root"), "rooted")
    split = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return materialized(rooted.join(materialized(split.select("key"), "split"), "key").select("node", "root").distinct(), "apart")


def deep_pairs(sets: DataFrame, k: int, small: int = DEEP_SMALL) -> DataFrame:
    """Pairs ``a, b`` of ``node, root, size, shingles`` that share a small enough bucket in some order of the coordinates.

    Each text goes down a tree per order: at each depth it meets the texts that agree
    in as many coordinates.  Buckets of one class, and of one text, end there, small
    ones give their pairs, larger ones go deeper.  What still agrees at the last depth
    is compared with one leader.
    """
    depths = [d for d in DEPTHS if d <= k] or [k]
    orders = np.argsort(np.random.default_rng(64).random((ORDERS, k)), axis=1)[:, : depths[-1]]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 3):
                values, offsets = _lists(part.column(3))
                doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                signature = dart_signatures(doc, values.view(np.uint64), np.ones(len(doc)), part.num_rows, k)
                keys = np.empty((part.num_rows, ORDERS, len(depths)), np.uint64)
                for o in range(ORDERS):
                    key, done = np.full(part.num_rows, o + 1, np.uint64), 0
                    for level, depth in enumerate(depths):
                        for c in orders[o, done:depth]:
                            key = mixed(key ^ signature[:, c]) + np.uint64(o + 1)
                        keys[:, o, level], done = key, depth
                rows = keys.reshape(-1, len(depths)).view(np.int64)
                ends = pa.array(np.arange(0, rows.size + 1, len(depths), dtype=np.int32))
                owner = pa.array(np.repeat(np.arange(part.num_rows), ORDERS))
                yield pa.record_batch([*(part.column(c).take(owner) for c in range(3)), pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))], ["node", "root", "size", "path"])

    paths = sets.select("node", "root", "size", "shingles").mapInArrow(sign, "node long, root long, size long, path array<long>")
    alive = materialized(paths, "paths")
    found = []
    for level in range(len(depths)):
        here = alive.withColumn("key", F.col("path")[level])
        buckets = here.groupBy("key").agg(
            F.count("*").alias("n"), F.min(F.struct("node", "size", "root")).alias("leader"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        met = materialized(here.join(buckets.filter("n > 1 AND low <> high").select("key", "n", "leader"), "key"), "deep")
        few = met.filter(F.col("n") <= small)
        a, b = (few.select("key", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "size", "root"))) for side in "ab")
        found.append(a.join(b, "key").filter("a_node < b_node AND a_root <> b_root").filter(_possible(F.col("a_size"), F.col("b_size"))).select("a_node", "b_node"))
        alive = met.filter(F.col("n") > small).select("node", "root", "size", "path", "leader")
        if alive.isEmpty():
            break
        if level < len(depths) - 1:
            alive = alive.drop("leader")
        else:
            stars = alive.filter("leader.root <> root").filter(_possible(F.col("leader.size"), F.col("size")))
            found.append(stars.select(F.col("leader.node").alias("a_node"), F.col("node").alias("b_node")))
    pairs = reduce(DataFrame.union, found).distinct()
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _classes(signed: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = nodes.select("digest", "node", "min_id", "n_docs").join(roots, "node", "left")
    rooted = materialized(rooted.withColumn("root", F.coalesce("root", "node")), "rooted-nodes")
    of_root = rooted.groupBy("root").agg(F.min("min_id").alias("class_id"), F.sum("n_docs").alias("class_size"))
    classes = rooted.join(materialized(of_root, "root-classes"), "root").select("digest", "class_id", "class_size")
    return (
        signed.select("doc_id", "mark", "digest")
        .join(materialized(classes, "classes"), "digest")
        .select("doc_id", F.col("mark").alias("text_mark"), "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, without near-duplicates: one row of each class."""
    verdicts = materialized(near_classes(docs, id_col, text_col), "verdicts")
    by_row = verdicts.groupBy("doc_id", "text_mark").agg(F.count("*").alias("n"), F.first("kept").alias("kept"))

    def these(rows: DataFrame, how: str) -> DataFrame:
        rows = materialized(rows.select(F.col("doc_id").alias(_ID), F.col("text_mark").alias(_MARK)), "rows")
        same = docs[id_col].eqNullSafe(rows[_ID]) & (F.xxhash64(docs[text_col]) == rows[_MARK])
        # The rows grow with the documents; a broadcast that only small tables get would help none.
        return docs.join(rows.hint("merge"), same, how)

    again = by_row.filter("kept AND n > 1")
    if again.isEmpty():
        return these(by_row.filter("NOT kept"), "left_anti")
    once = these(by_row.filter("NOT kept OR n > 1"), "left_anti")
    repeated = these(again, "left_semi").withColumn(_MARK, F.xxhash64(text_col))
    return once.unionByName(repeated.dropDuplicates([id_col, _MARK]).drop(_MARK))
