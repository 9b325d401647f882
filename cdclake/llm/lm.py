"""Language-model scores from a log-bilinear network trained by noise contrast.

Word counts cover the whole training corpus, and every word of it is modelled in
its context, in two levels.  The first predicts a symbol from the two before it: the
most frequent words are symbols of their own, all others fall into classes by their
endings, each a symbol.  The context's vector is the sum of the two symbols' vectors,
each weighted per dimension and place, and a symbol's energy is its product with the
symbol's own vector plus a bias.  It is trained on the counts of all triples of
symbols of the training corpus, telling them from noise drawn by unigram counts
(noise-contrastive estimation); one batched matrix product then gives normalised
probabilities for every context.

The second level predicts a word within its class.  Every word there has a vector
and a bias of its own, however rare it is; its energy is their product with the
main directions of the vector of the symbol before it, on top of the word's count.
Given these directions, the noise-contrastive estimates of different words do not
depend on each other, so they are made word by word where Spark has put the words,
from the counts of all pairs of word and symbol before, against as much noise as
there is data, in expectation and so without drawing.  Probabilities are normalised
by the energies' sums over all words of a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.words import mixed, pieces
from cdclake.session import materialized

#: Words that are symbols of their own, and classes of the others.  Triples of symbols are at most the sum's cube.
VOCABULARY = 126
CLASSES = 64
DIMENSIONS = 32
STEPS = 2500
BATCH = 1024
NOISE = 64
RATE = 0.02
#: Directions of the vector of a word within its class, the precision of its prior, and rounds of its fit.
DIRECTIONS = 8
PRIOR = 1.0
ROUNDS = 8

#: Words whose counts every task gets; counts of rarer words are joined.  A bound for memory, not for results.
COMMON_WORDS = 200_000
#: Bytes of text that are worked on at once, and distinct words that a task holds before it hands them on.
_PIECE = 1 << 20
_HELD = 250_000
#: Words whose vectors are worked on at once.
_WORDS = 2048
#: The end of a text as a word: no real word is empty.
END_WORD = ""


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (A-Z) words between ASCII white space, and the number of the text of each."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(words, "")
    return words.filter(full), parents.filter(full).to_numpy()


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over every text; the empty word stands for the texts' ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for piece in pieces(batch, 0, limit=_PIECE):
                words, _ = split_words(piece.column(0))
                counted = pc.value_counts(words)
                held.append(pa.table({"word": counted.field(0), "n": counted.field(1)}))
                held.append(pa.table({"word": pa.array([END_WORD]), "n": pa.array([piece.num_rows], pa.int64())}))
                rows += len(counted) + 1
                if rows > 2 * _HELD:
                    held = [_summed(held, ["word"])]
                    if (rows := held[0].num_rows) > _HELD:
                        yield from held.pop().to_batches()
                        rows = 0
        if held:
            yield from _summed(held, ["word"]).to_batches()

    return texts.select(text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    merged = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")])
    return merged.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


def word_classes(words: pa.Array, classes: int) -> np.ndarray:
    """The class of every word, by its last two bytes."""
    ending = np.zeros(len(words), np.uint64)
    if len(words):
        words = words.cast(pa.large_string())
        _, offsets, values = words.buffers()
        bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        for back in (1, 2):
            there = np.diff(bounds) >= back
            ending[there] = ending[there] * np.uint64(256) + data[bounds[1:][there] - back]
    return (mixed(ending) % np.uint64(classes)).astype(np.int64)


@dataclass
class Symbols:
    """The network's symbols: the vocabulary's words by number, then the classes of the rest, the end and the beginning."""

    words: list[str]
    classes: int = 1

    @property
    def rest(self) -> int:
        return len(self.words)

    @property
    def end(self) -> int:
        return len(self.words) + self.classes

    @property
    def begin(self) -> int:
        return self.end + 1

    @property
    def targets(self) -> int:
        return self.end + 1

    @property
    def all(self) -> int:
        return self.end + 2

    def triples(self, words: pa.Array, parents: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Every token with the two symbols before it as one number, and the number of its text."""
        encoded = words.dictionary_encode()
        different = encoded.dictionary
        numbers = pc.fill_null(pc.index_in(different, value_set=pa.array(self.words, pa.string())), -1).to_numpy()
        numbers = np.where(numbers < 0, self.rest + word_classes(different, self.classes), numbers)
        known = numbers[encoded.indices.to_numpy()]
        lengths = np.bincount(parents, minlength=texts)
        first = np.cumsum(lengths + 1) - (lengths + 1)
        symbols = np.full(len(words) + texts, self.end, np.int64)
        symbols[np.arange(len(words)) + parents] = known
        one = np.concatenate([[self.begin], symbols[:-1]])[: len(symbols)]
        one[first] = self.begin
        two = np.concatenate([[self.begin], one[:-1]])[: len(symbols)]
        two[first] = self.begin
        return (two * self.all + one) * self.targets + symbols, np.repeat(np.arange(texts), lengths + 1)


def triple_counts(texts: DataFrame, symbols: Symbols, text_col: str = "text") -> DataFrame:
    """``triple, n`` over every text; at most as many rows as there are triples of symbols."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for piece in pieces(batch, 0, limit=_PIECE):
                words, parents = split_words(piece.column(0))
                at, n = np.unique(symbols.triples(words, parents, piece.num_rows)[0], return_counts=True)
                held.append(pa.table({"triple": at, "n": n}))
                rows += len(at)
                if rows > 2 * _HELD:
                    held = [_summed(held, ["triple"])]
                    if (rows := held[0].num_rows) > _HELD:
                        yield from held.pop().to_batches()
                        rows = 0
        if held:
            yield from _summed(held, ["triple"]).to_batches()

    return texts.select(text_col).mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))


class LogBilinear:
    """The network: vectors of context symbols, of targets, weights of the two places, biases."""

    def __init__(self, symbols: int, targets: int, dimensions: int = DIMENSIONS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.symbols, self.targets, self.rng = symbols, targets, rng
        self.parameters = [
            rng.normal(0, 0.1, (symbols, dimensions)),
            rng.normal(0, 0.1, (targets, dimensions)),
            np.ones((2, dimensions)) * 0.5,
            np.zeros(targets),
        ]

    @classmethod
    def of(cls, symbols: Symbols, parameters: list[np.ndarray]) -> LogBilinear:
        made = cls(symbols.all, symbols.targets)
        made.parameters = parameters
        return made

    def fit(self, triples: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> LogBilinear:
        """Noise-contrastive training on triples drawn as often as they occur."""
        unigram = np.bincount(triples % self.targets, counts, self.targets) + 1.0
        unigram /= unigram.sum()
        self.parameters[3] = np.log(unigram)
        chance, noise_chance = np.cumsum(counts) / counts.sum(), np.cumsum(unigram)
        log_noise = np.log(NOISE * unigram)
        mean = [np.zeros_like(p) for p in self.parameters]
        square = [np.zeros_like(p) for p in self.parameters]
        for step in range(1, steps + 1):
            drawn = triples[np.minimum(np.searchsorted(chance, self.rng.random(BATCH)), len(triples) - 1)]
            noise = np.minimum(np.searchsorted(noise_chance, self.rng.random(NOISE)), self.targets - 1)
            gradients = self._gradients(drawn, noise, log_noise)
            rate = RATE * (1 - 0.9 * step / steps)
            for p, g, m, s in zip(self.parameters, gradients, mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        return self

    def _gradients(self, triples: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> list[np.ndarray]:
        vectors, outputs, weights, biases = self.parameters
        target, context = triples % self.targets, triples // self.targets
        two, one = context // self.symbols, context % self.symbols
        near, far = vectors[one], vectors[two]
        predicted = near * weights[0] + far * weights[1]
        true_energy = (predicted * outputs[target]).sum(1) + biases[target] - log_noise[target]
        noise_energy = predicted @ outputs[noise].T + biases[noise] - log_noise[noise]
        n = len(triples)
        wrong = (1 / (1 + np.exp(np.clip(true_energy, -30, 30))))[:, None] / -n  # towards the true symbols
        taken = 1 / (1 + np.exp(-np.clip(noise_energy, -30, 30))) / n  # away from the noise
        by_predicted = wrong * outputs[target] + taken @ outputs[noise]
        g_vectors, g_outputs, g_biases = np.zeros_like(vectors), np.zeros_like(outputs), np.zeros_like(biases)
        np.add.at(g_outputs, target, wrong * predicted)
        np.add.at(g_outputs, noise, taken.T @ predicted)
        np.add.at(g_biases, target, wrong[:, 0])
        np.add.at(g_biases, noise, taken.sum(0))
        np.add.at(g_vectors, one, by_predicted * weights[0])
        np.add.at(g_vectors, two, by_predicted * weights[1])
        g_weights = np.stack([(by_predicted * near).sum(0), (by_predicted * far).sum(0)])
        return [g_vectors, g_outputs, g_weights, g_biases]

    def log10_table(self) -> np.ndarray:
        """Normalised log10 probabilities by triple number: one matrix product per farther symbol."""
        vectors, outputs, weights, biases = self.parameters
        table = np.empty((self.symbols, self.symbols, self.targets), np.float32)
        for two in range(self.symbols):
            energy = (vectors * weights[0] + vectors[two] * weights[1]) @ outputs.T + biases
            energy -= energy.max(axis=1, keepdims=True)
            table[two] = (energy - np.log(np.exp(energy).sum(axis=1, keepdims=True))) / np.log(10)
        return table.ravel()

    def directions(self, weights: np.ndarray) -> np.ndarray:
        """The main directions of the nearer symbol's vectors, of variance 1 where symbols weigh so, and a constant."""
        vectors, shares = self.parameters[0] * self.parameters[2][0], weights / max(weights.sum(), 1)
        vectors = vectors - shares @ vectors
        values, axes = np.linalg.eigh((vectors * shares[:, None]).T @ vectors)
        main = [k for k in np.argsort(-values)[:DIRECTIONS] if values[k] > 1e-9 * values.max()]
        return np.hstack([np.ones((len(vectors), 1)), vectors @ axes[:, main] / np.sqrt(values[main])])


def word_contexts(texts: DataFrame, symbols: Symbols, text_col: str = "text") -> DataFrame:
    """``word, contexts`` of every word outside the vocabulary: the symbols before it with their numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, keys = [], 0, ["word", "one"]
        for batch in batches:
            for piece in pieces(batch, 0, limit=_PIECE):
                words, parents = split_words(piece.column(0))
                at = symbols.triples(words, parents, piece.num_rows)[0][np.arange(len(words)) + parents]
                others = at % symbols.targets >= symbols.rest
                one = (at[others] // symbols.targets % symbols.all).astype(np.int32)
                counted = pa.table({"word": words.filter(pa.array(others)), "one": one, "n": np.ones(len(one), np.int64)})
                held.append(_summed([counted], keys))
                rows += held[-1].num_rows
                if rows > 2 * _HELD:
                    held = [_summed(held, keys)]
                    if (rows := held[0].num_rows) > _HELD:
                        yield from held.pop().to_batches()
                        rows = 0
        if held:
            yield from _summed(held, keys).to_batches()

    pairs = texts.select(text_col).mapInArrow(count, "word string, one int, n long").repartition("word")
    pairs = pairs.groupBy("word", "one").agg(F.sum("n").alias("n"))
    return pairs.groupBy("word").agg(F.collect_list(F.struct("one", "n")).alias("contexts"))


def contrasted(seen: np.ndarray, noise: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """A vector for each row, which tells the contexts it is seen in from as many of noise; both as counts by symbol."""
    seen, noise, directions = (x.astype(np.float32) for x in (seen, noise, directions))
    both, d = seen + noise, directions.shape[1]
    squares = (directions[:, :, None] * directions[:, None, :]).reshape(len(directions), d * d)
    bound = np.linalg.inv((both @ squares).reshape(-1, d, d) / 4 + PRIOR * np.eye(d, dtype=np.float32))  # of the curvature
    vectors = np.zeros((len(seen), d), np.float32)
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-(vectors @ directions.T)))
        gradient = (seen - both * chance) @ directions - PRIOR * vectors
        vectors += (bound @ gradient[:, :, None])[:, :, 0]
    return vectors


def word_vectors(contexts: DataFrame, before: np.ndarray, directions: np.ndarray, classes: int) -> DataFrame:
    """``word, n, vector`` of every word; ``before`` holds by class how often each symbol stands before its words."""
    shares = (before / np.maximum(before.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    symbols, d = directions.shape

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.full((classes * symbols, d), np.nan, np.float32)  # words of a class seen once, after the same symbol
        for batch in batches:
            for k in range(0, batch.num_rows, _WORDS):
                words, lists = (c.slice(k, _WORDS) for c in batch.columns)
                flat, sizes = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy()
                one, n = (pc.struct_field(flat, j).to_numpy() for j in (0, 1))
                of, first = word_classes(words, classes), np.cumsum(sizes) - sizes
                total = np.add.reduceat(n, first)
                vectors = np.empty((len(words), d), np.float32)
                single = total == 1
                like = of[single] * symbols + one[first[single]]
                new = np.unique(like[np.isnan(once[like, 0])])
                for j in range(0, len(new), _WORDS):
                    part = new[j : j + _WORDS]
                    once[part] = contrasted(np.eye(symbols)[part % symbols], shares[part // symbols], directions)
                vectors[single] = once[like]
                seen = np.zeros((len(words), symbols), np.float32)
                seen[np.repeat(np.arange(len(words)), sizes), one] = n
                noise = total[~single, None] * shares[of[~single]]
                vectors[~single] = contrasted(seen[~single], noise, directions)
                ends = np.arange(len(words) + 1, dtype=np.int32) * d
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))
                yield pa.record_batch([words, pa.array(total), lists], ["word", "n", "vector"])

    return contexts.select("word", "contexts").mapInArrow(fit, "word string, n long, vector array<float>")


def norms(vectors: DataFrame, directions: np.ndarray, classes: int) -> np.ndarray:
    """By class and symbol before, the sum of the energies' exponentials over all words of the class and the unseen one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, len(directions)))
        for batch in batches:
            for k in range(0, batch.num_rows, _WORDS):
                words, n, lists = (c.slice(k, _WORDS) for c in batch.columns)
                own = pc.list_flatten(lists).to_numpy().reshape(len(words), -1).astype(float)
                energies = (n.to_numpy() + 1.0)[:, None] * np.exp(own @ directions.T)
                of = word_classes(words, classes)
                order = np.argsort(of, kind="stable")
                there, first = np.unique(of[order], return_index=True)
                total[there] += np.add.reduceat(energies[order], first)
        of, one = np.nonzero(total)
        yield pa.record_batch([pa.array(of), pa.array(one), pa.array(total[of, one])], ["class", "one", "z"])

    sums = vectors.select("word", "n", "vector").mapInArrow(add, "class long, one long, z double")
    result = np.ones((classes, len(directions)))
    for r in sums.groupBy("class", "one").agg(F.sum("z").alias("z")).collect():
        result[r["class"], r["one"]] += r["z"]
    return result


@dataclass
class Model:
    """What scoring needs; ``words`` is the table of all words outside the vocabulary, the rest is of bounded size."""

    symbols: Symbols
    parameters: list[np.ndarray]
    words: DataFrame
    directions: np.ndarray
    norms: np.ndarray
    common: list[str]
    common_counts: list[int]
    ends: int
    least_common: int
    tokens: int
    distinct: int

    def network(self) -> LogBilinear:
        return LogBilinear.of(self.symbols, self.parameters)


def train(texts: DataFrame, text_col: str = "text") -> Model | None:
    """A model of every text given; None without texts.

    To the driver come the ``COMMON_WORDS`` most frequent words at most, the network's
    parameters and the norms of classes; the network is trained in one task on the counts
    of triples, of which there are at most ``(VOCABULARY + CLASSES + 2) ** 3``.  The vectors
    of words are fitted and kept where the words are.
    """
    counts = materialized(word_counts(texts, text_col), "word-counts")
    scales = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("scale")).agg(F.count("*").alias("words"), F.sum("n").alias("n"))
    by_scale = sorted(((r["scale"], r["words"], r["n"]) for r in scales.collect()), reverse=True)
    if not by_scale:
        return None
    least, words = 2 ** (by_scale[0][0] + 1), 0
    for scale, number, _ in by_scale:
        if words + number > COMMON_WORDS:
            break
        least, words = 2**scale, words + number
    is_end = F.col("word") == END_WORD
    common = [(r["n"], r["word"]) for r in counts.filter((F.col("n") >= least) & ~is_end).collect()]
    common.sort(key=lambda x: (-x[0], x[1]))
    ends = counts.filter(is_end).first()["n"]
    symbols = Symbols([w for _, w in common[:VOCABULARY]], CLASSES)
    triples = materialized(triple_counts(texts, symbols, text_col), "triples")
    parameters = _fitted(triples, symbols)
    before = _before(triples, symbols)
    directions = LogBilinear.of(symbols, parameters).directions(before.sum(axis=0))
    vectors = word_vectors(word_contexts(texts, symbols, text_col), before, directions, symbols.classes)
    vectors = materialized(vectors, "word-vectors")
    return Model(
        symbols, parameters, vectors, directions, norms(vectors, directions, symbols.classes),
        [w for _, w in common], [n for n, _ in common], ends, least,
        sum(n for *_, n in by_scale), sum(number for _, number, _ in by_scale),
    )


def _before(triples: DataFrame, symbols: Symbols) -> np.ndarray:
    """By class, how often each symbol stands before its words."""
    target, one = F.col("triple") % symbols.targets, F.floor(F.col("triple") / symbols.targets) % symbols.all
    pairs = triples.select((target - symbols.rest).alias("class"), one.alias("one"), "n")
    pairs = pairs.filter((F.col("class") >= 0) & (F.col("class") < symbols.classes)).groupBy("class", "one").agg(F.sum("n").alias("n"))
    result = np.zeros((symbols.classes, symbols.all))
    for r in pairs.collect():
        result[r["class"], r["one"]] = r["n"]
    return result


def _fitted(counts: DataFrame, symbols: Symbols) -> list[np.ndarray]:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy().astype(np.int32), b.column(1).to_numpy()) for b in batches]
        triples, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        del parts
        network = LogBilinear(symbols.all, symbols.targets).fit(triples, n)
        flat = [p.ravel().tolist() for p in network.parameters]
        yield pa.record_batch([pa.array([[*range(len(flat))]]), pa.array([flat])], ["place", "parameters"])

    row = counts.repartition(1).sortWithinPartitions("triple").mapInArrow(fit, "place array<long>, parameters array<array<double>>").first()
    shapes = [p.shape for p in LogBilinear(symbols.all, symbols.targets).parameters]
    return [np.array(p).reshape(s) for p, s in zip(row["parameters"], shapes, strict=True)]


def score(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    A null text is an empty one, whose only token is its end.  ``base_score`` is the
    add-one unigram log10 probability; ``score`` is the model's: the network's for a symbol,
    and for a word outside the vocabulary the probability of its class times its own within
    the class after the symbol before it, all unseen words of a class being one word of
    energy 0.  Without a model ``base_score`` is 0 and ``score`` that of an untrained network.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema}
    spark = docs.sparkSession
    if model is None:
        none = spark.createDataFrame([], "word string, n long, vector array<float>")
        model = Model(Symbols([]), LogBilinear(3, 2).parameters, none, np.ones((3, 1)), np.ones((1, 3)), [], [], 0, 1, 0, 0)
    symbols, network, directions = model.symbols, model.network(), model.directions
    log_common = np.log10(np.array([*model.common_counts, 0], float) + 1)
    shared = spark.sparkContext.broadcast((pa.array([*model.common], pa.string()), log_common, _common_vectors(model), np.log10(model.norms)))
    has_end, log_end = model.ends > 0, float(np.log10(model.ends + 1))
    log_total = float(np.log10(model.tokens + model.distinct + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, logs, vectors, log_norms = shared.value
        table = network.log10_table()
        for batch in batches:
            for piece in pieces(batch, len(keep), limit=_PIECE):
                n = piece.num_rows
                words, parents = split_words(piece.column(len(keep)))
                triples, whose = symbols.triples(words, parents, n)
                found = pc.index_in(words, value_set=common)
                missing = pc.is_null(found).to_numpy(zero_copy_only=False)
                at = pc.fill_null(found, len(common)).to_numpy()
                of_words = triples[np.arange(len(words)) + parents]
                one = of_words // symbols.targets % symbols.all
                others = np.flatnonzero(of_words % symbols.targets >= symbols.rest)  # words that have a class
                before, own = one[others], at[others]
                within = logs[own] - log_norms[of_words[others] % symbols.targets - symbols.rest, before]
                for k in range(directions.shape[1]):
                    within += vectors[own, k] * directions[before, k] / np.log(10)
                lengths = np.bincount(parents, minlength=n)
                columns = {
                    "n_tokens": lengths + 1,
                    "n_known": np.bincount(parents, ~missing, n).astype(np.int64) + has_end,
                    "log_counts": np.bincount(parents, logs[at], n) + log_end,
                    "model": np.bincount(whose, table[triples], n) + np.bincount(parents[others], within, n),
                }
                rare = _rare(words.filter(pa.array(missing)), one[missing], parents[missing], n)
                yield pa.record_batch([*piece.columns[:-1], *map(pa.array, columns.values()), rare], [*keep, *columns, "rare"])

    figures = "n_tokens long, n_known long, log_counts double, model double"
    schema = ", ".join([*(f"`{c}` {t}" for c, t in kinds.items()), figures, "rare array<struct<word:string,one:int,n:long>>"])
    scanned = docs.select(*keep, docs[text_col].alias("__text")).mapInArrow(scan, schema)
    scanned = materialized(scanned.withColumn("__row", F.monotonically_increasing_id()), "scored")

    # Words that are not common: their counts and vectors are joined; those that are not there add log10(0 + 1).
    rare = scanned.filter(F.size("rare") > 0).select("__row", F.explode("rare").alias("r")).select("__row", "r.*")
    places = range(directions.shape[1])
    own = model.words.filter(F.col("n") < model.least_common).select(
        "word", F.col("n").alias("count"), *(F.col("vector")[k].cast("double").alias(f"v{k}") for k in places)
    )
    before = spark.createDataFrame(
        [(k, *map(float, row)) for k, row in enumerate(directions)],
        ", ".join(["one int", *(f"d{k} double" for k in places)]),
    )
    energy = sum(F.col(f"v{k}") * F.col(f"d{k}") for k in places) / F.lit(float(np.log(10)))
    per_row = (
        rare.join(own, "word")
        .join(F.broadcast(before), "one")  # a row per symbol
        .groupBy("__row")
        .agg(
            F.sum("n").alias("rare_known"),
            F.sum(F.col("n") * F.log10(F.col("count") + F.lit(1.0))).alias("rare_logs"),
            F.sum(F.col("n") * energy).alias("rare_energy"),
        )
    )
    rare_known, rare_logs, rare_energy = (F.coalesce(c, F.lit(0)) for c in ("rare_known", "rare_logs", "rare_energy"))
    return scanned.join(per_row, "__row", "left").select(
        *keep,
        "n_tokens",
        (F.col("n_known") + rare_known).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + rare_logs - F.col("n_tokens") * F.lit(log_total)).alias("base_score"),
        (F.col("model") + rare_logs + rare_energy).alias("score"),
    )


def _common_vectors(model: Model) -> np.ndarray:
    """The vectors of the common words in their order, zeros for the vocabulary's and a last row for all others."""
    vectors = np.zeros((len(model.common) + 1, model.directions.shape[1]), np.float32)
    found = model.words.filter(F.col("n") >= model.least_common).select("word", "vector").toArrow()
    if found.num_rows:
        at = pc.index_in(found["word"].combine_chunks(), value_set=pa.array(model.common, pa.string())).to_numpy()
        vectors[at] = pc.list_flatten(found["vector"].combine_chunks()).to_numpy().reshape(found.num_rows, -1)
    return vectors


def _rare(words: pa.Array, before: np.ndarray, parents: np.ndarray, texts: int) -> pa.Array:
    """Per text its words by the symbol before them with their numbers, as a list array."""
    kind = pa.list_(pa.struct([("word", pa.string()), ("one", pa.int32()), ("n", pa.int64())]))
    if not len(words):
        return pa.array([[]] * texts, kind)
    counted = pa.table({"text": parents, "word": words, "one": before.astype(np.int32)})
    counted = counted.group_by(["text", "word", "one"]).aggregate([([], "count_all")])
    counted = counted.sort_by("text").combine_chunks()
    ends = np.cumsum(np.bincount(counted["text"].to_numpy(), minlength=texts))
    values = pa.StructArray.from_arrays(
        [counted["word"].chunk(0), counted["one"].chunk(0), counted["count_all"].chunk(0).cast(pa.int64())],
        ["word", "one", "n"],
    )
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)
