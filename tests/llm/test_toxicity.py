import random

import duckdb
import numpy as np
import pytest

from cdclake.llm import queries, toxicity
from tests.llm import plain
from tests.llm.test_operators import documents, sentence


def votes_of(rng, n, accuracies, prior=0.3, copies=0):
    truth = rng.random(n) < prior
    votes = np.zeros((n, len(accuracies)), int)
    for j, (right, speaks) in enumerate(accuracies):
        said = np.where(rng.random(n) < right, truth, ~truth)
        votes[:, j] = np.where(rng.random(n) < speaks, np.where(said, toxicity.TOXIC, toxicity.CLEAN), toxicity.ABSTAIN)
    return truth, np.hstack([votes] + [votes[:, -1:]] * copies)


def test_label_model_recovers_accuracies_and_truth():
    rng = np.random.default_rng(1)
    given = [(0.95, 1.0), (0.9, 0.8), (0.85, 0.9), (0.8, 0.7), (0.75, 0.9), (0.55, 0.9)]
    truth, votes = votes_of(rng, 6000, given)
    model = toxicity.fit_label_model(votes, np.ones(len(votes)))
    assert model.prior == pytest.approx(0.3, abs=0.03)
    assert model.accuracies(votes, np.ones(len(votes))) == pytest.approx([a for a, _ in given], abs=0.04)
    posterior = model.posterior(votes)
    assert ((posterior > 0.5) == truth).mean() > 0.96
    assert posterior[votes.max(axis=1) == 0] == pytest.approx(model.prior)  # silence is no evidence


def test_copies_of_a_poor_voter_do_not_outvote_the_others():
    rng = np.random.default_rng(2)
    truth, votes = votes_of(rng, 6000, [(0.95, 1.0), (0.9, 1.0), (0.85, 1.0), (0.6, 1.0)], copies=8)
    model = toxicity.fit_label_model(votes, np.ones(len(votes)))
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93
    copies = set(range(3, votes.shape[1]))
    chained = sum(i in copies and p in copies for i, p in enumerate(model.parent))
    assert chained == len(copies) - 1


def labelled(n=300, seed=3):
    rng = random.Random(seed)
    insults = [f"blorg{k}" for k in range(6)]
    rows = []
    for i in range(n):
        words, bad = sentence(rng, rng.randrange(10, 60)).split(), i % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxic_texts_are_told_from_clean_ones(spark):
    rows = labelled()
    docs = documents(spark, [r[:2] for r in rows], ["score", "toxic", "place"])
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows[:200]], "doc_id long, toxic int, text string")
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in rows)
    # endings and beginnings: an insult that was never seen
    unseen = toxicity.ToxicityModel.scores(model, ["w1 w2 blorgish w3 w4 w5 w6", "w1 w2 plain w3 w4 w5 w6"])
    assert unseen[0] > 10 * unseen[1]


def test_nulls_repeats_long_texts_and_contradicting_labels(spark):
    rows = labelled(120)
    long = " ".join(w for _, t, _ in rows for w in t.split()) * 40 + " blorg1"
    odd = [(900, None), (901, ""), (902, "!?"), (None, "w1 w2"), (903, rows[0][1]), (903, rows[0][1]), (904, long)]
    docs = documents(spark, [r[:2] for r in rows] + odd)
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(0, 0), (5, None), (None, 1), (900, 0), (903, 1), (903, 1), (7, 3)], "doc_id long, toxic int"
    )
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 for r in got)
    scores = [r.score for r in got if r.doc_id == 903]
    assert scores[0] == scores[1] > 0.3
    again = toxicity.fit_toxicity(docs.repartition(3), labels.repartition(2))
    assert again.lexicons.entries == model.lexicons.entries and np.allclose(again.coefficients, model.coefficients, atol=1e-6)


def test_empty_tables_and_single_labels(spark):
    docs, none = documents(spark, [(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit_toxicity(docs, none), ["doc_id"]).collect()] == [0.5]
    assert toxicity.score(docs.limit(0), toxicity.fit_toxicity(docs.limit(0), none), ["doc_id"]).collect() == []
    only = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit_toxicity(docs, only), ["doc_id"]).first().score < 0.5


def test_the_sample_is_bounded(spark):
    rows = labelled(200)
    docs = documents(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, rows=20)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert np.mean([(got[i] >= 0.3) == bool(y) for i, _, y in rows]) > 0.95


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op13_toxicity"](spark, data).collect()}
    assert len(got) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(r.held_out == (plain.fold(i, 4) == 2) for i, r in got.items())
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{data}/labels.parquet'").fetchall()
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.98
    assert np.mean([p for p, y in held if y]) > 0.9
