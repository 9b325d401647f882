import random

import corpus_pipeline
from pyspark.sql import functions as F

from cdclake.llm import mixing, queries
from tests.llm import plain
from tests.llm.test_operators import documents, edited, sentence

DATA = "/root/testdata/sf0.001"


def test_stages_and_contract(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mix_sources", "shard"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES if q.startswith("op")}


def test_pipeline_against_plain_stages(spark, tmp_path):
    rng = random.Random(31)
    items = [sentence(rng, 20, 200) for _ in range(4)]
    rows = []
    for i in range(120):
        text = sentence(rng, rng.randrange(5, 80), 5000)
        if i % 10 == 3:
            text += " " + items[i % 4]
        rows.append((i, text, "en" if i % 2 else "de", f"s{i % 3}"))
    rows += [(200 + k, edited(rng, rows[k][1], 1), "en", "s0") for k in range(0, 60, 5) if len(rows[k][1].split()) > 40]
    rows += [(300, None, "en", None), (301, "12 ?!", None, "s1"), (302, "", "de", "s2"), (303, "ok then", None, None), (303, "ok then", None, None)]
    docs = documents(spark, rows, ["shard", "topic", "lang_pred", "digest"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left = {(r[0], r[1]) for r in rows}
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, step, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        got = {(r.doc_id, r.text) for r in out.collect()}
        if name == "language_id":
            left = {(d, t) for d, t in left if t and any(c.isalpha() for c in t)}
        elif name == "near_dedup":
            classes = plain.near_classes(dict(left))
            left = {(d, t) for d, t in left if classes[d] == d}
            assert out.count() == len(left)  # the repeated row went too
        elif name == "decontamination":
            left = {(d, t) for d, t in left if not plain.hits(t, items)[0]}
        elif name == "mix_sources":
            probability = {r.doc_id: r.probability for r in mixing.mix(step).collect()}
            import hashlib

            chance = lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:8], 16) / 2**32
            left = {(d, t) for d, t in left if chance(d) < probability[d]}
            assert 0 < len(left) < len(probability)
        assert got == left, name
        if name != "shard":
            assert out.columns == docs.columns
        step = out
    slots = {}
    for r in step.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.doc_id, r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "some item text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = queries.QUERIES["op4_language_id"](spark, DATA).join(docs.select("doc_id", "lang"), "doc_id")
    right, all_ = found.filter("held_out").agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.95 * all_
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scored = queries.QUERIES["op3_quality"](spark, DATA).join(labels, "doc_id")
    right, all_ = scored.agg(F.count_if(F.col("quality") == F.col("predicted")), F.count("*")).first()
    assert right >= 0.9 * all_


def test_shards_of_all_documents(spark):
    rows = queries.QUERIES["op5_sharding"](spark, DATA).collect()
    counts = {}
    for r in rows:
        counts.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert set(counts) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1


def test_main_texts_are_the_articles(spark):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.QUERIES["op8_html_text"](spark, DATA).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.DOTALL)[1]
        article = re.sub(r"<[^<>]*$", "", article)
        assert r.text.split() == unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert r.n_chars == len(r.text)


def test_model_beats_unigrams(spark):
    rows = [r for r in queries.QUERIES["op10_lm_scoring"](spark, DATA).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
