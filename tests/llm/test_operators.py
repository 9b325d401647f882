import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdclake.llm import decontaminate, exact_dedup, html_text, language, lm, minhash, mixing, quality, sharding, warc, words
from tests.llm import plain

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """Documents from (id, text) or (id, text, lang, source), with more columns whose names clash with the operators' own."""
    full = [(*r, *((None, None)[: max(0, 4 - len(r))]), None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in extra:
        df = df.withColumn(name, F.lit("theirs"))
    return df


def sentence(rng, n=40, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ------------------------------------------------------------- 1 mixing


def test_raking_meets_the_targets(spark):
    rng = random.Random(1)
    rows = [(s, lg, t, rng.randrange(50, 5000)) for s in "abc" for lg in ("x", "y", None) for t in ("p", "q")]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}}
    fitted = mixing.rake(cells, targets=targets).collect()
    for dim, shares in (("source", targets["source"]), ("lang", None), ("topic", None)):
        got, seen = Counter(), Counter()
        for r in fitted:
            got[r[dim]] += r.weight
            seen[r[dim]] += r.tokens
        if shares is None:
            tempered = {k: v ** mixing.TEMPER[dim] for k, v in seen.items()}
            shares = {k: v / sum(tempered.values()) for k, v in tempered.items()}
        for k, share in shares.items():
            assert got[k] == pytest.approx(share, abs=1e-3)


def marginals(rows, dim, value):
    got = Counter()
    for r in rows:
        got[r[dim]] += value(r)
    return got


def tempered(rows, dim):
    powers = {k: v ** mixing.TEMPER[dim] for k, v in marginals(rows, dim, lambda r: r.tokens).items()}
    return {k: v / sum(powers.values()) for k, v in powers.items()}


def test_raking_goes_on_until_nearly_monolingual_sources_fit(spark):
    langs = ("x", "y", "z", "w")
    rows = [(f"s{k}", lg, "p", (200_000 if k == 0 else 10_000) if lg == langs[k % 4] else 3 + k) for k in range(20) for lg in langs]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    fitted = mixing.rake(cells).collect()
    for dim in mixing.DIMENSIONS:
        got = marginals(fitted, dim, lambda r: r.weight)
        for k, share in tempered(fitted, dim).items():
            assert got[k] == pytest.approx(share, rel=1e-3)


def test_raking_tells_of_targets_that_contradict_each_other(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10), ("b", "y", "p", 10)], "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="contradict"):
        mixing.rake(cells, targets={"source": {"a": 0.9, "b": 0.1}}).collect()


def test_probabilities_meet_the_budget_and_stay_below_one(spark):
    rows = [("a", None, "p", 10), ("b", None, "p", 1000), ("c", None, "p", 5000), ("d", None, "p", 70)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    for keep in (0.1, 0.5, 1.0):
        got = mixing.bounded(mixing.rake(cells), keep).collect()
        assert all(0 <= r.probability <= 1 + 1e-12 for r in got)
        assert sum(r.tokens * r.probability for r in got) == pytest.approx(keep * 6080, rel=1e-6)
        free = {r.source: r.probability * r.tokens / r.weight for r in got if 0 < r.probability < 1 - 1e-9}
        assert max(free.values(), default=1) == pytest.approx(min(free.values(), default=1), rel=1e-6)


def test_small_probabilities_are_not_rounded_away(spark):
    rows = [("a", "x", "p", 10**9), ("b", "x", "p", 10**9)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    got = mixing.bounded(mixing.rake(cells), 1e-9).collect()
    assert all(r.probability == pytest.approx(1e-9, rel=1e-6) for r in got)


def test_slow_raking_goes_on_and_is_not_called_a_contradiction(spark, recwarn):
    # Nearly block-diagonal: sources and languages hang together by few tokens, so sweeps come nearer slowly.
    rows = [("a", "x", "p", 1000), ("b", "y", "p", 1000), ("a", "y", "p", 1), ("b", "x", "p", 1)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.52, "b": 0.48}}
    got = mixing.rake(cells, targets=targets).collect()
    assert not [w for w in recwarn if "contradict" in str(w.message)]
    by_source = marginals(got, "source", lambda r: r.weight)
    assert by_source["a"] == pytest.approx(0.52, abs=1e-4)
    assert marginals(got, "lang", lambda r: r.weight)["x"] == pytest.approx(0.5, abs=1e-4)


def test_expected_marginals_of_the_documents(spark):
    """At sf0.01 the sample's expected tokens have the target share of every source, language and topic, as far as in reach."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).collect()
    total = sum(r.tokens for r in got)
    for dim in mixing.DIMENSIONS:
        reached = reachable(got, dim)
        for k, n in marginals(got, dim, lambda r: r.tokens * r.probability).items():
            assert n / (mixing.KEEP * total) == pytest.approx(reached[k], rel=1e-3)


def reachable(rows, dim):
    """Target shares; where a value's tokens are too few all of them, and the others raised in proportion."""
    seen, wanted = marginals(rows, dim, lambda r: r.tokens), tempered(rows, dim)
    most = {k: n / (mixing.KEEP * sum(seen.values())) for k, n in seen.items()}
    whole = set()
    while True:
        factor = (1 - sum(most[k] for k in whole)) / sum(wanted[k] for k in seen if k not in whole)
        more = {k for k in seen if k not in whole and factor * wanted[k] >= most[k]}
        if not more:
            return {k: most[k] if k in whole else factor * wanted[k] for k in seen}
        whole |= more


def test_expected_tokens_of_the_sample_have_the_target_marginals(spark):
    rng = random.Random(3)
    rows = [(f"s{k}", lg, t, rng.randrange(50, 500) * n) for k in range(6) for lg in ("x", "y", None) for t, n in (("p", 100), ("q", 5), ("r", 1))]
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * 8) + (" | " if t == "q" else " @ " if t == "r" else ""), lg, s) for s, lg, t, n in rows for i in range(n // 50 + 1)],
        "doc_id long, text string, lang string, source string",
    )
    with pytest.warns(UserWarning, match="topic contact can have"):
        got = mixing.mix(docs).collect()
    assert any(r.probability == 1 for r in got) and all(0 <= r.probability <= 1 for r in got)
    total = sum(r.tokens for r in got)
    for dim in mixing.DIMENSIONS:
        reached = reachable(got, dim)
        for k, n in marginals(got, dim, lambda r: r.tokens * r.probability).items():
            assert n / (mixing.KEEP * total) == pytest.approx(reached[k], rel=1e-3)


def test_mixing_keeps_every_row_and_column(spark):
    rows = [(1, "a b | c", "x", "s"), (2, None, None, None), (None, "", "x", "s"), (2, "mail me @ home", "x", None), (2, "mail me @ home", "x", None)]
    docs = documents(spark, rows, ["topic", "tokens", "n", "ratio"])
    got = mixing.mix(docs).collect()
    assert len(got) == 5
    assert {(r.tokens, r.topic) for r in got} == {(5, "table"), (1, "prose"), (5, "contact")}
    kept = mixing.sample(docs, keep=1.0)
    assert kept.columns == docs.columns and kept.filter("topic = 'theirs'").count() == kept.count()
    assert mixing.sample(documents(spark, [])).count() == 0


# -------------------------------------------------------- 2 exact dedup


def plain_exact(rows):
    groups = {}
    for doc_id, text in rows:
        t = text or ""
        groups.setdefault("".join(c for c in t if c not in exact_dedup.WHITE_SPACE), []).append((doc_id, t))
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(d, best, len(members), d == best, sha) for d, _ in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    rng = random.Random(2)
    texts = ["", " \t\n\x0b\x0c\r", "é a", "éa", "x y", "xy", *("ab" * n for n in range(6)), "same text"]
    rows = [(i if i % 17 else -i, rng.choice(texts)) for i in range(200)] + [(None, "ab"), (None, "only mine"), (7, None), (7, None)]
    rows += [(1000 + i, "hot  text" if i % 2 else "hot text ") for i in range(300)]
    digest = (lambda c: F.substring(F.sha2(c, 256), 1, 1)) if weak else exact_dedup.sha256
    got = exact_dedup.exact_groups(documents(spark, rows, ["digest", "salt", "rank", "content"]), salts=4, digest=digest)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_exact(rows)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0


def test_extreme_ids(spark):
    rows = [(2**63 - 1, "a"), (-(2**63), "a"), (0, "a"), (2**63 - 1, "b"), (None, "b")]
    got = exact_dedup.exact_groups(documents(spark, rows)).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(2**63 - 1, -(2**63)), (-(2**63), -(2**63)), (0, -(2**63)), (2**63 - 1, 2**63 - 1), (None, 2**63 - 1)}


# ----------------------------------------------------------- 3 quality


def test_quality_separates_what_it_learned(spark):
    rng = random.Random(3)
    good = [sentence(rng, 60) for _ in range(120)]
    bad = [" | ".join(sentence(rng, 60).upper().split()) for _ in range(60)]
    rows = [*enumerate(good + bad), (900, None), (901, ""), (902, "x" * 300_000)]
    docs = documents(spark, rows, ["score", "quality", "place"])
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(180)] + [(3, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model, ["doc_id"]).collect()}
    assert len(got) == 183 and all(0 <= s <= 1 for s in got.values())
    right = sum((got[i] >= 0.5) == (i < 120) for i in range(180))
    assert right >= 176
    again = quality.fit_quality(docs.repartition(3), labels)
    assert again.good == model.good and again.bad == model.bad


def test_quality_without_labels(spark):
    docs = documents(spark, [(1, "a b c"), (2, None)])
    model = quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, model, ["doc_id"]).collect()} == {0.5}
    assert quality.score(documents(spark, []), model, ["doc_id"]).count() == 0


# ---------------------------------------------------------- 4 language


def plain_grams(text):
    kinds = language._kinds()
    text = "".join(c if kinds[ord(c)] else " " for c in text.lower())
    text = " " + " ".join(text.split(" ")).strip() + " "
    while "  " in text:
        text = text.replace("  ", " ")
    found = Counter()
    for i in range(len(text)):
        for n in (1, 2, 3):
            gram = text[i : i + n]
            if len(gram) == n and gram != " " and " " not in gram[1:-1]:
                found[gram] += 1
    return found


def gram_text(code):
    size, code = divmod(int(code), language._CODES**3)
    parts = [code // language._CODES**k % language._CODES for k in range(size, -1, -1)]
    return "".join(chr(p) if p else " " for p in parts)


@pytest.mark.parametrize("piece", [5, 1 << 20])
@pytest.mark.parametrize("text", ["Straße, déjà-vu! 3 a", "a", "ÀÉ ﬁ ǅ हिन्दी", "x" * 40, "the cat sat " * 4000, "".join(chr(0x4E00 + i % 400) for i in range(40_000))])
def test_grams_of_whole_texts(text, piece):
    if piece == 5 and len(text) > 1000:
        piece = 999
    grams, counts = language.gram_counts(text, piece)
    assert {gram_text(g): int(n) for g, n in zip(grams, counts)} == dict(plain_grams(text))


def test_distance_is_out_of_place():
    ranked = {"aa": language.top_grams(*language.gram_counts("abc abd abe")), "bb": language.top_grams(*language.gram_counts("xyz xyw xyv"))}
    profiles = language.Profiles(ranked)
    text = "abd xy"
    own = language.top_grams(*language.gram_counts(text)).tolist()
    near = {}
    for name, grams in ranked.items():
        places = {g: i for i, g in enumerate(grams.tolist())}
        near[name] = sum(language.PROFILE - abs(places[g] - i) for i, g in enumerate(own) if g in places)
    best = max(sorted(near), key=near.get)
    assert profiles.closest(text) == (best, pytest.approx(near[best] / sum(near.values())))
    assert profiles.closest("qq") == ("aa", 0.0) and profiles.closest("12 ?!") == ("und", 0.0) and profiles.closest(None) == ("und", 0.0)


def test_language_of_documents(spark):
    rng = random.Random(4)
    one, two = "the quick brown fox jumps over lazy dogs".split(), "der schnelle braune fuchs springt über faule hunde".split()
    rows = []
    for i in range(120):
        pool, lang = ((one, "en"), (two, "de"))[i % 2]
        rows.append((i, " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 30))), lang, "s"))
    rows += [(500, None, "en", None), (501, "", None, None), (502, "123", "de", None), (503, "the dogs", None, None), (503, "the dogs", None, None)]
    docs = documents(spark, rows, ["lang_pred", "score", "gram"])
    profiles = language.fit_profiles(docs)
    assert profiles.languages == ["de", "en"]
    got = language.identify(docs, profiles, docs.columns).collect()
    assert len(got) == 125 and len(got[0]) == len(docs.columns)
    assert sum(r.lang == r.lang_pred for r in got if r.doc_id < 120) >= 118
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id >= 500} == {500: "und", 501: "und", 502: "und", 503: "en"}
    stay = language.recognised(docs, profiles)
    assert stay.columns == docs.columns and stay.count() == 122
    nothing = language.fit_profiles(documents(spark, []))
    assert {r.lang_pred for r in language.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}


# ---------------------------------------------------------- 5 sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 4097])
def test_permutation(spark, n):
    place = sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), seed=5)
    got = [r.p for r in spark.range(n).select(place.alias("p")).collect()]
    assert sorted(got) == list(range(n))
    if n > 50:
        assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < n / 10
        other = [r.p for r in spark.range(n).select(sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), seed=6).alias("p")).collect()]
        assert other != got


def test_permutation_against_plain_feistel(spark):
    import struct

    import xxhash

    def hashed(*values):
        seed = 42
        for v, size in values:
            seed = xxhash.xxh64(struct.pack("<q" if size == 8 else "<i", v), seed=seed).intdigest()
        return seed - 2**64 if seed >= 2**63 else seed

    def network(x, a, b, seed):
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + hashed((seed, 4), (i, 4), (right, 8)) % a) % a
            else:
                right = (right + hashed((seed, 4), (i, 4), (left, 8)) % b) % b
        return left * b + right

    n = 1000
    a = math.ceil(math.sqrt(n))
    b = -(-n // a)
    want = []
    for x in range(n):
        x = network(x, a, b, 9)
        while x >= n:
            x = network(x, a, b, 9)
        want.append(x)
    got = spark.range(n).select(sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), seed=9).alias("p")).collect()
    assert [r.p for r in got] == want


def test_shards(spark):
    rows = [(i % 90 if i % 7 else None, f"t{i % 50}") for i in range(203)]
    docs = documents(spark, rows, ["shard", "position", "__extra"])
    got = sharding.shard_rows(docs, 8, ["doc_id", "text"]).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.shard == r.position % 8 and r.slot == r.position // 8
    assert len(got) == 203 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_rows(docs.repartition(7), 8, ["doc_id", "text"]).collect()
    key = lambda r: (str(r.doc_id), r.text, r.shard, r.slot)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert sharding.shard_rows(documents(spark, []), 8, ["doc_id"]).count() == 0


# ------------------------------------------------------- 6 near dedup


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("small", [1, 8])
def test_near_classes(spark, small):
    rng = random.Random(6)
    passage = sentence(rng, 60)
    texts = [sentence(rng, rng.randrange(1, 120)) for _ in range(40)]
    base = sentence(rng, 150)
    texts += [edited(rng, base, 2) for _ in range(30)]
    texts += [f"{sentence(rng, 12)} {passage} {sentence(rng, 6)}" for _ in range(30)]  # share much, but less than 0.8
    chain = sentence(rng, 100)
    for _ in range(6):
        texts.append(chain)
        chain = edited(rng, chain, 1)
    texts += [None, "", "?!", "one two", "One, two!", "one two three", base.upper(), base]
    rows = list(enumerate(texts))
    docs = documents(spark, rows, ["digest", "node", "mark", "bands", "row", "kept"])
    got = minhash.near_classes(docs, small=small).collect()
    want = plain.near_classes(dict(rows))
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def family(rng, n, changes, words=200):
    base = sentence(rng, words, 10**6)
    return [edited(rng, base, changes) for _ in range(n)]


def compared(monkeypatch):
    """A list that gets the number of pairs of every comparison."""
    counts, verified = [], minhash._verified

    def counting(pairs, sets):
        counts.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(minhash, "_verified", counting)
    return counts


def similar_pairs(texts):
    sets = [plain.shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for k in range(i):
            both = len(a & sets[k])
            if 5 * both >= 4 * (len(a) + len(sets[k]) - both):
                yield k, i


def test_families_below_the_bound_are_not_compared_in_all_pairs(spark, monkeypatch):
    counts, totals = compared(monkeypatch), {}
    for n in (500, 1000):
        rng = random.Random(40)
        texts = family(rng, n, 4)
        counts.clear()
        got = {r.doc_id: r.class_id for r in minhash.near_classes(documents(spark, list(enumerate(texts)))).collect()}
        totals[n] = sum(counts)
        links = list(similar_pairs(texts)) if n == 500 else []
        # The few links there are lie just above 0.8, among texts that are all 0.66 alike.
        assert sum(got[a] == got[b] for a, b in links) >= 0.9 * len(links)
    assert totals[1000] <= 2.2 * totals[500]
    assert totals[1000] < 1000 * 999 / 2 / 8


def test_copies_inside_a_family_are_found(spark):
    """Recall of links just above 0.8 and above 0.9 among many texts that are all about 0.66 alike."""
    rng = random.Random(41)
    texts = family(rng, 500, 4)
    rows = list(enumerate(texts + [edited(rng, t, 1 if i % 2 else 4) for i, t in enumerate(texts[:200])]))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(documents(spark, rows)).collect()}
    found, wanted = Counter(), Counter()
    for i in range(200):
        a, b = plain.shingles(rows[i][1]), plain.shingles(rows[500 + i][1])
        similarity = len(a & b) / len(a | b)
        if similarity >= 0.8:
            wanted[similarity >= 0.9] += 1
            found[similarity >= 0.9] += got[i] == got[500 + i]
    assert wanted[True] > 80 and wanted[False] > 80
    assert found[True] >= 0.99 * wanted[True] and found[False] >= 0.9 * wanted[False]


def test_texts_in_one_class_send_no_more_pairs(spark, monkeypatch):
    counts = compared(monkeypatch)
    rng = random.Random(42)
    rows = list(enumerate(family(rng, 600, 1)))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(documents(spark, rows)).collect()}
    assert set(got.values()) == {0}
    assert counts[0] <= 6 * 600 and sum(counts[1:]) <= 600


def test_recall_against_brute_force_on_documents(spark):
    """Links of similarity 0.8 or more among all documents of sf0.01 that are in one class, by similarity."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: plain.shingles(r.text) for r in docs.collect()}
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs).collect()}
    holders = {}
    for k, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(k)
    shared = Counter((a, b) for ks in holders.values() for i, a in enumerate(ks) for b in ks[i + 1 :])
    found, wanted = Counter(), Counter()
    for (a, b), both in shared.items():
        if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            band = int(20 * both / (len(sets[a]) + len(sets[b]) - both)) / 20
            wanted[band] += 1
            found[band] += got[a] == got[b]
    assert sum(wanted.values()) > 50
    assert all(found[band] >= 0.9 * n for band, n in wanted.items())
    for k, c in got.items():
        assert k == c or 5 * max(len(sets[k] & sets[o]) / max(1, len(sets[k] | sets[o])) for o in sets if o != k and got[o] == c) >= 4 or not sets[k]


def test_near_duplicates_go_and_rows_stay_as_they_are(spark):
    rng = random.Random(7)
    base = sentence(rng, 90)
    rows = [(5, base, "x", "s"), (3, edited(rng, base, 1), "x", "s"), (9, sentence(rng, 30), None, None), (9, "another text altogether with words", None, None)]
    rows += [(3, rows[1][1], "x", "s"), (None, sentence(rng, 20), None, None), (None, base + " more", None, None)]
    docs = documents(spark, rows, ["digest", "__mark", "text_mark"])
    got = minhash.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((r[0] or 0, r[1]) for r in (rows[1], rows[2], rows[3], rows[5]))
    assert minhash.deduplicated(documents(spark, [])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(8)
    elements = rng.integers(0, 2**63, 300).astype(np.uint64)
    x, y = rng.uniform(0.2, 4, 300), rng.uniform(0.2, 4, 300)
    x[:40], y[40:80] = 0, 0
    truth = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    doc = np.repeat([0, 1], 300)
    weight = np.concatenate([x, y])
    full = weight > 0
    s = minhash.dart_signatures(doc[full], np.tile(elements, 2)[full], weight[full], 2, 4000)
    assert (s[0] == s[1]).mean() == pytest.approx(truth, abs=0.04)
    alone = minhash.dart_signatures(doc[full & (doc == 1)] - 1, np.tile(elements, 2)[full & (doc == 1)], weight[full & (doc == 1)], 1, 4000)
    assert (alone[0] == s[1]).all()


def test_count_weights_tell_repetition(spark):
    rng = random.Random(9)
    line, tail = sentence(rng, 20), sentence(rng, 20)
    rows = [(1, f"{line} {tail}"), (2, " ".join([line] * 12) + " " + tail), (3, " ".join([line] * 13) + " " + tail)]
    by_count = {r.doc_id: r.class_id for r in minhash.near_classes(documents(spark, rows), weights="count").collect()}
    assert by_count == {1: 1, 2: 2, 3: 2}


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select((F.col("id") * 7 % 201).alias("a"), ((F.col("id") + 1) * 7 % 201).alias("b"))
    got = minhash.components(links).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


# ----------------------------------------------------- 7 decontamination


def test_contamination_against_every_window(spark):
    rng = random.Random(10)
    items = [sentence(rng, n, 300) for n in (10, 14, 25, 60, 3, 1, 5, 9)] + ["", None, "?!"]
    items.append(items[2])
    texts = [None, "", sentence(rng, 200)]
    for _ in range(150):
        parts = [sentence(rng, rng.randrange(0, 30), 300)]
        for _ in range(rng.randrange(0, 4)):
            w = (rng.choice(items[:4]) or "").split()
            i = rng.randrange(len(w))
            parts += [" ".join(w[i : i + rng.randrange(5, 20)]), sentence(rng, rng.randrange(0, 15), 300)]
        if rng.random() < 0.2:
            parts.append(rng.choice(items[4:8]))
        texts.append("; ".join(parts).upper() if rng.random() < 0.3 else ", ".join(parts))
    docs = documents(spark, list(enumerate(texts)), ["n_hit", "row", "found"])
    bench = spark.createDataFrame([(100 + k, t, "z") for k, t in enumerate(items)], "item_id long, text string, mark string")
    got = {r.doc_id: (r.n_words, r.n_hit, set(r["items"])) for r in decontaminate.contamination(docs, bench).collect()}
    for k, t in enumerate(texts):
        n, found = plain.hits(t, items)
        assert got[k] == (len(plain.words(t)), n, {str(100 + i) for i in found}), k
    clean = decontaminate.uncontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {k for k, v in got.items() if v[1] == 0}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, nothing).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(documents(spark, []), bench).count() == 0


def test_repeated_rows_and_ids_stay_apart(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = documents(spark, [(1, item), (1, "clean text"), (None, item), (1, item)])
    bench = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench).collect())
    assert got == [("1", 0, []), ("1", 11, ["1"]), ("1", 11, ["1"]), ("None", 11, ["1"])]


def test_a_common_phrase_below_the_span_pairs_nothing(spark, monkeypatch):
    """Nine common words in every item and document: no run is shared, and nothing is joined or put forward."""
    joined, hits = {}, decontaminate._hits
    rng = random.Random(12)
    phrase = sentence(rng, 9)

    def counting(found, runs):
        out = hits(found, runs)
        joined[found.count()] = (out.count(), found.select(F.sum(F.size("found"))).first()[0])
        return out

    monkeypatch.setattr(decontaminate, "_hits", counting)
    for n in (300, 600):
        texts = [f"{sentence(rng, 12, 10**6)} {phrase} {sentence(rng, 12, 10**6)}" for _ in range(2 * n)]
        bench = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:n])], "item_id long, text string")
        got = decontaminate.contamination(documents(spark, list(enumerate(texts[n:]))), bench).collect()
        assert not any(r.n_hit for r in got)
    assert joined[300][0] == joined[600][0] == 0
    assert joined[600][1] <= 10


def test_a_passage_of_many_items_and_documents_is_joined_once_per_document(spark, monkeypatch):
    rng = random.Random(13)
    passage, hits, joined = sentence(rng, 12), decontaminate._hits, []

    def counting(found, runs):
        out = hits(found, runs)
        joined.append(out.count())
        return out

    monkeypatch.setattr(decontaminate, "_hits", counting)
    items = [(k, f"{sentence(rng, 8, 10**6)} {passage}") for k in range(200)]
    docs = [(k, f"{sentence(rng, 20, 10**6)} {passage}") for k in range(100)]
    got = decontaminate.contamination(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert joined == [3 * 100]  # a passage of 12 words has three runs of ten
    assert all(r.n_hit == 12 and r["items"] == sorted(str(k) for k in range(200)) for r in got)


def test_hits_in_a_very_long_text(spark):
    rng = random.Random(14)
    item = sentence(rng, 30)
    text = " ".join(sentence(rng, 50, 10**6) for _ in range(6000)) + f" {item} end"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contamination(documents(spark, [(1, text), (2, text + " " + item)]), bench).collect()
    assert sorted((r.n_words, r.n_hit, r["items"]) for r in got) == [(300_031, 30, ["1"]), (300_061, 60, ["1"])]


# ------------------------------------------------------------ 8 html


def test_main_text():
    long = "This paragraph says a good deal about one thing and goes on about it for a while, as texts do."
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body>
    <nav><ul><li><a href="/">Home</a></li><li><a href="/b">More</a></li></ul></nav><script>if (a<b) "</p>{long}"</script>
    <div class="ad-box"><p>Buy this. {long}</p></div><div class="cookie notice">We use cookies.</div>
    <article><h1>A &amp; B&nbsp;title</h1><p>{long}<br>Next <b>bold</b>ly &#233;&lt;.</p><p>Short.<p>{long}
    <form><label>Name</label><button>Send</button></form><aside>{long}</aside></article>
    <section id="comments"><article><p>I agree. {long}</p></article></section><footer>&copy; x</footer><p"""
    got = html_text.main_text(page).split("\n\n")
    assert got == ["A & B title", f"{long} Next boldly é<.", "Short.", long]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>x", "</div></div>", "&#xD800;", "<p>" * 5000, "<div " + "a='" * 2000])
def test_odd_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_text_without_markup_hints_is_kept_by_length():
    long = "Plain words that fill a line and then some more words to make it a paragraph of a usual length here."
    page = f"<div><a href=a>x</a> <a href=b>y</a></div><div>{long}</div><div>{long}</div><div><a href=c>z</a></div>"
    assert html_text.main_text(page) == f"{long}\n\n{long}"


@pytest.mark.parametrize(
    "hidden",
    [
        """<script>var s="<!--";</script>""", "<style>/* <!-- */</style >", "<title>a <!-- b</title>", "<SCRIPT>'<p'</Script\n>",
        "<datalist id=d><option value=a><option value=b></datalist>", "<div><option>a<option>b</div>", "<select><option>a<option>b</select>",
        "<div><video src=v><p>No video</div>", "<object><object><p>x</object>y</object>", "<template><script>'</template>'</script>y</template>",
        "<svg><title>t</title><path d=''/></svg>", "<p><select><option>a</p>",
    ],
)
def test_text_after_hidden_elements_stays(hidden):
    long = "This paragraph says a good deal about one thing and goes on about it for a while, as texts do."
    assert html_text.main_text(f"<body>{hidden}<article><p>{long}</p></article><!-- end --></body>") == long


@pytest.mark.parametrize(
    "wrapper",
    [
        "div class='content has-sidebar'", "div class='page with-header'", "article class='post category-ads'",
        "div class='post hentry comments-open'", "article class='post share'", "div id=no-comments", "main class=comments",
        "div class=widget",
    ],
)
def test_classes_of_wrappers_do_not_drop_the_article(wrapper):
    long = " ".join(["This paragraph says a good deal about one thing and goes on about it for a while, as texts do."] * 5)
    page = f"<body><nav><a href=a>x</a></nav><{wrapper}><p>{long}</p><p>{long}</p></{wrapper.split()[0]}></body>"
    assert html_text.main_text(page) == f"{long}\n\n{long}"


def test_an_article_in_a_page_open_for_comments():
    assert html_text.main_text("<div class='hentry comments-open'><article><p>Few words.</p></article></div>") == "Few words."


@pytest.mark.parametrize("wrapper", ["nav", "div role=navigation", "div class='comment-list'", "footer", "aside class=post"])
def test_text_around_stays_out(wrapper):
    long = " ".join(["This paragraph says a good deal about one thing and goes on about it for a while, as texts do."] * 5)
    assert html_text.main_text(f"<{wrapper}><p>{long}</p></{wrapper.split()[0]}>") == ""


LINE = "This paragraph says a good deal about one thing and goes on about it for a while, as texts do."
LONG = " ".join([LINE] * 4)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><div class='entry-header'><h1>A headline</h1></div><p>{LONG}</p></article>", ["A headline", LONG]),
        (f"<article><p>{LONG}</p><p>So <math><mi>x</mi> = <mn>2</mn></math> holds.</p></article>", [LONG, "So x = 2 holds."]),
        (f"<div><p>{LONG}</p><p>He said no.</p><p>{LONG}</p></div>", [LONG, "He said no.", LONG]),
        (f"<article><p>{LONG} <a href=x>a link<p>{LONG}<p>{LINE}</article>", [f"{LONG} a link", LONG, LINE]),
        (f"<article><p>{LONG}</p><p class='ad'>Buy now. {LINE}</p><p>{LINE}</p></article>", [LONG, LINE]),
        (f"<article><p>{LONG}<p class=ad>Buy. {LINE}<p>{LINE}</article>", [LONG, LINE]),
        (f"<div><p>{LONG}</p><ul><li class='comment'>I agree. {LINE}<li class=comment><p>{LONG}</p></li></ul><p>{LONG}</p></div>", [LONG, LONG]),
        (f"<div><ul><li class=comment>{LINE}<li>{LONG}</ul></div>", [LONG]),
        (f"<div class='cookie-consent'><p>{LONG}</p></div><article><p>{LINE}</p></article>", [LINE]),
        (f"<div id=newsletter><p>{LONG}</p></div><div><p>{LONG}</p></div>", [LONG]),
        (f"<table><tr><td><a href=a>Home</a> <a href=b>About us</a></td><td>{LONG}</td></tr></table>", [LONG]),
        (f"<table><tr><td class=nav><a href=a>Home</a><td>{LONG}<tr><td>{LONG}</table>", [LONG, LONG]),
        (f"<article><a href=x><div><p>{LINE}</p></div></a><p>{LONG}</p></article>", [LONG]),
        (f"<article><ul><li>{LINE}<ul><li>inner one</ul><li>{LINE}</ul></article>", [LINE, "inner one", LINE]),
    ],
)
def test_pages_that_lost_or_kept_too_much(page, text):
    found = html_text.main_text(f"<body><nav><a href=n>x</a></nav>{page}<footer>f</footer></body>").split("\n\n")
    assert found == text


def test_a_very_long_page():
    page = "<article>" + f"<p>{LONG}</p><ul><li>{LINE}<li>{LINE}</ul>" * 5000 + "</article>"
    assert html_text.main_text(page).count("\n\n") == 3 * 5000 - 1


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>a b</p></article>", "t"), (1, None, None, "t"), (None, "u", "", None)], "page_id long, url string, html string, text string")
    got = html_text.extract(pages, ["page_id", "url"]).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", ""), ("1", "a b"), ("None", "")]
    assert html_text.extract(pages.limit(0), ["page_id"]).count() == 0


# ------------------------------------------------------------ 9 warc


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(11)
    big = "<p>" + sentence(rng, 60) + "</p>"
    rows = [(i, f"http://x.org/{i}?q=é b\r\nX: 1", "<html>" + sentence(rng, 200) + "</html>") for i in range(300)]
    rows += [(1000, None, big), (999, "", big), (1001, "u", big), (1002, "u", "short"), (1003, "u", "short"), (1004, "u", None), (1005, "u", "")]
    rows += [(999, "", big), (None, "u", big), (None, "v", "r\r\n\r\nWARC/1.1" * 40), (1006, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=300_000)
    assert archives.count() > 3 and archives.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_archives(archives).collect()
    assert len(got) == len(rows)
    by_id = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got)
    want = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and page_id != 999
        want[(page_id, "revisit" if revisit else "response", 999 if revisit else None, len(data), hashlib.sha256(data).hexdigest())] += 1
    assert by_id == want
    payloads = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert bytes(payloads[5]).decode() == rows[5][2]
    first = next(p for p in (tmp_path / "w").iterdir()).read_bytes()
    assert int.from_bytes(first[:4], "little") == warc.DICTIONARY_FRAME
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.endswith(".open")]


def test_no_pages_no_archives(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_archives(pages, str(tmp_path / "w"))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


# -------------------------------------------------------------- 10 lm


@pytest.mark.parametrize("common", [5, 200_000])
def test_base_scores(spark, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON_WORDS", common)
    monkeypatch.setattr(lm, "STEPS", 50)
    rng = random.Random(12)
    texts = [" ".join(rng.choice("The the a\x1cb É é x-y. zz".split(" ")) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += [None, "", " \t\n", "only here " * 3, "long " * 5000]
    docs = documents(spark, list(enumerate(texts)), ["score", "word", "n_tokens"])
    model = lm.train(docs.filter("doc_id % 3 > 0"))
    got = {r.doc_id: r for r in lm.score(docs, model, ["doc_id"]).collect()}
    counts = Counter(t for k, x in enumerate(texts) if k % 3 for t in [*plain.tokens(x), ""])
    total, distinct = sum(counts.values()), len(counts)
    for k, x in enumerate(texts):
        t = [*plain.tokens(x), ""]
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(t), sum(counts[w] > 0 for w in t), total)
        assert got[k].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t))
        assert got[k].score < 0


def test_network_is_normalised_and_learns():
    rng = np.random.default_rng(13)
    symbols = lm.Symbols(["a", "b", "c"])
    text = pa.array([" ".join("abc"[(i + rng.integers(0, 20) // 19) % 3] for i in range(300)) for _ in range(20)])
    w, parents = lm.split_words(text)
    triples, whose = symbols.triples(w, parents, 20)
    assert len(triples) == 20 * 301 and (np.bincount(whose) == 301).all()
    at, n = np.unique(triples, return_counts=True)
    network = lm.LogBilinear(symbols.all, symbols.targets).fit(at, n)
    table = network.log10_table().reshape(-1, symbols.targets)
    assert np.allclose((10**table).sum(axis=1), 1)
    unigram = np.bincount(triples % symbols.targets, minlength=symbols.targets) + 1.0
    assert network.log10_table()[triples].mean() > np.log10(unigram / unigram.sum())[triples % symbols.targets].mean() + 0.2


def test_no_training_text(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    assert lm.train(documents(spark, [])) is None
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in lm.score(docs, None, ["doc_id"]).collect()}
    assert got == {1: (3, 0, 0), 2: (1, 0, 0)}


def test_every_word_has_its_context(spark, monkeypatch):
    monkeypatch.setattr(lm, "VOCABULARY", 2)
    monkeypatch.setattr(lm, "COMMON_WORDS", 30)
    rng = random.Random(21)
    rows = []
    for k in range(600):
        side = rng.randrange(2)  # words outside the vocabulary, of one ending and frequency, keep to one of its words
        rows.append((k, " ".join(f"{'ab'[side]} w{2 * rng.randrange(60) + side:03}xx" for _ in range(20))))
    docs = documents(spark, rows)
    model = lm.train(docs.filter("doc_id < 500"))
    got = {r.doc_id: r for r in lm.score(docs, model, ["doc_id"]).collect()}
    vectors = {r.word: r for r in model.words.collect()}
    assert len(vectors) > 100 and model.least_common > min(r.n for r in vectors.values())  # common and joined ones
    assert all(r.n == sum(w == r.word for k, t in rows if k < 500 for w in t.split()) for r in vectors.values())

    # Word by word in plain Python; in every context the words of a class and the unseen one add up to 1.
    symbols, table = model.symbols, model.network().log10_table()
    classes = {w: int(lm.word_classes(pa.array([w]), symbols.classes)[0]) for w in {"unseen", *vectors}}
    number = {"a": symbols.words.index("a"), "b": symbols.words.index("b")}

    def weight(word, one):
        r = vectors.get(word)
        return (r.n + 1) * math.exp(sum(x * y for x, y in zip(r.vector, model.directions[one], strict=True))) if r else 1.0

    for one in (*number.values(), symbols.begin):
        for c in set(classes.values()):
            assert model.norms[c, one] == pytest.approx(1 + sum(weight(w, one) for w in vectors if classes[w] == c))
    for k, text in rows[::50]:
        two, one, expected = symbols.begin, symbols.begin, 0.0
        for w in [*text.split(), None]:
            symbol = symbols.end if w is None else number[w] if w in number else symbols.rest + classes[w]
            expected += table[(two * symbols.all + one) * symbols.targets + symbol]
            if w and w not in number:
                expected += math.log10(weight(w, one) / model.norms[classes[w], one])
            two, one = one, symbol
        assert got[k].score == pytest.approx(expected, abs=1e-4)

    # Half of the words can follow "a" and half "b": knowing that is worth log10(2) for each of 10,000 / 20 words of a text.
    counts = Counter(w for k, t in rows if k < 500 for w in t.split()[1::2])
    for k, text in rows[500:]:
        shares = sum(math.log10((counts[w] + 1) / (sum(counts.values()) + len(counts) + 1)) for w in text.split()[1::2])
        signs = [symbols.begin, symbols.begin]
        network = 0.0
        for w in [*text.split(), None]:
            symbol = symbols.end if w is None else number[w] if w in number else symbols.rest + classes[w]
            network += table[(signs[-2] * symbols.all + signs[-1]) * symbols.targets + symbol]
            signs.append(symbol)
        assert got[k].score - network > shares + 20 * 0.25


def test_words_after_one_word_differ_from_those_after_another():
    directions = np.array([[1.0, 1.0], [1.0, -1.0]])
    seen = np.array([[9, 0], [0, 9], [5, 5], [1, 0]])
    vectors = lm.contrasted(seen, seen.sum(axis=1, keepdims=True) * np.array([[0.5, 0.5]]), directions)
    assert vectors[0, 1] > vectors[3, 1] > 0.2 and vectors[1, 1] < -0.2 and abs(vectors[2, 1]) < 1e-6


def test_classes_of_words():
    texts = ["x", "axx", "bxx", "é", "\U0001f600", "xx", "xé"]
    array = pa.array(["skip", *texts]).slice(1)
    found = lm.word_classes(array, 64)
    assert found[1] == found[2] == found[5] and ((found >= 0) & (found < 64)).all()
    assert found.tolist() == [lm.word_classes(pa.array([t]), 64)[0] for t in texts]
    assert len(lm.word_classes(pa.array([], pa.string()), 64)) == 0


# --------------------------------------------------------------- words


def test_words_of_batches():
    texts = ["Ab cD,ef", None, "", "É9 ", ",,", "x", "y z" * 50, "\U0001f600 a"]
    array = pa.array(["skip", *texts]).slice(1)
    w = words.Words(array, words.ALPHANUMERIC)
    found = [[] for _ in texts]
    for k, d in enumerate(w.doc):
        found[d].append(w.text(k, k + 1))
    assert found == [plain.words(t) for t in texts]
    marks = {}
    for h, k in zip(w.hashes().tolist(), range(len(w.doc)), strict=True):
        assert marks.setdefault(w.text(k, k + 1), h) == h
    assert len(set(marks.values())) == len(marks)
    assert (w.hashes(limit=3) == w.hashes()).all()
    batch = pa.record_batch([pa.array(texts)], ["t"])
    assert sum(p.num_rows for p in words.pieces(batch, 0, limit=10)) == len(texts)
    assert [p.num_rows for p in words.pieces(batch, 0, 0, rows=3)] == [3, 3, 2]
    assert list(words.pieces(batch.slice(0, 0), 0)) == []
