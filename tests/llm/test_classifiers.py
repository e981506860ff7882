from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import language, quality, toxicity
from riskweave.llm.text import labelled_sample


def crc(doc):
    return zlib.crc32(str(doc).encode())


def auc(rows, label):
    ranked = sorted(rows, key=lambda r: r["score"])
    positives = [i for i, r in enumerate(ranked) if r[label] == 1]
    n, m = len(positives), len(ranked) - len(positives)
    return (sum(positives) - n * (n - 1) / 2) / (n * m)


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.01"
    return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]


def test_machine_equals_all_pairs():
    draw = np.random.default_rng(0)
    machine = quality.FactorisationMachine(
        0.3, draw.normal(size=quality.SIZE), draw.normal(size=(quality.SIZE, quality.RANK))
    )
    indices = draw.choice(quality.SIZE, 20, replace=False)
    values = draw.normal(size=20)
    expected = machine.bias + machine.weights[indices] @ values
    for i in range(20):
        for j in range(i):
            a, b = machine.vectors[indices[i]], machine.vectors[indices[j]]
            expected += values[i] * values[j] * (a @ b)
    assert machine.margin(indices, values) == pytest.approx(expected)


def test_machine_learns_an_interaction():
    """Only a pair of inputs tells the classes apart, no input alone."""
    rows = []
    for a in (0, 1):
        for b in (2, 3):
            rows += [(float((a == 0) == (b == 2)), np.array([a, b]), np.ones(2))] * 60
    machine = quality.FactorisationMachine.empty()
    machine.fit(rows, epochs=40)
    assert all((machine.score(i, v) > 0.5) == bool(t) for t, i, v in rows)


def test_held_out_quality(larger):
    docs, labels = larger
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert auc(rows, "quality") > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in scored.collect())


def test_held_out_toxicity(spark):
    """Toxic texts are few, so this takes the larger tables."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    rows = scored.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert auc(rows, "toxic") > 0.9
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in scored.collect())
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in scored.where("predicted = 0").collect()
    }


def test_labels_of_the_held_out_fold_are_not_learned(larger):
    docs, labels = larger
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    wrong = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit_toxicity(docs, x) for x in (labels, wrong))
    assert np.array_equal(one.buckets, two.buckets) and np.array_equal(one.weights, two.weights)


def test_ratios_equal_counts(spark):
    rows = [(1, "abcd", 1), (2, "abcd abcd", 1), (3, "wxyz", 0), (4, None, 0)]
    sample = spark.createDataFrame(rows * 20, "doc_id bigint, text string, target int")
    buckets, ratios, _ = toxicity.gram_ratios(sample)
    found = dict(zip(buckets.tolist(), ratios.tolist(), strict=True))
    (own,) = {int(b) for b in toxicity._distinct("abcd")} & {int(b) for b in toxicity._distinct("xabcdx")}
    assert found[own] == pytest.approx(np.log((41 / 42) / (1 / 42)))


def test_toxicity_of_few_labels(spark):
    """10 toxic and 15 clean texts: no n-gram has the evidence that larger tables ask for."""
    draw = np.random.default_rng(4)
    words = ["".join(draw.choice(list("abcdefghijklmnop"), 5)) for _ in range(60)]
    ids = [i for i in range(100) if crc(i) % 4 != 2][:18] + [i for i in range(100) if crc(i) % 4 == 2][:7]
    toxic = dict.fromkeys(ids[:7] + ids[18:21], 1)
    marks = "zzyxwv qqrstu".split()
    rows = [
        (i, " ".join([*draw.choice(words, 12), *(marks if i in toxic else []), *draw.choice(words, 8)]))
        for i in ids
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, toxic.get(i, 0)) for i in ids], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()
    assert {r["doc_id"] for r in found if r["predicted"]} == set(toxic)


@pytest.mark.parametrize("more", [0, 1])
def test_no_switch_in_the_number_of_strong_ngrams(spark, more):
    """63 or 64 strong n-grams: weak ones have no more say for the one that is missing."""
    evidence = np.concatenate([np.full(63 + more, 40.0), np.full(4000, 3.0)])
    values = toxicity.trusted(np.ones(len(evidence)), evidence)
    assert values[: 63 + more].min() > 0.98 and values[63 + more :].max() < 0.002
    assert toxicity.trusted(np.ones(1), np.array([toxicity.HALF_EVIDENCE]))[0] == 0.5


def test_scores_equal_spelled_out_sums(spark, larger):
    """The score of a text is the logistic sum over its distinct n-grams."""
    docs, labels = larger
    model = toxicity.fit_toxicity(docs, labels)
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    for row in docs.orderBy("doc_id").limit(60).collect():
        seen = {int(b) for part in toxicity.gram_buckets(row["text"] or "") for b in part}
        margin = model.bias + sum(weight.get(b, 0.0) for b in sorted(seen))
        assert found[row["doc_id"]] == pytest.approx(1 / (1 + np.exp(-margin)))


def test_bounded_sample(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    repeated = labels.union(labels.withColumn("toxic", F.lit(0))).union(
        spark.createDataFrame([(None, 1), (3, None)], "doc_id bigint, toxic int")
    )
    sample = labelled_sample(docs.union(docs), repeated, "toxic", 4, 2, 50)
    rows = sample.collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == 50
    assert all(r["target"] == 1 and crc(r["doc_id"]) % 4 != 2 for r in rows)


def test_held_out_language(larger):
    docs, _ = larger
    found = language.predict_languages(docs, language.fit_languages(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) for r in found.collect())


def test_proportions_of_a_mixture():
    draw = np.random.default_rng(1)
    shares = draw.dirichlet(np.full(400, 0.3), 3).T + 1e-4
    shares /= shares.sum(axis=0)
    counts = draw.multinomial(3000, 0.7 * shares[:, 0] + 0.3 * shares[:, 2])
    found = language.proportions(counts, shares)
    assert set(found) == {0, 2}
    assert found[0] == pytest.approx(0.7, abs=0.05)
    alone = language.proportions(draw.multinomial(3000, shares[:, 1]), shares)
    assert alone == {1: 1.0}


def test_sparse_proportions_equal_dense_ones():
    """Against mixtures over the whole table, with buckets that languages lack."""
    draw = np.random.default_rng(2)
    counted = draw.integers(0, 30, (language.BUCKETS, 6)) * (draw.random((language.BUCKETS, 6)) < 0.02)
    buckets, of = np.nonzero(counted)
    sparse = language.Shares.from_counts(buckets, of, counted[buckets, of].astype(float), 6)
    table = counted + language.SMOOTHING
    table = table / table.sum(axis=0)
    for true in ([1.0, 0, 0, 0, 0, 0], [0, 0.6, 0, 0.4, 0, 0], [0.2, 0, 0.3, 0, 0, 0.5]):
        counts = draw.multinomial(4000, table @ np.array(true))
        found = language.proportions(counts, sparse)
        assert set(found) == {i for i, share in enumerate(true) if share}
        dense = language.proportions(counts, table)
        assert dense == pytest.approx(found)
        best = max(range(6), key=lambda i: counts @ np.log(table[:, i]))
        assert next(iter(found)) == best
        weights = np.array([found.get(i, 0.0) for i in range(6)])
        value = counts @ np.log(table @ weights)
        for i in range(6):  # no other mixture of the chosen ones is likelier
            for j in found:
                moved = weights.copy()
                if i in found and i != j and moved[i] > 0.02:
                    moved[i], moved[j] = moved[i] - 0.02, moved[j] + 0.02
                    assert counts @ np.log(table @ moved) < value + 1e-6


def test_three_hundred_languages_are_learned(spark):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(300):
        syllables = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(12)]
        for j in range(8):
            text = " ".join("".join(draw.choice(syllables, 2)) for _ in range(40))
            rows.append((8 * i + j, text, f"l{i:03d}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit_languages(docs)
    assert len(model.names) == 300
    found = language.predict_languages(docs, model).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.98


def test_odd_rows(odd, nothing, labels, documents):
    models = [
        (quality.score_quality, quality.fit_quality(odd, labels)),
        (quality.score_quality, quality.fit_quality(documents, labels)),
        (toxicity.score_toxicity, toxicity.fit_toxicity(odd, labels)),
        (toxicity.score_toxicity, toxicity.fit_toxicity(documents, labels)),
        (language.predict_languages, language.fit_languages(odd)),
        (language.predict_languages, language.fit_languages(documents)),
        (language.predict_languages, language.fit_languages(nothing)),
    ]
    for apply, model in models:
        rows = apply(odd, model).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(
            str(r["doc_id"]) for r in odd.select("doc_id").collect()
        )
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
        assert apply(nothing, model).collect() == []
    und = language.predict_languages(odd, models[5][1]).where("lang_pred = 'und'")
    assert {r["doc_id"] for r in und.collect()} == {1, 2, 3, 8, None}
    assert toxicity.without_toxic(odd, models[3][1]).columns == odd.columns
