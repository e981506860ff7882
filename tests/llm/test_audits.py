"""Clustering, filter audit and license scan against brute force, and their edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm import clustering, filter_audit, licenses

# --- clustering


def lloyd(points, first, rounds):
    centroids, cluster = first.copy(), None
    for step in range(rounds + 1):
        squared = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        cluster = squared.argmin(axis=1)
        if step < rounds:
            for c in range(len(centroids)):
                if (cluster == c).any():
                    centroids[c] = points[cluster == c].sum(axis=0) // (cluster == c).sum()
    return cluster, squared.min(axis=1), centroids


@pytest.mark.parametrize("spread", [0, 3, 300])
def test_clusters_equal_full_scans(spark, spread):
    """With few distinct values there are ties and repeated vectors at every turn."""
    drawn = np.random.default_rng(spread).integers(-spread, spread + 1, (300, 6))
    drawn[200:] = drawn[100:200]
    rows = [(i, [float(x) / 16 for x in v], "x") for i, v in enumerate(drawn)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, cluster string").repartition(5)
    vectors = clustering.whole_vectors(table, 6, 16)
    first = clustering.first_centroids(vectors, 5, clustering.SEED)
    expected, distance, centroids = lloyd(drawn, first, 6)
    found = clustering.cluster_vectors(table, 5, 6, 6, 16)
    by_id = {r["vec_id"]: r for r in found.rows.collect()}
    assert [by_id[i]["cluster"] for i in range(300)] == expected.tolist()
    assert [by_id[i]["distance"] for i in range(300)] == distance.tolist()
    assert (found.centroids == centroids).all()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_approach_bounds_every_point_of_the_sphere(seed):
    draw = np.random.default_rng(seed)
    size = draw.integers(1, 5)
    center, old, new = draw.normal(size=(3, size)) * 10 ** draw.uniform(-1, 2, (3, 1))
    radius = 10 ** draw.uniform(-2, 2)
    bound = clustering.approach(center, radius, old, new)
    toward = draw.normal(size=(400, size))
    toward /= np.linalg.norm(toward, axis=1, keepdims=True)
    points = center + toward * radius * draw.uniform(0, 1, (400, 1)) ** 0.1
    points[0] = center + radius * (new - old) / (np.linalg.norm(new - old) or 1)
    nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
    assert nearer.max() <= bound + 1e-12
    assert bound <= np.linalg.norm(new - old) * (1 + 1e-6)


def test_drift_geometry_saves_scans():
    """A far centroid that moves sideways loosens nothing; by full drift all would be scanned."""
    draw = np.random.default_rng(1)
    old = np.array([[0, 0], [1000, 0]])
    new = np.array([[0, 0], [1000, 400]])
    x = draw.integers(-60, 61, (500, 2))
    cluster, upper, lower = clustering._scan(x, old)
    move = clustering.moved(old, new, np.array([upper.max(), 0.0]))
    assert move.loss[0] < 0.3 * 400
    far = clustering.Move(new, move.drift, np.full(2, 3000.0), np.zeros(2))
    assert clustering.reassigned(x, cluster, upper, lower, far)[3] == 500
    tight = clustering.Move(new, move.drift, move.loss, np.zeros(2))
    again, _, _, scanned = clustering.reassigned(x, cluster, upper, lower, tight)
    assert scanned == 0 and (again == clustering._scan(x, new)[0]).all()


def test_vectors_left_out_and_refused(spark):
    good = [0.5] * 64
    rows = [
        (1, good),
        (1, good),
        (None, [-0.25] * 64),
        (2, None),
        (3, []),
        (4, good[:63]),
        (5, [None] + good[1:]),
        (6, [float("nan")] + good[1:]),
        (7, [float("inf")] + good[1:]),
    ]
    table = spark.createDataFrame(
        [(i, v, 9, "a") for i, v in rows], "vec_id bigint, embedding array<float>, cluster int, _x string"
    )
    found = clustering.cluster_digest(table).collect()
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in found) == [
        ("1", 0, 0), ("1", 0, 0), ("None", 2, 0)
    ]
    empty = clustering.cluster_digest(table.limit(0))
    assert empty.collect() == [] and empty.columns == clustering.cluster_digest(table).columns
    huge = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        clustering.cluster_digest(huge)


# --- filter audit


def text_fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute_audit(docs, labels):
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    rows = Counter()
    parts = {source or "" for _, _, source in docs}
    orders = list(permutations("ABCDE"))
    totals = Counter()
    for doc_id, text, source in docs:
        failed = {f for f, x in text_fails(text or "").items() if x}
        if doc_id is not None and doc_id > least[text or ""]:
            failed.add("E")
        marks = [m for d, q, t in labels if d is not None and d == doc_id for m in (("good",) * (q == 1) + ("toxic",) * (t == 1))]
        part = source or ""
        for order in orders:
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                if f in failed:
                    rows[(*key, "redundant" if gone else "removed")] += 1
                    rows[(*key, "unique_fails")] += len(failed) == 1
                    if not gone:
                        totals[part, f] += 1
                        rows[(*key, "good_lost")] += "good" in marks
                        rows[(*key, "toxic_lost")] += "toxic" in marks
                    gone = True
                rows[(*key, "kept")] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (part, "".join(order), step): (
            *(rows[(part, "".join(order), step, n)] for n in names),
            totals[part, order[step - 1]],
        )
        for part in parts
        for order in orders
        for step in range(1, 6)
    }


def found_audit(docs, labels):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = filter_audit.filter_interactions(docs, labels).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_equals_brute_force_on_odd_rows(odd, spark):
    labels = [(1, 1, 0), (6, 1, 1), (6, 0, None), (7, None, 1), (None, 1, 1), (4, 1, 0), (4, 1, 0), (99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert found_audit(odd, table) == brute_audit(docs, labels)


def test_audit_equals_brute_force_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_BITS", 2)
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(150):
        text = " ".join(draw.choices(words, k=draw.choice([10, 49, 50, 70]))) if draw.random() < 0.7 else "SAME text"
        text += draw.choice(["", "", " #"]) + draw.choice(["", "ABCDEFGHIJ" * 4])
        docs.append((draw.randrange(200), text, draw.choice(["hot", "hot", "hot", "b", "", None])))
    labels = [(i, draw.randrange(2), draw.randrange(2)) for i in range(0, 200, 2)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(3)
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert found_audit(table, marked) == brute_audit(docs, labels)


def test_audit_of_nothing(nothing, labels):
    assert filter_audit.filter_interactions(nothing, labels).count() == 0


@given(st.lists(st.sets(st.integers(0, 40)), min_size=1, max_size=5))
def test_union_sizes(sets):
    lists = [np.array(sorted(s), np.int64) for s in sets]
    assert filter_audit.gallop_union(lists).tolist() == sorted(set().union(*sets))
    for mask, size in enumerate(filter_audit.union_sizes(lists)):
        assert size == len(set().union(*(s for i, s in enumerate(sets) if mask >> i & 1)))


def test_too_many_filters(odd):
    with pytest.raises(ValueError, match="filters"):
        filter_audit.audit_filters(odd, "source", "doc_id", dict.fromkeys("ABCDEFG", "x"), {})


# --- license scan


def lower_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_scan(text):
    words = lower_words(text)
    labels, base, places, score = set(), set(), [], 0.0
    for t in licenses.TEMPLATES:
        phrase = t.words.split()
        if t.together:
            at = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            if at:
                labels.add(t.label)
                score = 1.0
                if t.base:
                    base.add(t.label)
                    places += at
        else:
            for i in range(0, len(words), licenses.STRIDE):
                held = len(set(words[i : i + licenses.BLOCK]) & set(phrase))
                if held >= t.needed:
                    labels.add(t.label)
                    score = max(score, held / len(set(phrase)))
    bounds = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *bounds, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def scanned(docs):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = licenses.license_digest(docs).collect()
    return sorted((str(r["doc_id"]), *map(str, (r[n] for n in names))) for r in rows)


def expected_scan(docs):
    return sorted((str(d), *map(str, brute_scan(t))) for d, t in docs)


def test_license_scan_equals_brute_force(spark):
    """Texts drawn from the words of the templates come close to, and over, every threshold."""
    draw = random.Random(7)
    every = [w for t in licenses.TEMPLATES for w in t.words.split()]
    docs = []
    for i in range(250):
        pieces = []
        for _ in range(draw.randrange(1, 12)):
            t = draw.choice(licenses.TEMPLATES).words.split()
            if draw.random() < 0.5:
                t = [w for w in t if draw.random() > 0.15]
            if draw.random() < 0.3:
                draw.shuffle(t)
            pieces += t + draw.choices([*every, "x", "y"], k=draw.choice([0, 1, 60]))
        docs.append((i, draw.choice([" ", "\n", " - "]).join(pieces)))
    docs += docs[:5]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert scanned(table) == expected_scan(docs)


def test_phrases_across_block_bounds(spark):
    docs = []
    for shift in range(60, 70):
        docs.append((shift, "w " * shift + "ALL rights\nReserved; General Public-License cc.by " + "z " * 70))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert scanned(table) == expected_scan(docs)


def test_license_scan_of_odd_rows(odd, nothing):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert scanned(odd) == expected_scan(docs)
    full = licenses.scan_licenses(odd)
    assert full.count() == odd.count() and set(odd.columns) < set(full.columns)
    assert licenses.license_digest(nothing).count() == 0


def test_long_template_is_refused(odd):
    long = licenses.Template("x", " ".join(f"w{i}" for i in range(40)))
    with pytest.raises(ValueError, match="40 words"):
        licenses.matching_blocks(odd, [long])


def test_license_plan_has_no_python(odd):
    from tests.plans import no_python_and_no_cross_join

    order = licenses.token_order(odd, licenses.TEMPLATES)
    assert no_python_and_no_cross_join(licenses.matching_blocks(odd, order=order))
