"""Operators on word windows, against brute force over all windows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import decontamination, substring
from riskweave.llm.text import word_hashes
from riskweave.operators import joins

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_repeats(rows):
    """Rows as (doc_id, text); windows of 13 words."""
    least = {}
    worded = [(doc, WORDS.findall(text or "")) for doc, text in rows]
    for doc, words in worded:
        for i in range(len(words) - 12):
            window = tuple(words[i : i + 13])
            if doc is not None:
                least[window] = min(doc, least.get(window, doc))
    result = Counter()
    for doc, words in worded:
        gone = set()
        for i in range(len(words) - 12):
            if doc is not None and least[tuple(words[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result[doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return result


def repeats(docs):
    rows = substring.repeat_digest(docs).collect()
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)


def pairs(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_repeats_equal_brute_force(documents):
    assert repeats(documents) == brute_repeats(pairs(documents))


def test_repeats_in_odd_rows(odd, nothing):
    found = repeats(odd)
    assert found == brute_repeats(pairs(odd))
    assert sum(n for (doc, _, gone, _), n in found.items() if gone) == 2
    assert repeats(nothing) == Counter()


def test_a_passage_shared_by_very_many(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    own = F.concat(F.lit("own"), F.col("id").cast("string"))
    text = F.when(F.col("id") % 3 == 0, F.concat_ws(" ", own, F.lit(passage), own)).otherwise(own)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = substring.repeat_digest(docs.repartition(7)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows if r["n_removed"]} == {
        i: 50 for i in range(3, 900, 3)
    }


def test_words_repeated_within_and_across_texts(spark):
    """Texts of one word, of a short period, and with repeated rows, in any order."""
    words = [
        (5, "a " * 300),
        (3, "a " * 200),
        (9, "b c d " * 90 + "a " * 40),
        (4, "b c d " * 50),
        (7, "a " * 12),
        (3, "a " * 200),
        (4, "x " + "b c d " * 20),
        (-2, "c d b " * 8 + "end"),
    ]
    docs = spark.createDataFrame(words, "doc_id bigint, text string")
    for parts in (1, 3):
        assert repeats(docs.repartition(parts, "doc_id")) == brute_repeats(words)


def test_small_chunks_give_the_same(documents, monkeypatch):
    few = documents.where("doc_id % 7 < 2").coalesce(3)
    monkeypatch.setattr(substring, "_FLUSH", 500)
    assert repeats(few) == brute_repeats(pairs(few))


def test_a_hot_window_is_one_row_for_each_chunk(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    text = F.concat_ws(" ", F.concat(F.lit("own"), F.col("id").cast("string")), F.lit(passage))
    docs = spark.range(4000, numPartitions=5).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit(0).alias("version")
    )
    rows = substring.repeated_windows(docs).collect()
    opened = Counter(r["start"] for r in rows if r["start"] >= 0)
    assert max(opened.values()) == 4  # one for each partition but that of the least doc_id
    assert sum(1 for r in rows if r["start"] < 0) == 4000 - 5


def test_estimates_are_never_too_low(documents):
    """Every window of two documents passes the filter, even where it is far too small."""
    texts = documents.select("text")
    counts = Counter()
    for (text,) in texts.collect():
        least = substring.least_grams(word_hashes(text.encode().split()), 13, 7)
        counts.update(set(least.tolist()))
    twice = np.array([g for g, n in counts.items() if n > 1], np.uint64)
    once = np.array([g for g, n in counts.items() if n == 1], np.uint64)
    assert len(twice)
    for most in (1 << 10, 1 << 30):
        shape = substring.Shape(len(counts))
        shape.bits = min(shape.bits, most.bit_length() - 1)
        rows = texts.mapInArrow(
            lambda b, s=shape: substring.partition_sketch(b, s, 13, 7),
            "row int, slice int, wide boolean, first bigint, steps binary",
        )
        merged = rows.groupBy("row", "slice").applyInPandas(
            substring._merge(shape), "row int, slice int, bits binary"
        )
        blocks = {(r["row"], r["slice"]): bytes(r["bits"]) for r in merged.collect()}
        repeated = substring.RepeatFilter(shape, blocks)
        assert repeated(twice).all()
        if most == 1 << 30:
            assert repeated(once).mean() < 0.02


def test_filter_is_bounded_for_any_input():
    assert all(substring.Shape(10.0**p).bits <= 30 for p in range(16))


def brute_contamination(docs, items):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    windows = {}
    for item, text in items:
        words = ITEM_WORDS.findall(fold(text))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    result = Counter()
    for doc, text in docs:
        words, hit, found = ITEM_WORDS.findall(fold(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = windows.get(tuple(words[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= {str(o) for o in own if o is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result[doc, len(words), len(hit), len(found), digest, bool(hit)] += 1
    return result


def contamination(docs, items):
    rows = decontamination.decontamination_digest(docs, items).collect()
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return Counter(tuple(r[n] for n in names) for r in rows)


@pytest.fixture(scope="module")
def hard_items(spark):
    """Short items, overlapping ones, repeated words, shared passages, NULLs and repeated rows."""
    rows = [
        (1, "x"),
        (2, "one two"),
        (3, "three four five six SEVEN"),
        (4, "five six seven eight nine ten eleven twelve thirteen"),
        (5, "two three four five six seven eight nine ten eleven twelve"),
        (5, "two three four five six seven eight nine ten eleven twelve"),
        (11, "six seven eight nine ten eleven twelve thirteen fourteen and on"),
        (6, "a a a a a a a a a a a a"),
        (7, None),
        (8, " -- "),
        (None, "one two three"),
        (9, "ärger über straße"),
    ]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_contamination_equals_brute_force(documents, benchmark_items):
    expected = brute_contamination(pairs(documents), [tuple(r) for r in benchmark_items.collect()])
    assert contamination(documents, benchmark_items) == expected
    assert any(key[-1] for key in expected)


def test_contamination_of_odd_rows(spark, odd, nothing, hard_items):
    items = [tuple(r) for r in hard_items.collect()]
    more = [(100 + n, "b " + "a " * n + "b") for n in range(8, 15)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    assert contamination(docs, hard_items) == brute_contamination(pairs(docs), items)
    assert contamination(nothing, hard_items) == Counter()
    clean = brute_contamination(pairs(docs), [])
    assert contamination(docs, hard_items.limit(0)) == clean


def test_shuffled_joins_find_the_same(monkeypatch, odd, documents, hard_items, benchmark_items):
    nothing_broadcast = joins.BroadcastBound(rows=0)
    plain = decontamination.sized_join
    monkeypatch.setattr(
        decontamination,
        "sized_join",
        lambda *a, **k: plain(*a, **{**k, "bound": nothing_broadcast}),
    )
    items = [tuple(r) for r in benchmark_items.collect()]
    assert contamination(documents, benchmark_items) == brute_contamination(pairs(documents), items)
    items = [tuple(r) for r in hard_items.collect()]
    assert contamination(odd, hard_items) == brute_contamination(pairs(odd), items)


def test_contaminated_rows_go(odd, hard_items, documents, benchmark_items):
    for docs, items in ((odd, hard_items), (documents, benchmark_items)):
        found = decontamination.decontamination_digest(docs, items)
        kept = decontamination.without_contaminated(docs, items)
        assert kept.columns == docs.columns
        clean = sorted(str(r["doc_id"]) for r in found.where("NOT contaminated").collect())
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean


def test_winnowing_keeps_fewer_hashes(documents):
    worded = documents.select(decontamination.words_of(F.col("text")).alias("words"))
    grams = decontamination._with_grams(worded).where("n >= 100")
    sizes = grams.select(F.sum(F.size("grams")), F.sum(F.size(decontamination._kept()))).first()
    assert sizes[1] < 0.4 * sizes[0]


def test_no_python_on_the_main_path(documents, benchmark_items):
    plan = decontamination.decontamination_digest(documents, benchmark_items)
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
