from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import simhash
from riskweave.llm.components import connected_components
from riskweave.operators.joins import BroadcastBound


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Least id reachable over fingerprints of at most three differing bits."""
    prints = [brute_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, rows, strict=True):
        known = [d for d in (least.get(g), doc) if d is not None]
        least[g] = min(known) if known else None
    return Counter((doc, f"{p:016x}", least[g]) for (doc, _), p, g in zip(rows, prints, group, strict=True))


def found(df):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_equals_brute_force(documents, odd):
    docs = documents.select("doc_id", "text").union(odd.select(F.col("doc_id") + 10_000, "text"))
    rows = [tuple(r) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == brute_components(rows)


def test_odd_rows_and_empty_table(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert found(simhash.near_duplicates(odd)) == brute_components(rows)
    assert simhash.near_duplicates(nothing).collect() == []


def prints(spark, values):
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    return spark.createDataFrame(signed, "fingerprint bigint")


def brute_groups(values):
    group = {v: v for v in values}
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {k: new if g == old else g for k, g in group.items()}
    return {frozenset(k for k in group if group[k] == g) for g in group.values()}


def test_dense_groups_in_small_tiles(spark):
    """Chains and clouds around few centres, with tiles far smaller than the groups."""
    draw = random.Random(3)
    values = {0, 2**64 - 1, 7, 0xFFFF}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            values.add(centre)
            for bit in draw.sample(range(64), draw.randint(1, 3)):
                centre ^= 1 << bit if draw.random() < 0.5 else 0
    values |= {draw.getrandbits(64) for _ in range(200)}
    result = simhash.groups(prints(spark, values), tile=8)
    mine = {}
    for row in result.collect():
        mine.setdefault(row["component"], set()).add(row["fingerprint"] % 2**64)
    assert {frozenset(g) for g in mine.values()} == brute_groups(values)


def close_values(seed):
    draw = random.Random(seed)
    values = {0, 2**64 - 1}
    for _ in range(40):
        value = draw.getrandbits(64)
        for _ in range(4):
            values.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                value ^= 1 << bit
    return values


@pytest.mark.parametrize("parts", simhash.PARTS)
@pytest.mark.parametrize("bound", [BroadcastBound(), BroadcastBound(0, 0)])
def test_any_number_of_parts_gives_the_same_links(spark, parts, bound):
    """With all tiles known, and with only the crowded ones looked up."""
    values = close_values(parts)
    expected = {frozenset(g) for g in brute_groups(values)}
    edges = simhash.links(prints(spark, values), tile=2, parts=parts, bound=bound)
    group = {v: v for v in values}
    for row in edges.collect():
        a, b = (group[row[c] % 2**64] for c in "uv")
        group = {k: a if g == b else g for k, g in group.items()}
    assert {frozenset(k for k in group if group[k] == g) for g in group.values()} == expected


def test_parts_grow_with_the_fingerprints():
    chosen = [simhash.parts_for(10**n) for n in range(13)]
    assert chosen == sorted(chosen) and chosen[0] == 4 and chosen[7] == 8 and chosen[-1] == 16
    for parts in simhash.PARTS:
        sizes = simhash.part_sizes(parts)
        assert (len(sizes), sum(sizes)) == (parts, 64) and max(sizes) - min(sizes) <= 1


def test_links_do_not_list_all_pairs(spark):
    """A cloud of 400 fingerprints within few bits needs no 80,000 edges."""
    cloud = {(1 << a) | (1 << b) for a in range(64) for b in range(a)}
    cloud = set(sorted(cloud)[:400])
    edges = simhash.links(prints(spark, cloud))
    assert edges.count() < 20_000
    assert connected_components(edges).select("root").distinct().count() == 1


def test_components_of_a_long_path(spark):
    edges = spark.range(0, 300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = connected_components(edges)
    assert (roots.count(), roots.select("root").distinct().count()) == (301, 1)
    assert connected_components(edges.limit(0)).collect() == []


def test_one_of_each_group(odd, documents):
    kept = simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    groups = {c for _, _, c in brute_components(rows)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, groups))
    whole = brute_components([tuple(r) for r in documents.select("doc_id", "text").collect()])
    expected = {doc for doc, _, component in whole if doc == component}
    assert {r["doc_id"] for r in simhash.one_of_each_group(documents).collect()} == expected
