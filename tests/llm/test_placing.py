"""Shards, sequences and the pipeline."""

from __future__ import annotations

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskweave.llm import packing, pii, queries, sharding, simhash, toxicity

SPECIAL = "byte_bpe_50k.json"


def brute_permutation(rows, seed, hashes):
    """The same grid walk in plain Python, with the engine's hashes in a table."""
    a = max(1, int(np.ceil(np.sqrt(rows))))
    while a * a < rows:
        a += 1
    b = max(1, -(-rows // a))

    def once(n):
        x, y = n % a, n // a
        for step in range(sharding.ROUNDS):
            if step % 2:
                y = (y + hashes[x, step] % b) % b
            else:
                x = (x + hashes[y, step] % a) % a
        return x + y * a

    result = []
    for n in range(rows):
        place = once(n)
        while place >= rows:
            place = once(place)
        result.append(place)
    return result


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 10, 97, 1000, 4099])
def test_permutation(spark, rows):
    numbers = spark.range(rows)
    found = numbers.select("id", sharding.permuted(F.col("id"), rows, 5).alias("p")).collect()
    assert sorted(r["p"] for r in found) == list(range(rows))
    table = spark.range(70).select(
        "id", *[sharding._hash(F.col("id"), 5, s).alias(str(s)) for s in range(sharding.ROUNDS)]
    )
    hashes = {(r["id"], s): r[str(s)] for r in table.collect() for s in range(sharding.ROUNDS)}
    assert {r["id"]: r["p"] for r in found} == dict(enumerate(brute_permutation(rows, 5, hashes)))


def check_law(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(documents, odd, nothing):
    for docs in (documents, odd):
        rows = sharding.shard_digest(docs).collect()
        check_law(rows, 24)
        expected = Counter()
        for r in docs.collect():
            text = (r["text"] or "").encode()
            expected[r["doc_id"], len(text) + 8, zlib.crc32(text)] += 1
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
        assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    assert sharding.shard_digest(nothing).collect() == []


def test_shards_do_not_depend_on_partitions(documents):
    place = lambda df: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_digest(df).collect()}
    assert place(documents) == place(documents.repartition(9))


def test_equal_rows_get_slots_of_their_own(spark):
    same = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"))
    check_law(sharding.shard_rows(same, ["doc_id"], 7).collect(), 7)


def test_written_shards(spark, documents, tmp_path):
    sharded = sharding.shard_rows(documents, ["doc_id"], 5)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    rows = lambda df: sorted((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in df.collect())
    assert rows(back) == rows(sharded)


def test_sharding_is_native(documents):
    text = sharding.shard_digest(documents)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_differencing_is_nearly_equal():
    draw = random.Random(1)
    for windows in (1, 2, 5, 16):
        sizes = [draw.randint(1, 128) for _ in range(40 * windows)]
        shared = packing.differencing(sizes, windows)
        assert sorted(i for w in shared for i in w) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in w) for w in shared]
        assert max(sums) - min(sums) <= 2
    # the classic case: 8, 7, 6, 5, 4 give 16 and 14
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.differencing([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]


def test_window_count_rises():
    shared = packing.pack([700, 700, 600], 1024)
    assert len(shared) == 3  # two windows have room in sum, but not for these
    assert packing.pack([], 1024) == []


def test_encoder_equals_the_tokenizer(documents):
    model = Tokenizer.from_file(public_tokenizers.path(SPECIAL))
    with open(queries.RANKS, "rb") as file:
        encoder = packing.Encoder(file.read(), queries.PATTERN)
    texts = [r["text"] for r in documents.limit(60).collect()] + [
        "", " ", "a", " a", "a ", "a  b", "a \n b", "it's we'll  'tis\t\tx y", "é😀 ü　z 12 3.4", "\n\na b\r\n",
        "a\x1cb \x1c c \u0085 d",
        "x<|endoftext|>", "a  <|endoftext|> \n b<|endoftext|><|endoftext|", "<|endoftext|>'s  ", "<|ENDOFTEXT|>",
    ]
    for text in texts:
        expected = model.encode(text, add_special_tokens=False).ids + [0]
        assert encoder.ids(text).tolist() == expected


@pytest.mark.parametrize("space", [" ", "\n", "\u3000", " \n"])
def test_very_long_runs_of_whitespace(space):
    model = Tokenizer.from_file(public_tokenizers.path(SPECIAL))
    with open(queries.RANKS, "rb") as file:
        encoder = packing.Encoder(file.read(), queries.PATTERN)
    run = space * (2_000_000 // len(space))
    for text in (run, f"a{run}b's", f"{run}<|endoftext|> {run[:70_000]}\x1c"):
        expected = model.encode(text, add_special_tokens=False).ids + [0]
        assert encoder.ids(text).tolist() == expected


def test_cut_runs_equal_the_tokenizer():
    model = Tokenizer.from_file(public_tokenizers.path(SPECIAL))
    with open(queries.RANKS, "rb") as file:
        encoder = packing.Encoder(file.read(), queries.PATTERN, long_run=2)
    draw = random.Random(3)
    parts = [*" \n\t\x85\xa0\u2003\x1c\u200b", "  ", "a", "'s", "7", "!", "é", "<|endoftext|>", "<|"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 14)))
        expected = model.encode(text, add_special_tokens=False).ids + [0]
        assert encoder.ids(text).tolist() == expected


def test_added_tokens_are_those_of_the_tokenizer():
    with open(public_tokenizers.path(SPECIAL), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    assert packing.ADDED == {t["content"]: t["id"] for t in added}


def check_packing(pieces, docs):
    model = Tokenizer.from_file(public_tokenizers.path(SPECIAL))
    expected = Counter()
    for r in docs.collect():
        ids = model.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        expected[r["doc_id"], tuple(ids)] += 1
    places = defaultdict(list)
    by_doc = defaultdict(list)
    for r in pieces:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert len(r["ids"]) == r["length"] > 0
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["start"], tuple(r["ids"]), r["doc_tokens"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    for doc in {d for d, _ in expected}:
        copies = sum(n for (d, _), n in expected.items() if d == doc)
        tokens = sum(len(ids) * n for (d, ids), n in expected.items() if d == doc)
        assert sum(len(ids) for _, ids, _ in by_doc[doc]) == tokens
        if copies == 1:
            ((_, ids),) = [k for k in expected if k[0] == doc]
            joined = sum((part for _, part, _ in sorted(by_doc[doc])), ())
            assert joined == ids and {t for _, _, t in by_doc[doc]} == {len(ids)}
    return [sum(length for _, length in own) for own in places.values()]


def test_packing_round_trip(documents, odd, nothing):
    pieces = packing.packed_pieces(documents, queries.RANKS, queries.PATTERN)
    sizes = check_packing(pieces.collect(), documents)
    assert sum(sizes) > 0.98 * 1024 * len(sizes)
    check_packing(packing.packed_pieces(odd, queries.RANKS, queries.PATTERN).collect(), odd)
    assert packing.packed_pieces(nothing, queries.RANKS, queries.PATTERN).collect() == []


def test_pipeline_equals_its_parts(spark, sf_dir, documents, labels, benchmark_items):
    from tests.llm.test_simhash import brute_components
    from tests.llm.test_windows import brute_contamination

    model = toxicity.fit_toxicity(documents, labels)
    scored = toxicity.score_toxicity(documents, model).where("predicted = 0")
    left = {r["doc_id"] for r in scored.collect()}
    rows = [(r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] in left]
    firsts = {d for d, _, c in brute_components(rows) if d == c}
    rows = [r for r in rows if r[0] in firsts]
    found = brute_contamination(rows, [tuple(r) for r in benchmark_items.collect()])
    clean = {key[0] for key in found if not key[-1]}
    texts = {doc: pii.masked(text) for doc, text in rows if doc in clean}
    with open(queries.RANKS, "rb") as file:
        encoder = packing.Encoder(file.read(), queries.PATTERN)
    expected = {doc: len(encoder.ids(text)) for doc, text in texts.items()}

    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in pieces} == expected
    assert sum(r["length"] for r in pieces) == sum(expected.values())


def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, sf_dir)
            assert result.columns == docs.columns
            result.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_queries_are_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert set(queries.all_queries()) | {"pipeline"} <= names
    assert set(queries.all_oracles()) <= set(contract.oracle_sql())
    assert simhash.TILE == 2048
