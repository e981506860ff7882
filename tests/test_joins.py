from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators import joins
from riskweave.operators.joins import BroadcastBound, exclude_keys, measure
from riskweave.operators.split import hash_split, train_validation_split
from tests.plans import plan_of

NOTHING = BroadcastBound(rows=0)


@pytest.fixture(scope="module")
def facts(spark):
    """Key 7 has a third of all rows, and another third has no key."""
    key = (
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).cast("bigint")
    )
    return spark.range(3000).withColumn("key", key)


def brute_force(facts, bad, null_keys):
    rows = facts.collect()
    if not bad:
        return sorted(r["id"] for r in rows)
    keep_null = null_keys == "keep"
    return sorted(
        r["id"] for r in rows if (keep_null if r["key"] is None else r["key"] not in bad)
    )


@pytest.mark.parametrize("bound", [BroadcastBound(), NOTHING], ids=["broadcast", "salted"])
@pytest.mark.parametrize("null_keys", ["keep", "not_in"])
@pytest.mark.parametrize("bad", [[], [7], [3, 7, None], [1000]])
def test_exclusion(spark, facts, bound, null_keys, bad):
    keys = spark.createDataFrame([(b,) for b in bad], "key bigint")
    left = exclude_keys(facts, keys, "key", null_keys, bound, ["id"])
    assert left.columns == facts.columns
    found = sorted(r["id"] for r in left.collect())
    assert found == brute_force(facts, {b for b in bad if b is not None}, null_keys)


def test_small_sets_are_broadcast_and_large_ones_salted(spark, facts):
    keys = spark.range(5).select(F.col("id").alias("key"))
    small = plan_of(exclude_keys(facts, keys, "key"))
    assert "BroadcastHashJoin" in small and "_salt" not in small
    large = plan_of(exclude_keys(facts, keys, "key", bound=NOTHING))
    assert "_salt" in large
    assert "SinglePartition" not in large


def partition_sizes(joined):
    rows = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in rows]


def test_hot_keys_are_salted_by_their_counts(spark, many_partitions):
    """5,000 equally hot keys, one key of a third of all rows, and many equal rows."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).cast("bigint")
    facts = spark.range(0, 150_000, 1, 6).select(key.alias("key"), F.lit("same").alias("text"))
    names = spark.range(-1, 5000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    hot = {r["key"]: r["_salts"] for r in joins.hot_keys(facts, "key", 10).collect()}
    assert len(hot) == 5001 and hot[-1] == 5000 and hot[7] == 2
    assert [r["key"] for r in joins.hot_keys(facts, "key", 1000).collect()] == [-1]

    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        size = joins.measure(names)
        joined = joins.sized_join(facts, names, "key", "inner", size, NOTHING, None, 100)
        sizes = partition_sizes(joined)
        assert sum(sizes) == 150_000
        # 3,000 rows a partition on average; the hot key alone would bring 50,000
        assert max(sizes) < 6_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_list_of_hot_keys_stays_within_the_bound(spark):
    facts = spark.range(10_000).select((F.col("id") % 100).alias("key"))
    few = joins.hot_keys(facts, "key", 10, BroadcastBound(rows=50))
    assert few.count() == 0  # rather than list 100 keys, tasks get more rows


def test_dictionary_join_is_the_same_both_ways(spark, facts):
    names = spark.range(0, 50, 2).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    size = joins.measure(names)
    ways = [
        joins.sized_join(facts, names, "key", "left", size, bound, ["id"]).select("id", "name")
        for bound in (BroadcastBound(), NOTHING)
    ]
    assert ways[0].exceptAll(ways[1]).count() == ways[1].exceptAll(ways[0]).count() == 0


def test_measure_counts_text(spark):
    size = measure(spark.createDataFrame([("a" * 1000,), (None,)], "t string"))
    assert size.rows == 2
    assert 1000 < size.bytes < 1200


def test_unknown_null_rule(facts):
    with pytest.raises(ValueError):
        exclude_keys(facts, facts, "key", "drop")


def test_split_salted_equals_broadcast(transactions):
    first = train_validation_split(transactions, 604800)[1]
    second = train_validation_split(transactions, 604800, bound=NOTHING)[1]
    assert first.count() == 504
    assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0


def test_hash_split_ignores_partitioning(transactions):
    train, held_out = hash_split(transactions)
    moved, _ = hash_split(transactions.repartition(7))
    ids = lambda df: sorted(r[0] for r in df.select("TransactionID").collect())
    assert ids(train) == ids(moved)
    assert train.count() + held_out.count() == transactions.count()
    assert 0.7 < train.count() / transactions.count() < 0.9


def filtered(df, keys, on="key", **options):
    known = keys.where(F.col(on).isNotNull()).distinct()
    return joins.split_by_filter(df, known, on, measure(known), **options)


@pytest.mark.parametrize("most_words", [1, 8, 1 << 20])
@pytest.mark.parametrize("text", [False, True])
def test_filter_of_any_size_never_loses_a_key(spark, most_words, text):
    kind = "string" if text else "bigint"
    facts = spark.range(4000).select((F.col("id") % 1300).cast(kind).alias("key"), "id")
    facts = facts.unionAll(spark.sql(f"SELECT CAST(NULL AS {kind}), -1L"))
    keys = spark.range(0, 1300, 5).select(F.col("id").cast(kind).alias("key"))
    absent, rest = filtered(facts, keys, most_words=most_words)
    assert absent.columns == facts.columns
    assert absent.join(keys, "key").count() == 0
    assert absent.count() + rest.count() == 4001
    assert absent.where("key IS NULL").count() == 1
    if most_words > 1000:
        assert rest.join(keys, "key", "left_anti").count() < 0.05 * 4001


def test_filters_of_parts_merge(spark):
    keys = spark.range(1000).select(F.col("id").alias("key"))
    parts = [joins.key_filter(keys.where(f"key % 3 = {i}"), "key", 64) for i in range(3)]
    merged = parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("_word").agg(F.bit_or("_bits"))
    bits = lambda df: sorted(tuple(r) for r in df.collect())
    assert bits(merged) == bits(joins.key_filter(keys, "key", 64))


def test_no_filter_where_equal_keys_may_hash_apart(spark):
    numbers = spark.sql("SELECT DOUBLE(0.0) AS key UNION ALL SELECT DOUBLE(-0.0)")
    assert filtered(numbers, numbers) is None
    assert filtered(spark.range(3).toDF("key"), spark.range(3).select(F.col("id").cast("int").alias("key"))) is None
    kept = exclude_keys(numbers, numbers.limit(1), "key", bound=NOTHING, salt_by=["key"])
    assert kept.count() == 0


def test_rows_ruled_out_are_not_shuffled(spark):
    """The branch of absent keys has no exchange but the broadcast filter."""
    facts = spark.range(100_000).select((F.col("id") % 5000).alias("key"), "id")
    keys = spark.range(0, 5000, 50).select(F.col("id").alias("key"))
    absent, rest = filtered(facts, keys)
    plan = plan_of(absent)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rest.count() < 0.05 * 100_000
    whole = plan_of(exclude_keys(facts, keys, "key", bound=NOTHING, salt_by=["id"]))
    assert "Union" in whole and "_salt" in whole


def test_salts_without_an_identifier_are_stored(spark):
    """A shuffled input may come in another order when it is read again."""
    facts = spark.range(3000).select((F.col("id") % 3).alias("key")).repartition(5)
    names = spark.range(3).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    joined = joins._salted_join(facts, names, "key", "left", None, 100)
    plan = plan_of(joined)
    assert "monotonically_increasing_id" not in plan and "ExistingRDD" in plan
    assert joined.count() == 3000
