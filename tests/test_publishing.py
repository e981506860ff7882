from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators.split import training_rows
from riskweave.plans import jobs, pipelines, training
from riskweave.sources.commits import commit_batch, read_committed
from riskweave.sources.tables import save_model
from riskweave.streaming import publishing, replay, scoring
from tests.plans import plan_of


def message(n, origin):
    headers = [("trace", b"x")] + ([("origin", origin.encode())] if origin else [])
    return (b"k", f"{n}".encode(), headers)


def sent(spark, *rows):
    return spark.createDataFrame(list(rows), publishing.MESSAGE_SCHEMA)


def collect(spark, folder, target, check, within="1 day"):
    stream = spark.readStream.schema(publishing.MESSAGE_SCHEMA).parquet(folder)
    once = publishing.first_of_each_origin(stream, within)
    query = (
        once.writeStream.foreachBatch(commit_batch(target))
        .option("checkpointLocation", check)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = read_committed(spark, target, once.schema).collect()
    return sorted((bytes(r["value"]).decode(), r["origin"]) for r in rows)


def test_repeats_go_within_and_across_runs(spark, tmp_path):
    folder, target, check = (str(tmp_path / name) for name in ("sent", "kept", "check"))
    first = [message(1, "t/0/1"), message(1, "t/0/1"), message(2, "t/1/1"), message(9, None)]
    sent(spark, *first).write.parquet(folder)
    assert collect(spark, folder, target, check) == [
        ("1", "t/0/1"), ("2", "t/1/1"), ("9", None)
    ]
    later = [message(1, "t/0/1"), message(2, "t/1/1"), message(3, "t/0/2"), message(9, None)]
    sent(spark, *later).write.mode("append").parquet(folder)
    assert collect(spark, folder, target, check) == [
        ("1", "t/0/1"), ("2", "t/1/1"), ("3", "t/0/2"), ("9", None), ("9", None)
    ]


def test_batch_form_and_missing_headers(spark):
    rows = sent(spark, message(1, "t/0/1"), message(1, "t/0/1"), (b"k", b"7", None), (b"k", b"7", []))
    kept = publishing.first_of_each_origin(rows).collect()
    assert sorted(bytes(r["value"]) for r in kept) == [b"1", b"7", b"7"]
    assert publishing.first_of_each_origin(rows.limit(0)).collect() == []


def test_origins_are_places(spark):
    rows = spark.createDataFrame(
        [("t", 0, 5), ("t", None, 5), (None, 1, 1)], "topic string, partition int, offset bigint"
    )
    found = rows.select(publishing.place(rows).alias("o")).collect()
    assert [r["o"] for r in found] == ["t/0/5", None, None]
    headers = rows.select(publishing.origin_headers(publishing.place(rows)).alias("h"))
    assert [r[0] for r in headers.select(publishing.origin_of(F.col("h"))).collect()] == [
        "t/0/5", None, None
    ]


@pytest.fixture(scope="module")
def model(transactions):
    trees = pipelines.gradient_boosted_trees(maxIter=2, maxDepth=2)
    return training.fit_model(training_rows(transactions, 604800), trees)


def test_scored_batch_sent_twice_is_stored_once(spark, transactions, model, tmp_path):
    """The sender dies after sending a batch and before noting it, so the batch is sent again."""
    incoming, results = str(tmp_path / "incoming"), str(tmp_path / "results")
    numbered = replay.to_messages(transactions).select(
        "value",
        F.lit("in").alias("topic"),
        (F.xxhash64("value") % 4).cast("int").alias("partition"),
        F.xxhash64("value").alias("offset"),
    )
    numbered.write.parquet(incoming)
    died = []

    def send(batch, batch_id):
        batch.write.mode("append").parquet(results)
        if not died:
            died.append(batch_id)
            raise RuntimeError("after sending")

    def run():
        messages = spark.readStream.schema(numbered.schema).parquet(incoming)
        query = scoring.start_scoring(
            messages, model, send, lambda *_: None, str(tmp_path / "check"), {"availableNow": True}
        )
        query.awaitTermination()

    with pytest.raises(Exception, match="after sending"):
        run()
    run()
    n = transactions.count()
    assert spark.read.parquet(results).count() == 2 * n
    settings = ["--data", results, "--output", str(tmp_path / "kept")]
    job, s = jobs.parse_arguments(["collect-results", *settings, "--checkpoint", str(tmp_path / "c")])
    jobs.run_job(spark, job, s)
    jobs.run_job(spark, job, s)
    schema = publishing.first_of_each_origin(spark.read.parquet(results)).schema
    kept = read_committed(spark, str(tmp_path / "kept"), schema)
    assert (kept.count(), kept.select("origin").distinct().count()) == (n, n)


def test_counts_take_no_job_of_their_own(spark, transactions, model, tmp_path):
    incoming = str(tmp_path / "incoming")
    bad = spark.createDataFrame([("broken",)] * 3, "value string")
    replay.to_messages(transactions.limit(50)).select("value").unionByName(bad).write.parquet(incoming)

    def jobs_of(name, traffic):
        query = scoring.start_scoring(
            spark.readStream.schema("value string").parquet(incoming),
            model,
            commit_batch(str(tmp_path / name)),
            commit_batch(str(tmp_path / f"{name}-rejects")),
            str(tmp_path / f"{name}-check"),
            {"availableNow": True},
            traffic,
        )
        query.awaitTermination()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))

    traffic = scoring.Traffic()
    counted = jobs_of("counted", traffic)
    assert traffic.final() == scoring.Traffic(received=53, sent=50, rejected=3)
    assert counted == jobs_of("plain", None) > 0


def test_score_messages_job_reports_its_traffic(spark, transactions, model, tmp_path, caplog):
    save_model(model, str(tmp_path / "model"))
    lines = replay.to_messages(transactions.limit(20)).select(F.col("value").cast("string"))
    lines.write.text(str(tmp_path / "in"))
    names = {"data": "in", "model": "model", "output": "out", "rejects": "bad", "checkpoint": "c"}
    arguments = [x for k, v in names.items() for x in (f"--{k}", str(tmp_path / v))]
    with caplog.at_level("INFO", logger="riskweave.plans.jobs"):
        jobs.run_job(spark, *jobs.parse_arguments(["score-messages", *arguments]))
    assert "received=20, sent=20, rejected=0" in caplog.text


def test_state_is_spread_by_origin(spark, tmp_path):
    sent(spark, message(1, "t/0/1")).write.parquet(str(tmp_path / "sent"))
    batch = publishing.first_of_each_origin(spark.read.parquet(str(tmp_path / "sent")))
    assert "hashpartitioning(origin" in plan_of(batch)
