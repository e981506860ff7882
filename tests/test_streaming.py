from __future__ import annotations

import json

import pytest

from riskweave import schema as S
from riskweave.operators.split import training_rows
from riskweave.plans import pipelines, training
from riskweave.streaming import ingest, replay, scoring
from tests.plans import plan_of

GOOD = {
    "ts": "2022-09-06T08:48:38.773",
    "card_id": 7,
    "features": json.dumps(
        {"TransactionID": {"0": 9}, "card1": {"0": 7.0}, "V26": {"0": None}, "V183": {"0": 2}}
    ),
}


def parse(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return scoring.parse_messages(df).collect()


def test_good_message(spark):
    (row,) = parse(spark, json.dumps(GOOD))
    assert row["reject_reason"] is None
    assert (row["ts"], row["card_id"]) == (GOOD["ts"], 7)
    assert (row["TransactionID"], row["card1"], row["V183"]) == (9, 7, 2.0)
    assert row["V26"] is None and row["C7"] is None


@pytest.mark.parametrize(
    "text,reason",
    [
        ("not json", scoring.BAD_ENVELOPE),
        ("", scoring.BAD_ENVELOPE),
        (None, scoring.BAD_ENVELOPE),
        (json.dumps(GOOD)[:-4], scoring.BAD_ENVELOPE),
        (json.dumps({**GOOD, "card_id": "seven"}), scoring.BAD_ENVELOPE),
        (json.dumps({"ts": "x", "card_id": 1}), scoring.NO_FEATURES),
        ("{}", scoring.NO_FEATURES),
        (json.dumps({**GOOD, "features": "V26"}), scoring.BAD_FEATURES),
        (json.dumps({**GOOD, "features": '{"V26": {"0": "x"}}'}), scoring.BAD_FEATURES),
        (json.dumps({**GOOD, "features": '{"V26": 1.0}'}), scoring.BAD_FEATURES),
        (json.dumps({**GOOD, "features": '{"card1": {"0": 1e20}}'}), scoring.BAD_VALUE),
        (json.dumps({**GOOD, "features": '{"TransactionID": {"0": 9.7}}'}), scoring.BAD_VALUE),
        (json.dumps({**GOOD, "features": '{"TransactionID": {"0": null}}'}), scoring.MISSING_ID),
        (json.dumps({**GOOD, "features": '{"V26": {"0": 1}}'}), scoring.MISSING_ID),
        (json.dumps({**GOOD, "features": "{}"}), scoring.NO_ROW),
        (json.dumps({**GOOD, "features": '{"TransactionID": {}}'}), scoring.NO_ROW),
        (
            json.dumps({**GOOD, "features": '{"TransactionID": {"0": 1, "1": 2}}'}),
            scoring.SEVERAL_ROWS,
        ),
        (
            json.dumps({**GOOD, "features": '{"TransactionID": {"0": 1}, "V26": {"1": 2}}'}),
            scoring.SEVERAL_ROWS,
        ),
    ],
)
def test_bad_messages(spark, text, reason):
    (row,) = parse(spark, text)
    assert row["reject_reason"] == reason
    assert row["value"] == text


def test_any_row_key_will_do(spark):
    text = json.dumps({**GOOD, "features": '{"TransactionID": {"5": 9}, "card1": {"5": 7.0}}'})
    (row,) = parse(spark, text)
    assert (row["reject_reason"], row["TransactionID"], row["card1"]) == (None, 9, 7)


def test_large_identifiers_keep_all_digits(spark):
    text = json.dumps({**GOOD, "features": '{"TransactionID": {"0": 9007199254740993}}'})
    assert parse(spark, text)[0]["TransactionID"] == 9007199254740993


def test_json_is_parsed_once(spark, transactions):
    usable = scoring.usable(scoring.parse_messages(replay.to_messages(transactions)))
    assert plan_of(usable).count("from_json") == 2


def test_message_layout(transactions):
    (row,) = replay.replay(transactions, 1).collect()
    message = json.loads(row["value"])
    assert set(message) == {"ts", "card_id", "features"}
    cells = json.loads(message["features"])
    assert set(cells) == {f.name for f in S.SCORING_SCHEMA.fields}
    assert cells["card1"] == {"0": message["card_id"]}
    assert bytes(row["key"]).decode("ascii") == str(message["card_id"])


def test_replay_picks_the_least_hashes(spark, transactions):
    order = [replay.seeded_hash(42, replay.F.col(S.TRANSACTION_ID)), S.TRANSACTION_ID]
    ranked = [r[0] for r in transactions.orderBy(*order).select(S.TRANSACTION_ID).collect()]
    ids = lambda df: sorted(r[0] for r in df.select(S.TRANSACTION_ID).collect())
    for n in (0, 1, 10, 700, 1000, 5000):
        assert ids(replay.pick_rows(transactions, n)) == sorted(ranked[:n])
    again = transactions.union(transactions)
    assert ids(replay.pick_rows(again, 7)) == sorted(sorted(ranked[:4] * 2, key=ranked.index)[:7])
    plan = plan_of(replay.pick_rows(transactions, 700))
    assert "TakeOrderedAndProject" in plan and "Filter" in plan  # ties only are ordered


def test_replay_is_repeatable(transactions):
    pick = lambda df: sorted(r[0] for r in replay.pick_rows(df, 10).select(S.TRANSACTION_ID).collect())
    assert pick(transactions) == pick(transactions.repartition(5))


@pytest.fixture(scope="module")
def model(transactions):
    trees = pipelines.gradient_boosted_trees(maxIter=3, maxDepth=3)
    return training.fit_model(training_rows(transactions, 604800), trees)


def test_stream_scores_equal_batch_scores(spark, transactions, model, tmp_path):
    incoming = str(tmp_path / "incoming")
    bad = spark.createDataFrame([("broken",)], "value string")
    good = replay.to_messages(transactions).select("value")
    good.unionByName(bad).repartition(6).write.parquet(incoming)
    messages = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).parquet(incoming)
    )
    traffic = scoring.Traffic()
    query = scoring.start_scoring(
        messages,
        model,
        scoring.replace_batch(str(tmp_path / "results")),
        scoring.replace_batch(str(tmp_path / "rejects")),
        str(tmp_path / "checkpoint"),
        {"availableNow": True},
        traffic,
    )
    query.awaitTermination()
    n = transactions.count()
    assert traffic.final() == scoring.Traffic(received=n + 1, sent=n, rejected=1)
    assert scoring.received_messages(query.recentProgress) == transactions.count() + 1

    sent = spark.read.parquet(str(tmp_path / "results"))
    assert sent.select("batch").distinct().count() == 3
    found = {}
    for row in sent.collect():
        message = json.loads(row["value"])
        result = json.loads(message["result"])
        assert set(result) == {"TransactionID", "card1", "probability_"}
        assert bytes(row["key"]).decode("ascii") == str(message["card_id"]) == str(result["card1"])
        found[result["TransactionID"]] = result["probability_"]
    batch = scoring.score_rows(transactions, model).collect()
    assert found == pytest.approx({r["TransactionID"]: r["probability_"] for r in batch})

    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r["value"], r["reject_reason"]) for r in rejects] == [("broken", "bad_envelope")]


def test_score_stream_returns_its_rejects(spark, transactions, model):
    messages = replay.to_messages(transactions.limit(20)).select("value")
    broken = spark.createDataFrame([("broken",)], "value string")
    results, rejects = scoring.score_stream(messages.union(broken), model)
    assert results.count() == 20
    assert [r["value"] for r in rejects.collect()] == ["broken"]


def write_csv(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("device_id,ts,value\n" + "".join(f"{r}\n" for r in rows))


def test_ingest_converts_each_file_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")

    def run():
        ingest.start_csv_ingest(
            spark, str(source), target, str(tmp_path / "check"), pattern="sensors-*.csv"
        ).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(target).drop("batch").collect())

    write_csv(source, "sensors-1.csv", "1,a,0.5", "2,b,")
    write_csv(source, "other.csv", "9,z,9.0")
    assert run() == [(1, "a", 0.5), (2, "b", None)]
    write_csv(source, "sensors-2.csv", "3,c,1.5")
    assert [r[0] for r in run()] == [1, 2, 3]
    assert [r[0] for r in run()] == [1, 2, 3]


def test_ingest_with_archive_loses_nothing(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for n in range(3):
        write_csv(source, f"sensors-{n}.csv", f"{n},a,1.0")
        ingest.start_csv_ingest(
            spark, str(source), target, str(tmp_path / "check"), archive=str(tmp_path / "done")
        ).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [0, 1, 2]


def test_ingest_cleans_one_way_only(spark):
    with pytest.raises(ValueError):
        ingest.start_csv_ingest(spark, "a", "b", "c", archive="d", delete_source=True)


def test_result_keeps_null_fields(spark):
    df = spark.createDataFrame(
        [(1, None, 0.5)], "TransactionID bigint, card1 bigint, probability_ double"
    )
    (row,) = scoring.result_messages(df).collect()
    message = json.loads(row["value"])
    assert row["key"] is None and message["card_id"] is None
    assert json.loads(message["result"]) == {"TransactionID": 1, "card1": None, "probability_": 0.5}
