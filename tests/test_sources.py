from __future__ import annotations

import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.split import compromised_cards, training_rows
from riskweave.plans import jobs
from riskweave.plans.pipelines import gradient_boosted_trees
from riskweave.plans.training import parameter_grid
from riskweave.sources import tables, workspace
from riskweave.sources.runlog import RunLog, read_run_log
from tests.plans import plan_of


@pytest.fixture(scope="module")
def stored(transactions, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "transactions")
    tables.write_parquet(transactions, path)
    return path


def test_malformed_paths_are_refused():
    for path in ("s3a//bucket/key", "hdfs//host/x"):
        with pytest.raises(ValueError):
            tables.checked_path(path)
    for path in ("s3a://bucket/key", "/a//b", "a/b", "file:///x", "data//x/y", "hdfs:///tmp"):
        if path != "data//x/y":
            assert tables.checked_path(path) == path


def test_writing_twice_needs_a_mode(transactions, stored):
    with pytest.raises(Exception, match="already exists"):
        tables.write_parquet(transactions, stored)


def test_requested_partitions(transactions, tmp_path):
    path = str(tmp_path / "four")
    tables.write_parquet(transactions, path, partitions=4)
    assert len(list((tmp_path / "four").glob("part-*"))) == 4
    days = str(tmp_path / "days")
    by_day = transactions.withColumn("day", F.floor(F.col(S.TIME) / 86400))
    tables.write_parquet(by_day, days, partition_by=["day"])
    assert all(len(list(d.glob("part-*"))) == 1 for d in (tmp_path / "days").glob("day=*"))
    plan = plan_of(transactions.sparkSession.read.parquet(days).where("day = 3"))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_filters_and_columns_reach_the_scan(spark, stored):
    plan = plan_of(compromised_cards(training_rows(tables.read_transactions(spark, stored), 100)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "LessThan(TransactionDT,100)" in pushed and "EqualTo(isFraud,1)" in pushed
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert columns.count(":") == 3


def test_csv_header_is_not_data(spark, tmp_path):
    (tmp_path / "s-1.csv").write_text("device_id,ts,value\n1,a,0.5\n")
    (tmp_path / "s-2.csv").write_text("device_id,ts,value\n2,b,\n")
    df = tables.read_csv(spark, str(tmp_path / "s-*.csv"), S.SENSOR_SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", 0.5), (2, "b", None)]


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for name in ("first", "second"):
        log = RunLog(spark, path, name)
        log.params({"maxDepth": 6})
        log.metrics({"auc": 0.75})
        log.artifact("model", "/m")
    rows = read_run_log(spark, path)
    assert rows.count() == 8
    assert rows.select("run_id").distinct().count() == 2
    assert rows.where("ts IS NULL").count() == 0


def test_checkpoint_root_is_the_configured_folder(spark):
    assert workspace.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(workspace.checkpoint_root(spark))


class _ClusterContext:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class _ClusterSession:
    class conf:
        get = staticmethod(lambda name, default=None: default)

    sparkContext = _ClusterContext()


def test_a_cluster_gets_no_local_folder():
    with pytest.raises(RuntimeError):
        workspace.checkpoint_root(_ClusterSession())


def run(spark, *arguments):
    job, settings = jobs.parse_arguments(list(arguments))
    return jobs.run_job(spark, job, settings)


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_jobs_refuse_missing_settings(spark, job, capsys):
    with pytest.raises(SystemExit):
        jobs.parse_arguments([job])
    assert "needs --" in capsys.readouterr().err
    with pytest.raises(ValueError):
        jobs.run_job(spark, job, jobs.Settings())


def test_secrets_come_from_a_file(tmp_path):
    path = tmp_path / "kafka.properties"
    path.write_text("# broker\nkafka.sasl.password = a=b\n\nx=1\n")
    settings = jobs.Settings(kafka_options=("x=2",), kafka_properties=str(path))
    assert jobs._kafka_options(settings) == {"kafka.sasl.password": "a=b", "x": "2"}
    with pytest.raises(ValueError):
        jobs._kafka_options(jobs.Settings(kafka_options=("kafka.sasl.password=b",)))


def test_outputs_are_checked_first_and_overwritten_on_demand(spark, stored, tmp_path):
    model, train = str(tmp_path / "model"), str(tmp_path / "train")
    arguments = ["build-features", "--data", stored, "--model", model, "--features", train]
    run(spark, *arguments)
    with pytest.raises(FileExistsError):
        run(spark, *arguments)
    run(spark, *arguments, "--mode", "overwrite")
    for job in ("tune-model", "compare-models"):
        with pytest.raises(FileExistsError):
            run(spark, job, "--data", "nowhere", "--model", "nowhere", "--output", train)
    with pytest.raises(ValueError):
        run(spark, "tune-model", "--data", stored, "--output", "s3a//lost/colon")


def test_feature_jobs(spark, stored, tmp_path):
    model, train, test = (str(tmp_path / n) for n in ("model", "train", "test"))
    run(spark, "build-features", "--data", stored, "--model", model, "--features", train)
    run(spark, "apply-features", "--data", stored, "--model", model, "--features", test)
    first, second = (spark.read.parquet(p) for p in (train, test))
    assert first.count() == second.count() == 1000
    assert "features" in first.columns
    joined = first.join(second, S.TRANSACTION_ID).where(first.features != second.features)
    assert joined.count() == 0


def test_count_jobs(spark, stored, sf_dir, tmp_path):
    assert run(spark, "count-rows", "--data", stored) == 1000
    out = str(tmp_path / "counts")
    run(spark, "count-by-group", "--data", stored, "--group-by", "isFraud", "--output", out)
    counts = spark.read.csv(out, header=True)
    assert {r["isFraud"]: r["count"] for r in counts.collect()} == {"0": "986", "1": "14"}


def test_convert_job_with_deny_table(spark, tmp_path):
    (tmp_path / "s-1.csv").write_text("device_id,ts,value\n1,a,0.5\n2,b,1.0\n,c,2.0\n")
    spark.createDataFrame([(2,)], "device_id bigint").createOrReplaceTempView("denied_devices")
    out = str(tmp_path / "out")
    run(
        spark, "convert-csv", "--data", str(tmp_path / "s-*.csv"), "--output", out,
        "--deny-table", "denied_devices",
    )
    found = {r["device_id"] for r in spark.read.parquet(out).collect()}
    assert found == {1, None}


def test_ingest_job(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "s.csv").write_text("device_id,ts,value\n1,a,0.5\n")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run(spark, "ingest-csv", "--data", str(source), "--output", out, "--checkpoint", check)
    assert spark.read.parquet(out).count() == 1


def test_malformed_lines(spark, tmp_path):
    """Batch and stream agree on headers and on lines that do not fit."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "s.csv").write_text("device_id,ts,value\n1,a,0.5\nxx,b,1.0\n2,c,1.0,9\n3,d\n4,e,\n")
    at = {n: str(tmp_path / n) for n in ("out", "bad", "out2", "bad2", "check", "check2", "out3")}
    run(spark, "convert-csv", "--data", str(source), "--output", at["out"], "--rejects", at["bad"])
    ingest_to = ["ingest-csv", "--data", str(source), "--checkpoint"]
    run(spark, *ingest_to, at["check"], "--output", at["out2"], "--rejects", at["bad2"])
    for out, bad in (("out", "bad"), ("out2", "bad2")):
        rows = spark.read.parquet(at[out]).collect()
        assert sorted((r["device_id"], r["value"]) for r in rows) == [(1, 0.5), (4, None)]
        lines = {r[tables.RECORD] for r in spark.read.parquet(at[bad]).collect()}
        assert lines == {"xx,b,1.0", "2,c,1.0,9", "3,d"}
    with pytest.raises(Exception):  # noqa: B017
        tables.read_csv(spark, str(source), S.SENSOR_SCHEMA).collect()
    with pytest.raises(Exception):  # noqa: B017
        run(spark, *ingest_to, at["check2"], "--output", at["out3"])


def test_other_header_is_refused(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "s.csv").write_text("value,device_id,ts\n5,7,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv_lines(spark, str(source), S.SENSOR_SCHEMA).collect()
    with pytest.raises(Exception, match="(?i)header"):
        run(
            spark, "ingest-csv", "--data", str(source), "--output", str(tmp_path / "out"),
            "--checkpoint", str(tmp_path / "check"), "--rejects", str(tmp_path / "bad"),
        )


def test_ingest_job_deletes_what_it_converted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    arguments = [
        "ingest-csv", "--data", str(source), "--output", str(tmp_path / "out"),
        "--checkpoint", str(tmp_path / "check"), "--delete-source",
    ]
    for n in range(3):  # cleaning lags behind by a batch
        (source / f"s{n}.csv").write_text(f"device_id,ts,value\n{n},a,0.5\n")
        run(spark, *arguments)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert not (source / "s0.csv").exists()


def test_model_jobs_end_to_end(spark, stored, tmp_path, monkeypatch):
    """Tune, contest, replay and score through files."""
    monkeypatch.setattr(jobs, "parameter_grid", lambda trees: parameter_grid(trees, [2], [15]))
    small = partial(gradient_boosted_trees, maxIter=2)
    monkeypatch.setattr(jobs, "gradient_boosted_trees", small)
    at = {n: str(tmp_path / n) for n in ("model", "better", "log", "in", "out", "bad", "check")}
    run(spark, "tune-model", "--data", stored, "--output", at["model"], "--run-log", at["log"])
    decision = run(
        spark, "compare-models", "--data", stored, "--model", at["model"], "--output",
        at["better"], "--run-log", at["log"], "--cutoff", "604800", "--k-cards", "5",
    )
    assert decision.k == 5
    kinds = {r["kind"] for r in read_run_log(spark, at["log"]).collect()}
    assert kinds >= {"experiment", "param", "metric", "artifact", "decision"}

    run(spark, "replay-messages", "--data", stored, "--output", at["in"], "--messages", "25")
    run(
        spark, "score-messages", "--data", at["in"], "--model", at["model"], "--output", at["out"],
        "--rejects", at["bad"], "--checkpoint", at["check"],
    )
    assert spark.read.parquet(at["out"]).count() == 25


def test_arguments():
    job, settings = jobs.parse_arguments(
        [
            "score-messages", "--servers", "h:1", "--kafka-options", "a=b", "c=d=e", "--k-cards", "9",
            "--topic", "t", "--results-topic", "r", "--model", "m", "--rejects", "x", "--checkpoint", "c",
        ]
    )
    assert job == "score-messages"
    assert jobs._kafka_options(settings) == {"a": "b", "c": "d=e"}
    assert settings.k_cards == 9 and settings.p_value == 0.01 and settings.partitions is None
