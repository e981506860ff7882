"""Batch and streaming jobs, and their command line.

    python -m riskweave.plans.jobs build-features --data ... --model ... --features ...
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.split import without_denied
from riskweave.plans.champion import Decision, run_champion_challenger
from riskweave.plans.pipelines import gradient_boosted_trees
from riskweave.plans.training import (
    TuningResult,
    fit_features,
    log_tuning,
    parameter_grid,
    tune,
)
from riskweave.sources import kafka
from riskweave.sources.commits import commit_batch
from riskweave.sources.runlog import RunLog
from riskweave.sources.tables import (
    check_target,
    load_model,
    malformed,
    read_csv,
    read_csv_lines,
    read_table,
    read_transactions,
    save_model,
    well_formed,
    write_csv,
    write_parquet,
)
from riskweave.streaming.ingest import start_csv_ingest
from riskweave.streaming.publishing import MESSAGE_SCHEMA, first_of_each_origin
from riskweave.streaming.replay import replay
from riskweave.streaming.scoring import Traffic, start_scoring

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """Every job parameter; a job reads the ones it needs."""

    data: str = ""
    model: str = ""
    features: str = ""
    output: str = ""
    checkpoint: str = ""
    run_log: str = ""
    experiment: str = "card-fraud"
    partitions: int | None = None
    mode: str = "errorifexists"
    cutoff: int = S.TRAIN_SECONDS
    k_cards: int = 50
    p_value: float = 0.01
    iterations: int = 100
    val_frac: float = 0.2
    seed: int = 42
    parallelism: int = 2
    trials: str | None = None
    messages: int = 10
    servers: str = ""
    topic: str = ""
    results_topic: str = ""
    rejects: str = ""
    max_offsets: int | None = None
    kafka_options: tuple[str, ...] = ()
    kafka_properties: str = ""
    pattern: str = "*.csv"
    interval: str | None = None
    within: str = "1 day"
    archive: str | None = None
    delete_source: bool = False
    deny_table: str | None = None
    group_by: str = "Month"


def _log(spark: SparkSession, s: Settings) -> RunLog | None:
    return RunLog(spark, s.run_log, s.experiment) if s.run_log else None


_SECRET = ("password", "jaas", "secret", "token")


def _kafka_options(s: Settings) -> dict[str, str]:
    """Options of the command line over those of the properties file.

    Secrets belong in that file: a command line can be read by others.
    """
    found = dict(option.split("=", 1) for option in s.kafka_options)
    for key in found:
        if any(word in key.lower() for word in _SECRET):
            raise ValueError(f"put {key} into the file of --kafka-properties")
    if s.kafka_properties:
        with open(s.kafka_properties) as file:
            lines = [line.strip() for line in file]
        pairs = [line.split("=", 1) for line in lines if line and not line.startswith("#")]
        found = {key.strip(): value.strip() for key, value in pairs} | found
    return found


def missing_settings(job: str, s: Settings) -> list[str]:
    """Settings that a job needs and that are empty."""
    needed = list(REQUIRED[job])
    if job == "score-messages":
        needed += ["topic", "results_topic"] if s.servers else ["data", "output"]
    if job == "collect-results":
        needed += ["results_topic"] if s.servers else ["data"]
    if job == "replay-messages":
        needed += ["topic"] if s.servers else ["output"]
    return [name for name in needed if not getattr(s, name)]


def run_job(spark: SparkSession, job: str, s: Settings) -> object:
    missing = missing_settings(job, s)
    if missing:
        raise ValueError(f"{job} needs {', '.join(missing)}")
    return JOBS[job](spark, s)


def build_features(spark: SparkSession, s: Settings) -> None:
    """Fit the feature pipeline, save it, and write the training features."""
    for path in (s.model, s.features):
        check_target(spark, path, s.mode)
    data = read_transactions(spark, s.data)
    model = fit_features(data)
    save_model(model, s.model, s.mode == "overwrite")
    write_parquet(model.transform(data), s.features, s.mode, s.partitions)


def apply_features(spark: SparkSession, s: Settings) -> None:
    """Write the features of a data set with a saved pipeline."""
    check_target(spark, s.features, s.mode)
    data = read_transactions(spark, s.data)
    write_parquet(load_model(s.model).transform(data), s.features, s.mode, s.partitions)


def tune_model(spark: SparkSession, s: Settings) -> TuningResult:
    """Grid search; log the best parameters and AUC; save the refitted model."""
    check_target(spark, s.output, s.mode)
    data = read_transactions(spark, s.data)
    trees = gradient_boosted_trees()
    result = tune(
        data,
        trees,
        parameter_grid(trees),
        train_fraction=1 - s.val_frac,
        seed=s.seed,
        parallelism=s.parallelism,
        partitions=s.partitions,
        trials_path=s.trials,
    )
    for line in result.explained():
        logger.info(line)
    save_model(result.model, s.output, s.mode == "overwrite")
    log = _log(spark, s)
    if log is not None:
        log_tuning(result, data, log)
        log.artifact("model", s.output)
    return result


def compare_models(spark: SparkSession, s: Settings) -> Decision:
    """Fit a challenger and save it if it beats the saved champion."""
    check_target(spark, s.output, s.mode)
    decision, _ = run_champion_challenger(
        read_transactions(spark, s.data),
        load_model(s.model),
        s.cutoff,
        s.k_cards,
        s.p_value,
        s.iterations,
        output_path=s.output,
        log=_log(spark, s),
        overwrite=s.mode == "overwrite",
    )
    logger.info(decision)
    return decision


def count_rows(spark: SparkSession, s: Settings) -> int:
    n = read_transactions(spark, s.data).count()
    logger.info("rows: %d", n)
    return n


def count_by_group(spark: SparkSession, s: Settings) -> None:
    """Rows per value of a column, as CSV."""
    counts = spark.read.parquet(s.data).groupBy(s.group_by).count()
    write_csv(counts, s.output, s.mode, s.partitions)


def convert_csv(spark: SparkSession, s: Settings) -> None:
    """Sensor CSV files to Parquet, without the devices of an optional deny table.

    Malformed lines go to the folder ``rejects``; without one they are an error.
    """
    check_target(spark, s.output, s.mode)
    if s.rejects:
        check_target(spark, s.rejects, s.mode)
        lines = read_csv_lines(spark, s.data, S.SENSOR_SCHEMA)
        write_parquet(malformed(lines), s.rejects, s.mode)
        data = well_formed(lines)
    else:
        data = read_csv(spark, s.data, S.SENSOR_SCHEMA)
    if s.deny_table:
        data = without_denied(data, read_table(spark, s.deny_table))
    write_parquet(data, s.output, s.mode, s.partitions)


def ingest_csv(spark: SparkSession, s: Settings) -> None:
    """Convert arriving CSV files, once or continuously."""
    start_csv_ingest(
        spark,
        s.data,
        s.output,
        s.checkpoint,
        pattern=s.pattern,
        interval=s.interval,
        archive=s.archive,
        delete_source=s.delete_source,
        rejects=s.rejects or None,
    ).awaitTermination()


def score_messages(spark: SparkSession, s: Settings) -> None:
    """Score a Kafka topic into another, or a folder of text files into a folder.

    Unusable messages go to the folder ``rejects``. A folder is scored once
    unless ``interval`` says to keep waiting for files.
    """
    if s.servers:
        options = _kafka_options(s)
        messages = kafka.read_messages(spark, s.servers, s.topic, options, s.max_offsets)
        trigger = {"processingTime": s.interval or "1 second"}

        def write_results(batch: DataFrame, batch_id: int) -> None:
            kafka.write_messages(batch, s.servers, s.results_topic, options)

    else:
        messages = spark.readStream.text(s.data)
        trigger = {"processingTime": s.interval} if s.interval else {"availableNow": True}
        write_results = commit_batch(s.output)
    traffic = Traffic()
    query = start_scoring(
        messages,
        load_model(s.model),
        write_results,
        commit_batch(s.rejects),
        s.checkpoint,
        trigger,
        traffic,
    )
    try:
        query.awaitTermination()
    finally:
        logger.info("%s", traffic.final())


def collect_results(spark: SparkSession, s: Settings) -> None:
    """Store each result of a Kafka topic, or of a folder of messages, once.

    The first result of each origin within ``within`` is kept. A folder is read
    once unless ``interval`` says to keep waiting for files.
    """
    if s.servers:
        options = _kafka_options(s)
        messages = kafka.read_messages(spark, s.servers, s.results_topic, options, s.max_offsets)
        messages = messages.select("key", "value", "headers")
        trigger = {"processingTime": s.interval or "1 second"}
    else:
        messages = spark.readStream.schema(MESSAGE_SCHEMA).parquet(s.data)
        trigger = {"processingTime": s.interval} if s.interval else {"availableNow": True}
    (
        first_of_each_origin(messages, s.within)
        .writeStream.foreachBatch(commit_batch(s.output))
        .option("checkpointLocation", s.checkpoint)
        .trigger(**trigger)
        .start()
        .awaitTermination()
    )


def replay_messages(spark: SparkSession, s: Settings) -> None:
    """Send some transactions as scoring input to a Kafka topic or a folder of text files."""
    sent = replay(read_transactions(spark, s.data), s.messages, s.seed)
    if s.servers:
        kafka.write_messages(sent, s.servers, s.topic, _kafka_options(s))
    else:
        sent.select(F.col("value").cast("string")).write.mode("append").text(s.output)


JOBS: dict[str, Callable[[SparkSession, Settings], object]] = {
    f.__name__.replace("_", "-"): f
    for f in (
        build_features,
        apply_features,
        tune_model,
        compare_models,
        count_rows,
        count_by_group,
        convert_csv,
        ingest_csv,
        score_messages,
        collect_results,
        replay_messages,
    )
}

#: Settings each job cannot do without, whatever the others.
REQUIRED: dict[str, tuple[str, ...]] = {
    "build-features": ("data", "model", "features"),
    "apply-features": ("data", "model", "features"),
    "tune-model": ("data", "output"),
    "compare-models": ("data", "model", "output"),
    "count-rows": ("data",),
    "count-by-group": ("data", "output"),
    "convert-csv": ("data", "output"),
    "ingest-csv": ("data", "output", "checkpoint"),
    "score-messages": ("model", "rejects", "checkpoint"),
    "collect-results": ("output", "checkpoint"),
    "replay-messages": ("data",),
}

_TYPES = {"int": int, "int | None": int, "float": float}


def parse_arguments(arguments: list[str] | None = None) -> tuple[str, Settings]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    for f in fields(Settings):
        flag = "--" + f.name.replace("_", "-")
        if f.name == "kafka_options":
            parser.add_argument(flag, nargs="*", default=f.default, metavar="KEY=VALUE")
        elif f.type == "bool":
            parser.add_argument(flag, action="store_true")
        else:
            parser.add_argument(flag, type=_TYPES.get(f.type, str), default=f.default)
    values = vars(parser.parse_args(arguments))
    job = values.pop("job")
    values["kafka_options"] = tuple(values["kafka_options"])
    settings = Settings(**values)
    missing = ["--" + name.replace("_", "-") for name in missing_settings(job, settings)]
    if missing:
        parser.error(f"{job} needs {', '.join(missing)}")
    return job, settings


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    job, settings = parse_arguments(arguments)
    spark = SparkSession.builder.appName(f"riskweave {job}").getOrCreate()
    try:
        run_job(spark, job, settings)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
