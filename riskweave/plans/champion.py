"""Champion against challenger on bootstrapped card precision."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions.expressions import positive_probability
from riskweave.operators.evaluation import auc_covariance, normal_two_sided, t_test_less
from riskweave.operators.ranking import bootstrap_precision, bootstrap_summary, top_k_cards
from riskweave.operators.split import train_validation_split
from riskweave.plans.pipelines import challenger_classifier
from riskweave.plans.training import fit_model
from riskweave.sources.runlog import RunLog
from riskweave.sources.tables import save_model
from riskweave.sources.workspace import settle


@dataclass(frozen=True)
class Decision:
    k: int
    champion_precision: float
    challenger_precision: float
    t: float
    p_value: float
    replace_champion: bool
    champion_auc: float | None = None
    challenger_auc: float | None = None
    auc_z: float | None = None
    auc_p_value: float | None = None


def decide(
    champion: DataFrame, challenger: DataFrame, k: int, p_threshold: float = 0.01
) -> Decision:
    """Replace the champion if its mean precision is significantly lower.

    Both samples are resamples made with one seed, counted as independent, so
    the p-value shrinks as iterations are added; use it with a fixed number.
    """
    column = f"precision_top_{k}"
    champion, challenger = settle(champion), settle(challenger)
    test = t_test_less(champion, challenger, column)
    means = [bootstrap_summary(s, column).first()["mean"] for s in (champion, challenger)]
    return Decision(k, *means, test.t, test.p_value, test.p_value < p_threshold)


def _scored_by_both(
    valid: DataFrame, champion: PipelineModel, challenger: PipelineModel
) -> DataFrame:
    """Card, label and the scores of both models, settled, as both comparisons read them."""
    raw = valid.withColumn("_raw", F.struct(*valid.columns))  # feature stages replace columns
    first = champion.transform(raw).select(
        "_raw.*", positive_probability(F.col("probability")).alias("_champion")
    )
    both = challenger.transform(first).select(
        S.CARD,
        S.LABEL,
        "_champion",
        positive_probability(F.col("probability")).alias("_challenger"),
    )
    return settle(both)


def _resampled(both: DataFrame, k: int, iterations: int, seed: int) -> list[DataFrame]:
    """Bootstrapped precision of both models, from one shuffle of the scored rows."""
    cards = settle(
        both.groupBy(S.CARD).agg(
            F.max("_champion").alias("_champion"),
            F.max("_challenger").alias("_challenger"),
            F.max(S.LABEL).alias("max_label"),
        )
    )
    return [
        bootstrap_precision(
            top_k_cards(cards.select(S.CARD, F.col(name).alias("max_score"), "max_label"), k),
            k,
            iterations,
            seed,
            f"precision_top_{k}",
        )
        for name in ("_champion", "_challenger")
    ]


def _samples(
    valid: DataFrame,
    champion: PipelineModel,
    challenger: PipelineModel,
    k: int,
    iterations: int,
    seed: int,
) -> list[DataFrame]:
    """Bootstrapped precision of both models on the same rows."""
    return _resampled(_scored_by_both(valid, champion, challenger), k, iterations, seed)


def run_champion_challenger(
    data: DataFrame,
    champion: PipelineModel,
    cutoff: int = S.TRAIN_SECONDS,
    k: int = 50,
    p_threshold: float = 0.01,
    iterations: int = 100,
    seed: int = 25,
    output_path: str | None = None,
    log: RunLog | None = None,
    challenger_trees=None,
    overwrite: bool = False,
    partitions: int | None = None,
) -> tuple[Decision, PipelineModel]:
    """Fit a challenger before the cutoff, compare both after it, save a winner.

    The decision follows the resampled precision. Beside it stands a paired comparison of
    both AUCs, which counts what the two models' scores of the same rows have in common.
    """
    columns = [f.name for f in S.TRANSACTION_SCHEMA.fields]
    train, valid = train_validation_split(data.select(*columns), cutoff)
    challenger = fit_model(train, challenger_trees or challenger_classifier(), partitions=partitions)
    scored = _scored_by_both(valid, champion, challenger)
    samples = _resampled(scored, k, iterations, seed)
    paired = auc_covariance(scored, "_champion", "_challenger").first()
    decision = replace(
        decide(*samples, k, p_threshold),
        champion_auc=paired["auc1"],
        challenger_auc=paired["auc2"],
        auc_z=paired["z"],
        auc_p_value=normal_two_sided(paired["z"]),
    )
    if log is not None:
        log.append("decision", asdict(decision))
    if decision.replace_champion and output_path is not None:
        save_model(challenger, output_path, overwrite)
        if log is not None:
            log.artifact("model", output_path)
    return decision, challenger
