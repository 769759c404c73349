"""Training run: models, metrics, importances and periods, stored for later runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.operators.evaluation import split_periods, temporal_split
from subsight.operators.models import permutation_importance, predict, run_metrics_table, train_and_compare
from subsight.sinks.tables import append_run_metrics, replace_table


def train_and_store(
    features: DataFrame, folder: str, run_id: str, tree_iterations: int = 200, repeats: int = 20
) -> str:
    """Train both models and keep everything a later run or a reader needs.

    Under ``folder``: ``models/<run>`` with a saved pipeline per model,
    ``results/<run>`` (metrics by model and split), ``choice/<run>``,
    ``periods/<run>`` (rows and dates of the splits), ``importance/<run>`` of the
    chosen model on the test date, and ``metrics``, to which the run's metrics are
    appended in long form.  Returns the name of the chosen model.
    """
    fitted, results, choice = train_and_compare(features, tree_iterations)
    for name, model in fitted.items():
        model.write().overwrite().save(f"{folder}/models/{run_id}/{name}")
    replace_table(results, f"{folder}/results/{run_id}")
    replace_table(choice, f"{folder}/choice/{run_id}")
    replace_table(split_periods(features), f"{folder}/periods/{run_id}")
    chosen = choice.first()["selected_model"]
    importance = permutation_importance(fitted[chosen], temporal_split(features)[2], repeats)
    replace_table(importance.withColumn("model", F.lit(chosen)), f"{folder}/importance/{run_id}")
    append_run_metrics(run_metrics_table(results, run_id), f"{folder}/metrics")
    return chosen


def stored_scorer(spark: SparkSession, folder: str, run_id: str) -> Callable[[DataFrame], DataFrame]:
    """The chosen model of a stored run, as the daily run takes it."""
    chosen = spark.read.parquet(f"{folder}/choice/{run_id}").first()["selected_model"]
    model = PipelineModel.load(f"{folder}/models/{run_id}/{chosen}")
    return lambda features: predict(model, features)
