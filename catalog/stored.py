"""What the writers leave behind, read back."""

from pyspark.sql import functions as F

from catalog.churn import _CURRENT_SCORES, _TRAINING, features_of, scores_of
from catalog.registry import query
from catalog.sql import (
    ACTIVATION,
    ACTIVITY,
    ADOPTION,
    COHORTS,
    DIM_ACCOUNT,
    LOGO_CHURN,
    REVENUE,
    SEGMENTS,
    chain,
)
from catalog.stream import _MESSAGES, arrive, ingest, new_folder, read_files
from subsight import schemas
from subsight.operators.scoring import in_rank_order
from subsight.plans import marts as pl
from subsight.sinks import tables as sinks
from subsight.streaming import contract as ct
from subsight.streaming import ingest as ing


def _stored_marts(d):
    staged = pl.Staged(d.accounts, d.users, d.subscriptions, d.invoices, d.events)
    folder = new_folder(d.spark, "marts")
    stored, usage = pl.materialise_events(staged, folder)
    return pl.build_marts(stored, usage)


_MODEL_SIZES = {
    "dim_account": "dim_account",
    "fact_subscriptions": "subscriptions",
    "mart_activation": "activation",
    "mart_feature_adoption": "adoption",
    "mart_account_activity": "activity",
    "fact_product_events": "product_events",
    "mart_retention_cohorts": "cohorts",
    "mart_logo_churn": "logo",
    "mart_revenue_churn": "revenue_lost",
    "mart_revenue_retention": "revenue_kept",
    "mart_retention_segments": "segments",
}


@query(
    "export_bundle",
    " UNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS row_count FROM {v}" for m, v in _MODEL_SIZES.items())
    + """ UNION ALL SELECT 'mart_retention_behavior', count(DISTINCT kept) FROM paid""",
    chain(ACTIVATION, ACTIVITY, ADOPTION, DIM_ACCOUNT, COHORTS, LOGO_CHURN, REVENUE, SEGMENTS),
)
def _(d):
    """All reporting models built from the stored roll-up, written and counted."""
    paths = sinks.export_bundle(_stored_marts(d), pl.REQUIRED_MODELS, new_folder(d.spark, "bundle"))
    result = None
    for name, path in paths.items():
        row = d.spark.read.parquet(path).agg(F.count("*").alias("row_count")).withColumn("model", F.lit(name))
        result = row if result is None else result.unionByName(row)
    return result


@query("load_models", "SELECT * FROM logo ORDER BY month", LOGO_CHURN)
def _(d):
    """One of the reporting models in its fixed order, from the stored roll-up."""
    return pl.load_models(_stored_marts(d))["mart_logo_churn"]


@query(
    "export_training_set",
    "SELECT prediction_date, account_id, event_change_pct, seat_utilization, monthly_revenue, churn_label FROM features",
    _TRAINING,
)
def _(d):
    path = new_folder(d.spark, "training")
    sinks.export_training_set(features_of(d), path)
    return d.spark.read.parquet(path).select(
        "prediction_date", "account_id", "event_change_pct", "seat_utilization", "monthly_revenue", "churn_label"
    )


@query("write_scores", "SELECT * FROM scores", _CURRENT_SCORES)
def _(d):
    path = new_folder(d.spark, "scores")
    sinks.write_scores(scores_of(d), path)
    return in_rank_order(d.spark.read.parquet(path))


@query(
    "stream_dedup_with_state",
    "SELECT id AS event_id FROM sent WHERE event_id % 50 <> 7",
    _MESSAGES,
)
def _(d):
    """Dedup of contract-valid messages inside a streaming query."""
    source, target = new_folder(d.spark, "messages"), new_folder(d.spark, "unique")
    stream = read_files(d.spark, source, arrive(d.messages, source, 2))
    valid = ct.validate_contract(stream).where("reason is null")
    running = (
        ing.dedup_with_state(valid)
        .select("event_id")
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return d.spark.read.schema("event_id string").parquet(target)


@query(
    "stream_batches",
    """SELECT count(*) AS received, count(*) FILTER (reason IS NULL AND kafka_offset % 2 = 0) AS first_deliveries
       FROM deliveries""",
    _MESSAGES,
)
def _(d):
    """Counters of all micro-batches of an ingestion limited per trigger."""
    counters = d.spark.read.schema(schemas.STREAM_COUNTERS).parquet(ingest(d).counters)
    return counters.agg(F.sum("received").alias("received"), F.sum("persisted").alias("first_deliveries"))
