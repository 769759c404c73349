"""Skewed inputs give exact results, and plans keep the shapes that scale."""

import pytest
from tables import day, one, rows

from pyspark.sql import functions as F

from catalog import load
from subsight import schemas
from subsight.functions.ranking import running_totals
from subsight.operators import activity as usage
from subsight.operators import evaluation as ev
from subsight.operators.activation import account_activation
from subsight.operators.retention import retention_cohorts
from subsight.operators.usage import daily_usage
from subsight.sources.events import stg_events

SF = "/root/testdata/sf0.001"
N = 60_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one event, a third belong to one account."""
    i = F.col("id")
    hot_copy, hot_account = i % 3 == 0, i % 3 == 1
    return spark.range(N).select(
        F.when(hot_copy, "copy").otherwise(F.concat(F.lit("E"), i.cast("string"))).alias("event_id"),
        F.when(hot_copy, "A1").when(hot_account, "HOT").otherwise(F.concat(F.lit("A"), (i % 500).cast("string"))).alias("account_id"),
        F.concat(F.lit("U"), (i % 1000).cast("string")).alias("user_id"),
        F.when(i % 2 == 0, "report_created").otherwise("invite_sent").alias("event_name"),
        (F.lit("2024-03-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=(i % 40000).cast("int"))).alias("event_timestamp"),
        F.lit(1).alias("event_version"),
    )


def test_dedup_limits_copies_before_the_shuffle(skewed):
    events = stg_events(skewed)
    text = plan(events)
    partial = [line for line in text.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial, text
    assert events.count() == N - N // 3 + 1
    kept = one(events.where("event_id = 'copy'"))
    assert kept["event_timestamp"].isoformat() == "2024-03-01T00:00:00" and kept["user_id"] == "U0"


def test_hot_account(spark, build, skewed):
    events = stg_events(skewed)
    accounts = build.accounts(
        dict(account_id="HOT", trial_start_date=day("2024-03-01")), dict(account_id="A1"), dict(account_id="NONE")
    )
    for source in (events, daily_usage(events)):
        found = {r["account_id"]: r for r in usage.account_activity(accounts, build.users(), source).collect()}
        assert found["HOT"]["total_events"] == N // 3
        assert found["HOT"]["number_of_active_users"] == len({i % 1000 for i in range(1, N, 3)})
        assert found["HOT"]["report_created_count"] == sum(1 for i in range(1, N, 3) if i % 2 == 0)
        assert found["NONE"]["total_events"] == 0
        assert one(account_activation(accounts, source).where("account_id = 'HOT'"))["is_activated"] is False
        weeks = rows(retention_cohorts(accounts.where("account_id = 'HOT'"), source), "weeks_since_start", "retained_accounts")
        assert weeks[0] == (0, 1) and all(kept == 1 for _, kept in weeks)


def test_running_totals_split_tied_groups(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") % 97) / 97.0).alias("score"),
        F.col("id"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_totals(frame, [F.col("score").desc(), F.col("id").asc()], {"position": "one"})
    expected = sorted(((-(0.5 if i % 3 == 0 else (i % 97) / 97.0), i) for i in range(30_000)))
    found = {r["id"]: r["position"] for r in placed.collect()}
    assert all(found[i] == place for place, (_, i) in enumerate(expected, start=1))


def test_lift_with_most_rows_tied(spark):
    frame = spark.range(10_000).select(
        F.format_string("%05d", "id").alias("account_id"),
        F.when(F.col("id") < 500, 0.9).otherwise(0.5).alias("churn_probability"),
        (F.col("id") % 4 == 0).cast("int").alias("churn_label"),
    )
    result = one(ev.top_decile_lift(frame))
    assert (result["top_count"], result["top_positives"], result["top_decile_lift"]) == (1000, 250, 1.0)


# one-row or fixed-list sides are scalars or local tables, so none of these needs a product
@pytest.mark.parametrize(
    "name",
    [
        "account_activation",
        "account_activity",
        "feature_adoption",
        "retention_cohorts",
        "logo_churn",
        "revenue_retention",
        "prediction_spine",
        "churn_features",
        "current_scoring_features",
        "backfill_snapshots",
        "kpis",
        "activation_funnel",
        "event_validity",
        "stream_ownership",
    ],
)
def test_no_products_in_plans(spark, name):
    text = plan(load().QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_scan_reads_only_needed_columns(spark):
    frame = spark.read.schema(schemas.EVENTS).parquet(_stored(spark))
    text = plan(usage.weekly_active_accounts(frame))
    assert "ReadSchema: struct<account_id:string,event_timestamp:timestamp>" in text
    text = plan(usage.feature_usage(frame))
    assert "PushedFilters: [In(event_name" in text


def _stored(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="subsight-test-") + "/events"
    spark.createDataFrame([], schemas.EVENTS).write.parquet(path)
    return path


def test_registry():
    registry = load()
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_a_batch_of_messages_has_many_files(spark, tmp_path, monkeypatch):
    """A file of messages is read by one task, so a larger batch has more files and not larger ones."""
    from catalog import stream as cs

    monkeypatch.setattr(cs, "FILE_MESSAGES", 100)
    sent = spark.range(1000).select(F.lit(b"{}").alias("value"), F.lit(0).cast("bigint").alias("partition"), F.col("id").alias("offset"))
    files = cs.arrive(sent, f"{tmp_path}/in", 2)
    assert files == 5
    found = spark.read.parquet(f"{tmp_path}/in")
    assert found.count() == 1000 and len(found.inputFiles()) == 10
