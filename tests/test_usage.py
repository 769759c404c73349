from tables import day, moment, one, rows

from pyspark.sql import functions as F

from subsight import schemas
from subsight.operators import activation as act
from subsight.operators import activity as usage
from subsight.operators.usage import daily_usage
from subsight.sources.events import empty_stream_df, read_stream_files, stg_events
from subsight.sources.tables import MissingInputs, read_tables, require_inputs, require_models

import pytest

SETUP = ("workspace_created", "invite_sent", "integration_connected")


def test_activation_window_is_half_open(build):
    accounts = build.accounts(*[dict(account_id=a) for a in "ABCDE"])
    events = build.events(
        ("A", "u", "workspace_created", "2024-01-01 00:00:00"),
        ("A", "u", "invite_sent", "2024-01-03 00:00:00"),
        ("A", "u", "integration_connected", "2024-01-14 23:59:00"),
        ("B", "u", "workspace_created", "2024-01-01 00:00:00"),
        ("B", "u", "invite_sent", "2024-01-03 00:00:00"),
        ("B", "u", "integration_connected", "2024-01-15 00:00:00"),
        ("C", "u", "workspace_created", "2023-12-31 23:00:00"),
        ("C", "u", "invite_sent", "2024-01-03 00:00:00"),
        ("C", "u", "integration_connected", "2024-01-04 00:00:00"),
        ("D", "u", "invite_sent", "2024-01-03 00:00:00"),
    )
    result = act.account_activation(accounts, events)
    assert rows(result, "account_id", "is_activated", "activation_date", "days_to_activation") == [
        ("A", True, day("2024-01-14"), 13),
        ("B", False, None, None),
        ("C", False, None, None),
        ("D", False, None, None),
        ("E", False, None, None),
    ]
    assert rows(act.account_activation(accounts, daily_usage(events))) == rows(result)
    metrics = one(act.activation_metrics(result))
    assert metrics == dict(total_accounts=5, activated_accounts=1, activation_rate=0.2, median_days_to_activation=13.0)


def test_activation_metrics_without_accounts(build):
    empty = act.account_activation(build.accounts(), build.events())
    assert one(act.activation_metrics(empty)) == dict(
        total_accounts=0, activated_accounts=0, activation_rate=None, median_days_to_activation=None
    )


def test_dedup_prefers_batch_then_earliest(spark, build):
    batch = build.events(("A", "u", "user_login", "2024-01-05 00:00:00"))
    streamed = spark.createDataFrame(
        [
            ("E0000", "A", "u", "user_login", moment("2024-01-01 00:00:00"), 1),
            ("E9", "A", "u", "user_login", moment("2024-01-03 00:00:00"), 2),
            ("E9", "A", "u", "user_login", moment("2024-01-02 00:00:00"), 2),
        ],
        schemas.EVENTS,
    )
    assert rows(stg_events(batch, streamed), "event_id", "event_timestamp") == [
        ("E0000", moment("2024-01-05 00:00:00")),
        ("E9", moment("2024-01-02 00:00:00")),
    ]
    assert stg_events(batch, empty_stream_df(spark)).count() == 1


def test_stream_files_may_lack_optional_columns(spark, tmp_path):
    spark.createDataFrame([("a", "A")], "event_id string, account_id string").write.parquet(f"{tmp_path}/x")
    spark.createDataFrame([("b", "web")], "event_id string, source string").write.mode("append").parquet(f"{tmp_path}/x")
    read = read_stream_files(spark, f"{tmp_path}/x")
    assert read.columns == schemas.STREAM_LANDING.fieldNames()
    assert rows(read, "event_id", "account_id", "source") == [("a", "A", None), ("b", None, "web")]


def test_activity_edges(build):
    accounts = build.accounts(
        dict(account_id="A", seats_purchased=4), dict(account_id="B", seats_purchased=0), dict(account_id="C")
    )
    users = build.users(dict(user_id="u1", account_id="A"), dict(user_id="u2", account_id="A"))
    events = build.events(
        ("A", "u1", "user_login", "2024-03-31 10:00:00"),
        ("A", "u1", "report_created", "2024-03-25 00:00:00"),
        ("A", "u2", "report_created", "2024-03-24 23:59:00"),
        ("A", "u2", "invite_sent", "2024-03-02 00:00:00"),
        ("A", "u3", "invite_sent", "2024-03-01 23:00:00"),
        ("B", "u9", "user_login", "2024-03-01 10:00:00"),
    )
    for source in (events, daily_usage(events)):
        result = {r["account_id"]: r for r in usage.account_activity(accounts, users, source).collect()}
        a = result["A"]
        assert (a["total_events"], a["number_of_active_users"], a["report_created_count"]) == (5, 3, 2)
        assert (a["events_last_7d"], a["events_last_30d"], a["active_users_last_30d"]) == (2, 4, 2)
        assert (a["provisioned_users"], a["seat_utilization"], a["days_since_last_activity"]) == (2, 0.75, 0)
        assert result["B"]["seat_utilization"] is None and result["B"]["events_last_30d"] == 0
        assert result["B"]["days_since_last_activity"] == 30
        c = result["C"]
        assert (c["total_events"], c["first_event_at"], c["days_since_last_activity"]) == (0, None, None)
        assert c["activity_as_of_date"] == day("2024-03-31")


def test_adoption_keeps_unused_features_and_empty_cohorts(build):
    events = build.events(("A", "u", "invite_sent", "2024-01-01 00:00:00"), ("A", "u", "invite_sent", "2024-01-02 00:00:00"))
    adoption = usage.feature_adoption(build.accounts(dict(account_id="A"), dict(account_id="B")), events)
    found = rows(adoption.orderBy("display_order"), "display_order", "feature_name", "accounts_using_feature", "adoption_rate")
    assert [r[1] for r in found] == list(schemas.ADOPTION_FEATURES)
    assert found[0][2:] == (1, 0.5) and all(r[2:] == (0, 0.0) for r in found[1:])
    empty = usage.feature_adoption(build.accounts(), build.events())
    assert {r["adoption_rate"] for r in empty.collect()} == {None}


def test_active_accounts_skip_missing_timestamps(spark, build):
    events = build.events(
        ("A", "u", "user_login", "2024-01-01 00:00:00"),
        ("B", "u", "user_login", "2024-01-07 23:59:59"),
        ("A", "u", "user_login", "2024-01-08 00:00:00"),
    ).withColumn("event_timestamp", F.col("event_timestamp"))
    broken = events.withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    assert rows(usage.weekly_active_accounts(events.unionByName(broken))) == [
        (day("2024-01-01"), 2),
        (day("2024-01-08"), 1),
    ]
    assert rows(usage.monthly_active_accounts(events)) == [(day("2024-01-01"), 2)]


def test_missing_inputs_are_listed_together(spark, tmp_path):
    with pytest.raises(MissingInputs, match="accounts, events, invoices, subscriptions, users"):
        read_tables(spark, str(tmp_path))
    require_inputs(spark, [str(tmp_path)])
    with pytest.raises(MissingInputs, match="b, c"):
        require_models(["a"], ["c", "a", "b"])
