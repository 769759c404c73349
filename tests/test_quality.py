from decimal import Decimal

import pytest
from tables import day, rows

from pyspark.sql import functions as F

from subsight.operators import activation as act
from subsight.operators import quality as qa
from subsight.operators.activity import feature_adoption


def problems(df):
    return rows(df, "problem", "id")


def test_generic_checks(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    assert rows(qa.unique(frame, "k")) == [("a", 2)]
    assert qa.not_null(frame, "k").count() == 2
    parent = spark.createDataFrame([("b",)], "k string")
    assert rows(qa.relationships(frame, parent, "k"), "v") == [(1,), (2,)]
    assert rows(qa.accepted_values(frame, "k", ("b", "c")), "v") == [(1,), (2,)]


def test_report_and_gate(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    report = qa.quality_report({"keys": qa.unique(frame, "k"), "values": qa.not_null(frame, "v")})
    assert rows(report) == [("keys", 1, False), ("values", 0, True)]
    with pytest.raises(qa.QualityGateError, match=r"keys \(1\)"):
        qa.require_quality(report)
    qa.require_quality(report.where("passed"))


def bill(when, until, plan="Starter", **more):
    amount = {"Starter": 49, "Growth": 249, "Enterprise": 999}.get(plan)
    return dict(account_id="A", invoice_date=day(when), billing_period_end=day(until), plan=plan, amount=amount, **more)


def test_clean_billing_passes(build):
    invoices = build.invoices(
        bill("2024-01-15", "2024-02-14"), bill("2024-02-15", "2024-03-14", "Growth"), bill("2024-03-15", "2024-04-14", "Enterprise")
    )
    subscriptions = build.subscriptions(
        dict(account_id="A", plan="Enterprise", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-04-15"))
    )
    accounts = build.accounts(dict(account_id="A", plan="Enterprise"))
    assert problems(qa.billing_history_validity(invoices, subscriptions)) == []
    assert qa.latest_plan_matches(accounts, subscriptions, invoices).count() == 0


def test_broken_billing_is_found(build):
    invoices = build.invoices(
        bill("2024-01-15", "2024-02-14"),
        bill("2024-02-16", "2024-03-14", "Enterprise"),  # a gap, and two tiers up
        bill("2024-03-15", "2024-03-14", "Enterprise", invoice_id="short"),
        bill("2024-05-01", "2024-05-30", "Enterprise", invoice_id="late", subscription_id="other"),
    )
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-03-10")),
        dict(account_id="B", subscription_id="other", subscription_start_date=day("2024-01-15")),
    )
    found = problems(qa.billing_history_validity(invoices, subscriptions))
    assert ("billing periods do not meet", "SA@2024-02-15") in found
    assert ("billing periods do not meet", "SA@2024-02-16") in found
    assert ("plan tier skipped", "SA@2024-02-16") in found
    assert ("billed on or after cancellation", "I001") in found
    assert ("subscription of another account", "late") in found
    wrong = build.invoices(dict(bill("2024-03-15", "2024-03-01"), invoice_id="x"), dict(bill("2024-03-15", "2024-04-01"), invoice_id="y", subscription_id="?"))
    wrong = wrong.withColumn("amount", F.lit(Decimal("1.00")).cast("decimal(12,2)"))
    names = {p for p, _ in problems(qa.billing_history_validity(wrong, subscriptions))}
    assert {"period ends before it starts", "amount differs from plan price", "unknown subscription"} <= names
    accounts = build.accounts(dict(account_id="A"))
    assert rows(qa.latest_plan_matches(accounts, subscriptions, invoices), "account_id", "billed_plan") == [("A", "Enterprise")]


def test_event_rules(build):
    users = build.users(dict(user_id="U", account_id="A"), dict(user_id="V", account_id="B"))
    good = build.events(
        ("A", "U", "workspace_created", "2024-01-02 00:00:00"),
        ("A", "U", "report_created", "2024-01-03 00:00:00"),
        ("A", "U", "report_exported", "2024-01-04 00:00:00"),
    )
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-02-01"))
    )
    assert problems(qa.event_validity(good, users, subscriptions)) == []
    bad = build.events(
        ("A", "U", "workspace_created", "2024-01-02 00:00:00"),
        ("A", "U", "workspace_created", "2024-01-03 00:00:00"),
        ("A", "V", "user_login", "2024-01-04 00:00:00"),
        ("A", "?", "user_login", "2024-01-04 00:00:00"),
        ("A", "U", "user_login", "2023-12-31 00:00:00"),
        ("A", "U", "report_exported", "2024-02-01 00:00:00"),
    )
    assert problems(qa.event_validity(bad, users, subscriptions)) == [
        ("event before user creation", "E0004"),
        ("event on or after cancellation", "E0005"),
        ("export before any report", "A"),
        ("several workspaces", "A"),
        ("too much activity before workspace", "all"),
        ("unknown user", "E0003"),
        ("user of another account", "E0002"),
    ]


def test_seat_and_status_rules(build):
    accounts = build.accounts(dict(account_id="A", seats_purchased=1), dict(account_id="B", seats_purchased=-1))
    users = build.users(dict(user_id="U", account_id="A"), dict(user_id="V", account_id="A"))
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-01-15")),
        dict(account_id="B", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-02-15"), subscription_status="active"),
        dict(account_id="C"),
    )
    invoices = build.invoices(dict(account_id="C", invoice_date=day("2024-01-01"), amount=-1))
    assert problems(qa.seat_and_status_validity(accounts, users, subscriptions, invoices)) == [
        ("cancellation date and status disagree", "SB"),
        ("cancelled before paid start", "SA"),
        ("invoice for a trial account", "C"),
        ("more users than seats", "A"),
        ("negative amount", "I000"),
        ("negative seats", "B"),
    ]


def test_metric_contract(build):
    accounts = build.accounts(dict(account_id="A"), dict(account_id="B"))
    events = build.events(("A", "u", "invite_sent", "2024-01-02 00:00:00"))
    subscriptions = build.subscriptions(dict(account_id="A"))
    activation = act.account_activation(accounts, events)
    parts = (act.activation_metrics(activation), act.trial_conversion(subscriptions), feature_adoption(accounts, events))
    assert qa.metric_contract(accounts, activation, *parts).count() == 0
    early = activation.withColumns({"activation_date": F.lit(day("2023-01-01")), "is_activated": F.lit(True)})
    assert rows(qa.metric_contract(accounts, early, *parts)) == [
        ("activation flag and dates agree",),
        ("activation follows trial start",),
    ]
    assert qa.activation_consistency(activation).count() == 0
    assert qa.activation_consistency(early).count() == 2


def test_event_rules_take_one_scan(spark, build, tmp_path):
    build.events(("A", "U", "user_login", "2024-01-02 00:00:00"), ("A", "V", "report_exported", "2024-01-03 00:00:00")).write.parquet(
        f"{tmp_path}/events"
    )
    events = spark.read.parquet(f"{tmp_path}/events")
    users = build.users(dict(user_id="U", account_id="A"), dict(user_id="U", account_id="B"))
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    found = qa.event_validity(events, users, build.subscriptions(dict(account_id="A", cancellation_date=day("2024-01-03"))))
    text = found._jdf.queryExecution().toString()
    assert "FileScan parquet" not in text.split("== Physical Plan ==")[1]  # the stored rows are read instead
    assert spark._jsparkSession.sharedState().statusStore().executionsCount() - before <= 1
    assert rows(found) == [
        ("event on or after cancellation", "E0001"),
        ("export before any report", "A"),
        ("too much activity before workspace", "all"),
        ("unknown user", "E0001"),
        ("user of another account", "E0000"),
    ]
