import threading

import pytest
from tables import day, rows

from pyspark.sql import functions as F

from subsight.operators import quality as qa
from subsight.operators import snapshots as sn
from subsight.plans import marts
from subsight.plans.daily import run_daily
from subsight.sinks import tables as sinks
from subsight.sources.tables import MissingInputs, read_tables


@pytest.mark.parametrize("text", ["2026/09/25", "not-a-date", "2026-02-30", "20260925", None])
def test_bad_dates(text):
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        sn.parse_logical_date(text)


@pytest.fixture
def subscriptions(build):
    return build.subscriptions(
        dict(account_id="A", trial_start_date=day("2024-01-01"), subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-02-10")),
        dict(account_id="B", trial_start_date=day("2024-02-01")),
    )


def test_status_as_of(subscriptions):
    def status(text):
        return rows(sn.subscriptions_as_of(subscriptions, day(text)), "account_id", "subscription_status")

    assert status("2023-12-31") == []
    assert status("2024-01-14") == [("A", "trial")]
    assert status("2024-01-15") == [("A", "active")]
    assert status("2024-02-09") == [("A", "active"), ("B", "trial")]
    assert status("2024-02-10") == [("A", "cancelled"), ("B", "trial")]


def test_unparseable_dates_are_no_dates(spark):
    raw = spark.createDataFrame([("1", "2024-01-01T08:00:00"), ("2", "soon"), ("3", None)], "account_id string, account_created_at string")
    assert rows(sn.accounts_as_of(raw, day("2024-01-01")), "account_id") == [("1",)]


def test_backfill_equals_single_runs(spark, subscriptions, tmp_path):
    days = ["2024-01-15", "2024-02-01", "2024-02-10"]
    many = sinks.backfill("subscriptions", subscriptions, days, f"{tmp_path}/many")
    for text in days:
        single = sinks.write_snapshot("subscriptions", subscriptions, text, f"{tmp_path}/single")
    assert rows(spark.read.parquet(many)) == rows(spark.read.parquet(single))
    before = rows(spark.read.parquet(single))
    sinks.write_snapshot("subscriptions", subscriptions, days[1], f"{tmp_path}/single")
    assert rows(spark.read.parquet(single)) == before
    assert sorted(p.name for p in (tmp_path / "single" / "subscriptions").glob("date=*")) == [f"date={d}" for d in days]


def test_rerun_without_rows_empties_the_date(spark, subscriptions, tmp_path):
    path = sinks.backfill("subscriptions", subscriptions, ["2024-01-15", "2024-02-01"], str(tmp_path))
    sinks.write_snapshot("subscriptions", subscriptions.where("false"), "2024-01-15", str(tmp_path))
    assert rows(spark.read.parquet(path).select("date").distinct()) == [(day("2024-02-01"),)]


def test_snapshot_refuses_bad_keys(spark, build, tmp_path):
    twice = build.accounts(dict(account_id="A"), dict(account_id="A"))
    with pytest.raises(ValueError, match="duplicate account_id"):
        sinks.write_snapshot("accounts", twice, "2024-01-01", str(tmp_path))
    with pytest.raises(ValueError, match="null account_id"):
        sinks.write_snapshot("accounts", build.accounts(dict(account_id=None)), "2024-01-01", str(tmp_path))
    with pytest.raises(ValueError, match="no snapshots"):
        sinks.write_snapshot("events", twice, "2024-01-01", str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def constant_score(features):
    return features.withColumn("churn_probability", F.lit(0.5))


def small_tables(build):
    return marts.Staged(
        accounts=build.accounts(dict(account_id="A"), dict(account_id="B", trial_start_date=day("2024-01-02"))),
        users=build.users(dict(user_id="U", account_id="A")),
        subscriptions=build.subscriptions(
            dict(account_id="A", subscription_start_date=day("2024-01-15")), dict(account_id="B")
        ),
        invoices=build.invoices(
            dict(account_id="A", invoice_date=day("2024-01-15")), dict(account_id="A", invoice_date=day("2024-02-15"))
        ),
        events=build.events(("A", "U", "user_login", "2024-02-20 00:00:00")),
    )


def test_daily_run_and_models(spark, build, tmp_path):
    report = run_daily("2024-02-20", small_tables(build), str(tmp_path), constant_score)
    assert report.where("not passed").count() == 0 and report.count() > 80
    scores = spark.read.parquet(f"{tmp_path}/scores")
    assert rows(scores, "account_id", "risk_bucket", "prediction_date") == [("A", "Medium", day("2024-02-20"))]
    stored = {name: spark.read.parquet(f"{tmp_path}/marts/{name}") for name in marts.REQUIRED_MODELS}
    models = marts.load_models(stored)
    assert [r["feature_name"] for r in models["mart_feature_adoption"].collect()][0] == "invite_sent"
    bundle = sinks.export_bundle(stored, marts.REQUIRED_MODELS, f"{tmp_path}/bundle")
    assert set(bundle) == set(marts.REQUIRED_MODELS)
    with pytest.raises(MissingInputs, match="mart_logo_churn"):
        marts.load_models({k: v for k, v in stored.items() if k != "mart_logo_churn"})
    sinks.export_training_set(spark.read.parquet(f"{tmp_path}/marts/mart_churn_features"), f"{tmp_path}/train")
    assert spark.read.parquet(f"{tmp_path}/train").count() == 1


def test_rules_are_counted_by_the_write(spark, build, tmp_path):
    accounts = build.accounts(dict(account_id="A"), dict(account_id=None), dict(account_id="B", plan="Odd"))
    rules = {"m": {"missing": F.col("account_id").isNull(), "odd": ~F.col("plan").isin("Starter")}, "other": {"never": F.lit(True)}}
    store = marts.MeasuredStore(spark, str(tmp_path), rules)
    ran = spark._jsparkSession.sharedState().statusStore().executionsCount
    before = ran()
    assert rows(store("m", accounts), "account_id") == [("A",), ("B",), (None,)]
    assert ran() - before == 2  # the write and this read
    store("unruled", accounts)
    assert store.violations == {"missing": 1, "odd": 1}
    counted = {r["check_name"]: r["violations"] for r in store.counted().collect()}
    assert counted == {r["check_name"]: r["violations"] for r in qa.count_rules(accounts, rules["m"]).collect()}


def test_rules_broken_in_marts_block_scoring(build, tmp_path):
    staged = small_tables(build)
    odd = marts.Staged(staged.accounts, staged.users, staged.subscriptions, staged.invoices, staged.events.withColumn("event_name", F.lit("odd")))
    with pytest.raises(qa.QualityGateError, match="accepted_events_event_name"):
        run_daily("2024-02-20", odd, str(tmp_path), constant_score)
    assert not (tmp_path / "scores").exists()


def test_failed_check_blocks_scoring(build, tmp_path):
    staged = small_tables(build)
    bad = {"always": staged.accounts}
    with pytest.raises(qa.QualityGateError, match="always"):
        run_daily("2024-02-20", staged, str(tmp_path), constant_score, extra_checks=bad)
    assert not (tmp_path / "scores").exists() and (tmp_path / "quality").exists()


def test_tables_from_files(spark, build, tmp_path):
    staged = small_tables(build)
    for name in ("accounts", "users", "subscriptions", "invoices", "events"):
        frame = getattr(staged, name)
        text = {c: F.col(c).cast("string") for c, kind in frame.dtypes if kind in ("date", "timestamp")}
        frame.withColumns(text).write.parquet(f"{tmp_path}/{name}.parquet")
    read = marts.stage(read_tables(spark, str(tmp_path)))
    for name in ("accounts", "users", "subscriptions", "invoices", "events"):
        assert rows(getattr(read, name)) == rows(getattr(staged, name))


def test_independent_marts_are_written_side_by_side(spark, build, tmp_path):
    """Two marts meet in the store, and all are what they are one after the other."""
    meeting, stored = threading.Barrier(2), marts.stored_in(spark, str(tmp_path))

    def store(name, df):
        if name in ("int_account_activation", "dim_account"):
            meeting.wait(60)
        return stored(name, df)

    data = small_tables(build)
    together, lazy = marts.build_marts(data, store=store), marts.build_marts(data)
    assert together.keys() == lazy.keys()
    for name in ("dim_account", "mart_retention_behavior", "mart_churn_features", "mart_revenue_churn"):
        assert sorted(map(str, together[name].collect())) == sorted(map(str, lazy[name].collect()))
