from decimal import Decimal

import pytest
from tables import day, moment, one, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Observation
from pyspark.sql import functions as F

from subsight import schemas
from subsight.operators import evaluation as ev
from subsight.operators import features as ft
from subsight.operators import models as ml
from subsight.operators import scoring as sc
from subsight.operators.activation import account_activation
from subsight.operators.activity import dim_account
from subsight.operators.usage import daily_usage


@pytest.fixture(scope="module")
def small(build):
    accounts = build.accounts(*[dict(account_id=a, seats_purchased=4) for a in "ABCD"])
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-05-01")),
        dict(account_id="B", subscription_start_date=day("2024-03-01"), cancellation_date=day("2024-05-02")),
        dict(account_id="C", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-03-01")),
        dict(account_id="D"),
    )
    invoices = build.invoices(
        dict(invoice_id="1", account_id="A", invoice_date=day("2024-01-15"), plan="Starter", payment_status="failed"),
        dict(invoice_id="2", account_id="A", invoice_date=day("2024-03-15"), plan="Growth", amount=249),
        dict(invoice_id="3", account_id="A", invoice_date=day("2024-03-15"), plan=None, amount=100, payment_status="failed"),
        dict(invoice_id="4", account_id="B", invoice_date=day("2024-04-02"), amount=49),
    )
    events = build.events(
        ("A", "u1", "report_created", "2024-04-01 23:59:00"),
        ("A", "u1", "user_login", "2024-04-02 00:00:00"),
        ("A", "u1", "dashboard_viewed", "2024-03-03 00:00:00"),
        ("A", "u2", "dashboard_viewed", "2024-03-02 23:00:00"),
        ("A", "u2", "invite_sent", "2024-02-02 00:00:00"),
        ("A", "u2", "integration_connected", "2024-02-01 12:00:00"),
        ("A", "u2", "integration_connected", "2023-11-01 12:00:00"),
        ("B", "u5", "user_login", "2024-03-20 12:00:00"),
    )
    return accounts, subscriptions, invoices, events


def features_of(small, events=None):
    accounts, subscriptions, invoices, raw = small
    activation = account_activation(accounts, raw)
    snapshots = ft.prediction_spine(subscriptions, invoices)
    return ft.churn_features(snapshots, accounts, raw if events is None else events, invoices, activation)


def test_spine(small):
    _, subscriptions, invoices, _ = small
    assert rows(ft.prediction_spine(subscriptions, invoices), "account_id", "prediction_date") == [
        ("A", day("2024-02-01")),
        ("A", day("2024-03-01")),
        ("A", day("2024-04-01")),
        ("B", day("2024-03-01")),
        ("B", day("2024-04-01")),
        ("C", day("2024-02-01")),
    ]


def test_feature_windows(small):
    frame = features_of(small)
    assert frame.columns == ["account_id", "prediction_date", *schemas.FEATURE_COLUMNS, *schemas.AUDIT_COLUMNS, schemas.LABEL]
    found = {(r["account_id"], str(r["prediction_date"])): r.asDict() for r in frame.collect()}
    april = found[("A", "2024-04-01")]
    # window of 30 days is March 3 .. April 1, the one before February 2 .. March 2
    assert (april["events_last_7d"], april["events_last_30d"], april["events_previous_30d"]) == (1, 2, 2)
    assert (april["active_users_last_30d"], april["active_users_previous_30d"]) == (1, 1)
    assert april["integrations_connected"] == 2 and april["reports_created_last_30d"] == 1
    assert april["days_since_last_activity"] == 0 and april["days_since_last_login"] is None
    assert april["latest_event_at"] == moment("2024-04-01 23:59:00")
    assert april["event_change_pct"] == 0.0 and april["seat_utilization"] == 0.25
    # two invoices start on March 15: the later id wins, unless its plan is NULL
    assert (april["plan"], april["monthly_revenue"], april["recent_payment_failed"]) == ("Growth", Decimal("100.00"), 1)
    assert (april["failed_payments_last_90d"], april["total_failed_payments"]) == (2, 2)
    assert april["churn_label"] == 1  # cancelled on day 30
    february = found[("A", "2024-02-01")]
    assert february["events_last_30d"] == 1 and february["event_change_pct"] == 1.0
    assert february["integrations_connected"] == 2 and february["monthly_revenue"] == Decimal("49.00")
    b = found[("B", "2024-04-01")]
    assert b["churn_label"] == 0  # cancelled on day 31
    assert b["monthly_revenue"] == Decimal("0.00") and b["latest_invoice_date"] is None and b["plan"] == "Starter"
    march = found[("B", "2024-03-01")]
    assert march["events_last_30d"] == 0 and march["latest_event_at"] is None and march["event_change_pct"] == 0.0


def test_features_from_rollup_and_leakage(small):
    frame = features_of(small)
    assert rows(features_of(small, daily_usage(small[3]))) == rows(frame)
    assert ft.leakage_check(frame, small[1]).count() == 0
    wrong = frame.withColumn("churn_label", 1 - F.col("churn_label"))
    assert {r["problem"] for r in ft.leakage_check(wrong, small[1]).collect()} == {"label differs"}
    late = frame.withColumn("latest_event_at", F.lit("2030-01-01").cast("timestamp"))
    assert {r["problem"] for r in ft.leakage_check(late, small[1]).collect()} == {"event after cutoff"}


def test_current_scoring(small, build):
    accounts, _, invoices, events = small
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15")), dict(account_id="B", subscription_status="trial")
    )
    frame = ft.current_scoring_features(dim_account(accounts, subscriptions), events, invoices, account_activation(accounts, events))
    assert rows(frame, "account_id", "prediction_date", "events_last_7d") == [("A", day("2024-04-02"), 2)]
    assert "churn_label" not in frame.columns


# --- metrics against brute force ----------------------------------------------------------


def brute_force(pairs):
    positives = sum(y for _, y in pairs)
    levels = sorted({p for p, _ in pairs}, reverse=True)
    precision_sum, tp_before = 0.0, 0
    for level in levels:
        taken = [y for p, y in pairs if p >= level]
        tp = sum(taken)
        precision_sum += (tp - tp_before) / positives * tp / len(taken) if positives else 0.0
        tp_before = tp
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for a, y in pairs if y for b, z in pairs if not z]
    auc = sum(wins) / len(wins) if wins else None

    def at(cut):
        tp = sum(y for p, y in pairs if p >= cut)
        predicted = sum(1 for p, _ in pairs if p >= cut)
        f1 = 2 * tp / (predicted + positives) if predicted + positives else 0.0
        return f1, tp / predicted if predicted else 0.0, cut

    best = max(at(c) for c in {0.0, 1.0, *levels})
    return precision_sum, auc, best


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 8).map(lambda x: x / 8), st.integers(0, 1)), min_size=1, max_size=25))
def test_metrics_match_brute_force(spark, pairs):
    frame = spark.createDataFrame(
        [(f"A{i:03d}", p, y) for i, (p, y) in enumerate(pairs)], "account_id string, churn_probability double, churn_label int"
    )
    average_precision, auc, best = brute_force(pairs)
    ranking = one(ev.ranking_metrics(frame))
    assert ranking["pr_auc"] == pytest.approx(average_precision)
    assert ranking["roc_auc"] == (None if auc is None else pytest.approx(auc))
    chosen = one(ev.choose_threshold(frame))
    assert (chosen["f1"], chosen["precision"], chosen["threshold"]) == pytest.approx(best)
    ordered = sorted((-p, f"A{i:03d}", y) for i, (p, y) in enumerate(pairs))
    top = -(-len(pairs) // 10)
    rate = sum(y for _, y in pairs) / len(pairs)
    expected = (sum(y for *_, y in ordered[:top]) / top) / rate if rate else 0.0
    assert one(ev.top_decile_lift(frame))["top_decile_lift"] == pytest.approx(expected)


def test_metrics_per_key(spark):
    frame = spark.createDataFrame(
        [("m1", 0.9, 1), ("m1", 0.1, 0), ("m2", 0.9, 0), ("m2", 0.1, 1), ("m2", 0.1, 0)],
        "model string, churn_probability double, churn_label int",
    )
    found = rows(ev.ranking_metrics(frame, keys=["model"]), "model", "pr_auc", "roc_auc")
    assert found == [("m1", 1.0, 1.0), ("m2", pytest.approx(1 / 3), 0.25)]
    assert rows(ev.choose_threshold(frame, keys=["model"]), "model", "threshold") == [("m1", 0.9), ("m2", 0.1)]


def test_evaluate_and_threshold_zero_division(spark):
    frame = spark.createDataFrame([("A", 0.2, 0), ("B", 0.4, 0)], "account_id string, churn_probability double, churn_label int")
    result = one(ev.evaluate_scores(frame, 0.5))
    assert (result["precision"], result["recall"], result["f1"], result["roc_auc"], result["top_decile_lift"]) == (0, 0, 0, None, 0)
    assert (result["true_negatives"], result["true_positives"]) == (2, 0)


def test_temporal_split(spark):
    frame = spark.createDataFrame([(day(f"2024-0{m}-01"), i) for m in (1, 2, 3, 4) for i in range(m)], "prediction_date date, i int")
    train, validation, test = ev.temporal_split(frame)
    assert (train.count(), validation.count(), test.count()) == (3, 3, 4)
    assert rows(ev.split_periods(frame), "split", "row_count") == [("test", 4), ("train", 3), ("validation", 3)]
    with pytest.raises(ev.TooFewDates):
        ev.temporal_split(frame.where("prediction_date < '2024-03-01'"))


# --- reasons and ranking -------------------------------------------------------------------

QUIET = dict(
    event_change_pct=0.0,
    seat_utilization=0.5,
    days_since_last_activity=1,
    reports_created_last_30d=3,
    days_since_last_report=2,
    failed_payments_last_90d=0,
    integrations_connected=1,
    active_users_last_30d=5,
)
_KINDS = "event_change_pct double, seat_utilization double, days_since_last_activity int, reports_created_last_30d bigint, days_since_last_report int, failed_payments_last_90d bigint, integrations_connected bigint, active_users_last_30d bigint"


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({}, ["risk reflects the combined model pattern rather than one dominant signal"]),
        ({"event_change_pct": -0.3}, ["activity declined 30% versus the prior 30 days"]),
        ({"seat_utilization": 0.125}, ["only 12% of purchased seats were active"]),
        ({"seat_utilization": None}, ["risk reflects the combined model pattern rather than one dominant signal"]),
        ({"days_since_last_activity": 14}, ["last product activity was 14 days ago"]),
        ({"reports_created_last_30d": 0, "days_since_last_report": 40}, ["no recent reports; last report was 40 days ago"]),
        ({"reports_created_last_30d": 0, "days_since_last_report": None}, ["no report has been created"]),
        ({"failed_payments_last_90d": 1}, ["1 failed payment in 90 days"]),
        ({"failed_payments_last_90d": 2}, ["2 failed payments in 90 days"]),
        (
            {"integrations_connected": 0, "active_users_last_30d": 1, "event_change_pct": -1.0, "seat_utilization": 0.0},
            ["activity declined 100% versus the prior 30 days", "only 0% of purchased seats were active", "no integration was connected"],
        ),
    ],
)
def test_reasons(spark, change, expected):
    frame = spark.createDataFrame([tuple({**QUIET, **change}.values())], _KINDS)
    found = one(sc.with_reasons(frame))
    assert [found[f"top_reason_{i}"] for i in (1, 2, 3) if found[f"top_reason_{i}"]] == expected


@pytest.fixture(scope="module")
def scores(spark):
    data = [("A1", 0.6, 10.0), ("A2", 0.6, 20.0), ("A3", 0.3, 5.0), ("A4", 0.1, 1.0)]
    frame = spark.createDataFrame(data, "account_id string, churn_probability double, monthly_revenue double")
    return frame.select(
        "account_id",
        F.lit(day("2024-04-01")).alias("prediction_date"),
        "churn_probability",
        sc.risk_bucket(F.col("churn_probability")).alias("risk_bucket"),
        F.lit("first").alias("top_reason_1"),
        F.lit(" ").alias("top_reason_2"),
        F.lit(None).cast("string").alias("top_reason_3"),
        "monthly_revenue",
    )


def test_ranking_and_lookup(scores):
    assert [r["account_id"] for r in sc.rank_accounts(scores, limit=3).collect()] == ["A2", "A1", "A3"]
    assert [r["account_id"] for r in sc.rank_accounts(scores, limit=1, tie="account").collect()] == ["A1"]
    assert sc.rank_accounts(scores, bucket="Low", limit=100).count() == 1
    for limit in (0, 101):
        with pytest.raises(ValueError):
            sc.rank_accounts(scores, limit=limit)
    found = one(sc.account_risk(scores, " a3 "))
    assert found["account_id"] == "A3" and found["top_reasons"] == ["first"]
    assert sc.account_risk(scores, "nobody").count() == 0
    assert one(sc.risk_summary(scores)) == dict(
        scored_accounts=4, high_risk_accounts=2, medium_risk_accounts=1, low_risk_accounts=1, high_risk_monthly_revenue=30.0
    )
    assert sc.validate_scores(scores).count() == 0
    assert rows(sc.validate_scores(scores.where("false"))) == [("empty", 1)]
    with pytest.raises(ValueError, match="risk_bucket"):
        sc.validate_scores(scores.drop("risk_bucket"))


# --- models ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def learnable(spark):
    """Four monthly dates; idle accounts churn."""
    ids = spark.range(400).select(
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("account_id"),
        F.element_at(F.array(*[F.lit(day(f"2024-0{m}-01")) for m in (1, 2, 3, 4)]), (F.col("id") % 4 + 1).cast("int")).alias("prediction_date"),
        F.col("id"),
    )
    idle = (F.xxhash64("id") % 40 + 40) % 40
    columns = {c: (F.xxhash64("id", F.lit(c)) % 10).cast("double") for c in schemas.NUMERIC_FEATURES}
    columns["days_since_last_activity"] = F.when(F.col("id") % 17 != 0, idle.cast("double"))
    columns["monthly_revenue"] = F.lit(49).cast("decimal(12,2)")
    columns["plan"] = F.when(F.col("id") % 13 != 0, F.element_at(F.array(*[F.lit(p) for p in schemas.PLANS]), (F.col("id") % 3 + 1).cast("int")))
    columns["acquisition_channel"] = F.lit("Organic")
    return ids.withColumns({**columns, "churn_label": (idle > 30).cast("int")}).persist()


def test_models_learn_and_are_compared(learnable):
    models, results, choice = ml.train_and_compare(learnable, tree_iterations=5)
    chosen = one(choice)
    assert chosen["selected_model"] in (ml.LOGISTIC, ml.BOOSTED_TREES)
    found = {(r["model"], r["split"]): r for r in results.collect()}
    assert len(found) == 4
    assert all(r["pr_auc"] > 0.8 and 0 <= r["decision_threshold"] <= 1 for r in found.values())
    long = ml.run_metrics_table(results, "r")
    assert {r["run_id"] for r in long.collect()} == {"r"} and long.where("metric = 'pr_auc'").count() == 4
    scored = ml.predict(models[ml.LOGISTIC], learnable.withColumn("plan", F.lit("Unseen")))
    assert scored.where("churn_probability between 0 and 1").count() == 400
    importance = ml.permutation_importance(
        models[ml.BOOSTED_TREES], learnable.where("prediction_date = '2024-04-01'"), repeats=3,
        features=("days_since_last_activity", "company_size"),
    )
    by_name = {r["feature"]: r["importance_mean"] for r in importance.collect()}
    assert by_name["days_since_last_activity"] > 0.2 > abs(by_name["company_size"])


def test_ranking_between_cuts_equals_ranking_of_all(spark):
    """Whatever the cuts are; ties, keys without positives and stretches without rows take part."""
    frame = spark.range(3000).select(
        (F.col("id") % 3).alias("model"),
        (F.floor(F.abs(F.xxhash64("id")) % 1000 / 7) / 143).alias("churn_probability"),
        ((F.col("id") % 3 > 0) & (F.abs(F.xxhash64("id", F.lit(1))) % 9 == 0)).cast("int").alias("churn_label"),
    )
    columns = ("row_count", "positives", "pr_auc", "roc_auc")
    for keys in ((), ("model",)):
        whole = rows(ev.ranking_metrics(frame, keys=keys), *keys, *columns)
        for cuts in ([], [0.5], [-1.0, 0.0, 0.1, 0.1, 17 / 143, 0.9, 2.0]):
            found = rows(ev.ranking_metrics(frame, keys=keys, cuts=cuts), *keys, *columns)
            assert [[c if c is None else pytest.approx(c, abs=1e-12) for c in r] for r in whole] == [list(r) for r in found]


@pytest.mark.parametrize("kind", [ml.LOGISTIC, ml.BOOSTED_TREES])
def test_importance_equals_whole_predictions_of_shuffled_rows(spark, learnable, kind, monkeypatch):
    monkeypatch.setattr(ml, "_STRETCH_ROWS", 10)
    model = ml.fit(kind, learnable, max_iter=3)
    test = learnable.where("prediction_date = '2024-04-01'").withColumn("account_id", F.concat("account_id", F.lit("t")))
    calls, plain = [], ml.BestFirstModel._transform
    monkeypatch.setattr(ml.BestFirstModel, "_transform", lambda *a: calls.append(1) or plain(*a))
    names = ("days_since_last_activity", "plan", "monthly_revenue")
    found = {r["feature"]: r for r in ml.permutation_importance(model, test, repeats=2, features=names).collect()}
    assert set(found) == set(names) and not calls
    partnered = ml.shuffled_partners(test.select("account_id", "prediction_date", *schemas.FEATURE_COLUMNS, "churn_label"), 2)
    baseline = one(ev.ranking_metrics(ml.predict(model, test)))["pr_auc"]
    for name in names:
        donors = partnered.where("repeat = 1").select(F.col("position").alias("partner"), F.col(name).alias("borrowed"))
        swapped = partnered.join(donors, "partner").withColumn(name, F.col("borrowed")).drop("borrowed")
        scored = ml.predict(model, swapped)
        losses = [baseline - r["pr_auc"] for r in ev.ranking_metrics(scored, keys=["repeat"]).collect()]
        assert found[name]["importance_mean"] == pytest.approx(sum(losses) / 2, abs=1e-9)
        assert found[name]["repeats"] == 2


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000])
def test_keyed_permutations(spark, total):
    placed = spark.range(total).crossJoin(spark.range(30).withColumnRenamed("id", "key"))
    partner = ml.keyed_permutation(F.col("id"), total, F.lit(7), F.col("key"))
    found = {}
    for r in placed.select("id", "key", partner.alias("partner")).collect():
        found.setdefault(r["key"], {})[r["id"]] = r["partner"]
    for places in found.values():
        assert sorted(places.values()) == list(range(total))
    if total == 1000:
        # independent shuffles: about one fixed place each, shifts of all sizes, no two alike
        fixed = [sum(i == j for i, j in places.items()) for places in found.values()]
        assert sum(fixed) < 3 * len(found)
        assert all(len({(j - i) % total for i, j in places.items()}) > 550 for places in found.values())
        assert sum(found[0][i] == found[1][i] for i in range(total)) < 10


def test_logistic_gradient_tells_a_fitted_model(learnable):
    train = learnable.where("prediction_date < '2024-03-01'")
    fitted = ml.fit(ml.LOGISTIC, train)
    slopes = {r["input"]: r["gradient"] for r in ml.logistic_gradient(fitted, train).collect()}
    assert max(map(abs, slopes.values())) < 1e-4 and {"intercept", "plan=Starter", "company_size"} <= set(slopes)
    other = ml.fit(ml.LOGISTIC, train, max_iter=1)
    assert max(abs(r["gradient"]) for r in ml.logistic_gradient(other, train).collect()) > 1e-3


def test_models_go_to_tasks_of_an_observed_session(spark, learnable):
    """The session holds an observation's state, which cannot be sent, so a model must not hold the session."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    assert ml.predict(ml.fit(ml.LOGISTIC, learnable), learnable).where("churn_probability between 0 and 1").count() == learnable.count()


def test_balanced_weights(spark):
    frame = spark.createDataFrame([(0,), (0,), (0,), (1,)], "churn_label int")
    assert rows(ml.with_balanced_weights(frame).distinct()) == [(0, 4 / 6), (1, 2.0)]
    with pytest.raises(ValueError):
        ml.with_balanced_weights(frame.where("churn_label = 0"))


def test_training_run_is_stored_and_scores_later(spark, learnable, tmp_path):
    from subsight.plans.training import stored_scorer, train_and_store

    nothing = F.lit(None).cast("double")
    features = learnable.withColumn("days_since_last_report", nothing)  # NULL in every row
    chosen = train_and_store(features, str(tmp_path), "r1", tree_iterations=2, repeats=2)
    importance = spark.read.parquet(f"{tmp_path}/importance/r1")
    assert {r["feature"] for r in importance.collect()} == set(schemas.FEATURE_COLUMNS)
    assert {r["model"] for r in importance.collect()} == {chosen}
    periods = {r["split"]: r["row_count"] for r in spark.read.parquet(f"{tmp_path}/periods/r1").collect()}
    assert set(periods) == {"train", "validation", "test"} and sum(periods.values()) == features.count()
    metrics = spark.read.parquet(f"{tmp_path}/metrics")
    assert metrics.select("run_id", "model", "split").distinct().count() == 4
    scored = stored_scorer(spark, str(tmp_path), "r1")(features)
    assert scored.where("churn_probability between 0 and 1").count() == features.count()


def test_metrics_compute_the_held_out_dates_only(spark, monkeypatch):
    """The rows of both dates are those of the whole table, and no others are made."""
    from catalog import churn
    from fixture_views import TestData

    d, stored = TestData(spark, "/root/testdata/sf0.001"), []
    monkeypatch.setattr(churn, "stable", lambda df: stored.append(df) or df)
    _, *whole = ev.temporal_split(churn.features_of(d))
    for found, wanted in zip(churn.stored_held_out_of(d), whole, strict=True):
        assert wanted.count() and sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert stored[0].count() == sum(part.count() for part in whole)
    stored.clear()
    churn._results_of(d)
    assert stored[0].select("prediction_date").distinct().count() == 2
