from decimal import Decimal

from tables import day, one, rows

from subsight.operators import billing as bl
from subsight.operators import cohorts as co
from subsight.operators import retention as ret
from subsight.operators import revenue as rev
from subsight.operators.activation import account_activation
from subsight.operators.activity import dim_account, mart_account_activity, account_activity


def test_cohorts(build):
    accounts = build.accounts(
        dict(account_id="A", trial_start_date=day("2024-01-01")),
        dict(account_id="B", trial_start_date=day("2024-01-07")),
        dict(account_id="C", trial_start_date=day("2024-01-15")),
    )
    events = build.events(
        ("A", "u", "user_login", "2024-01-08 00:00:00"),
        ("A", "u", "user_login", "2024-01-09 00:00:00"),
        ("B", "u", "workspace_created", "2024-01-09 00:00:00"),
        ("C", "u", "workspace_created", "2024-01-16 00:00:00"),
    )
    assert rows(ret.retention_cohorts(accounts, events)) == [
        (day("2024-01-01"), 0, 2, 2, 1.0),
        (day("2024-01-01"), 1, 2, 1, 0.5),
        (day("2024-01-01"), 2, 2, 0, 0.0),
        (day("2024-01-15"), 0, 1, 1, 1.0),
    ]


def test_logo_churn_boundaries(build):
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-10"), cancellation_date=day("2024-03-01")),
        dict(account_id="B", subscription_start_date=day("2024-01-10"), cancellation_date=day("2024-01-20")),
        dict(account_id="C", subscription_start_date=day("2024-02-01")),
        dict(account_id="D"),
        # a second subscription of the same account is one logo
        dict(account_id="C", subscription_id="C2", subscription_start_date=day("2024-02-01")),
    )
    events = build.events(("A", "u", "user_login", "2024-04-02 00:00:00"))
    assert rows(ret.logo_churn(subscriptions, events)) == [
        (day("2024-01-01"), 0, 0, 1, 0.0),
        (day("2024-02-01"), 1, 0, 2, 0.0),
        (day("2024-03-01"), 2, 1, 1, 0.5),
        (day("2024-04-01"), 1, 0, 1, 0.0),
    ]


def test_revenue_movements(build):
    def bill(account, when, amount, **more):
        return dict(account_id=account, invoice_date=day(when), amount=amount, **more)

    invoices = build.invoices(
        bill("A", "2024-01-05", 40, plan="Starter"),
        bill("A", "2024-01-20", 9, plan="Growth", payment_status="failed"),
        bill("A", "2024-02-05", 249, plan="Growth"),
        bill("B", "2024-01-05", 249),
        bill("B", "2024-03-05", 249),
        bill("C", "2024-01-05", 249),
        bill("C", "2024-02-05", 0),
        bill("D", "2024-01-05", 249),
        bill("D", "2024-02-05", 49),
        bill("N", "2024-03-05", 999),
    )
    subscriptions = build.subscriptions(*[dict(account_id=a, subscription_start_date=day("2024-01-01")) for a in "ABCDN"])
    revenue = rev.account_monthly_revenue(invoices, subscriptions)
    january = [r for r in rows(revenue, "account_id", "month", "plan", "monthly_revenue") if r[0] == "A"][0]
    assert january == ("A", day("2024-01-01"), "Growth", Decimal("49.00"))
    # February: B has no row (churned in both), C has a zero row (churned only for NRR)
    churn = rows(rev.revenue_churn(revenue), "month", "starting_mrr", "churned_mrr")
    assert churn == [
        (day("2024-02-01"), Decimal("796.00"), Decimal("249.00")),
        (day("2024-03-01"), Decimal("298.00"), Decimal("298.00")),
    ]
    kept = rows(rev.revenue_retention(revenue))
    assert kept[0][:6] == (
        day("2024-02-01"),
        Decimal("796.00"),
        Decimal("498.00"),
        Decimal("200.00"),
        Decimal("200.00"),
        Decimal("298.00"),
    )
    assert kept[0][6] == 298 / 796
    disagreeing = rev.churn_reconciliation(rev.revenue_retention(revenue), rev.revenue_churn(revenue))
    assert rows(disagreeing) == [("churn_reconciliation", day("2024-02-01"))]


def test_segments_and_behavior(build):
    accounts = build.accounts(
        dict(account_id="A", company_size=50), dict(account_id="B", company_size=51), dict(account_id="C", company_size=1001)
    )
    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-15")),
        dict(account_id="B", subscription_start_date=day("2024-01-15"), cancellation_date=day("2024-02-15")),
        dict(account_id="C"),
    )
    dim = dim_account(accounts, subscriptions)
    found = {r[:2]: r[2:] for r in rows(ret.retention_segments(dim))}
    assert found[("company_size", "1-50")] == (1, 1, 0, 1.0)
    assert found[("company_size", "51-250")] == (1, 0, 1, 0.0)
    assert found[("plan", "Starter")] == (2, 1, 1, 0.5)
    assert ("company_size", "1001+") not in found
    events = build.events(("A", "u", "user_login", "2024-03-01 00:00:00"), ("B", "u", "user_login", "2024-02-01 00:00:00"))
    activity = mart_account_activity(account_activity(accounts, build.users(), events))
    behavior = {r["retention_status"]: r for r in ret.retention_behavior(dim, activity).collect()}
    assert behavior["churned"]["avg_days_since_last_activity"] == 29.0
    assert behavior["retained"]["total_accounts"] == 1


def test_cohort_reporting(build):
    accounts = build.accounts(dict(account_id="A"), dict(account_id="B", plan="Growth"))
    subscriptions = build.subscriptions(dict(account_id="A", subscription_start_date=day("2024-01-15")), dict(account_id="B"))
    dim = dim_account(accounts, subscriptions)
    events = build.events(
        ("A", "u", "workspace_created", "2024-01-01 00:00:00"),
        ("B", "u", "user_login", "2024-02-01 00:00:00"),
        ("B", "u", "report_created", "2024-02-02 00:00:00"),
    )
    activation = account_activation(accounts, events)
    cohort = co.filter_accounts(dim, plan="Growth")
    assert rows(cohort, "account_id") == [("B",)]
    assert co.filter_accounts(dim).count() == 2
    nobody = co.filter_accounts(dim, plan="Enterprise")
    cohort_events = co.restrict_to_accounts(events, cohort)

    figures = one(co.kpis(cohort, co.restrict_to_accounts(subscriptions, cohort), co.restrict_to_accounts(activation, cohort), cohort_events, events))
    assert figures["total_accounts"] == 1 and figures["monthly_active_accounts"] == 1
    assert figures["trial_conversion_rate"] == 0.0 and figures["median_days_to_activation"] is None
    assert figures["latest_observed_month"] == day("2024-02-01")

    empty = co.kpis(nobody, co.restrict_to_accounts(subscriptions, nobody), co.restrict_to_accounts(activation, nobody), co.restrict_to_accounts(events, nobody), events)
    assert one(empty)["activation_rate"] == 0.0
    monthly = co.align_activity_periods(co.monthly_active_accounts(cohort_events), co.monthly_active_accounts(events), "month_start")
    assert rows(monthly) == [(day("2024-01-01"), 0), (day("2024-02-01"), 1)]
    adoption = co.cohort_feature_adoption(cohort, cohort_events)
    kpi = co.kpis(cohort, subscriptions, co.restrict_to_accounts(activation, cohort), cohort_events, events)
    assert [r[1] for r in rows(co.insights(kpi, adoption, monthly))] == [
        "0% of selected accounts reached activation.",
        "Integration adoption (0%) is lower than report creation adoption (100%).",
        "Monthly active accounts increased by 1 in the latest month.",
    ]
    assert rows(co.insights(empty, adoption, monthly), "insight") == [("No accounts match the current filter selection.",)]
    funnel = rows(co.activation_funnel(dim, activation, events))
    assert [(r[1], r[2], r[4]) for r in funnel] == [
        ("Trial Started", 2, "100%"),
        ("Workspace Created", 1, "50%"),
        ("Invite Sent", 0, "0%"),
        ("Integration Connected", 0, "0%"),
        ("Activated", 0, "0%"),
    ]


def test_billing_schedule_is_anchored(spark, build):
    from pyspark.sql import functions as F

    subscriptions = build.subscriptions(
        dict(account_id="A", subscription_start_date=day("2024-01-31"), cancellation_date=day("2024-04-10")), dict(account_id="B")
    )
    found = rows(bl.billing_schedule(subscriptions, F.lit(day("2024-12-31"))), "billing_period_start", "billing_period_end")
    assert found == [
        (day("2024-01-31"), day("2024-02-28")),
        (day("2024-02-29"), day("2024-03-30")),
        (day("2024-03-31"), day("2024-04-09")),
    ]


def test_orphan_exports(build):
    events = build.events(
        ("A", "u", "report_exported", "2024-01-01 00:00:00"),
        ("A", "u", "report_created", "2024-01-02 00:00:00"),
        ("A", "u", "report_exported", "2024-01-02 00:00:00"),
        ("B", "u", "report_exported", "2024-01-02 00:00:00"),
        ("B", "u", "user_login", "2024-01-01 00:00:00"),
    )
    assert rows(bl.drop_orphan_exports(events), "event_id") == [("E0001",), ("E0002",), ("E0004",)]
