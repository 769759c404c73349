"""Snapshots, data quality, billing and health."""

from datetime import date

from pyspark.sql import functions as F

from catalog.churn import features_of, stored_features_of, with_score
from catalog.registry import query, rounded
from catalog.retention import revenue_of
from catalog.sql import (
    ACTIVATION,
    ACTIVITY,
    ADOPTION,
    COHORTS,
    FEATURES,
    LOGO_CHURN,
    REVENUE,
    SPINE,
    chain,
)
from catalog.stream import new_folder
from catalog.usage import MART_ACTIVITY, activation_of, activity_of
from subsight import schemas
from subsight.operators import activation as act
from subsight.operators import billing as bl
from subsight.operators import quality as qa
from subsight.operators import retention as ret
from subsight.operators import revenue as rev
from subsight.operators import snapshots as sn
from subsight.operators.activity import feature_adoption, mart_account_activity
from subsight.operators.health import freshness, run_health
from subsight.plans.daily import MART_ENUMS, MART_REQUIRED, run_daily
from subsight.plans.marts import Staged
from subsight.plans.training import stored_scorer, train_and_store
from subsight.sinks.tables import backfill, write_snapshot
from subsight.sources.tables import _exists

# --- snapshots ------------------------------------------------------------------------

_DAY = date(2024, 3, 15)
_BACKFILL = (date(2024, 3, 1), date(2024, 4, 1), date(2024, 5, 1))

_AS_OF = """SELECT * REPLACE (CASE WHEN cancellation_date <= d THEN 'cancelled'
    WHEN subscription_start_date <= d THEN 'active' ELSE 'trial' END AS subscription_status)"""


@query("accounts_as_of", "SELECT * FROM accounts WHERE CAST(account_created_at AS DATE) <= DATE '2024-03-15'")
def _(d):
    return sn.accounts_as_of(d.accounts, _DAY)


@query(
    "subscriptions_as_of",
    f"SELECT * EXCLUDE (d) FROM ({_AS_OF} FROM subscriptions, (SELECT DATE '2024-03-15' AS d) AS days "
    "WHERE trial_start_date <= d) AS restated",
)
def _(d):
    return sn.subscriptions_as_of(d.subscriptions, _DAY)


@query("invoices_as_of", "SELECT * FROM invoices WHERE invoice_date <= DATE '2024-03-15'")
def _(d):
    return sn.invoices_as_of(d.invoices, _DAY)


@query(
    "write_snapshot",
    "SELECT *, DATE '2024-03-15' AS snapshot_date, DATE '2024-03-15' AS date FROM invoices "
    "WHERE invoice_date <= DATE '2024-03-15'",
)
def _(d):
    """A snapshot written twice and read back."""
    root = new_folder(d.spark, "snapshots")
    for _ in range(2):
        path = write_snapshot("invoices", d.invoices, "2024-03-15", root)
    return d.spark.read.parquet(path)


@query(
    "backfill_snapshots",
    f"""SELECT * EXCLUDE (d), d AS snapshot_date, d AS date
        FROM ({_AS_OF} FROM subscriptions,
              (SELECT unnest([DATE '2024-03-01', DATE '2024-04-01', DATE '2024-05-01']) AS d) AS days
              WHERE trial_start_date <= d) AS restated""",
)
def _(d):
    """Three dates in one job, one of them written again on its own."""
    root = new_folder(d.spark, "snapshots")
    path = backfill("subscriptions", d.subscriptions, _BACKFILL, root)
    write_snapshot("subscriptions", d.subscriptions, _BACKFILL[1], root)
    return d.spark.read.parquet(path)


# Checks of the daily gate that are no rules on single rows.
_GATE_CHECKS = (
    [f"unique_{t}_{k}" for t, k in schemas.PRIMARY_KEYS.items() if t != "events"]
    + [f"relationship_{t}_account" for t in schemas.TABLES if t != "accounts"]
    + ["relationship_events_user", "relationship_invoices_subscription"]
    + [
        f"unique_{mart}"
        for mart in (
            "dim_account", "fact_product_events", "fact_subscriptions", "mart_activation", "mart_account_activity",
            "mart_feature_adoption", "mart_logo_churn", "mart_revenue_churn", "mart_revenue_retention",
            "mart_retention_behavior", "int_account_monthly_revenue",
        )
    ]
    + [f"relationship_{mart}" for mart in ("mart_activation", "mart_account_activity", "mart_churn_features")]
    + [
        "features_without_leakage", "activity_bounds", "activation_consistency", "adoption_bounds", "retention_bounds",
        "revenue_bounds", "churn_matches_cancellations", "churn_feature_validity",
    ]
)
_MART_RULE_NAMES = [f"not_null_{mart}_{c}" for mart, columns in MART_REQUIRED.items() for c in columns] + [
    f"accepted_{mart}_{column}" for mart, column in MART_ENUMS
]
_MAY_BE_NULL = ("subscription_start_date", "cancellation_date")
_SOURCE_LISTS = {
    ("accounts", "plan"): schemas.PLANS,
    ("accounts", "engagement_level"): schemas.ENGAGEMENT_LEVELS,
    ("users", "role"): schemas.ROLES,
    ("subscriptions", "plan"): schemas.PLANS,
    ("subscriptions", "subscription_status"): schemas.SUBSCRIPTION_STATUSES,
    ("invoices", "plan"): schemas.PLANS,
    ("invoices", "payment_status"): schemas.PAYMENT_STATUSES,
    ("events", "event_name"): schemas.EVENT_NAMES,
    ("events", "event_version"): schemas.EVENT_VERSIONS,
}


def _gate_sql(bent: dict[str, str], scored: str) -> str:
    """The report: source rules counted, all other checks without a violation, and the scored accounts.

    ``bent`` replaces the rows of a source table.
    """
    parts = []
    for table, schema in schemas.TABLES.items():
        rules = {f"not_null_{table}_{c}": f"{c} IS NULL" for c in schema.fieldNames() if c not in _MAY_BE_NULL}
        for (owner, column), values in _SOURCE_LISTS.items():
            if owner == table:
                listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
                rules[f"accepted_{table}_{column}"] = f"{column} NOT IN ({listed})"
        counts = ", ".join(f"count(*) FILTER ({bad})" for bad in rules.values())
        names = ", ".join(f"'{name}'" for name in rules)
        rows = bent.get(table, f"SELECT * FROM {'product_events' if table == 'events' else table}")
        parts.append(f"SELECT unnest([{names}]) AS check_name, unnest([{counts}]) AS violations FROM ({rows})")
    names = ", ".join(f"'{n}'" for n in [*_GATE_CHECKS, *_MART_RULE_NAMES])
    parts.append(f"SELECT unnest([{names}]), CAST(0 AS BIGINT)")
    return (
        "SELECT check_name, violations, violations = 0 AS passed FROM ("
        + " UNION ALL ".join(parts)
        + f") UNION ALL SELECT 'scored accounts', {scored}, TRUE"
    )


def _report_of(d, folder, report):
    """Report rows and how many accounts were scored."""
    path = f"{folder}/scores"
    scored = d.spark.read.parquet(path).count() if _exists(d.spark, path) else 0
    row = d.spark.range(1).select(
        F.lit("scored accounts").alias("check_name"), F.lit(scored).cast("bigint").alias("violations"), F.lit(True).alias("passed")
    )
    return report.unionByName(row)


def _staged(d, **bent):
    names = ("accounts", "users", "subscriptions", "invoices", "events")
    return Staged(**{name: bent.get(name, getattr(d, name)) for name in names})


@query(
    "daily_run",
    _gate_sql({}, "(SELECT count(*) FROM subscriptions WHERE subscription_status = 'active')"),
)
def _(d):
    """One day with scores of a stored model: the quality report and the number of scored accounts."""
    folder = new_folder(d.spark, "daily")
    train_and_store(stored_features_of(d), f"{folder}/training", "run-1")
    scorer = stored_scorer(d.spark, f"{folder}/training", "run-1")
    return _report_of(d, folder, run_daily("2024-12-01", _staged(d), folder, scorer))


@query(
    "daily_gate",
    _gate_sql(
        {
            "users": "SELECT * REPLACE (CASE WHEN CAST(user_id AS INT) % 7 = 3 THEN 'Ghost' ELSE role END AS role) FROM users",
            "invoices": """SELECT * REPLACE (CASE WHEN CAST(invoice_id AS INT) % 11 <> 5 THEN payment_status END
                AS payment_status) FROM invoices""",
            "events": """SELECT * REPLACE (CASE WHEN CAST(event_id AS INT) % 13 = 0 THEN 9 ELSE event_version END
                AS event_version) FROM product_events""",
        },
        "CAST(0 AS BIGINT)",
    ),
)
def _(d):
    """Bent roles, payment states and event versions: they are reported and nothing is scored."""
    users = d.users.withColumn("role", F.when(F.col("user_id").cast("int") % 7 == 3, "Ghost").otherwise(F.col("role")))
    invoices = d.invoices.withColumn("payment_status", F.when(F.col("invoice_id").cast("int") % 11 != 5, F.col("payment_status")))
    version = F.when(F.col("event_id").cast("int") % 13 == 0, 9).otherwise(F.col("event_version"))
    folder = new_folder(d.spark, "daily")
    staged = _staged(d, users=users, invoices=invoices, events=d.events.withColumn("event_version", version))
    try:
        run_daily("2024-12-01", staged, folder, with_score)
    except qa.QualityGateError:
        pass
    return _report_of(d, folder, d.spark.read.parquet(f"{folder}/quality/date=2024-12-01"))


# --- generic quality checks -------------------------------------------------------------


@query(
    "quality_unique",
    "SELECT event_id, count(*) AS occurrences FROM raw_product_events GROUP BY 1 HAVING count(*) > 1",
)
def _(d):
    return qa.unique(d.raw_events, "event_id")


@query("quality_not_null", "SELECT * FROM subscriptions WHERE subscription_start_date IS NULL")
def _(d):
    return qa.not_null(d.subscriptions, "subscription_start_date")


@query(
    "quality_relationships",
    "SELECT * FROM users WHERE account_id NOT IN (SELECT account_id FROM invoices)",
)
def _(d):
    """Users of accounts that were never invoiced."""
    return qa.relationships(d.users, d.invoices, "account_id")


@query(
    "quality_accepted_values",
    "SELECT * FROM product_events WHERE event_name NOT IN ('user_login', 'report_created')",
)
def _(d):
    return qa.accepted_values(d.events, "event_name", ("user_login", "report_created"))


# --- bounds, on marts that are bent so that some rows fail ---------------------------------


@query(
    "activity_bounds",
    """SELECT account_id FROM mart_account_activity
       WHERE seat_utilization * 4 > 1 OR seat_utilization < 0 OR days_since_last_activity < 0
          OR events_last_7d > events_last_30d""",
    chain(ACTIVITY, MART_ACTIVITY),
)
def _(d):
    activity = mart_account_activity(activity_of(d))
    return qa.activity_bounds(activity.withColumn("seat_utilization", F.col("seat_utilization") * 4))


@query("activation_consistency", "SELECT * FROM activation WHERE days_to_activation >= 7", ACTIVATION)
def _(d):
    """Activations that a seven-day window would not allow."""
    return qa.activation_consistency(activation_of(d), window_days=7)


@query(
    "adoption_bounds",
    """SELECT * REPLACE (adoption_rate + display_order AS adoption_rate) FROM adoption
       WHERE adoption_rate + display_order > 1""",
    ADOPTION,
)
def _(d):
    adoption = feature_adoption(d.accounts, d.events)
    return qa.adoption_bounds(adoption.withColumn("adoption_rate", F.col("adoption_rate") + F.col("display_order")))


@query(
    "retention_bounds",
    """SELECT 'cohort_retention' AS metric, CAST(cohort_week AS VARCHAR) AS period FROM cohorts
       WHERE retention_rate * 1.2::DOUBLE > 1 OR (weeks_since_start = 0 AND retention_rate * 1.2::DOUBLE <> 1)
       UNION ALL
       SELECT 'logo_churn', CAST(month AS VARCHAR) FROM logo
       WHERE churned_accounts * 20 > starting_accounts""",
    chain(COHORTS, LOGO_CHURN),
)
def _(d):
    cohorts = ret.retention_cohorts(d.accounts, d.events)
    logo = ret.logo_churn(d.subscriptions, d.events)
    return qa.retention_bounds(
        cohorts.withColumn("retention_rate", F.col("retention_rate") * 1.2),
        logo.withColumn("churned_accounts", F.col("churned_accounts") * 20),
    )


@query(
    "revenue_bounds",
    """SELECT 'revenue_churn' AS metric, CAST(month AS VARCHAR) AS period FROM revenue_lost WHERE churned_mrr * 3 > starting_mrr
       UNION ALL
       SELECT 'net_revenue_retention', CAST(month AS VARCHAR) FROM revenue_kept WHERE expansion_mrr > 0
       UNION ALL
       SELECT 'churn_reconciliation', CAST(k.month AS VARCHAR) FROM revenue_kept AS k JOIN revenue_lost AS l USING (month)
       WHERE abs(k.churned_mrr - l.churned_mrr * 3) > 0.01""",
    REVENUE,
)
def _(d):
    revenue = revenue_of(d)
    churn = rev.revenue_churn(revenue).withColumn("churned_mrr", F.col("churned_mrr") * 3)
    kept = rev.revenue_retention(revenue).withColumn("expansion_mrr", F.col("expansion_mrr") * 2)
    return qa.revenue_bounds(churn, kept)


@query(
    "churn_matches_cancellations",
    """SELECT month, churned_accounts, coalesce(n, 0) AS cancellations FROM logo LEFT JOIN (
           SELECT CAST(date_trunc('month', cancellation_date + 20) AS DATE) AS month, count(*) AS n
           FROM subscriptions WHERE cancellation_date IS NOT NULL GROUP BY 1) AS moved USING (month)
       WHERE churned_accounts <> coalesce(n, 0)""",
    LOGO_CHURN,
)
def _(d):
    """Against cancellations that are dated twenty days too late."""
    late = d.subscriptions.withColumn("cancellation_date", F.date_add("cancellation_date", 20))
    return qa.churn_matches_cancellations(ret.logo_churn(d.subscriptions, d.events), late)


@query(
    "churn_feature_validity",
    """SELECT account_id, prediction_date FROM features WHERE seat_utilization * 5 > 1
       UNION ALL SELECT account_id, prediction_date FROM features WHERE seat_utilization * 5 > 1 AND churn_label = 1
       UNION ALL SELECT account_id, prediction_date FROM features WHERE churn_label = 1""",
    chain(SPINE, ACTIVATION, FEATURES),
)
def _(d):
    """Stretched seat utilization, and positives entered twice."""
    features = features_of(d).withColumn("seat_utilization", F.col("seat_utilization") * 5)
    return qa.churn_feature_validity(features.unionByName(features.where("churn_label = 1")))


@query(
    "metric_contract",
    """SELECT rule FROM (
           SELECT 'one activation row per account' AS rule,
                  (SELECT count(*) FROM activation WHERE is_activated) <> (SELECT count(*) FROM accounts) AS broken
           UNION ALL SELECT 'adoption rates in range', (SELECT max(adoption_rate) FROM adoption) > 0.5
           UNION ALL SELECT 'all features present', (SELECT count(*) FROM adoption WHERE display_order > 1) <> 5
       ) AS rules WHERE broken""",
    chain(ACTIVATION, ADOPTION),
)
def _(d):
    """Headline metrics with missing accounts, doubled rates and a missing feature."""
    activation = activation_of(d)
    adoption = feature_adoption(d.accounts, d.events)
    return qa.metric_contract(
        d.accounts,
        activation.where("is_activated"),
        act.activation_metrics(activation),
        act.trial_conversion(d.subscriptions),
        adoption.where("display_order > 1").withColumn("adoption_rate", F.col("adoption_rate") * 2),
    )


@query(
    "quality_report",
    """SELECT check_name, violations, violations = 0 AS passed FROM (
           SELECT 'unique_raw_events' AS check_name,
                  (SELECT count(*) FROM (SELECT event_id FROM raw_product_events GROUP BY 1 HAVING count(*) > 1)) AS violations
           UNION ALL SELECT 'unique_events', 0
           UNION ALL SELECT 'paid_start', (SELECT count(*) FROM subscriptions WHERE subscription_start_date IS NULL)
           UNION ALL SELECT 'known_accounts', 0
       ) AS counted""",
)
def _(d):
    return qa.quality_report(
        {
            "unique_raw_events": qa.unique(d.raw_events, "event_id"),
            "unique_events": qa.unique(d.events, "event_id"),
            "paid_start": qa.not_null(d.subscriptions, "subscription_start_date"),
            "known_accounts": qa.relationships(d.events, d.accounts, "account_id"),
        }
    )


# --- billing and event rules ------------------------------------------------------------------

_MARKS = """
marks AS (
    SELECT subscription_id, day, count(*) FILTER (side = 's') AS starts, count(*) FILTER (side = 'e') AS ends
    FROM (SELECT subscription_id, billing_period_start AS day, 's' AS side FROM invoices
          UNION ALL SELECT subscription_id, billing_period_end + 1, 'e' FROM invoices) AS sides
    GROUP BY ALL
),
edges AS (
    SELECT subscription_id, min(billing_period_start) AS first_start, max(billing_period_end) + 1 AS last_end
    FROM invoices GROUP BY 1
),
tiers AS (
    SELECT subscription_id, billing_period_start,
           min(list_position(['Starter', 'Growth', 'Enterprise'], plan)) AS low,
           max(list_position(['Starter', 'Growth', 'Enterprise'], plan)) AS high
    FROM invoices GROUP BY ALL
)"""


@query(
    "billing_history_validity",
    """SELECT 'billing periods do not meet' AS problem, concat(subscription_id, '@', day) AS id
       FROM marks JOIN edges USING (subscription_id)
       WHERE starts > 1 OR ends > 1 OR (starts = 1 AND ends = 0 AND day <> first_start)
          OR (starts = 0 AND ends = 1 AND day <> last_end)
       UNION ALL
       SELECT 'plan tier skipped', concat(subscription_id, '@', billing_period_start)
       FROM (SELECT *, lag(low) OVER w AS low_before, lag(high) OVER w AS high_before FROM tiers
             WINDOW w AS (PARTITION BY subscription_id ORDER BY billing_period_start)) AS moves
       WHERE high - low > 1 OR high - low_before > 1 OR high_before - low > 1
       UNION ALL
       SELECT 'billed on or after cancellation', invoice_id FROM invoices JOIN subscriptions USING (subscription_id)
       WHERE billing_period_end >= cancellation_date""",
    _MARKS,
)
def _(d):
    return qa.billing_history_validity(d.invoices, d.subscriptions)


@query(
    "latest_plan_matches",
    """SELECT a.account_id, l.billed_plan, a.plan AS account_plan, s.plan AS subscription_plan
       FROM (SELECT account_id, first(plan ORDER BY billing_period_start DESC, invoice_id DESC) AS billed_plan
             FROM invoices GROUP BY 1) AS l
       JOIN accounts AS a USING (account_id) JOIN subscriptions AS s USING (account_id)
       WHERE l.billed_plan <> a.plan OR l.billed_plan <> s.plan""",
)
def _(d):
    return qa.latest_plan_matches(d.accounts, d.subscriptions, d.invoices)


@query(
    "event_validity",
    """SELECT 'user of another account' AS problem, event_id AS id FROM shifted JOIN users AS u USING (user_id)
       WHERE u.account_id <> shifted.account_id
       UNION ALL
       SELECT 'event before user creation', event_id FROM shifted JOIN users AS u USING (user_id)
       WHERE event_timestamp < u.created_at
       UNION ALL
       SELECT 'event on or after cancellation', event_id FROM shifted JOIN subscriptions AS s
           ON s.account_id = shifted.account_id WHERE event_timestamp >= s.cancellation_date
       UNION ALL
       SELECT 'several workspaces', account_id FROM shifted WHERE event_name = 'workspace_created'
       GROUP BY account_id HAVING count(*) > 1
       UNION ALL
       SELECT 'export before any report', account_id FROM shifted GROUP BY account_id
       HAVING count(*) FILTER (event_name = 'report_exported') > 0
          AND coalesce(min(event_timestamp) FILTER (event_name = 'report_created'), TIMESTAMP '9999-01-01')
              >= min(event_timestamp) FILTER (event_name = 'report_exported')
       UNION ALL
       SELECT 'too much activity before workspace', 'all' FROM (
           SELECT avg(CASE WHEN e.event_timestamp > w.made THEN 1 ELSE 0 END) AS share FROM shifted AS e
           LEFT JOIN (SELECT account_id, min(event_timestamp) AS made FROM shifted
                      WHERE event_name = 'workspace_created' GROUP BY 1) AS w ON w.account_id = e.account_id
           WHERE e.event_name <> 'workspace_created') AS shares WHERE share < 0.95""",
    """shifted AS (
        SELECT event_id, CASE WHEN event_version = 1 THEN account_id ELSE CAST(CAST(account_id AS BIGINT) + 1 AS VARCHAR) END
                   AS account_id, user_id, event_name, event_timestamp, event_version
        FROM product_events)""",
)
def _(d):
    """Events of version 2 are booked on the neighbouring account."""
    neighbour = (F.col("account_id").cast("bigint") + 1).cast("string")
    shifted = d.events.withColumn(
        "account_id", F.when(F.col("event_version") == 1, F.col("account_id")).otherwise(neighbour)
    )
    return qa.event_validity(shifted, d.users, d.subscriptions)


@query(
    "seat_and_status_validity",
    """SELECT 'more users than seats' AS problem, account_id AS id
       FROM (SELECT account_id, count(*) AS n FROM users GROUP BY 1) AS u JOIN accounts AS a USING (account_id)
       WHERE n > seats_purchased - 5
       UNION ALL SELECT 'negative seats', account_id FROM accounts WHERE seats_purchased < 5
       UNION ALL SELECT 'negative amount', invoice_id FROM invoices WHERE amount < 49
       UNION ALL SELECT 'cancellation date and status disagree', subscription_id FROM subscriptions
           WHERE (cancellation_date IS NOT NULL) <> (subscription_status = 'cancelled')
       UNION ALL SELECT 'cancelled before paid start', subscription_id FROM subscriptions
           WHERE cancellation_date <= subscription_start_date
       UNION ALL SELECT DISTINCT 'invoice for a trial account', account_id FROM invoices
           WHERE account_id IN (SELECT account_id FROM subscriptions WHERE subscription_status = 'trial')""",
)
def _(d):
    """With five seats fewer per account."""
    fewer = d.accounts.withColumn("seats_purchased", F.col("seats_purchased") - 5)
    return qa.seat_and_status_validity(fewer, d.users, d.subscriptions, d.invoices)


@query(
    "billing_schedule",
    """SELECT subscription_id, account_id, CAST(k AS INT) AS period_number, CAST(begins AS DATE) AS billing_period_start,
              CAST(least(CAST(subscription_start_date + to_months(k + 1) AS DATE) - 1, cancellation_date - 1) AS DATE)
                  AS billing_period_end
       FROM (SELECT *, subscription_start_date + to_months(k) AS begins
             FROM (SELECT *, CAST(unnest(range(0, 24)) AS INT) AS k FROM subscriptions
                   WHERE subscription_start_date IS NOT NULL) AS numbered) AS periods
       WHERE begins <= DATE '2024-12-31' AND begins < coalesce(cancellation_date, DATE '9999-01-01')""",
)
def _(d):
    return bl.billing_schedule(d.subscriptions, F.lit(date(2024, 12, 31)))


@query(
    "drop_orphan_exports",
    """SELECT * FROM product_events AS e WHERE event_name <> 'report_exported' OR EXISTS (
           SELECT 1 FROM product_events AS r WHERE r.account_id = e.account_id
             AND r.event_name = 'report_created' AND r.event_timestamp <= e.event_timestamp)""",
)
def _(d):
    return bl.drop_orphan_exports(d.events)


@query(
    "pre_cancel_decline",
    """SELECT count(*) FILTER (gap BETWEEN 29 AND 56) AS earlier_events,
              count(*) FILTER (gap BETWEEN 1 AND 28) AS final_events
       FROM (SELECT cancellation_date - CAST(event_timestamp AS DATE) AS gap
             FROM product_events JOIN subscriptions USING (account_id) WHERE subscription_status = 'cancelled') AS gaps""",
)
def _(d):
    return bl.pre_cancel_decline(d.events, d.subscriptions)


@query(
    "dataset_profile",
    """SELECT 'plan' AS profile, plan AS label, CAST(count(*) AS DOUBLE) AS value FROM accounts GROUP BY plan
       UNION ALL SELECT 'engagement_level', engagement_level, count(*) FROM accounts GROUP BY 2
       UNION ALL SELECT 'event_name', event_name, count(*) FROM product_events GROUP BY 2
       UNION ALL SELECT 'median_seats', plan, median(seats_purchased) FROM accounts GROUP BY plan
       UNION ALL SELECT 'average_events', engagement_level, round(avg(n), 9)
           FROM accounts JOIN (SELECT account_id, count(*) AS n FROM product_events GROUP BY 1) AS c USING (account_id)
           GROUP BY engagement_level
       UNION ALL SELECT 'weekday_share', 'all',
           round(avg(CASE WHEN isodow(event_timestamp) < 6 THEN 1 ELSE 0 END), 9) FROM product_events""",
)
def _(d):
    return rounded(bl.dataset_profile(d.accounts, d.events), "value")


# --- health -----------------------------------------------------------------------------------


@query(
    "run_health",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'daily' ELSE 'backfill' END AS job,
              max(o_orderdate) FILTER (o_orderstatus = 'F') AS last_success_at,
              max(o_orderdate) FILTER (o_orderstatus = 'P') AS last_failure_at,
              max(o_orderdate) AS last_completion_at
       FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1""",
)
def _(d):
    """Orders read as a run log: filled is success, pending is failure."""
    runs = d.table("orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, "daily").otherwise("backfill").alias("job"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "failed")
        .otherwise("running").alias("state"),
        F.col("o_orderdate").cast("timestamp").alias("ended_at"),
    )
    return run_health(runs)


@query(
    "freshness",
    """SELECT max(ts) AS latest_at,
              greatest(CAST(epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts)) AS DOUBLE)
                  / CAST(1000000 AS DOUBLE), 0) AS age_seconds FROM events""",
)
def _(d):
    rows = d.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return freshness(rows, "ts", F.lit("2024-02-01 12:00:00").cast("timestamp"))
