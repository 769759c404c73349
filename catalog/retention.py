"""Retention, churn, revenue and cohort reporting."""

from pyspark.sql import functions as F

from catalog.registry import query, rounded
from catalog.sql import (
    ACTIVATION,
    ACTIVITY,
    ADOPTION_LIST,
    COHORTS,
    DIM_ACCOUNT,
    LOGO_CHURN,
    REVENUE,
    SEGMENTS,
    chain,
)
from catalog.usage import MART_ACTIVITY, activation_of, activity_of, dim_of
from subsight.operators import cohorts as co
from subsight.operators import retention as ret
from subsight.operators import revenue as rev
from subsight.operators.activity import mart_account_activity, monthly_active_accounts


def revenue_of(d):
    return rev.account_monthly_revenue(d.invoices, d.subscriptions)


@query("retention_cohorts", "SELECT * FROM cohorts", COHORTS)
def _(d):
    return ret.retention_cohorts(d.accounts, d.events)


@query("logo_churn", "SELECT * FROM logo", LOGO_CHURN)
def _(d):
    return ret.logo_churn(d.subscriptions, d.events)


@query("account_monthly_revenue", "SELECT * FROM revenue", REVENUE)
def _(d):
    return revenue_of(d)


@query("revenue_churn", "SELECT * FROM revenue_lost", REVENUE)
def _(d):
    return rev.revenue_churn(revenue_of(d))


@query("revenue_retention", "SELECT * FROM revenue_kept", REVENUE)
def _(d):
    return rev.revenue_retention(revenue_of(d))


@query(
    "churn_reconciliation",
    """SELECT 'nrr_identity' AS metric, month FROM bent_kept
       WHERE abs(ending_mrr - (starting_mrr - churned_mrr - contraction_mrr + expansion_mrr)) > 0.01
       UNION ALL
       SELECT 'churn_reconciliation', k.month FROM bent_kept AS k JOIN revenue_lost AS l ON l.month = k.month
       WHERE abs(k.starting_mrr - l.starting_mrr) > 0.01 OR abs(k.churned_mrr - l.churned_mrr) > 0.01""",
    chain(
        REVENUE,
        """bent_kept AS (SELECT * REPLACE (
               ending_mrr + CASE WHEN month(month) % 3 = 1 THEN 5 ELSE 0 END AS ending_mrr,
               starting_mrr + CASE WHEN month(month) % 4 = 2 THEN 7 ELSE 0 END AS starting_mrr) FROM revenue_kept)""",
    ),
)
def _(d):
    """Revenue retention bent in known months, against revenue churn as it is."""
    revenue = revenue_of(d)
    bent = rev.revenue_retention(revenue).withColumns(
        {
            "ending_mrr": F.col("ending_mrr") + F.when(F.month("month") % 3 == 1, 5).otherwise(0),
            "starting_mrr": F.col("starting_mrr") + F.when(F.month("month") % 4 == 2, 7).otherwise(0),
        }
    )
    return rev.churn_reconciliation(bent, rev.revenue_churn(revenue))


@query("retention_segments", "SELECT * FROM segments", chain(DIM_ACCOUNT, SEGMENTS))
def _(d):
    return ret.retention_segments(dim_of(d))


_BEHAVIOR_AVERAGES = (
    "avg_total_events",
    "avg_active_users",
    "avg_seat_utilization",
    "avg_reports_created",
    "avg_reports_exported",
    "avg_integrations_connected",
    "avg_dashboards_viewed",
    "avg_days_since_last_activity",
    "avg_events_last_7d",
    "avg_events_last_30d",
    "avg_active_users_last_30d",
)


@query(
    "retention_behavior",
    """SELECT CASE WHEN kept THEN 'retained' ELSE 'churned' END AS retention_status, count(*) AS total_accounts,
              round(avg(total_events), 9) AS avg_total_events,
              round(avg(active_users), 9) AS avg_active_users,
              round(avg(seat_utilization), 9) AS avg_seat_utilization,
              round(avg(report_created_count), 9) AS avg_reports_created,
              round(avg(report_exported_count), 9) AS avg_reports_exported,
              round(avg(integration_connected_count), 9) AS avg_integrations_connected,
              round(avg(dashboard_viewed_count), 9) AS avg_dashboards_viewed,
              round(avg(days_since_last_activity), 9) AS avg_days_since_last_activity,
              round(avg(events_last_7d), 9) AS avg_events_last_7d,
              round(avg(events_last_30d), 9) AS avg_events_last_30d,
              round(avg(active_users_last_30d), 9) AS avg_active_users_last_30d
       FROM paid JOIN mart_account_activity AS m USING (account_id) GROUP BY kept""",
    chain(DIM_ACCOUNT, SEGMENTS, ACTIVITY, MART_ACTIVITY),
)
def _(d):
    behavior = ret.retention_behavior(dim_of(d), mart_account_activity(activity_of(d)))
    return rounded(behavior, *_BEHAVIOR_AVERAGES)


# --- cohort reporting ---------------------------------------------------------------

_CHOSEN = "chosen AS (SELECT * FROM dim_account WHERE plan = 'Growth' AND engagement_level = 'medium')"
_CHOSEN_EVENTS = "chosen_events AS (SELECT e.* FROM product_events AS e WHERE account_id IN (SELECT account_id FROM chosen))"


def chosen(d):
    return co.filter_accounts(dim_of(d), plan="Growth", engagement_level="medium")


def chosen_events(d):
    return co.restrict_to_accounts(d.events, chosen(d))


@query("filter_accounts", "SELECT * FROM chosen", chain(DIM_ACCOUNT, _CHOSEN))
def _(d):
    return chosen(d)


@query("restrict_to_accounts", "SELECT * FROM chosen_events", chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS))
def _(d):
    return chosen_events(d)


_ALIGNED = """
aligned AS (
    SELECT p.month_start, count(DISTINCT c.account_id) AS active_accounts
    FROM (SELECT DISTINCT CAST(date_trunc('month', event_timestamp) AS DATE) AS month_start FROM product_events) AS p
    LEFT JOIN chosen_events AS c ON CAST(date_trunc('month', c.event_timestamp) AS DATE) = p.month_start
    GROUP BY p.month_start
)"""


@query("align_activity_periods", "SELECT * FROM aligned", chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS, _ALIGNED))
def _(d):
    return co.align_activity_periods(
        monthly_active_accounts(chosen_events(d)), monthly_active_accounts(d.events), "month_start"
    )


_KPIS = """
kpi AS (
    SELECT (SELECT count(*) FROM chosen) AS total_accounts,
           count(*) FILTER (is_activated) AS activated_accounts,
           coalesce(CAST(count(*) FILTER (is_activated) AS DOUBLE) / nullif((SELECT count(*) FROM chosen), 0), 0)
               AS activation_rate,
           CAST(median(days_to_activation) AS DOUBLE) AS median_days_to_activation,
           coalesce(CAST((SELECT count(subscription_start_date) FROM chosen) AS DOUBLE)
               / nullif((SELECT count(*) FROM chosen), 0), 0) AS trial_conversion_rate,
           (SELECT count(DISTINCT account_id) FROM chosen_events
            WHERE date_trunc('month', event_timestamp)
                = (SELECT date_trunc('month', max(event_timestamp)) FROM product_events)) AS monthly_active_accounts,
           (SELECT CAST(date_trunc('month', max(event_timestamp)) AS DATE) FROM product_events) AS latest_observed_month
    FROM activation WHERE account_id IN (SELECT account_id FROM chosen)
)"""


def kpis_of(d):
    cohort = chosen(d)
    return co.kpis(
        cohort,
        co.restrict_to_accounts(d.subscriptions, cohort),
        co.restrict_to_accounts(activation_of(d), cohort),
        chosen_events(d),
        d.events,
    )


@query("kpis", "SELECT * FROM kpi", chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS, ACTIVATION, _KPIS))
def _(d):
    return kpis_of(d)


@query(
    "activation_funnel",
    """SELECT CAST(stage_order AS INT) AS stage_order, stage, account_count,
              coalesce(CAST(account_count AS DOUBLE) / nullif(total, 0), 0) AS percentage,
              concat(CAST(round_even(100 * coalesce(CAST(account_count AS DOUBLE) / nullif(total, 0), 0), 0) AS INT), '%')
                  AS percentage_display
       FROM (
           SELECT 1 AS stage_order, 'Trial Started' AS stage, (SELECT count(*) FROM chosen) AS account_count
           UNION ALL SELECT 2, 'Workspace Created',
               (SELECT count(DISTINCT account_id) FROM chosen_events WHERE event_name = 'workspace_created')
           UNION ALL SELECT 3, 'Invite Sent',
               (SELECT count(DISTINCT account_id) FROM chosen_events WHERE event_name = 'invite_sent')
           UNION ALL SELECT 4, 'Integration Connected',
               (SELECT count(DISTINCT account_id) FROM chosen_events WHERE event_name = 'integration_connected')
           UNION ALL SELECT 5, 'Activated',
               (SELECT count(*) FROM activation
                WHERE is_activated AND account_id IN (SELECT account_id FROM chosen))
       ) AS stages, (SELECT count(*) AS total FROM chosen) AS totals""",
    chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS, ACTIVATION),
)
def _(d):
    cohort = chosen(d)
    return co.activation_funnel(cohort, co.restrict_to_accounts(activation_of(d), cohort), chosen_events(d))


_CHOSEN_ADOPTION = f"""
chosen_adoption AS (
    SELECT f.name AS feature_name, count(DISTINCT e.account_id) AS accounts_using_feature,
           (SELECT count(*) FROM chosen) AS total_accounts,
           coalesce(CAST(count(DISTINCT e.account_id) AS DOUBLE) / nullif((SELECT count(*) FROM chosen), 0), 0)
               AS adoption_rate
    FROM (SELECT unnest({ADOPTION_LIST}) AS name) AS f LEFT JOIN chosen_events AS e ON e.event_name = f.name
    GROUP BY f.name
)"""


@query(
    "cohort_feature_adoption",
    "SELECT *, adoption_rate * 100 AS adoption_percentage FROM chosen_adoption",
    chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS, _CHOSEN_ADOPTION),
)
def _(d):
    return co.cohort_feature_adoption(chosen(d), chosen_events(d))


@query(
    "activity_table",
    """SELECT m.account_id, c.plan, c.engagement_level, c.subscription_status, m.total_events, m.active_users,
              m.first_event_at, m.last_event_at, m.report_created_count, m.report_exported_count,
              m.dashboard_viewed_count
       FROM mart_account_activity AS m JOIN chosen AS c ON c.account_id = m.account_id""",
    chain(DIM_ACCOUNT, _CHOSEN, ACTIVITY, MART_ACTIVITY),
)
def _(d):
    cohort = chosen(d)
    activity = co.restrict_to_accounts(mart_account_activity(activity_of(d)), cohort)
    return co.in_activity_order(co.activity_table(activity, cohort))


@query(
    "rate_trend",
    """SELECT 'logo_churn' AS metric, month, logo_churn_rate AS rate, logo_churn_rate * 100 AS percentage FROM logo
       UNION ALL SELECT 'revenue_churn', month, revenue_churn_rate, revenue_churn_rate * 100 FROM revenue_lost
       UNION ALL SELECT 'nrr', month, nrr, nrr * 100 FROM revenue_kept""",
    chain(LOGO_CHURN, REVENUE),
)
def _(d):
    revenue = revenue_of(d)
    trends = {
        "logo_churn": (ret.logo_churn(d.subscriptions, d.events), "logo_churn_rate"),
        "revenue_churn": (rev.revenue_churn(revenue), "revenue_churn_rate"),
        "nrr": (rev.revenue_retention(revenue), "nrr"),
    }
    result = None
    for name, (frame, column) in trends.items():
        rows = co.rate_trend(frame, column).withColumnRenamed(column, "rate").withColumn("metric", F.lit(name))
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "insights",
    """SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INT) AS position, insight FROM (
           SELECT 1 AS place, concat(CAST(round_even(activation_rate * 100, 0) AS INT),
                  '% of selected accounts reached activation.') AS insight FROM kpi
           UNION ALL
           SELECT 2, concat('Median activation time is ',
                  CASE WHEN median_days_to_activation = floor(median_days_to_activation)
                       THEN CAST(CAST(median_days_to_activation AS INT) AS VARCHAR)
                       ELSE format('{:.1f}', median_days_to_activation) END, ' days.')
           FROM kpi WHERE median_days_to_activation IS NOT NULL
           UNION ALL
           SELECT 3, concat('Integration adoption (', CAST(round_even(i.adoption_rate * 100, 0) AS INT), '%) is ',
                  CASE WHEN i.adoption_rate < r.adoption_rate THEN 'lower' ELSE 'higher' END,
                  ' than report creation adoption (', CAST(round_even(r.adoption_rate * 100, 0) AS INT), '%).')
           FROM chosen_adoption AS i, chosen_adoption AS r
           WHERE i.feature_name = 'integration_connected' AND r.feature_name = 'report_created'
             AND i.adoption_rate <> r.adoption_rate
           UNION ALL
           SELECT 4, CASE WHEN latest > before THEN concat('Monthly active accounts increased by ', latest - before, ' in the latest month.')
                          WHEN latest < before THEN concat('Monthly active accounts decreased by ', before - latest, ' in the latest month.')
                          ELSE 'Monthly active accounts were unchanged in the latest month.' END
           FROM (SELECT active_accounts AS latest, lag(active_accounts) OVER (ORDER BY month_start) AS before,
                        row_number() OVER (ORDER BY month_start DESC) AS r FROM aligned) AS moves
           WHERE r = 1 AND before IS NOT NULL
       ) AS sentences""",
    chain(DIM_ACCOUNT, _CHOSEN, _CHOSEN_EVENTS, ACTIVATION, _KPIS, _CHOSEN_ADOPTION, _ALIGNED),
)
def _(d):
    events = chosen_events(d)
    monthly = co.align_activity_periods(
        monthly_active_accounts(events), monthly_active_accounts(d.events), "month_start"
    )
    return co.insights(kpis_of(d), co.cohort_feature_adoption(chosen(d), events), monthly)


@query(
    "retention_insights",
    """SELECT 1 AS position, concat(segment_value, ' had the highest observed plan retention at ',
                  format('{:.1f}', retention_rate * 100), '%.') AS insight
       FROM (SELECT * FROM segments WHERE segment_type = 'plan' ORDER BY retention_rate DESC, segment_value LIMIT 1)
       UNION ALL
       SELECT 2, concat(upper(segment_value[1]), segment_value[2:], '-engagement accounts had ',
                  format('{:.1f}', retention_rate * 100), '% observed retention.')
       FROM (SELECT * FROM segments WHERE segment_type = 'engagement_level'
             ORDER BY retention_rate DESC, segment_value LIMIT 1)
       UNION ALL
       SELECT 3, concat('Latest-month NRR was ', format('{:.1f}', nrr * 100), '%, with $',
                  format('{:,}', CAST(churned_mrr AS BIGINT)), ' churned MRR.')
       FROM revenue_kept WHERE month = (SELECT max(month) FROM revenue_kept)""",
    chain(DIM_ACCOUNT, SEGMENTS, REVENUE),
)
def _(d):
    return co.retention_insights(ret.retention_segments(dim_of(d)), rev.revenue_retention(revenue_of(d)))
