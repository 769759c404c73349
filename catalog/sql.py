"""Reusable views of the check SQL (DuckDB)."""

ACTIVATION = """
milestones AS (
    SELECT a.account_id, e.event_name, min(e.event_timestamp) AS reached
    FROM accounts AS a JOIN product_events AS e USING (account_id)
    WHERE CAST(e.event_timestamp AS DATE) - a.trial_start_date BETWEEN 0 AND 13
    GROUP BY ALL
),
activation AS (
    SELECT account_id, trial_start_date, workspace_created_at, first_invite_sent_at,
           first_integration_connected_at,
           CASE WHEN reached_all THEN last_day END AS activation_date,
           reached_all AS is_activated,
           CASE WHEN reached_all THEN CAST(last_day - trial_start_date AS INT) END AS days_to_activation
    FROM (
        SELECT a.account_id, a.trial_start_date,
               w.reached AS workspace_created_at,
               i.reached AS first_invite_sent_at,
               c.reached AS first_integration_connected_at,
               CAST(greatest(w.reached, i.reached, c.reached) AS DATE) AS last_day,
               (w.reached IS NOT NULL AND i.reached IS NOT NULL AND c.reached IS NOT NULL) AS reached_all
        FROM accounts AS a
        LEFT JOIN milestones AS w ON w.account_id = a.account_id AND w.event_name = 'workspace_created'
        LEFT JOIN milestones AS i ON i.account_id = a.account_id AND i.event_name = 'invite_sent'
        LEFT JOIN milestones AS c ON c.account_id = a.account_id AND c.event_name = 'integration_connected'
    ) AS joined
)"""

ACTIVITY = """
horizon AS (SELECT max(CAST(event_timestamp AS DATE)) AS today FROM product_events),
aged_events AS (
    SELECT e.*, h.today - CAST(e.event_timestamp AS DATE) AS age FROM product_events AS e, horizon AS h
),
activity AS (
    SELECT a.account_id,
           min(e.event_timestamp) AS first_event_at,
           max(e.event_timestamp) AS last_event_at,
           count(e.event_id) AS total_events,
           count(DISTINCT e.user_id) AS number_of_active_users,
           count(CASE e.event_name WHEN 'report_created' THEN 1 END) AS report_created_count,
           count(CASE e.event_name WHEN 'report_exported' THEN 1 END) AS report_exported_count,
           count(CASE e.event_name WHEN 'dashboard_viewed' THEN 1 END) AS dashboard_viewed_count,
           count(CASE e.event_name WHEN 'invite_sent' THEN 1 END) AS invite_sent_count,
           count(CASE e.event_name WHEN 'integration_connected' THEN 1 END) AS integration_connected_count,
           any_value(a.seats_purchased) AS seats_purchased,
           (SELECT count(*) FROM users AS u WHERE u.account_id = a.account_id) AS provisioned_users,
           CAST(count(DISTINCT e.user_id) AS DOUBLE) / nullif(any_value(a.seats_purchased), 0) AS seat_utilization,
           (SELECT today FROM horizon) AS activity_as_of_date,
           CAST(min(e.age) AS INT) AS days_since_last_activity,
           count(CASE WHEN e.age < 7 THEN 1 END) AS events_last_7d,
           count(CASE WHEN e.age < 30 THEN 1 END) AS events_last_30d,
           count(DISTINCT CASE WHEN e.age < 30 THEN e.user_id END) AS active_users_last_30d
    FROM accounts AS a LEFT JOIN aged_events AS e ON e.account_id = a.account_id
    GROUP BY a.account_id
)"""

ADOPTION_LIST = "['invite_sent', 'integration_connected', 'report_created', 'report_exported', 'dashboard_viewed']"

ADOPTION = f"""
adoption AS (
    SELECT name AS feature_name,
           (SELECT count(DISTINCT account_id) FROM product_events WHERE event_name = name) AS accounts_using_feature,
           (SELECT count(*) FROM accounts) AS total_accounts,
           CAST((SELECT count(DISTINCT account_id) FROM product_events WHERE event_name = name) AS DOUBLE)
               / nullif((SELECT count(*) FROM accounts), 0) AS adoption_rate,
           CAST(list_position({ADOPTION_LIST}, name) AS INT) AS display_order
    FROM (SELECT unnest({ADOPTION_LIST}) AS name) AS listed
)"""

DIM_ACCOUNT = """
dim_account AS (
    SELECT a.*, s.subscription_status, s.subscription_start_date, s.cancellation_date, s.monthly_price
    FROM accounts AS a LEFT JOIN subscriptions AS s ON s.account_id = a.account_id
)"""

COHORTS = """
observed AS (SELECT CAST(date_trunc('week', max(event_timestamp)) AS DATE) AS final_week FROM product_events),
entered AS (SELECT account_id, CAST(date_trunc('week', trial_start_date) AS DATE) AS cohort_week FROM accounts),
visits AS (
    SELECT n.cohort_week, (CAST(date_trunc('week', e.event_timestamp) AS DATE) - n.cohort_week) // 7 AS week_number,
           count(DISTINCT e.account_id) AS seen
    FROM product_events AS e JOIN entered AS n USING (account_id)
    WHERE e.event_name <> 'workspace_created'
    GROUP BY ALL
),
cohorts AS (
    SELECT c.cohort_week, CAST(c.week_number AS INT) AS weeks_since_start, c.members AS cohort_size,
           CASE WHEN c.week_number = 0 THEN c.members ELSE coalesce(v.seen, 0) END AS retained_accounts,
           CAST(CASE WHEN c.week_number = 0 THEN c.members ELSE coalesce(v.seen, 0) END AS DOUBLE) / c.members
               AS retention_rate
    FROM (SELECT cohort_week, count(*) AS members,
                 unnest(range(0, (any_value(final_week) - cohort_week) // 7 + 1)) AS week_number
          FROM entered, observed GROUP BY cohort_week) AS c
    LEFT JOIN visits AS v ON v.cohort_week = c.cohort_week AND v.week_number = c.week_number
)"""

LOGO_CHURN = """
churn_months AS (
    SELECT CAST(unnest(range(date_trunc('month', (SELECT min(subscription_start_date) FROM subscriptions)),
                             date_trunc('month', (SELECT max(event_timestamp) FROM product_events)) + INTERVAL 1 DAY,
                             INTERVAL 1 MONTH)) AS DATE) AS month
),
logo AS (
    SELECT month, starting_accounts, churned_accounts, ending_accounts,
           CASE WHEN starting_accounts = 0 THEN 0.0::DOUBLE
                ELSE CAST(churned_accounts AS DOUBLE) / starting_accounts END AS logo_churn_rate
    FROM (
        SELECT m.month,
               (SELECT count(DISTINCT account_id) FROM subscriptions AS s
                WHERE s.subscription_start_date < m.month
                  AND coalesce(s.cancellation_date, DATE '9999-01-01') >= m.month) AS starting_accounts,
               (SELECT count(DISTINCT account_id) FROM subscriptions AS s
                WHERE s.subscription_start_date < m.month
                  AND CAST(date_trunc('month', s.cancellation_date) AS DATE) = m.month) AS churned_accounts,
               (SELECT count(DISTINCT account_id) FROM subscriptions AS s
                WHERE CAST(date_trunc('month', s.subscription_start_date) AS DATE) <= m.month
                  AND coalesce(CAST(date_trunc('month', s.cancellation_date) AS DATE), DATE '9999-01-01') > m.month)
                   AS ending_accounts
        FROM churn_months AS m
    ) AS counted
)"""

REVENUE = """
revenue AS (
    SELECT i.account_id, CAST(date_trunc('month', i.billing_period_start) AS DATE) AS month,
           first(i.plan ORDER BY i.billing_period_start DESC, i.invoice_id DESC) AS plan,
           s.subscription_status, CAST(sum(i.amount) AS DECIMAL(38, 2)) AS monthly_revenue
    FROM invoices AS i JOIN subscriptions AS s ON s.subscription_id = i.subscription_id
    GROUP BY i.account_id, CAST(date_trunc('month', i.billing_period_start) AS DATE), s.subscription_status
),
paired AS (
    SELECT CAST(p.month + INTERVAL 1 MONTH AS DATE) AS month, p.monthly_revenue AS was,
           n.monthly_revenue AS now_row, coalesce(n.monthly_revenue, 0) AS now
    FROM revenue AS p
    LEFT JOIN revenue AS n ON n.account_id = p.account_id AND n.month = CAST(p.month + INTERVAL 1 MONTH AS DATE)
    WHERE CAST(p.month + INTERVAL 1 MONTH AS DATE) <= (SELECT max(month) FROM revenue)
),
revenue_lost AS (
    SELECT month, CAST(sum(was) AS DECIMAL(38, 2)) AS starting_mrr,
           CAST(coalesce(sum(was) FILTER (now_row IS NULL), 0) AS DECIMAL(38, 2)) AS churned_mrr,
           CAST(coalesce(sum(was) FILTER (now_row IS NULL), 0) AS DOUBLE) / CAST(sum(was) AS DOUBLE)
               AS revenue_churn_rate
    FROM paired GROUP BY month HAVING sum(was) > 0
),
revenue_kept AS (
    SELECT month, CAST(sum(was) AS DECIMAL(38, 2)) AS starting_mrr,
           CAST(coalesce(sum(was) FILTER (now = 0), 0) AS DECIMAL(38, 2)) AS churned_mrr,
           CAST(coalesce(sum(was - now) FILTER (now > 0 AND now < was), 0) AS DECIMAL(38, 2)) AS contraction_mrr,
           CAST(coalesce(sum(now - was) FILTER (now > was), 0) AS DECIMAL(38, 2)) AS expansion_mrr,
           CAST(sum(now) AS DECIMAL(38, 2)) AS ending_mrr,
           CAST(sum(now) AS DOUBLE) / CAST(sum(was) AS DOUBLE) AS nrr
    FROM paired GROUP BY month HAVING sum(was) > 0
)"""

SEGMENTS = """
paid AS (
    SELECT *, subscription_status = 'active' AS kept FROM dim_account
    WHERE subscription_start_date IS NOT NULL AND subscription_status IN ('active', 'cancelled')
),
segments AS (
    SELECT segment_type, segment_value, count(*) AS total_accounts,
           count(*) FILTER (kept) AS retained_accounts, count(*) FILTER (NOT kept) AS churned_accounts,
           CAST(count(*) FILTER (kept) AS DOUBLE) / count(*) AS retention_rate
    FROM (
        SELECT kept, unnest(['plan', 'engagement_level', 'company_size', 'acquisition_channel']) AS segment_type,
               unnest([plan, engagement_level,
                       CASE WHEN company_size > 1000 THEN '1001+' WHEN company_size > 250 THEN '251-1000'
                            WHEN company_size > 50 THEN '51-250' ELSE '1-50' END,
                       acquisition_channel]) AS segment_value
        FROM paid
    ) AS laid_out
    GROUP BY ALL
)"""

SPINE = """
spine AS (
    SELECT s.account_id, m.prediction_date, s.subscription_start_date, s.cancellation_date
    FROM subscriptions AS s
    JOIN (SELECT CAST(unnest(range(
              date_trunc('month', (SELECT min(subscription_start_date) FROM subscriptions)) + INTERVAL 1 MONTH,
              date_trunc('month', (SELECT max(invoice_date) FROM invoices)) + INTERVAL 1 DAY,
              INTERVAL 1 MONTH)) AS DATE) AS prediction_date) AS m
      ON s.subscription_start_date <= m.prediction_date
     AND coalesce(s.cancellation_date, DATE '9999-01-01') > m.prediction_date
)"""

CURRENT_SPINE = """
spine AS (
    SELECT account_id, (SELECT max(CAST(event_timestamp AS DATE)) FROM product_events) AS prediction_date,
           subscription_start_date, cancellation_date
    FROM subscriptions WHERE subscription_status = 'active'
)"""

FEATURES = """
history AS (
    SELECT s.account_id, s.prediction_date, e.user_id, e.event_name, e.event_timestamp,
           s.prediction_date - CAST(e.event_timestamp AS DATE) AS age
    FROM spine AS s JOIN product_events AS e USING (account_id)
    WHERE CAST(e.event_timestamp AS DATE) <= s.prediction_date
),
used AS (
    SELECT account_id, prediction_date,
           count(*) FILTER (age < 7) AS e7, count(*) FILTER (age < 30) AS e30,
           count(*) FILTER (age BETWEEN 30 AND 59) AS p30,
           count(DISTINCT user_id) FILTER (age < 30) AS u30,
           count(DISTINCT user_id) FILTER (age BETWEEN 30 AND 59) AS up30,
           count(*) FILTER (age < 30 AND event_name = 'report_created') AS r30,
           count(*) FILTER (age BETWEEN 30 AND 59 AND event_name = 'report_created') AS rp30,
           count(*) FILTER (age < 30 AND event_name = 'report_exported') AS x30,
           count(*) FILTER (age < 30 AND event_name = 'dashboard_viewed') AS d30,
           count(*) FILTER (event_name = 'integration_connected') AS integrations,
           count(*) FILTER (age < 30 AND event_name = 'invite_sent') AS i30,
           min(age) AS idle, min(age) FILTER (event_name = 'report_created') AS report_idle,
           min(age) FILTER (event_name = 'user_login') AS login_idle,
           max(event_timestamp) AS latest_event_at
    FROM history GROUP BY account_id, prediction_date
),
billed AS (
    SELECT s.account_id, s.prediction_date,
           max(i.invoice_date) AS latest_invoice_date,
           first(i.plan ORDER BY i.billing_period_start DESC, i.invoice_id DESC) AS billed_plan,
           first(i.amount ORDER BY i.billing_period_start DESC, i.invoice_id DESC) AS billed_amount,
           first(i.payment_status ORDER BY i.billing_period_start DESC, i.invoice_id DESC) AS last_payment,
           count(*) FILTER (i.payment_status = 'failed' AND s.prediction_date - i.invoice_date < 90) AS failed_90d,
           count(*) FILTER (i.payment_status = 'failed') AS failed_ever
    FROM spine AS s JOIN invoices AS i ON i.account_id = s.account_id AND i.invoice_date <= s.prediction_date
    GROUP BY s.account_id, s.prediction_date
),
features AS (
    SELECT s.account_id, s.prediction_date,
           coalesce(b.billed_plan, a.plan) AS plan,
           a.company_size, a.seats_purchased, a.acquisition_channel,
           CAST(s.prediction_date - CAST(a.account_created_at AS DATE) AS INT) AS account_age_days,
           coalesce(u.e7, 0) AS events_last_7d,
           coalesce(u.e30, 0) AS events_last_30d,
           coalesce(u.p30, 0) AS events_previous_30d,
           coalesce(u.u30, 0) AS active_users_last_30d,
           coalesce(u.up30, 0) AS active_users_previous_30d,
           coalesce(u.r30, 0) AS reports_created_last_30d,
           coalesce(u.rp30, 0) AS reports_created_previous_30d,
           coalesce(u.x30, 0) AS reports_exported_last_30d,
           coalesce(u.d30, 0) AS dashboard_views_last_30d,
           coalesce(u.integrations, 0) AS integrations_connected,
           coalesce(u.i30, 0) AS invites_sent_last_30d,
           CAST(u.idle AS INT) AS days_since_last_activity,
           CAST(u.report_idle AS INT) AS days_since_last_report,
           CAST(u.login_idle AS INT) AS days_since_last_login,
           coalesce(u.e30, 0) - coalesce(u.p30, 0) AS event_change_30d,
           CASE WHEN coalesce(u.p30, 0) > 0 THEN CAST(u.e30 - u.p30 AS DOUBLE) / u.p30
                WHEN coalesce(u.e30, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS event_change_pct,
           coalesce(u.u30, 0) - coalesce(u.up30, 0) AS active_user_change,
           coalesce(u.r30, 0) - coalesce(u.rp30, 0) AS report_activity_change,
           CAST(coalesce(u.u30, 0) AS DOUBLE) / nullif(a.seats_purchased, 0) AS seat_utilization,
           coalesce(b.failed_90d, 0) AS failed_payments_last_90d,
           coalesce(b.failed_ever, 0) AS total_failed_payments,
           CASE WHEN b.last_payment = 'failed' THEN 1 ELSE 0 END AS recent_payment_failed,
           CAST(coalesce(b.billed_amount, 0) AS DECIMAL(12, 2)) AS monthly_revenue,
           CASE WHEN n.is_activated AND n.activation_date <= s.prediction_date THEN 1 ELSE 0 END AS is_activated,
           CASE WHEN n.activation_date <= s.prediction_date THEN n.days_to_activation END AS days_to_activation,
           u.latest_event_at, b.latest_invoice_date,
           CASE WHEN s.cancellation_date - s.prediction_date BETWEEN 1 AND 30 THEN 1 ELSE 0 END AS churn_label
    FROM spine AS s
    JOIN accounts AS a USING (account_id)
    LEFT JOIN used AS u USING (account_id, prediction_date)
    LEFT JOIN billed AS b USING (account_id, prediction_date)
    LEFT JOIN activation AS n USING (account_id)
)"""

# A made-up but deterministic score with many ties, the same in both engines.
SCORE = """CAST((CAST(account_id AS BIGINT) * 37 + month(prediction_date) * 11 + events_last_30d * 7) % 101 AS DOUBLE)
    / CAST(100 AS DOUBLE)"""

SCORED = f"""
scored AS (SELECT *, least(1.0::DOUBLE, {SCORE}) AS churn_probability FROM features)"""


def reasons(features: str = "scored") -> str:
    return f"""
explained AS (
    SELECT *, CASE WHEN len(found) = 0
                   THEN ['risk reflects the combined model pattern rather than one dominant signal']
                   ELSE found[1:3] END AS reasons
    FROM (
        SELECT *, list_filter([
            CASE WHEN event_change_pct <= -0.3 THEN
                concat('activity declined ', CAST(round_even(abs(event_change_pct) * 100, 0) AS INT), '% versus the prior 30 days') END,
            CASE WHEN seat_utilization < 0.25 THEN
                concat('only ', CAST(round_even(seat_utilization * 100, 0) AS INT), '% of purchased seats were active') END,
            CASE WHEN days_since_last_activity >= 14 THEN
                concat('last product activity was ', days_since_last_activity, ' days ago') END,
            CASE WHEN reports_created_last_30d = 0 THEN
                CASE WHEN days_since_last_report IS NULL THEN 'no report has been created'
                     ELSE concat('no recent reports; last report was ', days_since_last_report, ' days ago') END END,
            CASE WHEN failed_payments_last_90d = 1 THEN '1 failed payment in 90 days'
                 WHEN failed_payments_last_90d > 1 THEN concat(failed_payments_last_90d, ' failed payments in 90 days') END,
            CASE WHEN integrations_connected = 0 THEN 'no integration was connected' END,
            CASE WHEN active_users_last_30d <= 1 THEN 'one or fewer active users in the last 30 days' END
        ], lambda x: x IS NOT NULL) AS found
        FROM {features}
    ) AS searched
),
scores AS (
    SELECT account_id, prediction_date, churn_probability,
           CASE WHEN churn_probability >= 0.6 THEN 'High' WHEN churn_probability >= 0.3 THEN 'Medium' ELSE 'Low' END
               AS risk_bucket,
           reasons[1] AS top_reason_1, reasons[2] AS top_reason_2, reasons[3] AS top_reason_3,
           CAST(monthly_revenue AS DOUBLE) AS monthly_revenue
    FROM explained
)"""


def chain(*views: str) -> str:
    return ",\n".join(v.strip() for v in views)
