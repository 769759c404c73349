"""Fixed values and schemas of the subscription data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Names and limits that outputs must agree on.

PLANS = ("Starter", "Growth", "Enterprise")
PLAN_PRICES = {"Starter": 49, "Growth": 249, "Enterprise": 999}
ENGAGEMENT_LEVELS = ("low", "medium", "high")
CHANNELS = ("Organic", "Google Ads", "LinkedIn", "Referral", "Partner")
ROLES = ("Admin", "Manager", "Analyst", "Member")
SUBSCRIPTION_STATUSES = ("trial", "active", "cancelled")
PAYMENT_STATUSES = ("paid", "failed", "pending")

EVENT_NAMES = (
    "workspace_created",
    "invite_sent",
    "integration_connected",
    "report_created",
    "report_exported",
    "dashboard_viewed",
    "user_login",
)
EVENT_VERSIONS = (1, 2)
EVENT_SOURCES = ("web", "mobile", "api")
DEVICE_TYPES = ("desktop", "mobile", "tablet", "service")

ACTIVATION_EVENTS = ("workspace_created", "invite_sent", "integration_connected")
ADOPTION_FEATURES = (
    "invite_sent",
    "integration_connected",
    "report_created",
    "report_exported",
    "dashboard_viewed",
)
# Everything except the one-off workspace creation counts as real usage.
MEANINGFUL_EVENTS = tuple(n for n in EVENT_NAMES if n != "workspace_created")

RISK_BUCKETS = ("Low", "Medium", "High")

# Lowest probability of a risk bucket.
HIGH_RISK, MEDIUM_RISK = 0.60, 0.30

# Upper limits of company size buckets, and the bucket beyond them.
SIZE_BUCKETS = ((50, "1-50"), (250, "51-250"), (1000, "251-1000"))
LARGEST_SIZE_BUCKET = "1001+"

# Onboarding stages and the event that marks them.
FUNNEL_STAGES = (
    ("Trial Started", None),
    ("Workspace Created", "workspace_created"),
    ("Invite Sent", "invite_sent"),
    ("Integration Connected", "integration_connected"),
    ("Activated", None),
)

# Wording of risk reasons; the limits that trigger them are beside the rules.
REASON_DECLINE = "activity declined {percent} versus the prior 30 days"
REASON_SEATS = "only {percent} of purchased seats were active"
REASON_IDLE = "last product activity was {days} days ago"
REASON_OLD_REPORT = "no recent reports; last report was {days} days ago"
REASON_NO_REPORT = "no report has been created"
REASON_PAYMENTS = "{payments} in 90 days"
REASON_INTEGRATION = "no integration was connected"
REASON_USERS = "one or fewer active users in the last 30 days"
REASON_DEFAULT = "risk reflects the combined model pattern rather than one dominant signal"

# Wording of cohort observations.
INSIGHT_EMPTY = "No accounts match the current filter selection."
INSIGHT_ACTIVATION = "{percent} of selected accounts reached activation."
INSIGHT_MEDIAN = "Median activation time is {days} days."
INSIGHT_LOWER = "Integration adoption ({integration}) is lower than report creation adoption ({report})."
INSIGHT_HIGHER = "Integration adoption ({integration}) is higher than report creation adoption ({report})."
INSIGHT_UP = "Monthly active accounts increased by {count} in the latest month."
INSIGHT_DOWN = "Monthly active accounts decreased by {count} in the latest month."
INSIGHT_SAME = "Monthly active accounts were unchanged in the latest month."
INSIGHT_PLAN = "{plan} had the highest observed plan retention at {percent}."
INSIGHT_ENGAGEMENT = "{level}-engagement accounts had {percent} observed retention."
INSIGHT_NRR = "Latest-month NRR was {percent}, with ${amount} churned MRR."

# Wording of rejected stream messages that name an owner.
UNKNOWN_ACCOUNT = "unknown account_id: {id}"
UNKNOWN_USER = "unknown user_id: {id}"
WRONG_OWNER = "user_id does not belong to account_id"

# Stream health: words and the age in seconds up to which it is healthy.
HEALTHY_SECONDS = 300
STREAM_HEALTHY, STREAM_STALE, STREAM_EMPTY = "Healthy", "Stale", "No data"
FRESHNESS_EMPTY = "No events yet"
FRESHNESS_SECONDS = "{n} seconds ago"
FRESHNESS_MINUTE, FRESHNESS_MINUTES = "{n} minute ago", "{n} minutes ago"
FRESHNESS_HOURS = "{n} hours ago"

CATEGORICAL_FEATURES = ("plan", "acquisition_channel")
NUMERIC_FEATURES = (
    "company_size",
    "seats_purchased",
    "account_age_days",
    "events_last_7d",
    "events_last_30d",
    "events_previous_30d",
    "active_users_last_30d",
    "active_users_previous_30d",
    "reports_created_last_30d",
    "reports_created_previous_30d",
    "reports_exported_last_30d",
    "dashboard_views_last_30d",
    "integrations_connected",
    "invites_sent_last_30d",
    "days_since_last_activity",
    "days_since_last_report",
    "days_since_last_login",
    "event_change_30d",
    "event_change_pct",
    "active_user_change",
    "report_activity_change",
    "seat_utilization",
    "failed_payments_last_90d",
    "total_failed_payments",
    "recent_payment_failed",
    "monthly_revenue",
    "is_activated",
    "days_to_activation",
)
FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERIC_FEATURES
AUDIT_COLUMNS = ("latest_event_at", "latest_invoice_date")
LABEL = "churn_label"

SCORE_COLUMNS = (
    "account_id",
    "prediction_date",
    "churn_probability",
    "risk_bucket",
    "top_reason_1",
    "top_reason_2",
    "top_reason_3",
    "monthly_revenue",
)

# --- table schemas ----------------------------------------------------------

MONEY = T.DecimalType(12, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ACCOUNTS = _schema(
    account_id=T.StringType(),
    company_name=T.StringType(),
    company_size=T.IntegerType(),
    plan=T.StringType(),
    seats_purchased=T.IntegerType(),
    acquisition_channel=T.StringType(),
    trial_start_date=T.DateType(),
    account_created_at=T.TimestampType(),
    engagement_level=T.StringType(),
)
USERS = _schema(
    user_id=T.StringType(),
    account_id=T.StringType(),
    role=T.StringType(),
    created_at=T.TimestampType(),
    is_admin=T.BooleanType(),
)
SUBSCRIPTIONS = _schema(
    subscription_id=T.StringType(),
    account_id=T.StringType(),
    plan=T.StringType(),
    trial_start_date=T.DateType(),
    trial_end_date=T.DateType(),
    subscription_start_date=T.DateType(),
    cancellation_date=T.DateType(),
    subscription_status=T.StringType(),
    monthly_price=MONEY,
)
INVOICES = _schema(
    invoice_id=T.StringType(),
    account_id=T.StringType(),
    subscription_id=T.StringType(),
    invoice_date=T.DateType(),
    billing_period_start=T.DateType(),
    billing_period_end=T.DateType(),
    plan=T.StringType(),
    amount=MONEY,
    payment_status=T.StringType(),
)
EVENTS = _schema(
    event_id=T.StringType(),
    account_id=T.StringType(),
    user_id=T.StringType(),
    event_name=T.StringType(),
    event_timestamp=T.TimestampType(),
    event_version=T.IntegerType(),
)
# Landing format of streamed events: the contract fields, context and provenance.
STREAM_LANDING = _schema(
    event_id=T.StringType(),
    account_id=T.StringType(),
    user_id=T.StringType(),
    event_name=T.StringType(),
    event_timestamp=T.TimestampType(),
    event_version=T.LongType(),
    properties=T.StringType(),
    source=T.StringType(),
    device_type=T.StringType(),
    kafka_partition=T.LongType(),
    kafka_offset=T.LongType(),
    received_at=T.TimestampType(),
)
REJECTED = _schema(
    received_at=T.StringType(),
    reason=T.StringType(),
    raw_message=T.StringType(),
)
STREAM_COUNTERS = _schema(
    received=T.LongType(),
    persisted=T.LongType(),
    rejected=T.LongType(),
    duplicates=T.LongType(),
    latest_event_timestamp=T.TimestampType(),
)

TABLES = {
    "accounts": ACCOUNTS,
    "users": USERS,
    "subscriptions": SUBSCRIPTIONS,
    "invoices": INVOICES,
    "events": EVENTS,
}
PRIMARY_KEYS = {
    "accounts": "account_id",
    "users": "user_id",
    "subscriptions": "subscription_id",
    "invoices": "invoice_id",
    "events": "event_id",
}
