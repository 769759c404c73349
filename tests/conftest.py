import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# tests count what a session ran, which by default forgets all but the last 1,000
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.sql.ui.retainedExecutions=100000 pyspark-shell")

from subsight import schemas  # noqa: E402
from subsight.session import local_session  # noqa: E402
from tables import day, moment  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, memory="4g")


class Build:
    """Small tables with defaults for the columns a test does not care about."""

    def __init__(self, spark):
        self.spark = spark

    def _frame(self, schema, rows):
        names = schema.fieldNames()
        return self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    def accounts(self, *rows):
        base = dict(
            company_name="C",
            company_size=10,
            plan="Starter",
            seats_purchased=10,
            acquisition_channel="Organic",
            trial_start_date=day("2024-01-01"),
            account_created_at=moment("2024-01-01 00:00:00"),
            engagement_level="low",
        )
        return self._frame(schemas.ACCOUNTS, [{**base, **r} for r in rows])

    def users(self, *rows):
        base = dict(role="Member", created_at=moment("2024-01-01 00:00:00"), is_admin=False)
        return self._frame(schemas.USERS, [{**base, **r} for r in rows])

    def subscriptions(self, *rows):
        result = []
        for r in rows:
            r = dict(r)
            r.setdefault("subscription_id", "S" + r["account_id"])
            r.setdefault("plan", "Starter")
            r.setdefault("trial_start_date", day("2024-01-01"))
            r.setdefault("trial_end_date", day("2024-01-15"))
            if "subscription_status" not in r:
                r["subscription_status"] = (
                    "cancelled" if r.get("cancellation_date") else "active" if r.get("subscription_start_date") else "trial"
                )
            r.setdefault("monthly_price", Decimal("49.00"))
            result.append(r)
        return self._frame(schemas.SUBSCRIPTIONS, result)

    def invoices(self, *rows):
        result = []
        for i, r in enumerate(rows):
            r = dict(r)
            r.setdefault("invoice_id", f"I{i:03d}")
            r.setdefault("subscription_id", "S" + r["account_id"])
            r.setdefault("billing_period_start", r["invoice_date"])
            r.setdefault("billing_period_end", r["invoice_date"])
            r.setdefault("plan", "Starter")
            r["amount"] = Decimal(str(r.get("amount", 49)))
            r.setdefault("payment_status", "paid")
            result.append(r)
        return self._frame(schemas.INVOICES, result)

    def events(self, *rows):
        """(account, user, name, time) tuples."""
        return self._frame(
            schemas.EVENTS,
            [
                dict(event_id=f"E{i:04d}", account_id=a, user_id=u, event_name=n, event_timestamp=moment(t), event_version=1)
                for i, (a, u, n, t) in enumerate(rows)
            ],
        )


@pytest.fixture(scope="session")
def build(spark):
    return Build(spark)
