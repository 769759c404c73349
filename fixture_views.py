"""The subscription tables as views over the driver's test tables.

One set of definitions is rendered in two SQL dialects, so that the Spark
operators and the DuckDB checks start from the same rows.  Account ``a`` owns
customers 5a .. 5a+4; seven years of orders are folded into 2024.  All rows of
the source tables take part.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.schemas import EVENTS
from subsight.session import configure, shared_folder
from subsight.sources import tables
from subsight.sources.events import stg_events


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def idiv(self, x: str, y: int) -> str:
        return f"({x} div {y})" if self.spark else f"({x} // {y})"

    def add_days(self, day: str, n: str) -> str:
        n = f"CAST({n} AS INT)"
        return f"date_add({day}, {n})" if self.spark else f"({day} + {n})"

    def days_from(self, epoch: str, ts: str) -> str:
        epoch, day = f"DATE '{epoch}'", f"CAST({ts} AS DATE)"
        return f"datediff({day}, {epoch})" if self.spark else f"date_diff('day', {epoch}, {day})"

    def at_hour(self, day: str, n: str) -> str:
        n = f"CAST({n} AS INT)"
        if self.spark:
            return f"timestampadd(HOUR, {n}, CAST({day} AS TIMESTAMP))"
        return f"(CAST({day} AS TIMESTAMP) + to_hours({n}))"

    # --- values derived from an account number ---------------------------------

    def trial_start(self, a: str) -> str:
        return self.add_days("DATE '2024-01-01'", f"{a} * 7 % 150")

    def paid_start(self, a: str) -> str:
        return f"CASE WHEN {a} % 5 <> 0 THEN {self.add_days(self.trial_start(a), '14')} END"

    def cancelled_on(self, a: str) -> str:
        day = self.add_days(self.trial_start(a), f"44 + {a} * 11 % 120")
        return f"CASE WHEN {a} % 5 <> 0 AND {a} % 4 = 1 THEN {day} END"

    def folded(self, ts: str) -> str:
        return self.add_days("DATE '2024-01-01'", f"{self.days_from('1995-01-01', ts)} % 364")


def _plan(number: str) -> str:
    return f"CASE {number} % 3 WHEN 0 THEN 'Starter' WHEN 1 THEN 'Growth' ELSE 'Enterprise' END"


def _price(number: str) -> str:
    return f"CAST(CASE {number} % 3 WHEN 0 THEN 49 WHEN 1 THEN 249 ELSE 999 END AS DECIMAL(12, 2))"


def definitions(d: Dialect) -> dict[str, str]:
    """SQL of each view in dependency order, over customer, orders and lineitem."""
    a = "a"
    owner = d.idiv("o_custkey", 5)
    return {
        "accounts": f"""
            SELECT CAST(a AS STRING) AS account_id,
                   concat('Account ', CAST(a AS STRING)) AS company_name,
                   CAST(5 + (a * 37) % 1500 AS INT) AS company_size,
                   {_plan(a)} AS plan,
                   CAST(5 + (a * 7) % 40 AS INT) AS seats_purchased,
                   CASE a % 5 WHEN 0 THEN 'Organic' WHEN 1 THEN 'Google Ads' WHEN 2 THEN 'LinkedIn'
                              WHEN 3 THEN 'Referral' ELSE 'Partner' END AS acquisition_channel,
                   {d.trial_start(a)} AS trial_start_date,
                   {d.at_hour(d.trial_start(a), '8')} AS account_created_at,
                   CASE a % 4 WHEN 0 THEN 'low' WHEN 3 THEN 'high' ELSE 'medium' END AS engagement_level
            FROM (SELECT DISTINCT {d.idiv('c_custkey', 5)} AS a FROM customer) AS numbered""",
        "users": f"""
            SELECT CAST(c_custkey AS STRING) AS user_id,
                   CAST({d.idiv('c_custkey', 5)} AS STRING) AS account_id,
                   CASE c_custkey % 5 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Manager' WHEN 2 THEN 'Analyst'
                                      ELSE 'Member' END AS role,
                   {d.at_hour(d.trial_start(d.idiv('c_custkey', 5)), '0')} AS created_at,
                   c_custkey % 5 = 0 AS is_admin
            FROM customer""",
        "subscriptions": f"""
            SELECT CAST(a AS STRING) AS subscription_id,
                   CAST(a AS STRING) AS account_id,
                   {_plan(a)} AS plan,
                   {d.trial_start(a)} AS trial_start_date,
                   {d.add_days(d.trial_start(a), '14')} AS trial_end_date,
                   {d.paid_start(a)} AS subscription_start_date,
                   {d.cancelled_on(a)} AS cancellation_date,
                   CASE WHEN a % 5 = 0 THEN 'trial' WHEN a % 4 = 1 THEN 'cancelled' ELSE 'active' END
                       AS subscription_status,
                   {_price(a)} AS monthly_price
            FROM (SELECT DISTINCT {d.idiv('c_custkey', 5)} AS a FROM customer) AS numbered""",
        "invoices": f"""
            SELECT CAST(o_orderkey AS STRING) AS invoice_id,
                   CAST(a AS STRING) AS account_id,
                   CAST(a AS STRING) AS subscription_id,
                   billed AS invoice_date,
                   billed AS billing_period_start,
                   {d.add_days('billed', '29')} AS billing_period_end,
                   {_plan('o_orderkey')} AS plan,
                   {_price('o_orderkey')} AS amount,
                   CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'pending' ELSE 'paid' END
                       AS payment_status
            FROM (SELECT o_orderkey, o_orderstatus, {owner} AS a, {d.folded('o_orderdate')} AS billed
                  FROM orders) AS billed_orders
            WHERE billed >= {d.paid_start(a)}
              AND billed < coalesce({d.cancelled_on(a)}, DATE '9999-01-01')""",
        "raw_product_events": f"""
            SELECT CAST(l_orderkey * 8 + l_linenumber AS STRING) AS event_id,
                   CAST(a AS STRING) AS account_id,
                   CAST(o_custkey AS STRING) AS user_id,
                   CASE l_partkey % 7 WHEN 0 THEN 'workspace_created' WHEN 1 THEN 'invite_sent'
                        WHEN 2 THEN 'integration_connected' WHEN 3 THEN 'report_created'
                        WHEN 4 THEN 'report_exported' WHEN 5 THEN 'dashboard_viewed'
                        ELSE 'user_login' END AS event_name,
                   {d.at_hour('happened', 'l_partkey % 24')} AS event_timestamp,
                   CAST(1 + l_linenumber % 2 AS INT) AS event_version
            FROM (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, {owner} AS a,
                         {d.folded('l_shipdate')} AS happened
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS shipped
            WHERE happened >= {d.trial_start(a)}
              AND happened < coalesce({d.cancelled_on(a)}, DATE '9999-01-01')""",
    }


# Kafka-like messages: JSON text per row of the driver's event table.
_STREAM_NAMES = {
    "signup": "workspace_created",
    "click": "user_login",
    "view": "dashboard_viewed",
    "purchase": "report_created",
    "error": "invite_sent",
}


def stream_messages(events: DataFrame) -> DataFrame:
    """(value, partition, offset) rows of the message stream.

    Ids ending in 0 are delivered twice.  In every fifty ids one has an unknown
    event name and one an unknown account; version 2 carries its context.
    """
    number = F.col("event_id")
    account = F.floor(F.col("user_id") / 5)
    mapped = F.create_map(*[F.lit(x) for pair in _STREAM_NAMES.items() for x in pair])
    second_version = number % 2 == 1
    body = F.struct(
        F.concat(F.lit("S"), number.cast("string")).alias("event_id"),
        F.when(number % 50 == 13, F.lit("nobody")).otherwise(account.cast("string")).alias("account_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(number % 50 == 7, F.lit("mystery")).otherwise(mapped[F.col("event_type")]).alias("event_name"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("event_timestamp"),
        (1 + number % 2).cast("int").alias("event_version"),
        F.from_json("props", "k int").alias("properties"),
        F.when(second_version, F.lit("web")).alias("source"),
        F.when(second_version, F.lit("desktop")).alias("device_type"),
    )
    copies = F.when(number % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select(
        F.to_json(body).cast("binary").alias("value"),
        (account % 4).cast("long").alias("partition"),
        number.alias("number"),
        F.explode(copies).alias("copy"),
    ).select("value", "partition", (F.col("number") * 2 + F.col("copy")).alias("offset"))


def malformed_messages(events: DataFrame) -> DataFrame:
    """Every event as a message broken in one of twelve ways, by its id."""
    number = F.col("event_id")
    q = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
    account = F.floor(F.col("user_id") / 5).cast("string")
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = (number % 12).cast("int")
    fields = F.array_compact(
        F.array(
            F.when(kind != 0, q("event_id", F.when(kind == 1, F.lit("")).otherwise(F.concat(F.lit("S"), number.cast("string"))))),
            q("account_id", account),
            q("user_id", F.when(kind == 11, F.lit("9999999999")).otherwise(F.col("user_id").cast("string"))),
            q("event_name", F.lit("user_login")),
            q("event_timestamp", F.when(kind == 2, ts).when(kind == 3, F.lit("not-a-time")).otherwise(F.concat(ts, F.lit("+00:00")))),
            F.when(kind == 4, F.lit('"event_version":"1"')).when(kind == 5, F.lit('"event_version":99')).when(
                kind.isin(6, 10), F.lit('"event_version":2')
            ).otherwise(F.lit('"event_version":1')),
            F.when(kind == 7, F.lit('"colour":"red"')),
            F.when(kind == 10, F.lit('"source":"web","device_type":"fridge"')),
        )
    )
    text = F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))
    text = F.when(kind == 8, F.concat(F.lit("["), text, F.lit("]"))).when(kind == 9, F.lit("{not json")).otherwise(text)
    return events.select(
        text.cast("binary").alias("value"), F.lit(0).cast("long").alias("partition"), number.alias("offset")
    )


_STORED: dict[str, str] = {}

#: Messages in one file of a source at most.
FILE_MESSAGES = 50_000


def store_views(spark: SparkSession, sf_dir: str) -> None:
    """Write the views and the deduplicated events once.

    Queries over ``sf_dir`` in this process read them from then on, so that a
    timing shows the operator and not the building of its input.
    """
    data = TestData(spark, sf_dir)
    path = f"{shared_folder(spark)}/views-{uuid.uuid4().hex}"
    views = {name: getattr(data, name) for name in ("accounts", "users", "subscriptions", "invoices", "events")}
    for name, df in {**views, "raw_product_events": data.raw_events}.items():
        df.write.parquet(f"{path}/{name}")
    _STORED[sf_dir] = path


class TestData:
    """Lazily built DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._sql = definitions(Dialect(spark=True))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str, **sources: DataFrame) -> DataFrame:
        if self.sf_dir in _STORED:
            return self.spark.read.parquet(f"{_STORED[self.sf_dir]}/{name}")
        text = self._sql[name]
        for source in sources:
            for before in ("FROM ", "JOIN "):
                text = text.replace(f"{before}{source}", f"{before}{{{source}}}")
        return self.spark.sql(text, **sources)

    @cached_property
    def accounts(self) -> DataFrame:
        return tables.stg_accounts(self._view("accounts", customer=self.table("customer")))

    @cached_property
    def users(self) -> DataFrame:
        return tables.stg_users(self._view("users", customer=self.table("customer")))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return tables.stg_subscriptions(self._view("subscriptions", customer=self.table("customer")))

    @cached_property
    def invoices(self) -> DataFrame:
        return tables.stg_invoices(self._view("invoices", orders=self.table("orders")))

    @cached_property
    def raw_events(self) -> DataFrame:
        return self._view("raw_product_events", lineitem=self.table("lineitem"), orders=self.table("orders"))

    @cached_property
    def events(self) -> DataFrame:
        return stg_events(self.raw_events)

    @cached_property
    def stored_events(self) -> DataFrame:
        """Deduplicated events as a stored table, for queries that read them often."""
        if self.sf_dir in _STORED:
            return self.spark.read.schema(EVENTS).parquet(f"{_STORED[self.sf_dir]}/events")
        path = f"{shared_folder(self.spark)}/stg_events-{uuid.uuid4().hex}"
        self.events.write.parquet(path)
        return self.spark.read.schema(EVENTS).parquet(path)

    @cached_property
    def messages(self) -> DataFrame:
        """The stream's messages, written once: queries go through them batch by batch."""
        path = f"{shared_folder(self.spark)}/messages-{uuid.uuid4().hex}"
        made = stream_messages(self.table("events"))
        # a file is read by one task, so none is large
        made.write.option("maxRecordsPerFile", FILE_MESSAGES).parquet(path)
        return self.spark.read.schema(made.schema).parquet(path)


def duckdb_ctes() -> str:
    """``WITH`` clause that defines the views for DuckDB, events deduplicated."""
    parts = [f"{name} AS ({text})" for name, text in definitions(Dialect(spark=False)).items()]
    parts.append(
        """product_events AS (
            SELECT * EXCLUDE (copy_number) FROM (
                SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp, user_id,
                    event_name, event_version, account_id) AS copy_number
                FROM raw_product_events) AS numbered_events
            WHERE copy_number = 1)"""
    )
    return "WITH " + ",\n".join(parts)
