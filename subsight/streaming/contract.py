"""The versioned event contract as column expressions.

A message is a JSON object in UTF-8.  Version 1 has six required fields and
optional properties; version 2 also needs source and device type.  Types are
strict: the text "1" is not version 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsight.functions.expr import fill
from subsight.schemas import (
    DEVICE_TYPES,
    EVENT_NAMES,
    EVENT_SOURCES,
    EVENT_VERSIONS,
    UNKNOWN_ACCOUNT,
    UNKNOWN_USER,
    WRONG_OWNER,
)

_FIELDS = (
    "event_id",
    "account_id",
    "user_id",
    "event_name",
    "event_timestamp",
    "event_version",
    "properties",
    "source",
    "device_type",
)
_IDS = ("event_id", "account_id", "user_id")
# ISO-8601 date and time that states its offset
_ZONED = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:?\d{2})$"


def _field(name: str) -> Column:
    return F.try_variant_get("message", f"$.{name}", "variant")


def _kind(name: str) -> Column:
    """JSON type of a field: STRING, BIGINT, VOID, OBJECT<...>; NULL if absent."""
    return F.col(f"kind_{name}")


def _is(name: str, kind: str) -> Column:
    return F.coalesce(_kind(name) == kind, F.lit(False))


def _text(name: str) -> Column:
    return F.when(_is(name, "STRING"), F.try_variant_get("message", f"$.{name}", "string"))


def _absent(name: str) -> Column:
    return F.coalesce(_kind(name) == "VOID", F.lit(True))


def _zoned_timestamp(text: Column) -> Column:
    offset = F.regexp_replace(F.upper(text), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(text.rlike(_ZONED), offset.try_cast("timestamp"))


def validate_contract(messages: DataFrame) -> DataFrame:
    """Parse (value, ...) rows; add the event fields and ``reason``.

    ``reason`` is NULL for a valid message and otherwise lists every broken
    rule.  Other columns of the input are kept.
    """
    raw = F.col("value").cast("string")
    parsed = messages.withColumn("text", raw).withColumn(
        "message", F.when(F.is_valid_utf8("text"), F.try_parse_json("text"))
    )
    parsed = parsed.select("*", *[F.schema_of_variant(_field(c)).alias(f"kind_{c}") for c in _FIELDS])
    # json_object_keys is NULL for anything but an object
    keys = F.json_object_keys(F.when(F.col("message").isNotNull(), F.col("text")))
    timestamp_text = _text("event_timestamp")
    version = F.when(_is("event_version", "BIGINT"), F.try_variant_get("message", "$.event_version", "long"))
    fields = parsed.select(
        *messages.columns,
        F.col("message").isNotNull().alias("is_json"),
        keys.alias("keys"),
        *[_text(c).alias(c) for c in (*_IDS, "event_name")],
        _zoned_timestamp(timestamp_text).alias("event_timestamp"),
        timestamp_text.alias("timestamp_text"),
        version.alias("event_version"),
        F.coalesce(_kind("properties").startswith("OBJECT"), F.lit(False)).alias("properties_ok"),
        _kind("properties").isNull().alias("properties_absent"),
        F.to_json(_field("properties")).alias("properties_json"),
        *[_text(c).alias(c) for c in ("source", "device_type")],
        *[_absent(c).alias(f"{c}_absent") for c in ("source", "device_type")],
    )
    extra = F.array_except("keys", F.array(*[F.lit(f) for f in _FIELDS]))
    context_missing = F.col("source_absent") | F.col("device_type_absent")

    def bad(condition: Column, text: Column | str) -> Column:
        return F.when(condition, F.lit(text) if isinstance(text, str) else text)

    def not_one_of(name: str, values) -> Column:
        return ~F.coalesce(F.col(name).isin(*values), F.lit(False))

    problems = F.array_compact(
        F.array(
            bad(F.size(extra) > 0, F.concat(F.lit("unexpected fields: "), F.array_join(extra, ", "))),
            *[bad(F.coalesce(F.length(c) < 1, F.lit(True)), f"{c} must be a non-empty string") for c in _IDS],
            bad(not_one_of("event_name", EVENT_NAMES), "event_name is not a known event"),
            bad(
                F.col("event_timestamp").isNull(),
                F.when(
                    F.col("timestamp_text").try_cast("timestamp").isNotNull() & ~F.col("timestamp_text").rlike(_ZONED),
                    "event_timestamp must include a timezone",
                ).otherwise("event_timestamp is not a valid ISO-8601 time"),
            ),
            bad(not_one_of("event_version", EVENT_VERSIONS), "event_version is not supported"),
            bad(~F.col("properties_ok") & ~F.col("properties_absent"), "properties must be an object"),
            bad(~F.col("source_absent") & not_one_of("source", EVENT_SOURCES), "source is not a known source"),
            bad(
                ~F.col("device_type_absent") & not_one_of("device_type", DEVICE_TYPES),
                "device_type is not a known device",
            ),
            bad(
                (F.col("event_version") == 2) & context_missing,
                "event_version 2 requires source and device_type",
            ),
        )
    )
    reason = (
        F.when(~F.col("is_json"), "message is not valid UTF-8 JSON")
        .when(F.col("keys").isNull(), "message must be a JSON object")
        .when(F.size(problems) > 0, F.array_join(problems, "; "))
    )
    checked = F.struct(
        *[F.col(c) for c in (*_IDS, "event_name", "event_timestamp", "event_version")],
        F.coalesce("properties_json", F.lit("{}")).alias("properties"),
        F.col("source"),
        F.col("device_type"),
        reason.alias("reason"),
    )
    # A filter on the reason must not be pushed below the parsing, where it
    # would parse each message once per rule; it does not pass a generator.
    return fields.select(*messages.columns, F.inline(F.array(checked)))


def validate_ownership(checked: DataFrame, accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Extend ``reason`` for contract-valid rows with the first ownership failure.

    Messages that broke the contract are not joined at all: a storm of them,
    without ids, would meet in one task.  The reference tables may be far
    larger than a batch, so they are first reduced to the ids the batch names.
    A user listed under several accounts owns all of them; every join matches
    once at most, so that messages cannot multiply.
    """
    named = checked.where("reason is null")
    account_ids = named.select("account_id").distinct()
    user_ids = named.select("user_id").distinct()
    known_accounts = (
        accounts.select("account_id").distinct().join(account_ids, "account_id", "left_semi").withColumn("_account", F.lit(True))
    )
    owned = users.select("user_id", "account_id").join(user_ids, "user_id", "left_semi").distinct()
    known_users = owned.select("user_id").distinct().withColumn("_user", F.lit(True))
    joined = (
        named.join(known_accounts, "account_id", "left")
        .join(known_users, "user_id", "left")
        .join(owned.withColumn("_owner", F.lit(True)), ["user_id", "account_id"], "left")
    )
    reason = (
        F.when(F.col("_account").isNull(), fill(UNKNOWN_ACCOUNT, id=F.col("account_id")))
        .when(F.col("_user").isNull(), fill(UNKNOWN_USER, id=F.col("user_id")))
        .when(F.col("_owner").isNull(), WRONG_OWNER)
    )
    judged = joined.withColumn("reason", reason).select(*checked.columns)
    return judged.unionByName(checked.where("reason is not null"))


def event_row(valid: DataFrame, received_at: Column | None = None) -> DataFrame:
    """The twelve landing columns of valid messages."""
    when = F.current_timestamp() if received_at is None else received_at
    return valid.select(
        *_FIELDS,
        F.col("partition").cast("long").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        when.alias("received_at"),
    )


def rejected_row(rejected: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Dead-letter rows; undecodable bytes are replaced, never lost."""
    when = F.current_timestamp() if received_at is None else received_at
    return rejected.select(
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("received_at"),
        "reason",
        F.make_valid_utf8(F.col("value").cast("string")).alias("raw_message"),
    )
