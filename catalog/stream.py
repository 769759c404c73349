"""Stream contract, ingestion and status."""

import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from fixture_views import FILE_MESSAGES, malformed_messages
from subsight import schemas
from subsight.session import shared_folder
from subsight.sources.events import empty_stream_df, stg_events
from subsight.sources.tables import _exists
from subsight.streaming import contract as ct
from subsight.streaming import ingest as ing
from subsight.streaming.status import stream_status

# Valid and rejected messages, from the driver's event table.
_MESSAGES = """
sent AS (
    SELECT event_id, 'S' || event_id AS id, CAST(user_id // 5 AS VARCHAR) AS account_id,
           CAST(user_id AS VARCHAR) AS user_id,
           CASE event_type WHEN 'signup' THEN 'workspace_created' WHEN 'click' THEN 'user_login'
                WHEN 'view' THEN 'dashboard_viewed' WHEN 'purchase' THEN 'report_created' ELSE 'invite_sent' END
               AS event_name,
           ts, 1 + event_id % 2 AS version, replace(props, ' ', '') AS properties,
           (user_id // 5) % 4 AS lane, event_id * 2 AS first_offset,
           CASE event_id % 50 WHEN 7 THEN 'event_name is not a known event'
                WHEN 13 THEN 'unknown account_id: nobody' END AS reason
    FROM events
),
deliveries AS (
    SELECT *, first_offset AS kafka_offset FROM sent
    UNION ALL SELECT *, first_offset + 1 FROM sent WHERE event_id % 10 = 0
)"""

_LANDED = """SELECT id AS event_id, account_id, user_id, event_name, ts AS event_timestamp,
    CAST(version AS BIGINT) AS event_version, properties,
    CASE WHEN version = 2 THEN 'web' END AS source, CASE WHEN version = 2 THEN 'desktop' END AS device_type,
    lane AS kafka_partition, first_offset AS kafka_offset"""


def new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(spark, checked):
    """Checked messages as a table: the next step reads them several times, parsing them is most of the work."""
    path = new_folder(spark, "checked")
    checked.write.parquet(path)
    return spark.read.schema(checked.schema).parquet(path)


def arrive(messages, folder, batches):
    """Add messages to the files of a source; returns the files of one of so many batches.

    Files, not batches, have a bounded size: a batch is read by as many tasks as it has files.
    """
    files = max(1, -(-messages.count() // (batches * FILE_MESSAGES)))
    messages.repartition(batches * files, F.expr("offset div 2")).write.mode("append").parquet(folder)
    return files


def read_files(spark, folder, files):
    reader = spark.readStream.schema("value binary, partition bigint, offset bigint")
    return reader.option("maxFilesPerTrigger", files).parquet(folder)


def ingest(d):
    """Send every message through a file-source stream, in two batches and one of late copies.

    Some second copies arrive beside the first, the others in the last batch.
    """
    source = new_folder(d.spark, "messages")
    late = F.col("offset") % 40 == 1
    files = arrive(d.messages.where(~late), source, 2)
    arrive(d.messages.where(late), source, 1)
    stream = read_files(d.spark, source, files)
    sink = ing.StreamSink(new_folder(d.spark, "ingested"))
    running = ing.ingest_stream(stream, lambda _: (d.accounts, d.users), sink, {"availableNow": True})
    running.awaitTermination()
    return sink


@query(
    "stream_contract",
    """SELECT event_id AS "offset", CASE event_id % 12
           WHEN 0 THEN 'event_id must be a non-empty string'
           WHEN 1 THEN 'event_id must be a non-empty string'
           WHEN 2 THEN 'event_timestamp must include a timezone'
           WHEN 3 THEN 'event_timestamp is not a valid ISO-8601 time'
           WHEN 4 THEN 'event_version is not supported'
           WHEN 5 THEN 'event_version is not supported'
           WHEN 6 THEN 'event_version 2 requires source and device_type'
           WHEN 7 THEN 'unexpected fields: colour'
           WHEN 8 THEN 'message must be a JSON object'
           WHEN 9 THEN 'message is not valid UTF-8 JSON'
           WHEN 10 THEN 'device_type is not a known device' END AS reason
       FROM events""",
)
def _(d):
    return ct.validate_contract(malformed_messages(d.table("events"))).select("offset", "reason")


@query(
    "stream_ownership",
    """SELECT kafka_offset AS "offset", lane AS partition, reason FROM deliveries
       UNION ALL
       SELECT event_id, 9, 'unknown user_id: 9999999999' FROM events WHERE event_id % 12 = 11""",
    _MESSAGES,
)
def _(d):
    malformed = malformed_messages(d.table("events")).withColumn("partition", F.lit(9).cast("long"))
    checked = ct.validate_contract(d.messages).unionByName(
        ct.validate_contract(malformed).where("reason is null")
    )
    return ct.validate_ownership(kept(d.spark, checked), d.accounts, d.users).select("partition", "offset", "reason")


@query(
    "stream_dedup",
    """SELECT id AS event_id, lane AS partition, first_offset AS "offset" FROM sent
       WHERE reason IS NULL AND id NOT IN (SELECT 'S' || event_id FROM events WHERE event_type = 'click')""",
    _MESSAGES,
)
def _(d):
    """First deliveries that were not persisted before; clicks had been."""
    checked = ct.validate_ownership(kept(d.spark, ct.validate_contract(d.messages)), d.accounts, d.users)
    checked = kept(d.spark, checked)
    persisted = (
        d.table("events")
        .where("event_type = 'click'")
        .select(F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("event_id"))
    )
    fresh = ing.drop_persisted(ing.dedup_batch(checked.where("reason is null")), persisted)
    return fresh.select("event_id", "partition", "offset")


@query(
    "stream_event_row",
    _LANDED.replace("first_offset AS kafka_offset", "kafka_offset")
    + """, TIMESTAMP '2024-02-01 00:00:00' AS received_at
         FROM deliveries WHERE reason IS NULL OR reason LIKE 'unknown account%'""",
    _MESSAGES.replace("CAST(user_id // 5 AS VARCHAR) AS account_id",
                      "CASE WHEN event_id % 50 = 13 THEN 'nobody' ELSE CAST(user_id // 5 AS VARCHAR) END AS account_id"),
)
def _(d):
    """Landing rows of every message that meets the contract."""
    valid = ct.validate_contract(d.messages).where("reason is null")
    return ct.event_row(valid, F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query("stream_ingest", _LANDED + " FROM sent WHERE reason IS NULL", _MESSAGES)
def _(d):
    return ing.landed_events(d.spark, ingest(d)).drop("received_at")


def deliver_twice(d, sink):
    """Five batches, each of them delivered twice."""
    lot = F.expr("(offset div 2) % 5")
    for batch in range(5):
        part = d.messages.where((lot == batch) | ((lot == batch - 1) & (F.col("offset") % 40 == 1)))
        for _ in range(2):
            ing.process_batch(part, batch, lambda _: (d.accounts, d.users), sink)


@query("stream_replay", _LANDED + " FROM sent WHERE reason IS NULL", _MESSAGES)
def _(d):
    """Replayed batches with packed ones among those they are compared with."""
    sink = ing.StreamSink(new_folder(d.spark, "replayed"), pack_every=2)
    deliver_twice(d, sink)
    return ing.landed_events(d.spark, sink).drop("received_at")


@query(
    "stream_packs",
    """SELECT event_id % 5 AS batch_id, event_id % 5 < 4 AS packed, count(*) AS events FROM sent
       WHERE reason IS NULL GROUP BY ALL""",
    _MESSAGES,
)
def _(d):
    """Events per batch after packing twice: batches 0 to 3 lie in packs, and only there."""
    sink = ing.StreamSink(new_folder(d.spark, "packed"), pack_every=2)
    deliver_twice(d, sink)
    ing.pack_landed(d.spark, sink, 4)
    loose = d.spark.read.schema(schemas.STREAM_LANDING).option("basePath", sink.events).parquet(f"{sink.events}/batch_id=*")
    packed = d.spark.read.parquet(f"{sink.packed}/*").select(F.col("batch_id").cast("bigint"), F.lit(True).alias("packed"))
    both = loose.select(F.col("batch_id").cast("bigint"), F.lit(False).alias("packed")).unionByName(packed)
    return both.groupBy("batch_id", "packed").agg(F.count("*").alias("events"))


@query(
    "flush_policy",
    """SELECT event_id // width AS batch_id, count(*) AS received, count(*) FILTER (reason IS NULL) AS persisted,
              count(*) FILTER (reason IS NOT NULL) AS rejected, count(*) <= width AS within_limit
       FROM sent, (SELECT CAST(ceil(count(*) / 4.0) AS BIGINT) AS width FROM events) AS policy
       GROUP BY event_id // width, width""",
    _MESSAGES,
)
def _(d):
    """Batches of at most a quarter of the events, counted off by a running number."""
    numbered = d.messages.where("offset % 2 = 0").select(F.expr("offset div 2").alias("number"), "value", "partition", "offset")
    # dense numbers, so the last one tells how many there are
    events = d.table("events").agg(F.max("event_id")).first()[0] + 1
    limit = -(-events // 4)

    def read(max_events):
        counted = d.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", max_events).load()
        return counted.select(F.col("value").alias("number")).join(numbered, "number").select("value", "partition", "offset")

    sink = ing.StreamSink(new_folder(d.spark, "limited"))
    running = ing.ingest_by_policy(read, lambda _: (d.accounts, d.users), sink, max_events=limit, seconds=0.1)
    try:
        while running.isActive and not _exists(d.spark, f"{sink.counters}/batch_id={(events - 1) // limit}/_SUCCESS"):
            running.awaitTermination(0.2)
    finally:
        running.stop()
    counters = d.spark.read.schema(schemas.STREAM_COUNTERS).parquet(sink.counters).where("received > 0")
    return counters.select(
        F.col("batch_id").cast("bigint"), "received", "persisted", "rejected", (F.col("received") <= limit).alias("within_limit")
    )


@query("stream_rejects", "SELECT reason, id AS event_id FROM deliveries WHERE reason IS NOT NULL", _MESSAGES)
def _(d):
    rejected = d.spark.read.schema(schemas.REJECTED).json(ingest(d).rejected)
    return rejected.select("reason", F.get_json_object("raw_message", "$.event_id").alias("event_id"))


@query(
    "stream_counters",
    """SELECT count(*) AS received, count(DISTINCT id) FILTER (reason IS NULL) AS persisted,
              count(reason) AS rejected,
              count(*) - count(reason) - count(DISTINCT id) FILTER (reason IS NULL) AS duplicates,
              max(ts) FILTER (reason IS NULL) AS latest_event_timestamp
       FROM deliveries""",
    _MESSAGES,
)
def _(d):
    return ing.stream_counters(d.spark, ingest(d))


@query(
    "stream_status",
    """SELECT CAST(1 AS BIGINT) AS file_count, count(*) AS total_rows, count(DISTINCT id) AS events_received, max(ts) AS latest_event_timestamp,
              CAST(epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts)) AS DOUBLE) / CAST(1000000 AS DOUBLE)
                  AS seconds_since_last_event,
              concat(format('{:.1f}', (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3600000000),
                     ' hours ago') AS freshness,
              'Stale' AS status
       FROM sent WHERE reason IS NULL""",
    _MESSAGES,
)
def _(d):
    # one file, so that their number does not depend on the machine
    path = new_folder(d.spark, "landed")
    ing.landed_events(d.spark, ingest(d)).coalesce(1).write.parquet(path)
    landing = d.spark.read.schema(schemas.STREAM_LANDING).parquet(path)
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    return stream_status(landing, now)


@query("empty_stream", "SELECT * FROM product_events")
def _(d):
    """Events when nothing has been streamed yet."""
    return stg_events(d.raw_events, empty_stream_df(d.spark))
