"""Ingestion of the event stream into Parquet with rejection and dedup.

Each micro-batch writes only its own ``batch_id=N`` folders, with overwrite.
A batch that is replayed after a crash therefore replaces its own output, and
the checkpoint advances after the writes: at-least-once delivery ends up as
exactly one persisted row per event id.

The landed events are the table of known ids: a batch looks its own ids up in
those of earlier batches.  Small landed files are packed into larger ones, each
once; a pack counts from the moment its commit marker stands, and the folders
it replaces go when a later pack is made, so that readers are not disturbed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subsight.schemas import STREAM_COUNTERS, STREAM_LANDING
from subsight.sources.tables import _exists
from subsight.streaming.contract import (
    event_row,
    rejected_row,
    validate_contract,
    validate_ownership,
)

References = Callable[[SparkSession], tuple[DataFrame, DataFrame]]

#: Batches after which landed files are packed, and bytes of input per pack.
PACK_EVERY = 64
PACK_BYTES = 4 << 30


@dataclass(frozen=True)
class StreamSink:
    """Folders of one ingestion target."""

    root: str
    pack_every: int = PACK_EVERY

    @property
    def events(self) -> str:
        return f"{self.root}/product_events"

    @property
    def packed(self) -> str:
        """Packs, in folders named by their first and last batch."""
        return f"{self.root}/packed_events"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def counters(self) -> str:
        return f"{self.root}/counters"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def dedup_batch(valid: DataFrame) -> DataFrame:
    """First delivery of each event id by (partition, offset).

    Map tasks keep one row per id before the shuffle, so a storm of copies of
    one event stays cheap.
    """
    arrival = Window.partitionBy("event_id").orderBy("partition", "offset")
    return valid.withColumn("_delivery", F.row_number().over(arrival)).where("_delivery = 1").drop("_delivery")


def _folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the finished folders in ``path``, with their bytes."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath().getParent() for status in fs.globStatus(pattern) or ()]
    return {folder.getName(): fs.getContentSummary(folder).getLength() for folder in found}


def _packs(spark: SparkSession, sink: StreamSink) -> list[tuple[int, int]]:
    """(first, last batch) of every committed pack."""
    return sorted(tuple(map(int, name.split("-"))) for name in _folders(spark, sink.packed))


def _loose(spark: SparkSession, sink: StreamSink, packs: list[tuple[int, int]]) -> dict[int, int]:
    """Finished batches that no pack covers, with their bytes."""
    batches = {int(name.split("=")[1]): size for name, size in _folders(spark, sink.events).items()}
    return {b: size for b, size in sorted(batches.items()) if not any(a <= b <= z for a, z in packs)}


def _read_batches(spark: SparkSession, sink: StreamSink, batches: list[int]) -> DataFrame:
    reader = spark.read.schema(STREAM_LANDING).option("basePath", sink.events)
    paths = [f"{sink.events}/batch_id={b}" for b in batches]
    return reader.parquet(*paths).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def landed(spark: SparkSession, sink: StreamSink, before: int | None = None) -> DataFrame:
    """Landed events with their batch number, of batches below ``before`` if given.

    Packs are listed first: what is packed in the meantime is still found in
    the folders of its batches.
    """
    packs = _packs(spark, sink)
    loose = [b for b in _loose(spark, sink, packs) if before is None or b < before]
    parts = []
    if loose:
        parts.append(_read_batches(spark, sink, loose))
    if packs:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STREAM_LANDING.fields)
        paths = [f"{sink.packed}/{a}-{z}" for a, z in packs]
        packed = spark.read.schema(f"{columns}, batch_id bigint").parquet(*paths)
        parts.append(packed if before is None else packed.where(F.col("batch_id") < before))
    if not parts:
        return spark.createDataFrame([], STREAM_LANDING).withColumn("batch_id", F.lit(0).cast("bigint"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def landed_events(spark: SparkSession, sink: StreamSink) -> DataFrame:
    """All landed events in the landing format."""
    return landed(spark, sink).drop("batch_id")


def pack_landed(spark: SparkSession, sink: StreamSink, before: int, pack_bytes: int = PACK_BYTES) -> list[tuple[int, int]]:
    """Pack the loose batches below ``before``; returns the new packs.

    Call it when batch ``before`` begins: all below it are committed and none
    of them can come back.  Neighbouring batches go together up to
    ``pack_bytes``, in files sized by bytes, and every batch is rewritten once.
    A pack is valid with its ``_SUCCESS`` marker; a failed one is overwritten.
    Folders that earlier packs replaced are removed first.
    """
    packs = _packs(spark, sink)
    for name in _folders(spark, sink.events):
        batch = int(name.split("=")[1])
        if any(a <= batch <= z for a, z in packs):
            _remove(spark, f"{sink.events}/{name}")
    groups: list[list[int]] = []
    held = 0
    for batch, size in _loose(spark, sink, packs).items():
        if batch >= before:
            continue
        if not groups or held + size > pack_bytes:
            groups.append([])
            held = 0
        groups[-1].append(batch)
        held += size
    made = []
    for group in groups:
        if len(group) > 1:
            rows = _read_batches(spark, sink, group).hint("rebalance")
            rows.write.mode("overwrite").parquet(f"{sink.packed}/{group[0]}-{group[-1]}")
            made.append((group[0], group[-1]))
    return made


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_persisted(valid: DataFrame, persisted: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Rows whose id has not been persisted yet, however long ago.

    The persisted ids are many and the batch is small, so the ids are first
    reduced to those of the batch; adaptive execution knows its true size and
    spares the persisted ids a shuffle.  ``among`` gives the ids of the batch
    where they are cheaper to come by than from ``valid``.
    """
    wanted = (valid if among is None else among).select("event_id").distinct()
    seen = persisted.select("event_id").join(wanted, "event_id", "left_semi").distinct()
    return valid.join(seen, "event_id", "left_anti")


def dedup_with_state(valid_stream: DataFrame) -> DataFrame:
    """Same rule inside a streaming query, with ids in the state store.

    The cost per batch follows the batch, not the history.  All ids are kept
    for ever, so Spark's default provider, which holds them in executor memory,
    is refused on a cluster; :func:`subsight.session.configure` chooses the
    RocksDB one where the session names none.  Of copies inside one batch any
    may be kept.
    """
    spark = valid_stream.sparkSession
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if "RocksDB" not in provider and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("stream dedup by state needs the RocksDB state store provider")
    return valid_stream.dropDuplicates(["event_id"])


def dedup_within_watermark(valid_stream: DataFrame, delay: str) -> DataFrame:
    """Bounded state: copies are dropped if they arrive within ``delay``."""
    return valid_stream.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def process_batch(messages: DataFrame, batch_id: int, references: References, sink: StreamSink) -> None:
    """Validate, deduplicate and persist one micro-batch.

    Its counters are observed by the two writes themselves, in their last
    stages, where every row passes once however often an earlier one is rerun.
    The latest time also advances on duplicates.
    """
    spark = messages.sparkSession
    if sink.pack_every and batch_id and batch_id % sink.pack_every == 0:
        pack_landed(spark, sink, batch_id)
    accounts, users = references(spark)
    # read several times; a lost block is recomputed from the source.  The
    # ownership check reads the parsed messages once per reference table
    parsed = validate_contract(messages).persist()
    checked = validate_ownership(parsed, accounts, users).persist()
    try:
        received, persisted = Observation(), Observation()
        valid = F.when(F.col("reason").isNull(), F.col("event_timestamp"))
        seen = checked.observe(
            received,
            F.count(F.lit(1)).alias("rows"),
            F.count("reason").alias("rejected"),
            F.max(valid).alias("latest"),
        )
        rejected_row(seen.where("reason is not null")).write.mode("overwrite").json(
            f"{sink.rejected}/batch_id={batch_id}"
        )
        accepted = checked.where("reason is null")
        fresh = event_row(drop_persisted(dedup_batch(accepted), landed(spark, sink, batch_id), accepted))
        fresh.observe(persisted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{sink.events}/batch_id={batch_id}"
        )
        found, kept = received.get, persisted.get["rows"]
        row = (found["rows"], kept, found["rejected"], found["rows"] - found["rejected"] - kept, found["latest"])
        spark.createDataFrame([row], STREAM_COUNTERS).coalesce(1).write.mode("overwrite").parquet(
            f"{sink.counters}/batch_id={batch_id}"
        )
    finally:
        checked.unpersist()
        parsed.unpersist()


def flush_policy(max_events: int = 25, seconds: float = 10.0) -> dict:
    """Reader limit and trigger equal to "so many events or so many seconds".

    The defaults suit a demo; raise them with the event rate, since every
    batch costs a few jobs and files.
    """
    if max_events < 1 or seconds <= 0:
        raise ValueError("max_events and seconds must be positive")
    return {"max_per_trigger": max_events, "trigger": {"processingTime": f"{seconds} seconds"}}


def ingest_stream(
    messages: DataFrame,
    references: References,
    sink: StreamSink,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start ingesting a stream of (value, partition, offset) rows.

    ``references`` is called for every batch, so new accounts and users are
    seen without a restart.
    """
    return (
        messages.writeStream.option("checkpointLocation", sink.checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(lambda df, batch_id: process_batch(df, batch_id, references, sink))
        .start()
    )


def ingest_by_policy(
    read: Callable[[int], DataFrame],
    references: References,
    sink: StreamSink,
    max_events: int = 25,
    seconds: float = 10.0,
) -> StreamingQuery:
    """Ingest with :func:`flush_policy`; ``read`` opens the stream with that many
    messages per batch at most, as :func:`subsight.sources.events.read_events_kafka` does."""
    policy = flush_policy(max_events, seconds)
    return ingest_stream(read(policy["max_per_trigger"]), references, sink, policy["trigger"])


def stream_counters(spark: SparkSession, sink: StreamSink) -> DataFrame:
    """Totals over all batches; zero before the first one."""
    if not _exists(spark, f"{sink.counters}/batch_id=*"):
        rows = spark.createDataFrame([], STREAM_COUNTERS)
    else:
        rows = spark.read.schema(STREAM_COUNTERS).parquet(sink.counters)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in STREAM_COUNTERS.fieldNames()[:4]]
    return rows.agg(*sums, F.max("latest_event_timestamp").alias("latest_event_timestamp"))
