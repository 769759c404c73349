import json

import pytest
from tables import day, moment, one, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from subsight import schemas
from subsight.session import configure
from subsight.sources.events import read_stream_files, stg_events
from subsight.streaming import contract as ct
from subsight.streaming import ingest as ing
from subsight.streaming.status import stream_status

GOOD = dict(
    event_id="E1",
    account_id="A1",
    user_id="U1",
    event_name="user_login",
    event_timestamp="2026-09-25T19:00:00Z",
    event_version=1,
)
MESSAGE = "value binary, partition bigint, offset bigint"


def messages(spark, *bodies):
    encoded = [b if isinstance(b, bytes) else json.dumps(b).encode() for b in bodies]
    return spark.createDataFrame([(bytearray(v), 0, i) for i, v in enumerate(encoded)], MESSAGE)


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


CASES = [
    (GOOD, None),
    ({**GOOD, "properties": {"b": 1, "a": [1]}}, None),
    ({**GOOD, "event_version": 2, "source": "web", "device_type": "desktop"}, None),
    ({**GOOD, "source": None}, None),
    ({**GOOD, "event_timestamp": "2026-09-25T21:00:00+02:00"}, None),
    ({**GOOD, "event_timestamp": "2026-09-25 21:00:00.5+0200"}, None),
    (without("event_id"), "event_id must"),
    ({**GOOD, "event_id": ""}, "event_id must"),
    ({**GOOD, "event_id": 5}, "event_id must"),
    ({**GOOD, "event_name": "unknown_action"}, "event_name is"),
    (without("event_version"), "event_version is"),
    ({**GOOD, "event_version": 99}, "event_version is"),
    ({**GOOD, "event_version": "1"}, "event_version is"),
    ({**GOOD, "event_version": True}, "event_version is"),
    ({**GOOD, "event_timestamp": "not-a-time"}, "event_timestamp is not"),
    ({**GOOD, "event_timestamp": "2026-02-30T00:00:00Z"}, "event_timestamp is not"),
    ({**GOOD, "event_timestamp": 1700000000}, "event_timestamp is not"),
    ({**GOOD, "event_timestamp": "2026-09-25T19:00:00"}, "must include a timezone"),
    ({**GOOD, "event_version": 2}, "requires source and device_type"),
    ({**GOOD, "source": "fax"}, "source is"),
    ({**GOOD, "properties": None}, "properties must"),
    ({**GOOD, "colour": "red", "size": 1}, "unexpected fields: colour, size"),
    ([GOOD], "must be a JSON object"),
    ("text", "must be a JSON object"),
    (b"null", "must be a JSON object"),
    (b"{not json", "not valid UTF-8 JSON"),
    (b"\xff\xfe{}", "not valid UTF-8 JSON"),
    (b"", "not valid UTF-8 JSON"),
]


def test_contract(spark):
    found = ct.validate_contract(messages(spark, *[c for c, _ in CASES])).orderBy("offset").collect()
    for row, (body, expected) in zip(found, CASES):
        if expected is None:
            assert row["reason"] is None, (body, row["reason"])
        else:
            assert row["reason"] and expected in row["reason"], (body, row["reason"])
    assert found[1]["properties"] == '{"a":[1],"b":1}' and found[0]["properties"] == "{}"
    assert found[4]["event_timestamp"] == found[0]["event_timestamp"] == moment("2026-09-25 19:00:00")


def test_several_broken_rules_are_all_named(spark):
    reason = one(ct.validate_contract(messages(spark, {"event_version": 3})))["reason"]
    for part in ("event_id", "account_id", "user_id", "event_name", "event_timestamp", "event_version"):
        assert part in reason


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(max_size=40) | st.text(max_size=20).map(lambda t: json.dumps(t).encode()), min_size=1, max_size=20))
def test_no_message_breaks_validation(spark, values):
    checked = ct.validate_contract(messages(spark, *values))
    assert checked.where("reason is not null").count() == len(values)
    assert ct.rejected_row(checked).count() == len(values)


@pytest.fixture(scope="module")
def references(build):
    accounts = build.accounts(dict(account_id="A1"), dict(account_id="A2"))
    users = build.users(dict(user_id="U1", account_id="A1"), dict(user_id="U2", account_id="A2"))
    return accounts, users


def test_ownership_first_failure_wins(spark, references):
    bodies = [
        GOOD,
        {**GOOD, "account_id": "X", "user_id": "Y"},
        {**GOOD, "user_id": "Y"},
        {**GOOD, "user_id": "U2"},
        without("event_id"),
    ]
    checked = ct.validate_ownership(ct.validate_contract(messages(spark, *bodies)), *references)
    assert [r["reason"] for r in checked.orderBy("offset").collect()] == [
        None,
        "unknown account_id: X",
        "unknown user_id: Y",
        "user_id does not belong to account_id",
        "event_id must be a non-empty string",
    ]


def send(spark, folder, start, *bodies):
    rows_ = [(bytearray(json.dumps(b).encode() if not isinstance(b, bytes) else b), 0, start + i) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows_, MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, references, sink):
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(folder)
    ing.ingest_stream(stream, lambda _: references, sink, {"availableNow": True}).awaitTermination()


def test_ingest_restart_and_replay(spark, references, tmp_path):
    folder, sink = f"{tmp_path}/in", ing.StreamSink(f"{tmp_path}/out")
    send(spark, folder, 0, GOOD, GOOD, {**GOOD, "event_id": "E2"}, b"broken")
    run(spark, folder, references, sink)
    send(spark, folder, 10, {**GOOD, "event_id": "E2", "event_timestamp": "2027-01-01T00:00:00Z"}, {**GOOD, "event_id": "E3"})
    run(spark, folder, references, sink)
    run(spark, folder, references, sink)  # nothing new

    landed = read_stream_files(spark, sink.events)
    assert landed.columns == schemas.STREAM_LANDING.fieldNames()
    assert rows(landed, "event_id", "kafka_offset") == [("E1", 0), ("E2", 2), ("E3", 11)]
    counters = one(ing.stream_counters(spark, sink))
    assert counters == dict(
        received=6, persisted=3, rejected=1, duplicates=2, latest_event_timestamp=moment("2027-01-01 00:00:00")
    )
    rejected = spark.read.schema(schemas.REJECTED).json(sink.rejected)
    assert one(rejected.select("reason", "raw_message")) == dict(reason="message is not valid UTF-8 JSON", raw_message="broken")

    # a batch that is processed again replaces its own output
    again = spark.createDataFrame([(bytearray(json.dumps({**GOOD, "event_id": "E3"}).encode()), 0, 11)], MESSAGE)
    ing.process_batch(again, 1, lambda _: references, sink)
    assert rows(read_stream_files(spark, sink.events), "event_id") == [("E1",), ("E2",), ("E3",)]

    now = F.lit("2026-09-25 19:04:00").cast("timestamp")
    status = one(stream_status(spark.read.schema(schemas.STREAM_LANDING).parquet(sink.events), now))
    assert status["total_rows"] == 3 and status["status"] == "Healthy" and status["seconds_since_last_event"] == 240.0
    assert status["freshness"] == "4 minutes ago"
    merged = stg_events(spark.createDataFrame([], schemas.EVENTS), read_stream_files(spark, sink.events))
    assert merged.count() == 3


def batches(i):
    """A new event and one of two batches ago."""
    return {**GOOD, "event_id": f"E{i}"}, {**GOOD, "event_id": f"E{max(0, i - 2)}"}


@pytest.mark.parametrize("replayed", [3, 4, 5])
def test_packs_survive_replays(spark, references, tmp_path, replayed):
    """A batch that comes back before, at and after packing leaves what it left."""
    sink = ing.StreamSink(f"{tmp_path}/out", pack_every=2)
    for i in range(replayed + 1):
        ing.process_batch(messages(spark, *batches(i)), i, lambda _: references, sink)
    before = rows(ing.landed_events(spark, sink), "event_id", "kafka_offset")
    counters = one(ing.stream_counters(spark, sink))
    ing.process_batch(messages(spark, *batches(replayed)), replayed, lambda _: references, sink)
    assert rows(ing.landed_events(spark, sink), "event_id", "kafka_offset") == before
    assert len(before) == replayed + 1 == counters["persisted"]
    assert one(ing.stream_counters(spark, sink)) == counters


def test_packing_keeps_rows_and_disturbs_no_reader(spark, references, tmp_path):
    sink = ing.StreamSink(f"{tmp_path}/out", pack_every=0)
    for i in range(5):
        ing.process_batch(messages(spark, *batches(i)), i, lambda _: references, sink)
    held = rows(ing.landed(spark, sink), "batch_id", "event_id")
    reading = ing.landed(spark, sink)  # planned before the pack, run after it
    assert ing.pack_landed(spark, sink, 4) == [(0, 3)]
    assert rows(reading, "batch_id", "event_id") == held == rows(ing.landed(spark, sink), "batch_id", "event_id")
    assert rows(ing.landed(spark, sink, 2), "batch_id") == [(0,), (1,)]
    # nothing to pack; what the first pack replaced goes now
    assert ing.pack_landed(spark, sink, 4) == []
    assert not (tmp_path / "out/product_events/batch_id=3").exists() and (tmp_path / "out/product_events/batch_id=4").exists()
    assert rows(ing.landed(spark, sink), "batch_id", "event_id") == held
    # a pack without its marker does not count
    (tmp_path / "out/packed_events/0-3/_SUCCESS").rename(tmp_path / "out/packed_events/0-3/other")
    assert rows(ing.landed(spark, sink), "batch_id") == [(4,)]


def test_packs_are_limited_by_bytes(spark, references, tmp_path):
    sink = ing.StreamSink(f"{tmp_path}/out", pack_every=0)
    for i in range(6):
        ing.process_batch(messages(spark, *batches(i)), i, lambda _: references, sink)
    size = max(ing._folders(spark, sink.events).values())
    assert ing.pack_landed(spark, sink, 6, 2 * size + 9) == [(0, 1), (2, 3), (4, 5)]
    assert rows(ing.landed_events(spark, sink), "event_id") == [(f"E{i}",) for i in range(6)]


def test_counters_cost_no_query_of_their_own(spark, references, tmp_path):
    """A batch is three writes, which count its rows on the way."""
    sink = ing.StreamSink(f"{tmp_path}/out", pack_every=0)
    ran = spark._jsparkSession.sharedState().statusStore().executionsCount
    before = ran()
    ing.process_batch(messages(spark, *batches(1), b"broken"), 0, lambda _: references, sink)
    assert ran() - before == 3
    assert one(ing.stream_counters(spark, sink))["rejected"] == 1


def test_users_under_several_accounts_do_not_multiply(spark, build):
    accounts = build.accounts(dict(account_id="A1"), dict(account_id="A2"), dict(account_id="A3"))
    users = build.users(*[dict(user_id="U1", account_id=a) for a in ("A1", "A2", "A2")])
    bodies = [GOOD, {**GOOD, "account_id": "A2"}, {**GOOD, "account_id": "A3"}]
    checked = ct.validate_ownership(ct.validate_contract(messages(spark, *bodies)), accounts, users)
    assert [r["reason"] for r in checked.orderBy("offset").collect()] == [None, None, "user_id does not belong to account_id"]


def test_malformed_storm_is_not_joined(spark, references):
    storm = messages(spark, *[b"broken"] * 200, GOOD)
    checked = ct.validate_ownership(ct.validate_contract(storm), *references)
    assert checked.count() == 201 and checked.where("reason is null").count() == 1


def test_ingest_by_policy(spark, references, tmp_path):
    folder, sink = f"{tmp_path}/in", ing.StreamSink(f"{tmp_path}/out")
    send(spark, folder, 0, GOOD)
    asked = []

    def read(limit):
        asked.append(limit)
        return spark.readStream.schema(MESSAGE).parquet(folder)

    running = ing.ingest_by_policy(read, lambda _: references, sink, max_events=7, seconds=1)
    running.processAllAvailable()
    running.stop()
    assert asked == [7] and ing.landed_events(spark, sink).count() == 1


def test_state_store_dedup(spark, tmp_path):
    spark.createDataFrame([("a", day("2024-01-01")), ("a", day("2024-01-01")), ("b", day("2024-01-02"))], "event_id string, d date").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_id string, d date").parquet(f"{tmp_path}/in").withColumn("event_timestamp", F.col("d").cast("timestamp"))
    for i, deduplicated in enumerate((ing.dedup_with_state(stream), ing.dedup_within_watermark(stream, "1 hour"))):
        query = (
            deduplicated.writeStream.format("parquet").option("path", f"{tmp_path}/out{i}")
            .option("checkpointLocation", f"{tmp_path}/cp{i}").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out{i}").count() == 2


def test_a_session_keeps_stream_state_on_disk(spark):
    """Otherwise dedup by state is refused on a cluster; a provider of the session's own stays."""
    name = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" in spark.conf.get(name)
    chosen = spark.conf.get(name)
    try:
        spark.conf.set(name, "other")
        assert configure(spark).conf.get(name) == "other"
    finally:
        spark.conf.set(name, chosen)


def test_empty_and_policy(spark, tmp_path):
    assert one(ing.stream_counters(spark, ing.StreamSink(f"{tmp_path}/none")))["received"] == 0
    assert ing.flush_policy()["max_per_trigger"] == 25
    with pytest.raises(ValueError):
        ing.flush_policy(0)
