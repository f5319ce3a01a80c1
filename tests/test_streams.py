from __future__ import annotations

import json
from datetime import datetime

import pytest

from shelfmark.sources import supplied
from shelfmark.streaming.contracts import (
    CLICKSTREAM,
    CONTRACTS,
    FIRST_MILLIS,
    LAST_MILLIS,
    OFFERS,
    split_by_contract,
)
from shelfmark.streaming.ingest import file_stream, ingest, read_ingested
from shelfmark.streaming.kafka import avro_schema

CLICK = ("E1", "U1", "S1", "/home", "view", 1_704_067_207_179, "mobile")


def click(**changes):
    return tuple({**dict(zip(CLICKSTREAM.columns, CLICK)), **changes}.values())


def test_contract_splits_messages(spark):
    rows = [
        click(),
        click(event_id="no device", device_type=None),
        click(event_id="bad type", event_type="signup"),
        click(event_id="null type", event_type=None),
        click(event_id="no time", event_time=None),
        click(event_id="two", user_id=None, event_type="x"),
        click(event_id=None),
    ]
    frame = spark.createDataFrame(rows, CLICKSTREAM.wire_schema)
    accepted, rejected = split_by_contract(frame, CLICKSTREAM)
    assert {r.event_id for r in accepted.collect()} == {"E1", "no device"}
    assert {r.event_id: r.rejected_for for r in rejected.collect()} == {
        "bad type": "event_type",
        "null type": "event_type",
        "no time": "event_time",
        "two": "user_id,event_type",
        None: "event_id",
    }


def test_millis_become_a_timestamp(spark):
    accepted, _ = split_by_contract(spark.createDataFrame([CLICK], CLICKSTREAM.wire_schema), CLICKSTREAM)
    assert accepted.first().event_time == datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_offers_enum(spark):
    rows = [("O", "U", "P", 1.0, 1, s) for s in ("sent", "viewed", "accepted", "expired", "unknown")]
    accepted, rejected = split_by_contract(spark.createDataFrame(rows, OFFERS.wire_schema), OFFERS)
    assert (accepted.count(), rejected.count()) == (4, 1)


@pytest.mark.parametrize("millis", [2**63 - 1, -(2**63), FIRST_MILLIS - 1, LAST_MILLIS + 1])
def test_times_out_of_range_are_rejected_with_their_value(spark, millis):
    frame = spark.createDataFrame([click(), click(event_time=millis)], CLICKSTREAM.wire_schema)
    accepted, rejected = split_by_contract(frame, CLICKSTREAM)
    assert accepted.count() == 1
    (row,) = rejected.collect()
    assert (row.rejected_for, row.event_time) == ("event_time", None)
    assert json.loads(row["_raw"])["event_time"] == millis


@pytest.mark.parametrize("millis", [FIRST_MILLIS, LAST_MILLIS, 0])
def test_the_whole_calendar_is_accepted(spark, millis):
    frame = spark.createDataFrame([click(event_time=millis)], CLICKSTREAM.wire_schema)
    assert split_by_contract(frame, CLICKSTREAM)[0].count() == 1


@pytest.mark.parametrize("source_format", ["parquet", "json"])
def test_ingest_in_batches_then_restart_then_more(spark, sf_dir, tmp_path, source_format):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    messages = supplied.clickstream(supplied.events(spark, sf_dir))
    writer = messages.repartition(4).write.format(source_format)
    writer.save(landing)

    def run():
        stream = file_stream(spark, landing, CLICKSTREAM, source_format, max_files_per_trigger=1)
        query = ingest(stream, CLICKSTREAM, target, checkpoint)
        query.awaitTermination()
        return len([p for p in query.recentProgress if p.numInputRows])

    def counts():
        return tuple(
            read_ingested(spark, target, CLICKSTREAM, rejects).count() for rejects in (False, True)
        )

    expected = tuple(part.count() for part in split_by_contract(messages, CLICKSTREAM))
    assert run() == 4
    assert counts() == expected
    run()
    assert counts() == expected, "a restart adds nothing"

    writer.mode("append").save(landing)
    run()
    assert counts() == tuple(2 * n for n in expected)


def test_bad_messages_do_not_stop_a_stream(spark, tmp_path):
    """Out-of-range, missing and malformed ones land among the rejected with what came."""
    landing = tmp_path / "landing"
    landing.mkdir()
    good = dict(zip(CLICKSTREAM.columns, CLICK))
    lines = [
        json.dumps(good),
        json.dumps({**good, "event_time": 2**62}),
        json.dumps({**good, "user_id": None}),
        '{"event_id": "E9", "event_time": "noon"',
    ]
    (landing / "a.json").write_text("\n".join(lines) + "\n")
    target = str(tmp_path / "t")
    for _ in range(2):
        stream = file_stream(spark, str(landing), CLICKSTREAM, "json")
        ingest(stream, CLICKSTREAM, target, str(tmp_path / "c")).awaitTermination()
    assert [r.event_id for r in read_ingested(spark, target, CLICKSTREAM).collect()] == ["E1"]
    rejected = read_ingested(spark, target, CLICKSTREAM, rejects=True).collect()
    assert len(rejected) == 3
    raw = {r["_raw"] for r in rejected}
    assert lines[3] in raw
    assert any(str(2**62) in text for text in raw)


def test_reading_before_anything_is_written(spark, tmp_path):
    assert read_ingested(spark, str(tmp_path / "absent"), OFFERS).count() == 0
    only_bad = spark.createDataFrame([("O", None, "P", 1.0, 1, "sent")], OFFERS.wire_schema)
    only_bad.write.parquet(str(tmp_path / "landing"))
    ingest(
        file_stream(spark, str(tmp_path / "landing"), OFFERS), OFFERS, str(tmp_path / "t"), str(tmp_path / "c")
    ).awaitTermination()
    assert read_ingested(spark, str(tmp_path / "t"), OFFERS).count() == 0
    assert read_ingested(spark, str(tmp_path / "t"), OFFERS, rejects=True).count() == 1


def test_ingested_rows_are_stamped_typed_and_pruned_by_day(spark, sf_dir, tmp_path):
    landing = str(tmp_path / "landing")
    supplied.offers(supplied.events(spark, sf_dir)).write.parquet(landing)
    ingest(
        file_stream(spark, landing, OFFERS), OFFERS, str(tmp_path / "t"), str(tmp_path / "c")
    ).awaitTermination()
    result = read_ingested(spark, str(tmp_path / "t"), OFFERS)
    assert result.columns == [*OFFERS.columns, "_ingestion_time"]
    assert dict(result.dtypes)["offer_time"] == "timestamp"
    assert result.where("_ingestion_time IS NULL").count() == 0
    days = sorted({r[0] for r in result.selectExpr("to_date(offer_time)").distinct().collect()})
    some = read_ingested(spark, str(tmp_path / "t"), OFFERS, start=days[1], end=days[2])
    assert {r[0] for r in some.selectExpr("to_date(offer_time)").collect()} == set(days[1:3])
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in text.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("topic", sorted(CONTRACTS))
def test_avro_schema_follows_the_contract(topic):
    contract = CONTRACTS[topic]
    fields = {f["name"]: f["type"] for f in json.loads(avro_schema(contract))["fields"]}
    assert list(fields) == contract.columns
    for name, symbols in contract.enums.items():
        assert fields[name]["symbols"] == list(symbols)
    assert fields[contract.time_field] == {"type": "long", "logicalType": "timestamp-millis"}
    for name in contract.optional:
        assert fields[name][0] == "null"
