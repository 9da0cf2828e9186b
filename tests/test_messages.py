"""Messages: validation, dead letters, ingest, change envelopes, replay."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.plans import marks, replay, validation
from wayfare.sources import ingest, schemas, tables

T0 = datetime(2024, 1, 1)
ID = "00000000-0000-4000-8000-00000000000{}"
GOOD = {
    "event_id": ID.format(1),
    "user_id": 7,
    "event_type": "search_performed",
    "event_time": "2024-05-24T12:00:00Z",
    "properties": {"route": "A -> B"},
}


def texts(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def without(field):
    return {k: v for k, v in GOOD.items() if k != field}


VERDICTS = [
    (GOOD, []),
    ({**GOOD, "properties": '{"route": "x", "more": 1}', "device_type": None, "extra": [1]}, []),
    ({**GOOD, "event_id": "", "properties": {"route": ""}}, []),
    ({**GOOD, "user_id": "7"}, []),
    ({**GOOD, "user_id": True}, []),
    ({**GOOD, "event_time": 1716552000}, []),
    ({**GOOD, "event_time": 1716552000.25}, []),
    ({**GOOD, "event_id": 5}, [("event_id", "string_type")]),
    (without("event_id"), [("event_id", "missing")]),
    ({**GOOD, "event_id": None}, [("event_id", "string_type")]),
    ({**GOOD, "user_id": 7.5}, [("user_id", "int_from_float")]),
    ({**GOOD, "user_id": "x"}, [("user_id", "int_parsing")]),
    ({**GOOD, "user_id": None}, [("user_id", "int_type")]),
    ({**GOOD, "user_id": -1}, [("user_id", "greater_than_equal")]),
    (without("user_id"), [("user_id", "missing")]),
    ({**GOOD, "event_type": "page_view"}, [("event_type", "literal_error")]),
    ({**GOOD, "event_type": 1}, [("event_type", "literal_error")]),
    ({**GOOD, "event_time": "yesterday"}, [("event_time", "datetime_parsing")]),
    ({**GOOD, "event_time": True}, [("event_time", "datetime_type")]),
    ({**GOOD, "properties": "{broken"}, [("properties", "json_invalid")]),
    ({**GOOD, "properties": "5"}, [("properties", "model_type")]),
    ({**GOOD, "properties": [1]}, [("properties", "model_type")]),
    ({**GOOD, "properties": {}}, [("properties.route", "missing")]),
    ({**GOOD, "properties": {"route": 5}}, [("properties.route", "string_type")]),
    (without("properties"), [("properties", "missing")]),
    ("{broken", [("$", "json_invalid")]),
    (None, [("$", "json_invalid")]),
    ("[]", [(f, "missing") for f in ("event_id", "user_id", "event_type", "event_time", "properties")]),
    ('{"event_id":"a"} {"event_id":"b"}', [("$", "json_invalid")]),
    (json.dumps(GOOD) + "]", [("$", "json_invalid")]),
    (json.dumps(GOOD) + ", 5", [("$", "json_invalid")]),
    (json.dumps(GOOD) + " \n", []),
    ("", [("$", "json_invalid")]),
    ("{'event_id':'a'}", [("$", "json_invalid")]),
    ({**GOOD, "properties": '{"route":"x"} {}'}, [("properties", "json_invalid")]),
]


def test_verdicts(spark):
    frame = texts(spark, *[message for message, _ in VERDICTS])
    got = [[tuple(v) for v in row.violations] for row in validation.validate_user_events(frame).collect()]
    assert got == [expected for _, expected in VERDICTS]


def test_a_repeated_key_keeps_the_last_value(spark):
    text = json.dumps(GOOD)[:-1] + ', "user_id": 9}'
    assert validation.validate_user_events(texts(spark, text)).head().user_id == 9


def test_accepted_rows(spark):
    offset = {**GOOD, "event_time": "2024-05-24T12:00:00.75-05:00", "properties": '{"route":"é \\" x","z":1}'}
    raw = validation.normalize_user_event(validation.validate_user_events(texts(spark, offset)), "t", T0)
    row = raw.head()
    assert raw.columns == schemas.schema("raw_user_events").names
    assert (row.event_time, row.source_topic, row.ingested_at) == (datetime(2024, 5, 24, 17), "t", T0)
    assert json.loads(row.properties) == {"route": 'é " x'}


def test_dead_letters_keep_the_whole_text_and_the_reason(spark):
    long_text = json.dumps({**GOOD, "event_type": "nope", "note": "x" * 50_000})
    frame = texts(spark, long_text, {**GOOD, "properties": "{broken"}, "{torn", GOOD)
    letters = validation.dead_letters(validation.validate_user_events(frame), failed_at=T0)
    assert letters.columns == schemas.schema("dlq_user_events").names
    got = letters.collect()
    assert [r.event_id for r in got] == [ID.format(1), ID.format(1), None]
    assert got[0].raw_event == long_text
    reasons = [json.loads(r.error_reason) for r in got]
    assert [r["error_type"] for r in reasons] == ["ValidationError", "JSONDecodeError", "JSONDecodeError"]
    assert reasons[0]["error_details"] == [{"field": "event_type", "error": "literal_error"}]
    assert reasons[0]["ingested_at"] == "2024-01-01T00:00:00.000000+00:00"
    assert {(r.recovered, r.replay_count, r.replayed, r.failed_at) for r in got} == {(False, 0, False, T0)}


AD = {"platform": "google_ads", "campaign_id": 1001, "campaign_name": " Summer ", "clicks": 3, "impressions": 9, "spend": 1.5}


def test_ads_split_and_fail(spark, rows):
    bare = {k: AD[k] for k in ("platform", "campaign_id", "campaign_name")}
    bad = [
        {**AD, "platform": "other"}, {**AD, "platform": "google_ads\n"}, {**AD, "campaign_name": " \t"}, {**AD, "clicks": -1},
        {**AD, "spend": None}, {**AD, "campaign_id": "x"}, {**AD, "impressions": 1.5}, "{torn", without("x"),
    ]
    frame = texts(spark, {**AD, "other": 1}, bare, *bad)
    valid = ingest.ingest_ads(frame, T0, mode="split")
    assert valid.columns == schemas.schema("raw_google_ads").names
    assert rows(valid, "campaign_id", "campaign_name", "clicks", "impressions", "spend") == [
        (1001, "Summer", 0, 0, 0.0), (1001, "Summer", 3, 9, 1.5),
    ]
    assert validation.refused(validation.check_ads(frame)).count() == len(bad)
    with pytest.raises(validation.InvalidBatch):
        ingest.ingest_ads(frame, T0)
    assert ingest.ingest_ads(texts(spark, AD), T0).count() == 1
    with pytest.raises(ValueError):
        ingest.ingest_ads(frame, T0, mode="maybe")


def test_bookings_from_landing_files(spark, tmp_path, rows):
    record = {"booking_id": 1, "user_id": 2, "route": "a", "transport_type": "bus", "status": "paid", "price": 35.5, "currency": "USD"}
    (tmp_path / "call.json").write_text(
        json.dumps([{**record, "created_at": "2024-01-01T10:00:00.5+02:00"}, {**record, "created_at": "junk", "extra": 1}])
    )
    landed = tables.read_json_rows(spark, str(tmp_path), ingest.BOOKING_RECORD)
    raw = ingest.ingest_bookings(landed, "run-1", "2024-01-02 03:04:05.6789")
    assert raw.columns == schemas.schema("raw_bookings").names
    assert rows(raw, "created_at", "loaded_at", "run_id") == [
        (datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 3, 4, 5, 678000), "run-1"),
    ]


def test_unreadable_creation_text_is_kept_as_a_dead_letter(spark):
    record = {"booking_id": 7, "user_id": 1, "route": "A-B", "price": 22.0, "status": "paid"}
    records = spark.createDataFrame([(json.dumps(record | {"created_at": t}),) for t in ("junk", "2024-01-01T10:00:00Z", None)], "value string")
    records = records.select(F.from_json("value", ingest.BOOKING_RECORD).alias("r")).select("r.*")
    (letter_,) = ingest.unreadable_bookings(records, T0).collect()
    assert (letter_.booking_id, letter_.error_reason, letter_.failed_at) == (7, "created_at is not a time", T0)
    assert json.loads(letter_.raw_record)["created_at"] == "junk" and json.loads(letter_.raw_record)["price"] == "22"
    assert ingest.ingest_bookings(records, "r", T0).count() == 2


def test_prices_that_are_not_finite_are_dead_letters(spark, rows):
    prices = [1.5, -1.0, float("nan"), float("inf"), -1e30, None]
    raw = spark.createDataFrame([(n + 1, p) for n, p in enumerate(prices)], "booking_id long, price double")
    empty = {c: F.lit(None).cast("string") for c in ("user_id", "route", "transport_type", "status", "currency", "created_at", "loaded_at", "run_id")}
    valid, letters = validation.split_bookings(raw.withColumns(empty), T0)
    assert rows(valid, "booking_id") == [(1,)]
    assert rows(letters, "booking_id", "error_reason") == [
        (2, "price is negative"), (3, "price is not finite"), (4, "price is not finite"), (5, "price is negative"), (6, "unknown validation error"),
    ]


def test_payload_archive_has_one_row_per_call(spark, rows):
    calls = [[{"campaign_id": 1, "clicks": n} for n in range(start, start + 500)] for start in range(0, 2500, 500)] + [[]]
    for partitions in (1, 3, 8):
        responses = texts(spark, *map(json.dumps, calls)).repartition(partitions)
        archive = ingest.archive_payload(responses, "meta_ads", T0)
        assert {(r.source, r.endpoint, r.fetched_at) for r in archive.collect()} == {("meta_ads", "meta-ads", T0)}
        assert sorted(len(json.loads(r.payload)) for r in archive.collect()) == [0] + [500] * 5
        back = ingest.unpack_payload(archive, "campaign_id long, clicks long")
        assert sorted(r.clicks for r in back.collect()) == list(range(2500))


CHANGES = [
    ({"after": {"order_id": 123}, "before": None}, (123, None, "null", '{"order_id":123}', None)),
    ({"after": None, "before": {"order_id": 456}, "op": "d"}, (456, "d", '{"order_id":456}', "null", None)),
    (
        {"op": "u", "before": {"order_id": 1, "status": "paid"}, "after": {"order_id": 1, "status": "completed"}, "ts_ms": 123456789},
        (1, "u", '{"order_id":1,"status":"paid"}', '{"order_id":1,"status":"completed"}', 123456789),
    ),
    ({"op": "c", "after": {"status": "x"}}, (None, "c", "null", '{"status":"x"}', None)),
]


def test_change_envelopes(spark):
    frame = texts(spark, *[message for message, _ in CHANGES], "{torn", "5", None, "[]", '{"op":"c"} x', '{"op":"c"}]', "{'op':'c'}")
    raw = ingest.cdc_to_raw(frame, ingested_at=T0)
    assert raw.columns == schemas.schema("raw_cdc_orders").names
    got = [(r.order_id, r.op, r.before_record, r.after_record, r.source_ts_ms) for r in raw.collect()]
    assert got == [expected for _, expected in CHANGES]


def letter(event_id, raw, minute, recovered=False, count=0, topic=validation.USER_EVENTS_TOPIC):
    return (event_id, raw, "{}", topic, T0 + timedelta(minutes=minute), recovered, None, count, False, None)


def letters(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.schema("dlq_user_events"))


def test_replay_picks_sends_and_marks(spark, tmp_path):
    avro_like = {**GOOD, "event_time": "broken", "extra": 1, "properties": {"z": 1, "route": "b"}}
    dlq = letters(
        spark,
        letter(ID.format(1), json.dumps(avro_like), 5),
        letter(ID.format(2), json.dumps({**GOOD, "properties": "{broken"}), 1),
        letter("no-uuid", json.dumps(GOOD), 2),
        letter(ID.format(3), "{torn", 3),
        letter(ID.format(4), json.dumps({**GOOD, "user_id": "7"}), 3),
        letter(ID.format(5), json.dumps(GOOD), 0, count=3),
        letter(ID.format(6), json.dumps(GOOD), 0, recovered=True),
        letter(ID.format(7), json.dumps(GOOD), 0, topic="other"),
        letter(ID.format(8), json.dumps(GOOD), 9),
        letter(None, json.dumps(GOOD), 2),
    )
    assert [r.event_id for r in replay.replay_candidates(dlq, batch=3).collect()] == [ID.format(2), None, "no-uuid"]
    sink = str(tmp_path / "topic")
    after = {r.event_id: r for r in replay.replay_dlq(dlq, sink, as_of=T0, batch=6).collect()}
    assert {key for key, r in after.items() if r.replayed} == {ID.format(1), ID.format(2)}
    assert after[ID.format(1)].replay_count == 1 and after[ID.format(1)].replayed_at == T0
    sent = [json.loads(r.value) for r in spark.read.text(sink).collect()]
    assert len(sent) == 4
    assert {m["properties"] for m in sent} == {'{"z":1,"route":"b"}', "{broken", '{"route":"A -> B"}'}
    assert all(set(m) <= {"event_id", "user_id", "event_type", "event_time", "properties", "device_type"} for m in sent)


def test_replay_through_a_function_and_failed_delivery(spark):
    dlq = letters(spark, letter(ID.format(1), json.dumps(GOOD), 5))
    taken = []
    after = replay.replay_dlq(dlq, lambda messages: taken.extend(messages.collect()), as_of=T0)
    assert len(taken) == 1 and after.head().replay_count == 1

    def broken(messages):
        raise OSError("topic is away")

    with pytest.raises(OSError):
        replay.replay_dlq(dlq, broken, as_of=T0)


def test_three_replays_are_the_limit(spark):
    dlq = letters(spark, letter(ID.format(1), json.dumps(GOOD), 5))
    for _ in range(5):
        dlq = spark.createDataFrame(replay.replay_dlq(dlq, lambda messages: None, as_of=T0).collect(), dlq.schema)
    assert dlq.head().replay_count == 3


def test_recoveries(spark):
    dlq = letters(spark, letter(ID.format(1), "{}", 5), letter(ID.format(1), "{}", 50), letter(ID.format(2), "{}", 5), letter(None, "{}", 5))
    log = spark.createDataFrame(
        [(ID.format(1), T0 + timedelta(minutes=10)), (ID.format(1), T0 + timedelta(minutes=20))], "event_id string, ingested_at timestamp"
    )
    got = [(r.event_id, r.failed_at.minute, r.recovered, r.recovered_at) for r in replay.apply_recoveries(dlq, log).collect()]
    assert sorted(got, key=repr) == sorted(
        [
            (ID.format(1), 5, True, T0 + timedelta(minutes=20)),
            (ID.format(1), 50, False, None),
            (ID.format(2), 5, False, None),
            (None, 5, False, None),
        ],
        key=repr,
    )
    ids = spark.createDataFrame([(ID.format(2),), ("no-uuid",)], "event_id string")
    marked = replay.mark_recovered(dlq, ids, T0).where("recovered").collect()
    assert [(r.event_id, r.recovered_at) for r in marked] == [(ID.format(2), T0)]


def test_against_the_contract_library(spark):
    """The accept set of integers and times equals that of the library the contract is written for."""
    pydantic = pytest.importorskip("pydantic")
    model = pydantic.create_model("E", user_id=(int, ...), event_time=(datetime, ...))
    numbers = [7, "7", " 7", "7.0", "7.", "7.5", 7.0, 7.5, True, None, "", "1_0", "1__0", "+3", "0x1", "1e2", 100.0]
    times = ["2024-05-24", "2024-05-24T01:02:03", "2024-05-24 01:02", "2024-5-24", 0, 1.5, "12", "x", None, True,
             "2024-05-24T01:02:03.5+05:30", "2024-05-24T01:02:03+0530", "2024-13-01", 3e10]
    cases = [{"user_id": n, "event_time": "2024-05-24"} for n in numbers] + [{"user_id": 1, "event_time": t} for t in times]
    frame = texts(spark, *[{**GOOD, **case} for case in cases])
    for case, row in zip(cases, validation.validate_user_events(frame).collect()):
        try:
            expected = model(**case)
        except pydantic.ValidationError:
            assert row.violations, case
            continue
        assert not row.violations, case
        moment = expected.event_time
        moment = moment - moment.utcoffset() if moment.tzinfo else moment
        assert row.user_id == expected.user_id and row.event_time == moment.replace(microsecond=0, tzinfo=None)


def test_the_cheap_way_and_the_thorough_way_agree(spark, monkeypatch):
    """Messages put together at random get the same verdict and values whichever way they are read."""
    import random

    pick = random.Random(7)
    pools = {
        "event_id": [ID.format(1), ID.format(2).upper(), "plain", 5, 5.5, None, True, "5", ["x"], ""],
        "user_id": [1, "2", " 3 ", 4.0, "5.0", 5.5, -1, "x", None, True, 10**18, 10**19, "007"],
        "event_type": ["search_performed", "booking_started", "payment_completed", "other", 1, None],
        "event_time": ["2024-05-24T12:00:00Z", "2024-05-24T12:00:00.5+02:00", "2024-02-30T12:00:00Z", "2024-05-24", 17e8, "17", None, "x"],
        "properties": [
            {"route": "R1"}, '{"route":"R1"}', {"route": "true"}, {"route": True}, {"route": 5}, {"route": "5"}, {}, "5", 5,
            "{", '{"route":"é"} x', [{"route": "R1"}], '[{"route":"R1"}]', {"route": {"a": 1}}, '{"route":"a","route":7}', None,
            {"route": "", "x": 1}, '{"route":"nan"}', {"route": "NaN"},
        ],
        "extra": [1, {"event_id": "x"}, None],
    }
    messages = []
    for _ in range(3000):
        message = dict(GOOD)
        for field in pick.sample(sorted(pools), pick.choice([0, 1, 1, 1, 2, 6])):
            if pick.random() < 0.1:
                message.pop(field, None)
            else:
                message[field] = pick.choice(pools[field])
        text = json.dumps(message, ensure_ascii=pick.random() < 0.5)
        messages.append(pick.choice([text] * 12 + [text + " ", text + "x", text[:-1], "[" + text + "]", text + text]))
    frame = texts(spark, *messages)
    quick = validation.validate_user_events(frame).collect()
    kind = "struct<event_id:string,user_id:bigint,event_type:string,event_time:timestamp,route:string>"
    taken = validation._plain_events(frame).where("_plain IS NOT NULL").count()
    monkeypatch.setattr(validation, "_plain_events", lambda df: df.withColumn("_plain", F.lit(None).cast(kind)))
    thorough = validation.validate_user_events(frame).collect()
    assert 300 < taken < 2500
    for a, b in zip(quick, thorough):
        assert a.violations == b.violations, a.value
        if not a.violations:
            assert a == b, a.value


def test_letters_that_cannot_be_sent_block_nothing(spark, tmp_path, rows):
    dlq = letters(spark, *[letter(f"bad-{n}", "{torn", n) for n in range(20)], letter(ID.format(1), json.dumps(GOOD), 40))
    places = [str(tmp_path / name) for name in ("marks", "outbox", "topic")]
    for turn in range(5):
        marks.replay_round(dlq, *places, replay_id=f"r{turn}", as_of=T0, max_replays=3)
    marks.replay_round(dlq, *places, replay_id="r4", as_of=T0, max_replays=3)  # repeated after a failure
    state = marks.with_state(dlq, marks.read_marks(spark, places[0]))
    assert [(r.event_id, r.replay_count) for r in state.where("replayed").collect()] == [(ID.format(1), 2)]
    assert {r.replay_count for r in state.where("not replayed").collect()} == {3}
    assert spark.read.text(places[2]).distinct().count() == 1
    assert dlq.count() == state.count()


def test_marks_follow_what_the_sink_reports(spark, tmp_path):
    dlq = letters(spark, letter(ID.format(1), json.dumps(GOOD), 1), letter(ID.format(2), json.dumps(GOOD), 2))
    path = str(tmp_path / "marks")
    assert marks.read_marks(spark, path).count() == 0
    marks.replay_round(dlq, path, str(tmp_path / "o"), lambda messages: messages.limit(1), "one", T0)
    state = marks.with_state(dlq, marks.read_marks(spark, path)).collect()
    assert sorted((r.replayed, r.replay_count) for r in state) == [(False, 1), (True, 1)]
    log = spark.createDataFrame([(ID.format(2), T0 + timedelta(minutes=2)), (ID.format(1), T0), ("x", T0 + timedelta(minutes=9))], "event_id string, ingested_at timestamp")
    marks.mark_recoveries(dlq, path, log, "recovery-1")
    state = marks.with_state(dlq, marks.read_marks(spark, path)).where("recovered").collect()
    assert [(r.event_id, r.recovered_at) for r in state] == [(ID.format(2), T0 + timedelta(minutes=2))]
