"""Stated results for single functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retail_stream import schemas
from retail_stream.functions import columns as C
from retail_stream.functions import records
from retail_stream.operators import routing
from retail_stream.plans import records as plans


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return row.select(column).first()[0]


def raw(spark, *lines, arrival=None):
    arrival = arrival or dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([(v, arrival) for v in lines], "value string, arrival_ts timestamp")


def test_text_number_becomes_double(spark):
    rows = plans.orders(raw(spark, '{"id":"1","total_amount":"12.5"}', '{"id":"2","total_amount":7}'))
    assert {r.id: r.total_amount for r in rows.collect()} == {"1": 12.5, "2": 7.0}


def test_number_becomes_text(spark):
    rows = plans.event_logs(raw(spark, '{"mid":"m","ts":1,"itemid":7,"unknown":1}')).collect()
    assert rows[0].itemid == "7" and rows[0].ch is None and rows[0].log_date == "1970-01-01"


@pytest.mark.parametrize(
    "line, reason",
    [
        ("oops", "malformed"),
        ("", "malformed"),
        (None, "malformed"),
        ("[1,2]", "malformed"),
        ('{"mid":"m","ts":"then"}', "missing key"),
        ('{"ts":5}', "missing key"),
        ('{"mid":"m","ts":9223372036854775807}', "ts out of range"),
        ('{"mid":"m","ts":5', "malformed"),
    ],
)
def test_bad_row_is_set_aside(spark, line, reason):
    rows = raw(spark, line, '{"mid":"m","ts":5}')
    assert plans.startup_logs(rows).count() == 1
    assert [r.reason for r in records.quarantine(rows, schemas.STARTUP).collect()] == [reason]


def test_every_row_is_kept_or_set_aside(spark):
    rows = raw(spark, "x", '{"id":"1"}', '{"id":null}', '{"id":"2","total_amount":"no"}')
    kept, aside = plans.orders(rows), records.quarantine(rows, schemas.ORDER)
    assert kept.count() + aside.count() == rows.count()
    assert {r.id for r in kept.collect()} == {"1", "2"}


def test_parse_runs_once_per_row(spark):
    rows = plans.startup_logs(raw(spark, '{"mid":"m","ts":5}'))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "line, stamped",
    [
        ('{"b":7,"ts":1}', '{"b":7,"ts":5}'),
        ('{"b":"7","c":{"d":[1,"x"]},"e":null}', '{"b":"7","c":{"d":[1,"x"]},"e":null,"ts":5}'),
        ('{"a":1,"a":2}', '{"a":2,"ts":5}'),
        ("{}", '{"ts":5}'),
    ],
)
def test_stamp(spark, line, stamped):
    arrival = dt.datetime(1970, 1, 1, 0, 0, 0, 5000, tzinfo=dt.timezone.utc)
    assert routing.route_logs(raw(spark, line, arrival=arrival)).first().value == stamped


def test_unreadable_log_is_rejected(spark):
    rows = raw(spark, "oops", '{"a":1}')
    assert [r.value for r in routing.rejected_logs(rows).collect()] == ["oops"]
    assert routing.route_logs(rows).count() == 1


def test_stamp_uses_the_clock_without_arrival(spark):
    rows = spark.createDataFrame([('{"ts":1}',)], "value string")
    got = routing.route_logs(rows).select(F.get_json_object("value", "$.ts").cast("bigint")).first()[0]
    assert abs(got - dt.datetime.now(dt.timezone.utc).timestamp() * 1000) < 60_000


@pytest.mark.parametrize(
    "line, topic",
    [
        ('{"type":"startup"}', "start"),
        ('{"type":"event"}', "event"),
        ('{"type":"event","page":"startup_page"}', "start"),
    ],
)
def test_log_topic(spark, line, topic):
    assert routing.route_logs(raw(spark, line)).first().topic == topic
    assert routing.route_logs(raw(spark, line), "shop_").first().topic == "shop_" + topic


def test_log_time(spark):
    row = spark.createDataFrame([(1582287132000,)], "ts bigint")
    assert tuple(records.with_log_time(row).first())[1:] == ("2020-02-21", "12")


def test_log_time_follows_the_session_zone(spark, settings):
    settings(spark__sql__session__timeZone="Asia/Shanghai")
    row = spark.createDataFrame([(1582287132000,)], "ts bigint")
    assert tuple(records.with_log_time(row).first())[1:] == ("2020-02-21", "20")


@pytest.mark.parametrize(
    "text, parts",
    [
        ("2020-02-21 12:12:12", ("2020-02-21", "12")),
        ("2020-02-21", ("2020-02-21", None)),
        (None, (None, None)),
    ],
)
def test_create_time(spark, text, parts):
    row = spark.createDataFrame([(text,)], "create_time string")
    assert tuple(records.with_create_time(row).first())[1:] == parts


@pytest.mark.parametrize(
    "tel, masked", [("13812345678", "1381*******"), ("138", "138*******"), (None, None)]
)
def test_mask(spark, tel, masked):
    assert one(spark, C.mask_phone("tel"), tel=tel) == masked


@pytest.mark.parametrize(
    "birthday, age",
    [("1995-05-05", 28), ("2024-06-01", 0), ("2026-01-01", -2), ("never", None), (None, None)],
)
def test_age(spark, birthday, age):
    assert one(spark, C.age_in_years("birthday", "2024-01-01"), birthday=birthday) == age


@pytest.mark.parametrize(
    "day, before", [("2024-03-01", "2024-02-29"), ("2024-01-01", "2023-12-31"), ("x", None)]
)
def test_previous_day(spark, day, before):
    assert one(spark, C.previous_day(day), x="") == before
    assert one(spark, C.previous_day(F.col("day")), day=day) == before


def test_document_id(spark):
    assert one(spark, C.document_id("o", "d"), o="7", d="9") == "7-9"


def test_full_topic_name():
    assert schemas.full_name("order_info") == "order_info"
    assert schemas.full_name(schemas.USER, "shop_") == "shop_user_info"
    assert list(schemas.TOPICS) == ["start", "event", "order_info", "order_detail", "user_info"]
