from datetime import datetime

import pytest
from conftest import RAW_DDL, SF_SMALL, raw_row
from pyspark.sql import functions as F

from clickloom.functions import clock, text
from clickloom.operators import validate
from clickloom.operators.validate import ABSENT
from clickloom.sources import recipe


def reasons(spark, *rows, ddl=RAW_DDL):
    df = validate.annotate(spark.createDataFrame(list(rows), ddl))
    return [r["errors"] for r in df.select("errors").collect()]


def test_valid_row_is_trimmed_and_lowered(spark):
    df = spark.createDataFrame(
        [raw_row(client_id="\t c1\u00a0", event_name=" Page_Viewed ", event_data=' {"a": 1} ', referrer=" r ")],
        RAW_DDL,
    )
    row = validate.valid_events(validate.annotate(df)).first()
    assert (row.client_id, row.event_name, row.event_data, row.referrer) == ("c1", "page_viewed", '{"a": 1}', " r ")
    assert row.timestamp == datetime(2024, 1, 1, 10)


def test_messages_in_field_order(spark):
    (errors,) = reasons(spark, raw_row(
        client_id=None, timestamp=" ", event_name="x", event_data="[1]", page_url="", user_agent="\n"))
    assert errors == [
        "client_id: Input should be a valid string",
        "timestamp: Value error, timestamp is empty",
        "event_name: Input should be one of the known event names",
        "event_data: Value error, event_data JSON must be an object",
        "page_url: Value error, required field is empty",
        "user_agent: Value error, required field is empty",
    ]


def test_null_and_unparsable_timestamp(spark):
    assert reasons(spark, raw_row(timestamp=None), raw_row(timestamp="soon"), raw_row(timestamp="10:00:00")) == [
        ["timestamp: Value error, timestamp is null"],
        ["timestamp: Value error, timestamp is not a valid datetime"],
        ["timestamp: Value error, timestamp is not a valid datetime"],
    ]


@pytest.mark.parametrize("absent", ["client_id", "timestamp", "event_data"])
def test_absent_column(spark, absent):
    df = spark.createDataFrame([raw_row()], RAW_DDL).drop(absent)
    assert validate.annotate(df).first()["errors"] == [f"{absent}: Field required"]


def test_absent_referrer_is_fine(spark):
    df = spark.createDataFrame([raw_row()], RAW_DDL).drop("referrer")
    row = validate.annotate(df).first()
    assert row["is_valid"] and row["referrer"] is None


def test_absence_per_row(spark):
    df = spark.createDataFrame([raw_row(), raw_row()], RAW_DDL).coalesce(1).withColumn(
        ABSENT, F.when(F.monotonically_increasing_id() == 0, F.array(F.lit("timestamp")))
        .otherwise(F.array().cast("array<string>")))
    assert [r["errors"] for r in validate.annotate(df).collect()] == [["timestamp: Field required"], []]


@pytest.mark.parametrize("cell,stored", [
    (None, "{}"), ("", "{}"), ("  ", "{}"), ("null", "{}"), (" NULL ", "{}"), ('{"a":1}', '{"a":1}'),
])
def test_event_data_defaults(spark, cell, stored):
    row = validate.annotate(spark.createDataFrame([raw_row(event_data=cell)], RAW_DDL)).first()
    assert row["is_valid"] and row["event_data"] == stored


GOOD_JSON = ['{}', '{"a":1}', '{"a":"it\'s"}', '{"a":"\\"\'"}', '[1]', '"x"', '12', '{\n"a":\t1}', '{"a":{"b":[{}]}}',
             '{"a":"\\\\"}']
BAD_JSON = ["{bad", '{"a":1', '{"a":1} {}', '{"a":1},"b"', '{"a":1}] {}', '{"a":1}}', "{'a':1}", '{"a":1,}', "tru",
            '{"a":"x\ty"}', '{"a":"b\nc","d":"e"}', '{"a":01}', '{"a":"\\x"}']


def test_json_is_strict_and_whole(spark):
    df = spark.createDataFrame([(t,) for t in GOOD_JSON + BAD_JSON], "t string")
    got = {r["t"]: r["ok"] for r in df.select("t", text.is_json(F.col("t")).alias("ok")).collect()}
    assert got == {**{t: True for t in GOOD_JSON}, **{t: False for t in BAD_JSON}}


TIMES = {
    "2024-01-01T10:00:00.123Z": datetime(2024, 1, 1, 10, 0, 0, 123000),
    "2024-01-01 10:00:00": datetime(2024, 1, 1, 10),
    "2024-01-01T10:00:00+05:30": datetime(2024, 1, 1, 4, 30),
    "2024-01-01T10:00:00-0200": datetime(2024, 1, 1, 12),
    "2024-01-01": datetime(2024, 1, 1),
    "01/02/2024 10:11": datetime(2024, 1, 2, 10, 11),
    "1/2/2024 3:04:05 PM": datetime(2024, 1, 2, 15, 4, 5),
    "2024/1/5": datetime(2024, 1, 5),
    "5 Jan 2024 06:07": datetime(2024, 1, 5, 6, 7),
    "Jan 5, 2024": datetime(2024, 1, 5),
    "20240105T060708": datetime(2024, 1, 5, 6, 7, 8),
    "20240105": datetime(2024, 1, 5),
    "2024-01-01T10:00+02:00": datetime(2024, 1, 1, 8),
    "2024-01-01T10+02": datetime(2024, 1, 1, 8),
    "20240101T101010Z": datetime(2024, 1, 1, 10, 10, 10),
    "20240101T101010+0200": datetime(2024, 1, 1, 8, 10, 10),
    "2024-01-01T10:00:00,123Z": datetime(2024, 1, 1, 10, 0, 0, 123000),
    "2024-01-01T10:00:00z": datetime(2024, 1, 1, 10),
    "13/01/2024": datetime(2024, 1, 13),
    "2024-01-01T10:00:00+5:30": datetime(2024, 1, 1, 4, 30),
    "2024-01-01T10:00:00 GMT+2": datetime(2024, 1, 1, 8),
    "2024-01-01T10:00:00 UTC+05:30": datetime(2024, 1, 1, 4, 30),
    "2024-01-01T10:00:00 EST": datetime(2024, 1, 1, 15),
    "2024-07-01 10:00:00 Europe/Paris": datetime(2024, 7, 1, 8),
    "2024-01-01T10:00:00+05:30:00": datetime(2024, 1, 1, 4, 30),
    "2024-01-01T10:00:00 Nowhere/There": None,
    "2024-01-01T10:00:00+99:00": None,
    "T10:00": None,
    "2024-13-01": None,
    "99/99/2024": None,
    "170000": None,
    "1700000000": None,
    "now": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in TIMES], "t string")
        got = {r["t"]: r["v"] for r in df.select("t", clock.parse_timestamp(F.col("t")).alias("v")).collect()}
        assert got == TIMES
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_typed_timestamps(spark):
    raw = spark.createDataFrame([raw_row()], RAW_DDL)
    for expression, expected in [
        ("1704103200", datetime(2024, 1, 1, 10)),
        ("1704103200123L", datetime(2024, 1, 1, 10, 0, 0, 123000)),
        ("1704103200.5D", datetime(2024, 1, 1, 10, 0, 0, 500000)),
        ("TIMESTAMP_NTZ'2024-01-01 10:00:00'", datetime(2024, 1, 1, 10)),
        ("TIMESTAMP'2024-01-01 10:00:00Z'", datetime(2024, 1, 1, 10)),
    ]:
        df = raw.withColumn("timestamp", F.expr(expression))
        assert validate.annotate(df).first()["timestamp"] == expected


def test_typed_event_data(spark):
    df = spark.createDataFrame([raw_row()], RAW_DDL).withColumn("event_data", F.expr("named_struct('revenue', 2.5D)"))
    assert validate.annotate(df).first()["event_data"] == '{"revenue":2.5}'


def test_boundary_diff(spark):
    row = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 10:00:59' a, TIMESTAMP_NTZ'2024-01-01 10:30:00' b, "
        "TIMESTAMP_NTZ'1969-12-31 23:59:59.5' c, TIMESTAMP_NTZ'1970-01-01 00:00:00.1' d"
    ).select(
        clock.boundary_diff("minute", F.col("a"), F.col("b")),
        clock.boundary_diff("second", F.col("a"), F.col("b")),
        clock.boundary_diff("day", F.col("a"), F.col("b")),
        clock.boundary_diff("minute", F.col("b"), F.col("a")),
        *[clock.boundary_diff(u, F.col("c"), F.col("d")) for u in ("second", "minute", "hour", "day")],
    ).first()
    assert tuple(row) == (30, 1741, 0, -30, 1, 1, 1, 1)


def test_log_status_and_files_without_rows(spark):
    rows = [raw_row(), raw_row(client_id=None)]
    df = spark.createDataFrame(rows, RAW_DDL).withColumn("source_file", F.lit("mixed.csv")).unionByName(
        spark.createDataFrame([raw_row(client_id=None)], RAW_DDL).withColumn("source_file", F.lit("bad.csv"))
    ).unionByName(spark.createDataFrame([raw_row()], RAW_DDL).withColumn("source_file", F.lit("good.csv")))
    files = spark.createDataFrame([(f"{n}.csv",) for n in ("mixed", "bad", "good", "empty")], "source_file string")
    log = validate.file_log(validate.annotate(df), datetime(2024, 1, 1), "r", files)
    got = {r["filename"]: (r["rows_read"], r["rows_inserted"], r["rows_quarantined"], r["status"]) for r in log.collect()}
    assert got == {
        "mixed.csv": (2, 1, 1, "partial_failure"), "bad.csv": (1, 0, 1, "FAILED"),
        "good.csv": (1, 1, 0, "COMPLETED"), "empty.csv": (0, 0, 0, "COMPLETED"),
    }


def test_record_is_computed_before_the_generator(spark):
    """A generator evaluates what it is given without generated code."""
    annotated = validate.annotate(spark.createDataFrame([raw_row()], RAW_DDL))
    plan = validate.valid_events(annotated)._jdf.queryExecution().optimizedPlan().toString()
    generate = [line for line in plan.splitlines() if "Generate " in line]
    assert len(generate) == 1 and "inline(array(_record" in generate[0], plan


def test_number_is_searched_once_per_row(spark):
    plan = recipe.raw_clickstream(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1, plan
