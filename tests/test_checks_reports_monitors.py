import random
from datetime import date, datetime, timedelta

import pytest
from conftest import STG_DDL, at, stg_row
from pyspark.sql import functions as F

from clickloom.operators.attribution import attribute, purchases
from clickloom.operators.identity import stitch_identity
from clickloom.operators.leads import lead_velocity
from clickloom.operators.matching import session_minutes
from clickloom.operators.orders import order_items
from clickloom.operators.sessions import session_rollup
from clickloom.plans import checks, monitors, reports


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    events = ["page_viewed", "product_added_to_cart", "email_filled_on_popup", "checkout_started", "checkout_completed"]
    rows = []
    for i in range(900):
        client = rng.choice(["hot", "hot", "a", "b", "c", "d"])
        time = datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(12 * 86400))
        event = rng.choice(events)
        buy = event == "checkout_completed"
        price = rng.randrange(1, 500) / 4
        rows.append(stg_row(
            client, time.isoformat(), event,
            email=f"{client}@x" if event == "email_filled_on_popup" and client != "d" else None,
            txn=f"T{i}" if buy else None, revenue=price if buy else None,
            items=f'[{{"item_id":"i","item_price":{price},"quantity":1}}]' if buy else None,
            channel=rng.choice(["Paid", "Direct", "Referral"])))
    stg = spark.createDataFrame(rows, STG_DDL).cache()
    users = stitch_identity(stg).cache()
    sessions = session_rollup(stg, users).cache()
    buys = purchases(stg, users)
    made = {
        "stg_events": stg, "dim_user_map": users, "dim_sessions": sessions,
        "fct_attribution": attribute(buys, sessions).cache(), "fct_order_items": order_items(stg).cache(),
        "rpt_lead_velocity": lead_velocity(stg, users),
    }
    yield made
    for df in (stg, users, sessions, made["fct_attribution"], made["fct_order_items"]):
        df.unpersist()


def statuses(tables, **changes):
    summary = checks.check_summary(checks.check_results({**tables, **changes}))
    return {r["check_name"]: (r["status"], r["details"]) for r in summary.collect()}


def test_sound_tables_pass(tables):
    got = statuses(tables)
    assert {s for s, _ in got.values()} == {"PASS"}
    assert list(got)[0] == "sessions_overview" and got["event_coverage"][1] == "unassigned_events=0"


def test_dropped_session_is_found(tables):
    sessions = tables["dim_sessions"]
    longest = sessions.orderBy(F.desc("actions_per_session"), "session_id").first()
    got = statuses(tables, dim_sessions=sessions.where(F.col("session_id") != longest["session_id"]))
    assert got["event_coverage"] == ("FAIL", f"unassigned_events={longest['actions_per_session']}")


def test_shifted_start_is_found(tables):
    sessions = tables["dim_sessions"]
    first = sessions.where("actions_per_session > 1 AND client_id = 'hot'").orderBy("session_id").first()
    moved = sessions.withColumn("started_at", F.when(
        F.col("session_id") == first["session_id"], F.col("started_at") + F.expr("INTERVAL 1 MICROSECOND")
    ).otherwise(F.col("started_at")))
    got = statuses(tables, dim_sessions=moved)
    assert got["actions_mismatch"] == ("FAIL", "rowcount=1")
    assert got["event_coverage"] == ("FAIL", "unassigned_events=1")


def test_merged_and_overlapping_sessions_are_found(tables):
    sessions = tables["dim_sessions"]
    one, two = sessions.where("client_id = 'hot'").orderBy("started_at").limit(2).collect()
    merged = sessions.withColumn("ended_at", F.when(
        F.col("session_id") == one["session_id"], F.lit(two["ended_at"])).otherwise(F.col("ended_at")))
    got = statuses(tables, dim_sessions=merged)
    assert got["within_session_gap"] == ("FAIL", "rowcount=1")
    assert got["between_session_gap"] == ("FAIL", "rowcount=1")
    assert got["event_coverage"][0] == "FAIL"  # events counted in two sessions


def test_doubled_item_and_late_credit_are_found(spark, tables):
    items = tables["fct_order_items"]
    one = items.orderBy("transaction_id").limit(1)
    assert statuses(tables, fct_order_items=items.unionByName(one))["revenue_discrepancy"] == ("FAIL", "rowcount=1")
    late = tables["fct_attribution"].withColumn("purchase_time", F.col("purchase_time") + F.expr("INTERVAL 9 DAYS"))
    n = late.count()
    assert statuses(tables, fct_attribution=late)["lookback"] == ("FAIL", f"rowcount={n}")


def test_duplicates_are_only_reported(tables):
    stg = tables["stg_events"]
    doubled = stg.unionByName(stg.where("event_name = 'checkout_completed'").limit(3))
    assert statuses(tables, stg_events=doubled)["duplicate_purchases"] == ("PASS", "duplicate_pairs=3")


def test_broken_check_does_not_stop_others(spark, tables):
    results = checks.check_results(tables)
    broken = tables["dim_sessions"].select(F.raise_error(F.lit("boom")).alias("x"))
    results = {"broken": (checks.zero_rows_status, lambda: broken), **results}
    summary, samples = checks.run_checks(spark, results)
    got = {r["check_name"]: r["status"] for r in summary.collect()}
    assert got.pop("broken") == "FAIL" and set(got.values()) == {"PASS"} and samples == {}
    with pytest.raises(checks.ChecksFailed, match="broken"):
        checks.require_passed(summary)


def test_empty_tables(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert set(s for s, _ in statuses(empty).values()) == {"PASS"}
    for make in reports.report_sections(empty).values():
        make().collect()


def test_missing_column_fails_only_what_reads_it(spark, tables, folder):
    lacking = {**tables, "dim_sessions": tables["dim_sessions"].drop("converted"), "fct_order_items": tables["fct_order_items"].drop("line_total")}
    summary, _ = checks.run_checks(spark, checks.check_results(lacking))
    got = {r["check_name"]: (r["status"], r["details"]) for r in summary.collect()}
    assert {n for n, (s, _) in got.items() if s == "FAIL"} == {"sessions_overview", "revenue_discrepancy"}
    assert got["sessions_overview"][1] == "error=AnalysisException"
    outcome = {r["section"]: r["error"] for r in reports.write_report(spark, reports.report_sections(lacking), folder).collect()}
    assert outcome["engagement_overview"] and outcome["funnel"] and outcome["attribution_overview"] is None
    del lacking["fct_attribution"]
    summary, _ = checks.run_checks(spark, checks.check_results(lacking))
    got = {r["check_name"]: r["status"] for r in summary.collect()}
    assert got["lookback"] == "FAIL" and got["event_coverage"] == "PASS"


def test_failing_sample_of_nulls_keeps_its_schema(spark, tables):
    row = spark.createDataFrame([(None, None)], "transaction_id string, revenue double")
    summary, samples = checks.run_checks(spark, {"nulls": (checks.zero_rows_status, lambda: row)})
    assert summary.first()["status"] == "FAIL"
    assert samples["nulls"].schema == row.schema and samples["nulls"].collect() == row.collect()


def test_conservation(tables):
    sections = {name: make() for name, make in reports.report_sections(tables).items()}
    total = sections["engagement_overview"].first()["total_sessions"]
    assert total == sections["funnel"].first()["total_sessions"]
    for name, column in (("device_usage", "session_count"), ("device_browser_usage", "session_count"),
                         ("daily_kpi", "sessions"), ("new_vs_returning", "sessions")):
        assert sections[name].agg(F.sum(column)).first()[0] == total
    revenue = tables["stg_events"].where("event_name = 'checkout_completed'").agg(F.sum("revenue")).first()[0]
    days = sections["daily_kpi"].agg(F.sum("revenue"), F.sum("converted_sessions")).first()
    assert days[0] == pytest.approx(revenue)
    assert days[1] == sections["funnel"].first()["step_4_purchase"]
    assert sections["attribution_overview"].agg(F.sum("last_click_revenue")).first()[0] == pytest.approx(revenue)
    for row in sections["fc_vs_lc_revenue"].groupBy("model").agg(F.sum("revenue").alias("r")).collect():
        assert row["r"] == pytest.approx(revenue)


def test_unattributed_bucket_and_days_without_purchases(spark):
    attribution = spark.createDataFrame(
        [("T", "u", 2.0, at("2024-01-01 10:00"), None, None), ("S", "u", 3.0, at("2024-01-01 10:00"), "s", "Paid")],
        "transaction_id string, purchaser_master_id string, revenue double, purchase_time timestamp_ntz, "
        "lc_session_id string, lc_channel string").withColumn("fc_channel", F.col("lc_channel"))
    got = {r["channel"]: tuple(r)[1:] for r in reports.attribution_overview(attribution).collect()}
    assert got == {"Direct/Unattributed": (2.0, 1, 0.0), "Paid": (3.0, 1, 3.0)}
    sessions = spark.createDataFrame(
        [(at("2024-01-02 10:00"), 0), (at("2024-01-01 10:00"), 1)], "started_at timestamp_ntz, converted int")
    first, second = reports.daily_kpi(sessions, attribution).collect()
    assert (first["orders"], first["revenue"], first["aov"]) == (2, 5.0, 2.5)
    assert (second["day"], second["orders"], second["revenue"], second["aov"]) == (date(2024, 1, 2), None, None, None)


def test_failing_section_does_not_stop_report(spark, tables, folder):
    sections = {"bad": lambda: tables["dim_sessions"].select(F.raise_error(F.lit("x")).alias("y")),
                **reports.report_sections(tables)}
    outcome = {r["section"]: r["error"] for r in reports.write_report(spark, sections, folder).collect()}
    assert outcome.pop("bad") is not None and set(outcome.values()) == {None}
    assert spark.read.parquet(folder + "/lead_velocity").count() == 1


LOG = "filename string, run_timestamp timestamp_ntz, rows_read bigint, rows_quarantined bigint"


def one(df):
    (row,) = df.collect()
    return row["passed"], row["details"]


def test_log_monitors(spark):
    log = spark.createDataFrame([("a", at("2024-01-01 23:00"), 100, 5), ("b", at("2024-01-02 01:00"), 10, 1),
                                 ("c", at("2024-01-03 01:00"), 0, 0)], LOG)
    assert one(monitors.logs_present(log, date(2024, 1, 1))) == (True, "logs_today=1")
    assert one(monitors.logs_present(log, date(2024, 1, 9))) == (False, "logs_today=0")
    assert one(monitors.quarantine_rate(log, date(2024, 1, 1)))[0] is True
    assert one(monitors.quarantine_rate(log, date(2024, 1, 2))) == (
        False, "rows_read=10, rows_quarantined=1, rate=0.1000 (max 0.05)")
    for day in (3, 9):
        assert one(monitors.quarantine_rate(log, date(2024, 1, day))) == (False, "rows_read=0")
    files = spark.createDataFrame([("e_2024-01-01.csv",), ("e_20240102.csv",)] * 2, "source_file string")
    assert one(monitors.quarantine_files(files, date(2024, 1, 1))) == (False, "found=1, first=e_2024-01-01.csv")
    assert one(monitors.quarantine_files(files, date(2024, 1, 3))) == (True, "none")


def events_on(spark, counts):
    rows = [(at(f"{day} 10:00"),) for day, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz")


def test_volume_monitors(spark):
    steady = {f"2024-01-{d:02d}": 10 + d % 2 for d in range(1, 10)}
    assert one(monitors.volume_anomaly(events_on(spark, steady)))[0] is True
    burst = one(monitors.volume_anomaly(events_on(spark, {**steady, "2024-01-12": 60})))
    assert burst[0] is False and burst[1].startswith("day=2024-01-12, z_score=")
    flat = {f"2024-01-{d:02d}": 10 for d in range(1, 5)}
    assert one(monitors.volume_anomaly(events_on(spark, {**flat, "2024-01-06": 99}))) == (
        True, "day=2024-01-06, z_score=NULL (insufficient history)")
    assert one(monitors.freshness(events_on(spark, flat))) == (True, "day=2024-01-04, event_count=10")
    nothing = events_on(spark, flat).limit(0)
    assert one(monitors.freshness(nothing)) == (False, "no data")
    assert one(monitors.volume_anomaly(nothing)) == (False, "no data")


def test_revenue_monitor_counts_both_purchase_events(spark):
    ddl = "event_name string, revenue double"
    rows = [("purchase", None), ("checkout_completed", 1.0), ("page_viewed", None)]
    assert one(monitors.missing_revenue(spark.createDataFrame(rows, ddl))) == (
        False, "pct_missing_revenue=50.0000 (max 1.0)")
    assert one(monitors.missing_revenue(spark.createDataFrame(rows[2:], ddl))) == (
        True, "pct_missing_revenue=NULL (no matching events)")
    raw = spark.createDataFrame([("purchase", '{"item_price":1}'), ("purchase", '{"value":1}'), ("purchase", "{}")],
                                "event_name string, event_data string")
    assert one(monitors.missing_revenue(raw)) == (False, "pct_missing_revenue=33.3333 (max 1.0)")


def test_session_monitors_and_column_names(spark):
    ddl = "session_start_at timestamp_ntz, event_count bigint"
    df = spark.createDataFrame([(at("2024-01-01 10:00"), 9), (at("2024-01-02 10:00"), 1), (at("2024-01-02 11:00"), 2)], ddl)
    assert one(monitors.funnel_health(df)) == (True, "day=2024-01-02, engagement_rate=50.00 (min 10.0)")
    assert one(monitors.funnel_health(df.limit(0))) == (False, "no data")
    assert one(monitors.funnel_health(df.drop("event_count"))) == (False, "dim_sessions missing required columns")


def test_table_choice(spark, tables):
    orders = spark.createDataFrame([("s",), (None,)], "session_id string")
    assert one(monitors.unattributed(*monitors.orders_table({"fct_orders": orders}))) == (
        False, "total_orders=2, orphan_orders=1")
    with pytest.raises(LookupError):
        monitors.events_table({})
    with pytest.raises(LookupError):
        monitors.orders_table({})
    raw = spark.createDataFrame([(at("2024-01-01 10:00"), "purchase", "{}")],
                                "timestamp timestamp_ntz, event_name string, event_data string")
    results = monitors.monitor_results(
        spark, {"raw_events": raw, "fct_attribution": tables["fct_attribution"]}, date(2024, 1, 1))
    summary = monitors.monitor_summary(results)
    got = {r["name"]: (r["passed"], r["details"]) for r in summary.collect()}
    assert got["logs_present"] == (False, "missing table pipeline_logs")
    assert got["funnel_health"] == (False, "missing table dim_sessions")
    assert got["unattributed"][0] is True and len(got) == 8
    with pytest.raises(monitors.MonitorsFailed, match="quarantine_rate"):
        monitors.require_passed(summary)
