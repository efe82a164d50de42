"""Registered queries over the driver tables: name -> callable(spark, sf_dir) -> DataFrame.

All start from ``events``, turned into raw clickstream by ``sources.recipe``. Ratios and sums of
doubles are rounded here, as their last digits depend on summation order. Reports use a
240-minute session gap beside the usual 30 where the table would otherwise hold hardly any
session of several events.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from clickloom.functions import clock, keys, text, web
from clickloom.operators import (
    attribution, identity, leads, matching, orders, sessions as session_ops, stage, validate,
)
from clickloom.plans import checks, ingest, monitors, reports
from clickloom.session import scratch_path
from clickloom.sources import csv_files
from clickloom.sources.layers import Layers
from clickloom.sources.tables import TableFolder

Query = Callable[[SparkSession, str], DataFrame]

GAP, WIDE_GAP = 30, 240
RUN_TIMESTAMP = datetime(2024, 1, 30, 23, 59, 59)
AS_OF = date(2024, 1, 30)

_QUERIES: dict[str, Query] = {}


def _query(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    _QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


# --- ingest ---------------------------------------------------------------------------------


@_query
def ingest_null_tokens(layers: Layers) -> DataFrame:
    raw = layers.raw().selectExpr(
        "event_id",
        """CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN 'NULL' WHEN 2 THEN 'None'
           WHEN 3 THEN '' WHEN 4 THEN 'nUll' WHEN 5 THEN ' ' ELSE user_agent END AS cell""",
    )
    return raw.select("event_id", text.null_token_to_null(F.col("cell")).alias("cell"))


@_query
def ingest_alias_coalesce(layers: Layers) -> DataFrame:
    raw = layers.raw().selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 = 0 THEN '  ' WHEN event_id % 4 <> 0 THEN client_id END AS clientId",
        "concat('alt', CAST(event_id AS STRING)) AS client_id",
        "source_file",
    )
    shape = csv_files.HeaderShape(("clientId", "client_id"))
    return csv_files.normalize_columns(
        raw.select("event_id", "source_file", F.col("clientId").alias("_c0"), F.col("client_id").alias("_c1")),
        shape, ["_c0", "_c1"], "event_id",
    ).select("event_id", "client_id")


@_query
def ingest_derive_timestamp(layers: Layers) -> DataFrame:
    stamp = F.col("timestamp")
    raw = layers.raw().select(
        "event_id", "source_file",
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.substring(stamp, 1, 10)).alias("_c0"),
        F.when(F.col("event_id") % 7 == 0, None).otherwise(F.substring(stamp, 12, 8)).alias("_c1"),
    )
    shape = csv_files.HeaderShape(("Date", "TIME"))
    return csv_files.normalize_columns(raw, shape, ["_c0", "_c1"], "event_id").select(
        "event_id", "timestamp"
    )


@_query
def ingest_valid(layers: Layers) -> DataFrame:
    return validate.valid_events(layers.annotated(), "event_id")


@_query
def ingest_quarantine(layers: Layers) -> DataFrame:
    return validate.quarantined(layers.annotated(), "event_id", "source_file")


@_query
def ingest_log(layers: Layers) -> DataFrame:
    return validate.file_log(layers.annotated(), RUN_TIMESTAMP).drop("run_id")


@_query
def validation_summary(layers: Layers) -> DataFrame:
    return validate.validation_summary(layers.annotated())


@_query
def validation_top_errors(layers: Layers) -> DataFrame:
    return validate.top_errors(layers.annotated())


def _csv_annotated(layers: Layers) -> DataFrame:
    return validate.annotate(csv_files.read_events(layers.spark, layers.csv_files()))


@_query
def csv_ingest_valid(layers: Layers) -> DataFrame:
    """Accepted rows of CSV files with three header shapes."""
    return validate.valid_events(_csv_annotated(layers))


@_query
def csv_ingest_quarantine(layers: Layers) -> DataFrame:
    return validate.quarantined(_csv_annotated(layers))


@_query
def header_report(layers: Layers) -> DataFrame:
    """Header drift by shape, with the rows of that shape."""
    files = layers.csv_files()
    rows = csv_files.read_events(layers.spark, files).groupBy("source_file").agg(F.count("*").alias("n_rows"))
    report = csv_files.header_report(layers.spark, files).join(rows, "source_file")
    shape = [
        F.array_join(c, "|").alias(c)
        for c in ("headers", "normalized_headers", "extra_columns", "missing_core")
    ]
    return report.groupBy(*shape).agg(F.sum("n_rows").alias("n_rows"))


def _ingested(layers: Layers) -> TableFolder:
    """The CSV files ingested twice: the second run replaces the rows of the first and logs again."""
    pattern = layers.csv_pattern()

    def fill(base: str) -> None:
        for _ in range(2):
            ingest.ingest(layers.spark, pattern, base, run_timestamp=RUN_TIMESTAMP)

    return layers.tables("ingested", fill)


@_query
def ingest_landed_events(layers: Layers) -> DataFrame:
    return ingest.raw_events(_ingested(layers)).drop("source_file")


@_query
def ingest_landed_quarantine(layers: Layers) -> DataFrame:
    return ingest.quarantine(_ingested(layers)).drop("source_file")


@_query
def ingest_landed_log(layers: Layers) -> DataFrame:
    """Totals of each of the two runs."""
    return _ingested(layers)[ingest.LOGS].groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_inserted", "rows_quarantined")]
    ).drop("run_id")


@_query
def ingest_absent_columns(layers: Layers) -> DataFrame:
    """No row has user_agent, some files lack page_url, timestamps are NULL or blank at times."""
    lacking = layers.raw().drop("user_agent").withColumns({
        "timestamp": F.expr("CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE timestamp END"),
        validate.ABSENT: F.expr("CASE WHEN event_id % 11 = 0 THEN array('page_url') ELSE array() END"),
    })
    return validate.quarantined(validate.annotate(lacking), "event_id").select("event_id", "error_reason")


# Suffixes that spell one moment in several ways: (format of the stamp, what follows, hours to subtract).
STAMPS = (
    ("yyyy-MM-dd'T'HH:mm", "+02:00", 2), ("yyyy-MM-dd'T'HH", "+02", 2), ("yyyyMMdd'T'HHmmss", "Z", 0),
    ("yyyyMMdd'T'HHmmss", "+0200", 2), ("yyyy-MM-dd'T'HH:mm:ss", ",000z", 0), ("yyyy-MM-dd HH:mm:ss", " GMT-3", -3),
    ("yyyy-MM-dd HH:mm:ss", " EST", -5), ("yyyy-MM-dd HH:mm", "", 0), ("yyyy-MM-dd HH:mm:ss", " Nowhere/There", None),
    ("HH:mm", "", None),
)


@_query
def parse_timestamps(layers: Layers) -> DataFrame:
    spelled = F
    for number, (pattern, end, _) in enumerate(STAMPS):
        spelled = spelled.when(F.col("event_id") % len(STAMPS) == number, F.concat(F.date_format("timestamp", pattern), F.lit(end)))
    return layers.valid().select("event_id", clock.parse_timestamp(spelled).alias("parsed"))


@_query
def typed_epochs(layers: Layers) -> DataFrame:
    """Numbers of seconds or of milliseconds as the timestamp column."""
    millis = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("timestamp"))
    number = F.when(F.col("event_id") % 2 == 0, F.floor(millis / 1000)).otherwise(millis).cast("double")
    return layers.valid().select("event_id", clock.as_timestamp_ntz(number, DoubleType()).alias("parsed"))


@_query
def order_quantity_text(layers: Layers) -> DataFrame:
    text = F.concat((F.col("event_id") % 10).cast("string"), F.lit("."), (F.col("event_id") % 4 * 25).cast("string"))
    return layers.valid().select("event_id", orders.whole_number(text).alias("quantity"))


# --- staging --------------------------------------------------------------------------------


@_query
def stg_events(layers: Layers) -> DataFrame:
    return stage.stage_events(layers.valid(), "event_id")


@_query
def channel_group(layers: Layers) -> DataFrame:
    return layers.valid().select(
        "event_id", web.channel_group(F.col("page_url"), F.col("referrer")).alias("channel_group")
    )


@_query
def device_platform(layers: Layers) -> DataFrame:
    return layers.valid().select("event_id", web.platform(F.col("user_agent")).alias("platform"))


@_query
def device_os(layers: Layers) -> DataFrame:
    return layers.valid().select("event_id", web.operating_system(F.col("user_agent")).alias("os"))


@_query
def device_browser(layers: Layers) -> DataFrame:
    return layers.valid().select("event_id", web.browser(F.col("user_agent")).alias("browser"))


@_query
def utm_params(layers: Layers) -> DataFrame:
    return layers.valid().select(
        "event_id",
        *[web.utm_param(F.col("page_url"), p).alias(f"utm_{p}") for p in ("source", "medium", "campaign")],
    )


@_query
def date_diff_boundaries(layers: Layers) -> DataFrame:
    start = F.lit("2024-01-15 12:34:56.789").cast("timestamp_ntz")
    return layers.valid().select(
        "event_id",
        *[
            clock.boundary_diff(unit, start, F.col("timestamp")).alias(f"{unit}s")
            for unit in ("second", "minute", "day")
        ],
    )


@_query
def purchase_key(layers: Layers) -> DataFrame:
    return layers.valid().select(
        "event_id", keys.purchase_key(F.col("client_id"), F.col("timestamp")).alias("purchase_pk")
    )


# --- identity and sessions ------------------------------------------------------------------


@_query
def email_signals(layers: Layers) -> DataFrame:
    return identity.email_signals(layers.stg())


@_query
def dim_user_map(layers: Layers) -> DataFrame:
    return identity.stitch_identity(layers.stg())


@_query
def identity_join(layers: Layers) -> DataFrame:
    events = layers.stg().select("event_id", "client_id", "timestamp", "event_name")
    return identity.identity_join(events, layers.user_map())


@_query
def session_minutes(layers: Layers) -> DataFrame:
    return session_ops.activity_minutes(layers.stg(), WIDE_GAP).select(
        "client_id", "first_ts", "last_ts", "events", "prev_ts",
        F.col("is_new").cast("bigint").alias("is_new"), "session_rank",
    )


@_query
def sessionize_events(layers: Layers) -> DataFrame:
    events = layers.stg().select("event_id", "client_id", "timestamp", "event_name")
    return session_ops.sessionize(events, layers.user_map(), WIDE_GAP)


@_query
def dim_sessions(layers: Layers) -> DataFrame:
    sessions = session_ops.session_rollup(layers.stg(), layers.user_map(), GAP)
    return _rounded(sessions, {"session_duration_minutes": 6})


@_query
def dim_sessions_gap240(layers: Layers) -> DataFrame:
    sessions = session_ops.session_rollup(layers.stg(), layers.user_map(), WIDE_GAP)
    return _rounded(sessions, {"session_duration_minutes": 6})


@_query
def session_first_touch(layers: Layers) -> DataFrame:
    return session_ops.first_touch(layers.sessions(WIDE_GAP))


@_query
def session_key(layers: Layers) -> DataFrame:
    return layers.sessions(WIDE_GAP).select("client_id", "started_at", "session_id")


@_query
def event_session_match(layers: Layers) -> DataFrame:
    return matching.event_session_match(layers.stg(), layers.sessions(WIDE_GAP))


@_query
def rpt_funnel_metrics(layers: Layers) -> DataFrame:
    return session_ops.funnel(layers.sessions(GAP))


# --- attribution, orders, leads ---------------------------------------------------------------


@_query
def purchases(layers: Layers) -> DataFrame:
    return attribution.purchases(layers.stg(), layers.user_map())


@_query
def attribution_candidates(layers: Layers) -> DataFrame:
    return attribution.attribution_candidates(layers.purchases(), layers.sessions(GAP))


@_query
def attribution_ranks(layers: Layers) -> DataFrame:
    return attribution.attribution_ranks(layers.purchases(), layers.sessions(GAP))


@_query
def fct_attribution(layers: Layers) -> DataFrame:
    return attribution.attribute(layers.purchases(), layers.sessions(GAP))


@_query
def fct_attribution_gap240(layers: Layers) -> DataFrame:
    return attribution.attribute(layers.purchases(), layers.sessions(WIDE_GAP))


@_query
def dedupe_first_purchase(layers: Layers) -> DataFrame:
    """Grouped by item instead of transaction, so that groups of several purchases occur."""
    stg = layers.stg().withColumn("transaction_id", F.get_json_object("items_json", "$[0].item_id"))
    return orders.first_purchases(stg)


@_query
def explode_items(layers: Layers) -> DataFrame:
    return orders.explode_items(layers.stg().select("event_id", "items_json"))


@_query
def fct_order_items(layers: Layers) -> DataFrame:
    return _rounded(orders.order_items(layers.stg()), {"line_total": 2})


@_query
def rpt_lead_velocity(layers: Layers) -> DataFrame:
    return leads.lead_velocity(layers.stg(), layers.user_map())


# --- tables and views -------------------------------------------------------------------------


@_query
def table_replaced(layers: Layers) -> DataFrame:
    """A table written over one of other columns and rows."""
    def fill(base: str) -> None:
        tables = TableFolder(layers.spark, base)
        tables.put("named_events", layers.stg().select(F.col("client_id").alias("old"), "event_id"))
        tables.put("named_events", layers.stg().where("event_name <> 'page_viewed'").select("event_id", "event_name"))

    return layers.tables("replaced", fill)["named_events"]


@_query
def view_replaced(layers: Layers) -> DataFrame:
    """A view defined over an earlier one of its name."""
    tables = layers.tables("views", lambda base: None)
    for sessions in (layers.sessions(WIDE_GAP), layers.sessions(GAP)):
        tables.view("rpt_replaced_view", session_ops.funnel(sessions))
    return layers.spark.table("rpt_replaced_view")


# --- report -----------------------------------------------------------------------------------


@_query
def engagement_overview(layers: Layers) -> DataFrame:
    return _rounded(
        reports.engagement_overview(layers.sessions(GAP)),
        {c: 6 for c in ("avg_session_duration_min", "avg_actions_per_session", "bounce_rate_percent",
                        "conversion_rate_percent")},
    )


@_query
def device_usage(layers: Layers) -> DataFrame:
    return _rounded(reports.device_usage(layers.sessions(GAP)), {"conversion_rate": 6})


@_query
def device_browser_usage(layers: Layers) -> DataFrame:
    return _rounded(reports.device_browser_usage(layers.sessions(GAP)), {"conversion_rate": 6})


@_query
def attribution_overview(layers: Layers) -> DataFrame:
    return _rounded(
        reports.attribution_overview(layers.attribution(GAP)),
        {"last_click_revenue": 2, "retained_revenue": 2},
    )


@_query
def lead_velocity_summary(layers: Layers) -> DataFrame:
    velocity = leads.lead_velocity(layers.stg(), layers.user_map())
    return _rounded(
        reports.lead_velocity_summary(velocity),
        {"avg_days_to_convert": 6, "median_days_to_convert": 6},
    )


@_query
def daily_kpi(layers: Layers) -> DataFrame:
    return _rounded(
        reports.daily_kpi(layers.sessions(GAP), layers.attribution(GAP)),
        {"session_cvr_pct": 6, "revenue": 2, "aov": 4},
    )


@_query
def fc_vs_lc_revenue(layers: Layers) -> DataFrame:
    return _rounded(reports.fc_vs_lc_revenue(layers.attribution(GAP)), {"revenue": 2})


@_query
def new_vs_returning(layers: Layers) -> DataFrame:
    return _rounded(
        reports.new_vs_returning(layers.sessions(WIDE_GAP)), {"session_cvr_pct": 6, "avg_actions": 6}
    )


@_query
def report_outcome(layers: Layers) -> DataFrame:
    """The report without the table that one section reads: rows of each section, NULL where it failed."""
    tables = {"dim_sessions": layers.sessions(WIDE_GAP), "fct_attribution": layers.attribution(GAP)}
    sections = reports.report_sections(tables)
    path = scratch_path(layers.spark, "report")
    outcome = reports.write_report(layers.spark, sections, path)
    written = [r["section"] for r in outcome.where("error IS NULL").collect()]
    counts = [layers.spark.read.parquet(f"{path}/{name}").agg(F.lit(name).alias("section"), F.count("*").alias("n_rows")) for name in written]
    return outcome.join(reduce(DataFrame.unionByName, counts), "section", "left").select(
        "section", "position", F.col("error").isNotNull().alias("failed"), "n_rows")


# --- checks -----------------------------------------------------------------------------------
# Sessions cut at 240 minutes break the 30-minute rules and sessions cut at 30 break the
# 240-minute rules, so the checks that must find nothing also have something to find.


@_query
def check_sessions_overview(layers: Layers) -> DataFrame:
    return _rounded(
        checks.sessions_overview(layers.sessions(WIDE_GAP)),
        {c: 6 for c in ("avg_session_duration_min", "avg_actions_per_session", "bounce_rate_percent",
                        "session_conversion_rate_percent")},
    )


@_query
def check_within_gap(layers: Layers) -> DataFrame:
    return checks.within_gap(layers.session_minutes(GAP), GAP)


@_query
def check_within_gap_faulty(layers: Layers) -> DataFrame:
    return checks.within_gap(layers.session_minutes(WIDE_GAP), GAP)


@_query
def check_between_gap(layers: Layers) -> DataFrame:
    return checks.between_gap(layers.sessions(GAP), GAP)


@_query
def check_between_gap_faulty(layers: Layers) -> DataFrame:
    return checks.between_gap(layers.sessions(GAP), WIDE_GAP)


@_query
def check_event_coverage(layers: Layers) -> DataFrame:
    return checks.event_coverage(layers.stg(), layers.session_minutes(WIDE_GAP))


def _truncated(layers: Layers) -> DataFrame:
    """Faulty sessions: all end where they started."""
    return layers.sessions(WIDE_GAP).withColumn("ended_at", F.col("started_at"))


@_query
def check_event_coverage_faulty(layers: Layers) -> DataFrame:
    return checks.event_coverage(
        layers.stg(), matching.session_minutes(layers.stg(), _truncated(layers))
    )


@_query
def check_actions_mismatch(layers: Layers) -> DataFrame:
    return checks.actions_mismatch(layers.sessions(WIDE_GAP), layers.session_minutes(WIDE_GAP))


@_query
def check_actions_mismatch_faulty(layers: Layers) -> DataFrame:
    sessions = _truncated(layers)
    return checks.actions_mismatch(sessions, matching.session_minutes(layers.stg(), sessions))


@_query
def check_attribution_coverage(layers: Layers) -> DataFrame:
    return _rounded(checks.attribution_coverage(layers.attribution(GAP)), {"pct_unattributed_lc": 6})


@_query
def check_lookback(layers: Layers) -> DataFrame:
    return checks.lookback(layers.attribution(GAP), layers.sessions(GAP))


@_query
def check_lookback_faulty(layers: Layers) -> DataFrame:
    """Sessions moved a week back: most last clicks then lie out of the window."""
    moved = layers.sessions(WIDE_GAP).withColumn("started_at", F.col("started_at") - F.expr("INTERVAL 7 DAYS"))
    return checks.lookback(layers.attribution(WIDE_GAP), moved)


@_query
def check_fc_lc_difference(layers: Layers) -> DataFrame:
    return _rounded(checks.fc_lc_difference(layers.attribution(GAP)), {"pct_different": 6})


@_query
def check_duplicate_purchases(layers: Layers) -> DataFrame:
    return checks.duplicate_purchases(layers.stg())


@_query
def check_duplicate_purchases_by_item(layers: Layers) -> DataFrame:
    """Grouped by item instead of transaction, so that there are duplicates to find."""
    stg = layers.stg().withColumn("transaction_id", F.get_json_object("items_json", "$[0].item_id"))
    return checks.duplicate_purchases(stg)


@_query
def check_revenue_discrepancy(layers: Layers) -> DataFrame:
    return _rounded(
        checks.revenue_discrepancy(layers.order_items()),
        {"declared_total": 2, "calculated_total": 2, "discrepancy": 2},
    )


@_query
def check_summary(layers: Layers) -> DataFrame:
    tables = {
        "stg_events": layers.stg(),
        "dim_sessions": layers.sessions(GAP),
        "fct_attribution": layers.attribution(GAP),
        "fct_order_items": layers.order_items(),
        "session_minutes": layers.session_minutes(GAP),
    }
    return checks.check_summary(checks.check_results(tables, GAP))


@_query
def check_samples(layers: Layers) -> DataFrame:
    """Checks that find faults, one that finds none and one that errors, with the rows sampled of each."""
    results = {
        "within_gap": (checks.zero_rows_status, lambda: checks.within_gap(layers.session_minutes(WIDE_GAP), GAP)),
        "between_gap": (checks.zero_rows_status, lambda: checks.between_gap(layers.sessions(GAP), WIDE_GAP)),
        "sound": (checks.zero_rows_status, lambda: checks.between_gap(layers.sessions(GAP), GAP)),
        "broken": (checks.zero_rows_status, lambda: layers.stg().select("no_such_column")),
    }
    summary, samples = checks.run_checks(layers.spark, results)
    sampled = F
    for name, rows in samples.items():
        sampled = sampled.when(F.col("check_name") == name, rows.count())
    return summary.select("check_name", "status", (sampled.otherwise(0) if samples else F.lit(0)).alias("sampled"))


# --- monitors -----------------------------------------------------------------------------------


@_query
def mon_logs_present(layers: Layers) -> DataFrame:
    return monitors.logs_present(layers.log(RUN_TIMESTAMP), AS_OF)


@_query
def mon_quarantine_rate(layers: Layers) -> DataFrame:
    return monitors.quarantine_rate(layers.log(RUN_TIMESTAMP), AS_OF)


def _quarantine(layers: Layers) -> DataFrame:
    """Source files with rejected rows, by the log."""
    return layers.log(RUN_TIMESTAMP).where("rows_quarantined > 0").select(
        F.col("filename").alias("source_file")
    )


@_query
def mon_quarantine_files(layers: Layers) -> DataFrame:
    return monitors.quarantine_files(_quarantine(layers), AS_OF)


@_query
def mon_freshness(layers: Layers) -> DataFrame:
    return monitors.freshness(layers.stg())


@_query
def volume_zscore(layers: Layers) -> DataFrame:
    return _rounded(
        monitors.volume_zscore(layers.stg()), {"avg_prev7": 6, "sd_prev7": 6, "z_score": 6}
    )


@_query
def mon_volume_anomaly(layers: Layers) -> DataFrame:
    return monitors.volume_anomaly(layers.stg())


@_query
def mon_missing_revenue(layers: Layers) -> DataFrame:
    return monitors.missing_revenue(layers.stg())


@_query
def mon_missing_revenue_raw(layers: Layers) -> DataFrame:
    return monitors.missing_revenue(layers.valid())


@_query
def mon_funnel_health(layers: Layers) -> DataFrame:
    return monitors.funnel_health(layers.sessions(WIDE_GAP))


@_query
def mon_unattributed(layers: Layers) -> DataFrame:
    return monitors.unattributed(layers.attribution(GAP))


@_query
def mon_summary(layers: Layers) -> DataFrame:
    tables = {
        "pipeline_logs": layers.log(RUN_TIMESTAMP),
        "quarantine": _quarantine(layers),
        "stg_events": layers.stg(),
        "dim_sessions": layers.sessions(GAP),
        "fct_attribution": layers.attribution(GAP),
    }
    return monitors.monitor_summary(monitors.monitor_results(layers.spark, tables, AS_OF))


@_query
def mon_fallbacks(layers: Layers) -> DataFrame:
    """Raw events instead of staged ones, orders under another name, other column names, no log and no quarantine."""
    sessions = layers.sessions(WIDE_GAP).withColumnsRenamed(
        {"started_at": "session_start_at", "actions_per_session": "event_count"})
    tables = {
        "raw_events": layers.valid(),
        "dim_sessions": sessions,
        "fct_orders": layers.attribution(GAP).select(F.col("lc_session_id").alias("session_id")),
    }
    return monitors.monitor_summary(monitors.monitor_results(layers.spark, tables, AS_OF))
