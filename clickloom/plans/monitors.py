"""Threshold monitors. Each is a one-row DataFrame (name, passed, details)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.plans.checks import percent
from clickloom.schema import CHECKOUT_DONE, PURCHASE


def _result(df: DataFrame, name: str, passed: Column, details: Column) -> DataFrame:
    """One row; a comparison with NULL does not pass."""
    return df.select(
        F.lit(name).alias("name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        details.alias("details"),
    )


def _verdict(spark: SparkSession, name: str, passed: bool, details: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("name"), F.lit(passed).alias("passed"), F.lit(details).alias("details")
    )


def _latest(daily: DataFrame) -> DataFrame:
    """The row of the greatest day; one all-NULL row if there is none."""
    others = [c for c in daily.columns if c != "day"]
    return daily.agg(F.max(F.struct("day", *others)).alias("latest")).select("latest.*")


def _on_day(log: DataFrame, as_of_date: date) -> DataFrame:
    return log.where(F.to_date("run_timestamp") == F.lit(as_of_date))


def logs_present(log: DataFrame, as_of_date: date) -> DataFrame:
    n = F.col("n")
    counted = _on_day(log, as_of_date).agg(F.count("*").alias("n"))
    return _result(counted, "logs_present", n > 0, F.concat(F.lit("logs_today="), n.cast("string")))


def quarantine_rate(log: DataFrame, as_of_date: date, max_rate: float = 0.05) -> DataFrame:
    totals = _on_day(log, as_of_date).agg(
        F.sum("rows_read").alias("seen"), F.sum("rows_quarantined").alias("rejected")
    ).withColumn("rate", F.try_divide(F.col("rejected").cast("double"), F.col("seen")))
    text = F.format_string(
        f"rows_read=%d, rows_quarantined=%d, rate=%.4f (max {max_rate:.2f})",
        "seen", "rejected", "rate",
    )
    details = F.when(F.coalesce("seen", F.lit(0)) == 0, "rows_read=0").otherwise(text)
    return _result(totals, "quarantine_rate", F.col("rate") <= max_rate, details)


def quarantine_files_on(quarantine: DataFrame, as_of_date: date) -> DataFrame:
    """Quarantined source files named after the day, as YYYYMMDD or YYYY-MM-DD."""
    name = F.col("source_file")
    marks = [as_of_date.strftime("%Y%m%d"), as_of_date.strftime("%Y-%m-%d")]
    return quarantine.where(name.contains(marks[0]) | name.contains(marks[1])).select(name).distinct()


def quarantine_files(quarantine: DataFrame, as_of_date: date) -> DataFrame:
    found = quarantine_files_on(quarantine, as_of_date).agg(
        F.count("*").alias("n"), F.min("source_file").alias("first")
    )
    n = F.col("n")
    return _result(
        found, "quarantine_files", n == 0,
        F.when(n == 0, "none").otherwise(F.format_string("found=%d, first=%s", "n", "first")),
    )


def daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("events"))


def freshness(events: DataFrame) -> DataFrame:
    day, n = F.col("day"), F.col("events")
    details = F.when(day.isNull(), "no data").otherwise(
        F.concat(F.lit("day="), day.cast("string"), F.lit(", event_count="), n.cast("string"))
    )
    return _result(_latest(daily_counts(events)), "freshness", n > 0, details)


def volume_zscore(events: DataFrame) -> DataFrame:
    """Each day's count against the up to seven present days before it, in population deviations.

    The ordered window sees one row per day, so its single partition stays small.
    """
    before = Window.orderBy("day").rowsBetween(-7, -1)
    return daily_counts(events).select(
        "day",
        "events",
        F.avg("events").over(before).alias("avg_prev7"),
        F.stddev_pop("events").over(before).alias("sd_prev7"),
    ).withColumn(
        "z_score",
        (F.col("events") - F.col("avg_prev7")) / F.nullif(F.col("sd_prev7"), F.lit(0.0)),
    )


def volume_anomaly(events: DataFrame, max_abs_z: float = 3.0) -> DataFrame:
    day, z = F.col("day"), F.col("z_score")
    shown = F.concat(F.lit("day="), day.cast("string"), F.lit(", z_score="))
    details = (
        F.when(day.isNull(), "no data")
        .when(z.isNull(), F.concat(shown, F.lit("NULL (insufficient history)")))
        .otherwise(F.concat(shown, F.format_string(f"%.3f (max {max_abs_z})", "z_score")))
    )
    latest = _latest(volume_zscore(events).select("day", "z_score"))
    passed = day.isNotNull() & F.coalesce(F.abs("z_score") < max_abs_z, F.lit(True))
    return _result(latest, "volume_anomaly", passed, details)


def missing_revenue(events: DataFrame, max_pct: float = 1.0) -> DataFrame:
    """Share of purchases without revenue.

    Events without a revenue column are judged by text: neither "value" nor "price" occurs.
    """
    if "revenue" in events.columns:
        missing = F.col("revenue").isNull()
    else:
        missing = ~F.col("event_data").contains("value") & ~F.col("event_data").contains("price")
    rated = (
        events.where(F.col("event_name").isin(PURCHASE, CHECKOUT_DONE))
        .agg(percent(F.count_if(missing), F.count("*")).alias("pct"))
    )
    pct = F.col("pct")
    details = F.when(pct.isNull(), "pct_missing_revenue=NULL (no matching events)").otherwise(
        F.format_string(f"pct_missing_revenue=%.4f (max {max_pct})", "pct")
    )
    return _result(rated, "missing_revenue", F.coalesce(pct < max_pct, F.lit(True)), details)


def _first_column(df: DataFrame, *names: str) -> str | None:
    return next((n for n in names if n in df.columns), None)


def funnel_health(sessions: DataFrame, min_engagement_rate: float = 10.0) -> DataFrame:
    """Share of the latest day's sessions with more than one action."""
    started = _first_column(sessions, "session_start_at", "started_at")
    actions = _first_column(sessions, "event_count", "actions_per_session")
    if started is None or actions is None:
        return _verdict(
            sessions.sparkSession, "funnel_health", False, "dim_sessions missing required columns"
        )
    daily = sessions.groupBy(F.to_date(started).alias("day")).agg(
        percent(F.count_if(F.col(actions) > 1), F.count("*")).alias("rate")
    )
    day, rate = F.col("day"), F.col("rate")
    details = F.when(day.isNull(), "no data").otherwise(
        F.concat(
            F.lit("day="), day.cast("string"),
            F.format_string(f", engagement_rate=%.2f (min {min_engagement_rate})", "rate"),
        )
    )
    return _result(_latest(daily), "funnel_health", rate > min_engagement_rate, details)


def unattributed(orders: DataFrame, session_column: str = "lc_session_id") -> DataFrame:
    totals = orders.agg(
        F.count("*").alias("orders"), F.count_if(F.col(session_column).isNull()).alias("orphans")
    )
    details = F.format_string("total_orders=%d, orphan_orders=%d", "orders", "orphans")
    return _result(totals, "unattributed", F.col("orphans") == 0, details)


def events_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    for name in ("stg_events", "raw_events"):
        if name in tables:
            return tables[name]
    raise LookupError("no events table: expected stg_events or raw_events")


def orders_table(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, str]:
    for name, column in (("fct_orders", "session_id"), ("fct_attribution", "lc_session_id")):
        if name in tables:
            return tables[name], column
    raise LookupError("no orders table: expected fct_orders or fct_attribution")


def monitor_results(spark: SparkSession, tables: Mapping[str, DataFrame], as_of_date: date, *,
                    max_quarantine_rate: float = 0.05, max_abs_z: float = 3.0,
                    max_missing_pct: float = 1.0,
                    min_engagement_rate: float = 10.0) -> dict[str, DataFrame]:
    """All monitors in order. A missing log or session table fails its monitors."""
    results: dict[str, DataFrame] = {}
    if "pipeline_logs" in tables:
        log = tables["pipeline_logs"]
        results["logs_present"] = logs_present(log, as_of_date)
        results["quarantine_rate"] = quarantine_rate(log, as_of_date, max_quarantine_rate)
    else:
        for name in ("logs_present", "quarantine_rate"):
            results[name] = _verdict(spark, name, False, "missing table pipeline_logs")
    if "quarantine" in tables:
        results["quarantine_files"] = quarantine_files(tables["quarantine"], as_of_date)
    else:
        results["quarantine_files"] = _verdict(spark, "quarantine_files", True, "none")
    events = events_table(tables)
    results["freshness"] = freshness(events)
    results["volume_anomaly"] = volume_anomaly(events, max_abs_z)
    results["missing_revenue"] = missing_revenue(events, max_missing_pct)
    if "dim_sessions" in tables:
        results["funnel_health"] = funnel_health(tables["dim_sessions"], min_engagement_rate)
    else:
        results["funnel_health"] = _verdict(spark, "funnel_health", False, "missing table dim_sessions")
    results["unattributed"] = unattributed(*orders_table(tables))
    return results


def monitor_summary(results: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results.values())


class MonitorsFailed(RuntimeError):
    """Some monitor did not pass."""


def require_passed(summary: DataFrame) -> None:
    failed = [r["name"] for r in summary.where("NOT passed").select("name").collect()]
    if failed:
        raise MonitorsFailed("failed monitors: " + ", ".join(failed))
