"""Business report sections over dim_sessions, fct_attribution and rpt_lead_velocity."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.operators.sessions import funnel
from clickloom.plans.checks import percent
from clickloom.schema import UNATTRIBUTED


def engagement_overview(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("session_id").alias("total_sessions"),
        F.avg("session_duration_minutes").alias("avg_session_duration_min"),
        F.avg("actions_per_session").alias("avg_actions_per_session"),
        percent(F.count_if(F.col("actions_per_session") == 1), F.count("*")).alias("bounce_rate_percent"),
        percent(F.sum("converted"), F.count("*")).alias("conversion_rate_percent"),
    )


def _usage(sessions: DataFrame, *by: str) -> DataFrame:
    return (
        sessions.groupBy(*by)
        .agg(
            F.count("session_id").alias("session_count"),
            (F.avg("converted") * F.lit(100.0)).alias("conversion_rate"),
        )
        .orderBy(F.desc("session_count"), *by)
    )


def device_usage(sessions: DataFrame) -> DataFrame:
    return _usage(sessions, "platform")


def device_browser_usage(sessions: DataFrame) -> DataFrame:
    return _usage(sessions, "platform", "browser")


def attribution_overview(attribution: DataFrame) -> DataFrame:
    retained = F.when(F.col("fc_channel") == F.col("lc_channel"), F.col("revenue")).otherwise(F.lit(0.0))
    return (
        attribution.groupBy(F.coalesce("lc_channel", F.lit(UNATTRIBUTED)).alias("channel"))
        .agg(
            F.sum("revenue").alias("last_click_revenue"),
            F.count_distinct("transaction_id").alias("last_click_conversions"),
            F.sum(retained).alias("retained_revenue"),
        )
        .orderBy(F.desc_nulls_last("last_click_revenue"))
    )


def lead_velocity_summary(velocity: DataFrame) -> DataFrame:
    days = "days_to_convert"
    return velocity.agg(
        F.avg(days).alias("avg_days_to_convert"),
        F.median(days).alias("median_days_to_convert"),
        F.min(days).alias("fastest_conversion"),
        F.max(days).alias("slowest_conversion"),
    )


def daily_kpi(sessions: DataFrame, attribution: DataFrame) -> DataFrame:
    visits = sessions.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count("*").alias("sessions"), F.sum("converted").alias("converted_sessions")
    )
    buys = attribution.groupBy(F.to_date("purchase_time").alias("day")).agg(
        F.count_distinct("transaction_id").alias("orders"), F.sum("revenue").alias("revenue")
    )
    return (
        visits.join(buys, "day", "left")
        .select(
            "day", "sessions", "converted_sessions",
            percent(F.col("converted_sessions"), F.col("sessions")).alias("session_cvr_pct"),
            "orders", "revenue",
            F.try_divide("revenue", "orders").alias("aov"),
        )
        .orderBy("day")
    )


def fc_vs_lc_revenue(attribution: DataFrame) -> DataFrame:
    """Both models in one pass: each purchase counts once per model."""
    models = F.array(
        F.struct(F.lit("Last Click").alias("model"), F.col("lc_channel").alias("channel")),
        F.struct(F.lit("First Click").alias("model"), F.col("fc_channel").alias("channel")),
    )
    return (
        attribution.select("revenue", "transaction_id", F.inline(models))
        .groupBy("model", F.coalesce("channel", F.lit(UNATTRIBUTED)).alias("channel"))
        .agg(F.sum("revenue").alias("revenue"), F.count_distinct("transaction_id").alias("orders"))
        .orderBy("model", F.desc_nulls_last("revenue"))
    )


def new_vs_returning(sessions: DataFrame) -> DataFrame:
    """Sessions on a user's first day are New. Sessions are first reduced to (user, day)."""
    user_days = sessions.groupBy("master_user_id", F.to_date("started_at").alias("day")).agg(
        F.count("*").alias("n"), F.sum("converted").alias("conv"), F.sum("actions_per_session").alias("acts")
    )
    first_day = F.min("day").over(Window.partitionBy("master_user_id"))
    return (
        user_days.withColumn("user_type", F.when(F.col("day") == first_day, "New").otherwise("Returning"))
        .groupBy("user_type")
        .agg(
            F.sum("n").alias("sessions"),
            (F.sum("conv") / F.sum("n") * F.lit(100.0)).alias("session_cvr_pct"),
            (F.sum("acts") / F.sum("n")).alias("avg_actions"),
        )
        .orderBy(F.desc("sessions"))
    )


def report_sections(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Section name -> function that builds it, in report order; nothing is read before it is called."""
    def sessions() -> DataFrame:
        return tables["dim_sessions"]

    def attribution() -> DataFrame:
        return tables["fct_attribution"]

    return {
        "engagement_overview": lambda: engagement_overview(sessions()),
        "device_usage": lambda: device_usage(sessions()),
        "device_browser_usage": lambda: device_browser_usage(sessions()),
        "attribution_overview": lambda: attribution_overview(attribution()),
        "funnel": lambda: funnel(sessions()),
        "lead_velocity": lambda: lead_velocity_summary(tables["rpt_lead_velocity"]),
        "daily_kpi": lambda: daily_kpi(sessions(), attribution()),
        "fc_vs_lc_revenue": lambda: fc_vs_lc_revenue(attribution()),
        "new_vs_returning": lambda: new_vs_returning(sessions()),
    }


def write_report(spark: SparkSession, sections: Mapping[str, Callable[[], DataFrame]], path: str) -> DataFrame:
    """Build and write each section as a table under ``path``; a failing section does not stop the others.

    Returns section, position, error (NULL where it was written).
    """
    outcome = []
    for position, (name, make) in enumerate(sections.items(), start=1):
        try:
            make().write.mode("overwrite").parquet(f"{path}/{name}")
            error = None
        except Exception as failure:  # reported, so that later sections still run
            error = f"{type(failure).__name__}: {failure}"
        outcome.append((name, position, error))
    return spark.createDataFrame(outcome, "section string, position int, error string")
