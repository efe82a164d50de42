"""Data checks after the transformation. Each check is a DataFrame; each status one row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.functions.clock import boundary_diff
from clickloom.operators.matching import session_minutes
from clickloom.schema import CHECKOUT_DONE, LOOKBACK_DAYS, SESSION_GAP_MINUTES


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def sessions_overview(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("*").alias("total_sessions"),
        F.count_distinct("client_id").alias("distinct_clients"),
        F.count_distinct("master_user_id").alias("distinct_master_users"),
        F.avg("session_duration_minutes").alias("avg_session_duration_min"),
        F.avg("actions_per_session").alias("avg_actions_per_session"),
        percent(F.count_if(F.col("actions_per_session") == 1), F.count("*")).alias("bounce_rate_percent"),
        (F.avg("converted") * F.lit(100.0)).alias("session_conversion_rate_percent"),
    )


def within_gap(minutes: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions holding a pause of at least the gap. ``minutes`` is from ``session_minutes``."""
    timeline = Window.partitionBy("session_id", "client_id").orderBy("minute_no")
    pause = F.col("minute_no") - F.lag("minute_no").over(timeline)
    return (
        minutes.withColumn("pause", pause)
        .groupBy("session_id", "client_id")
        .agg(F.max("pause").alias("max_gap_minutes"))
        .where(F.col("max_gap_minutes") >= gap_minutes)
        .orderBy(F.desc("max_gap_minutes"))
    )


def between_gap(sessions: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Neighbouring sessions of one device that are closer than the gap."""
    timeline = Window.partitionBy("client_id").orderBy("started_at")
    return (
        sessions.select(
            "client_id", "session_id", "started_at",
            F.lag("ended_at").over(timeline).alias("prev_session_end"),
        )
        .select(
            "client_id", "session_id",
            boundary_diff("minute", F.col("prev_session_end"), F.col("started_at")).alias("gap_minutes"),
        )
        .where(F.col("gap_minutes") < gap_minutes)
        .orderBy("gap_minutes")
    )


def event_coverage(stg: DataFrame, minutes: DataFrame) -> DataFrame:
    """Events, events inside some session, and the rest."""
    none = F.lit(0).cast("bigint")
    total = stg.agg(F.count("*").alias("total_events")).withColumn("assigned", none)
    assigned = minutes.agg(F.coalesce(F.sum("events"), none).alias("assigned")).withColumn(
        "total_events", none
    )
    return total.unionByName(assigned).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("assigned").alias("events_assigned_to_sessions"),
        (F.sum("total_events") - F.sum("assigned")).alias("unassigned_events"),
    )


def actions_mismatch(sessions: DataFrame, minutes: DataFrame) -> DataFrame:
    """Sessions whose stored action count is not the recount by time."""
    actual = minutes.groupBy("session_id").agg(F.sum("events").alias("actual_events"))
    diff = F.col("actions_per_session") - F.col("actual_events")
    return (
        sessions.select("session_id", "actions_per_session")
        .join(actual, "session_id")
        .withColumn("diff", diff)
        .where("diff <> 0")
        .orderBy(F.abs("diff").desc())
    )


def attribution_coverage(attribution: DataFrame) -> DataFrame:
    return attribution.agg(
        F.count("*").alias("total_purchases"),
        F.count("lc_session_id").alias("last_click_attributed"),
        F.count("fc_session_id").alias("first_click_attributed"),
        percent(F.count_if(F.col("lc_session_id").isNull()), F.count("*")).alias("pct_unattributed_lc"),
    )


def lookback(attribution: DataFrame, sessions: DataFrame,
             lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Purchases whose last-click session began more than the lookback before.

    One session may be credited with a large share of all purchases, so it is met once per
    purchase day; purchases are joined only with the days found late, of which sound tables
    have none.
    """
    bought = attribution.select(
        "transaction_id", "purchase_time", "lc_session_id", F.to_date("purchase_time").alias("day")
    )
    started = sessions.select(
        F.col("session_id").alias("lc_session_id"), F.col("started_at").alias("lc_started_at")
    )
    days = boundary_diff("day", F.col("lc_started_at"), F.col("day").cast("timestamp_ntz"))
    late = (
        bought.select("lc_session_id", "day").distinct()
        .join(started, "lc_session_id")
        .withColumn("days_before_purchase", days)
        .where(F.col("days_before_purchase") > lookback_days)
    )
    return (
        bought.join(late, ["lc_session_id", "day"])
        .select("transaction_id", "purchase_time", "lc_session_id", "lc_started_at", "days_before_purchase")
        .orderBy(F.desc("days_before_purchase"))
    )


def fc_lc_difference(attribution: DataFrame) -> DataFrame:
    same = F.col("fc_session_id") == F.col("lc_session_id")
    return attribution.where("fc_session_id IS NOT NULL AND lc_session_id IS NOT NULL").agg(
        F.count("*").alias("total_attributed"),
        F.count_if(same).alias("same_session_fc_lc"),
        F.count_if(~same).alias("different_session_fc_lc"),
        percent(F.count_if(~same), F.count("*")).alias("pct_different"),
    )


def duplicate_purchases(stg: DataFrame) -> DataFrame:
    return (
        stg.where((F.col("event_name") == CHECKOUT_DONE) & F.col("transaction_id").isNotNull())
        .groupBy("transaction_id", "client_id")
        .agg(
            F.count("*").alias("raw_checkout_completed_events"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
        .where("raw_checkout_completed_events > 1")
        .orderBy(F.desc("raw_checkout_completed_events"))
    )


def revenue_discrepancy(items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Transactions whose declared revenue is not the sum of their line items."""
    return (
        items.groupBy("transaction_id")
        .agg(
            F.max("declared_order_revenue").alias("declared_total"),
            F.sum("line_total").alias("calculated_total"),
        )
        .withColumn("discrepancy", F.col("declared_total") - F.col("calculated_total"))
        .where(F.abs("discrepancy") > tolerance)
        .orderBy(F.desc_nulls_last("discrepancy"))
    )


def _status(df: DataFrame, name: str, passed: Column, details: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        details.alias("details"),
    )


def _counted(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def summary_status(name: str, df: DataFrame) -> DataFrame:
    n = F.col("n")
    return _status(_counted(df), name, F.lit(True), F.when(n > 0, "1 row").otherwise("ok"))


def zero_rows_status(name: str, df: DataFrame) -> DataFrame:
    n = F.col("n")
    return _status(_counted(df), name, n == 0, F.concat(F.lit("rowcount="), n.cast("string")))


def diagnostic_status(name: str, df: DataFrame) -> DataFrame:
    n = F.col("n").cast("string")
    return _status(_counted(df), name, F.lit(True), F.concat(F.lit("duplicate_pairs="), n))


def coverage_status(name: str, df: DataFrame) -> DataFrame:
    n = F.col("unassigned_events")
    return _status(df, name, n == 0, F.concat(F.lit("unassigned_events="), n.cast("string")))


# How a check is judged, and what builds its result.
Check = tuple[Callable[[str, DataFrame], DataFrame], Callable[[], DataFrame]]

# A check that errors is reported as failed; these never make the run fail.
DIAGNOSTIC = ("duplicate_purchases",)


def check_results(tables: Mapping[str, DataFrame], gap_minutes: int = SESSION_GAP_MINUTES,
                  lookback_days: int = LOOKBACK_DAYS) -> dict[str, Check]:
    """name -> (status function, function that builds the result), in reporting order.

    ``tables`` holds stg_events, dim_sessions, fct_attribution and fct_order_items, and
    session_minutes where it was written beforehand, as three checks read it. Nothing is read or
    resolved before a check's function is called.
    """
    def stg() -> DataFrame:
        return tables["stg_events"]

    def sessions() -> DataFrame:
        return tables["dim_sessions"]

    def attribution() -> DataFrame:
        return tables["fct_attribution"]

    def minutes() -> DataFrame:
        return tables["session_minutes"] if "session_minutes" in tables else session_minutes(stg(), sessions())

    return {
        "sessions_overview": (summary_status, lambda: sessions_overview(sessions())),
        "within_session_gap": (zero_rows_status, lambda: within_gap(minutes(), gap_minutes)),
        "between_session_gap": (zero_rows_status, lambda: between_gap(sessions(), gap_minutes)),
        "event_coverage": (coverage_status, lambda: event_coverage(stg(), minutes())),
        "actions_mismatch": (zero_rows_status, lambda: actions_mismatch(sessions(), minutes())),
        "attribution_coverage": (summary_status, lambda: attribution_coverage(attribution())),
        "lookback": (zero_rows_status, lambda: lookback(attribution(), sessions(), lookback_days)),
        "fc_lc_difference": (summary_status, lambda: fc_lc_difference(attribution())),
        "duplicate_purchases": (diagnostic_status, lambda: duplicate_purchases(stg())),
        "revenue_discrepancy": (zero_rows_status, lambda: revenue_discrepancy(tables["fct_order_items"])),
    }


def check_summary(results: Mapping[str, Check]) -> DataFrame:
    """check_name, status, details: one row per check."""
    rows = [status(name, make()) for name, (status, make) in results.items()]
    return reduce(DataFrame.unionByName, rows)


class ChecksFailed(RuntimeError):
    """A must-pass check failed; ``summary`` holds the status rows."""

    def __init__(self, summary: DataFrame, names: list[str]):
        super().__init__("failed checks: " + ", ".join(names))
        self.summary = summary


def run_checks(spark: SparkSession, results: Mapping[str, Check]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run every check even if some error. Returns the summary and up to 10 rows per failing check.

    A failing sample keeps its check's columns and types, whatever its values.
    """
    rows, samples = [], {}
    for name, (status, make) in results.items():
        try:
            df = make()
            row = tuple(status(name, df).first())
            if row[1] == "FAIL":
                samples[name] = spark.createDataFrame(df.take(10), df.schema)
        except Exception as error:  # a broken check must not hide the others
            row = (name, "FAIL", f"error={type(error).__name__}")
        rows.append(row)
    return spark.createDataFrame(rows, "check_name string, status string, details string"), samples


def require_passed(summary: DataFrame) -> None:
    failed = summary.where((F.col("status") == "FAIL") & ~F.col("check_name").isin(*DIAGNOSTIC))
    names = [r["check_name"] for r in failed.select("check_name").collect()]
    if names:
        raise ChecksFailed(summary, names)
