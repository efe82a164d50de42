"""The transformation run: every derived table and view from raw events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.attribution import attribute, purchases
from clickloom.operators.identity import stitch_identity
from clickloom.operators.leads import lead_velocity
from clickloom.operators.matching import session_minutes
from clickloom.operators.orders import order_items
from clickloom.operators.sessions import funnel, session_rollup
from clickloom.operators.stage import stage_events
from clickloom.plans import checks, monitors, reports
from clickloom.plans.ingest import LOGS, quarantine, raw_events
from clickloom.schema import LOOKBACK_DAYS, SESSION_GAP_MINUTES
from clickloom.sources.tables import TableFolder


def build_tables(tables: TableFolder, raw: DataFrame, *, gap_minutes: int = SESSION_GAP_MINUTES,
                 lookback_days: int = LOOKBACK_DAYS, on_bad_number: str = "error") -> dict[str, DataFrame]:
    """Write the tables in dependency order, each read back by the next, and define the views."""
    made: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        made[name] = tables.put(name, df)
        return made[name]

    stg = put("stg_events", stage_events(raw, on_bad_number=on_bad_number))
    user_map = put("dim_user_map", stitch_identity(stg))
    sessions = put("dim_sessions", session_rollup(stg, user_map, gap_minutes))
    buys = put("purchases", purchases(stg, user_map))
    put("fct_attribution", attribute(buys, sessions, lookback_days))
    put("fct_order_items", order_items(stg, on_bad_number))
    made["rpt_lead_velocity"] = tables.view("rpt_lead_velocity", lead_velocity(stg, user_map))
    made["rpt_funnel_metrics"] = tables.view("rpt_funnel_metrics", funnel(sessions))
    return made


def run(spark: SparkSession, base: str, as_of_date: date, *,
        gap_minutes: int = SESSION_GAP_MINUTES, lookback_days: int = LOOKBACK_DAYS,
        on_bad_number: str = "error") -> dict[str, DataFrame]:
    """Tables, checks, report and monitors over what ``ingest`` landed under ``base``.

    Failing checks or monitors do not stop later steps; read ``check_summary`` and
    ``monitor_summary``, or pass them to ``checks.require_passed`` / ``monitors.require_passed``.
    """
    tables = TableFolder(spark, base)
    made = build_tables(
        tables, raw_events(tables), gap_minutes=gap_minutes, lookback_days=lookback_days,
        on_bad_number=on_bad_number,
    )
    made["session_minutes"] = tables.put(
        "session_minutes", session_minutes(made["stg_events"], made["dim_sessions"])
    )
    summary, samples = checks.run_checks(
        spark, checks.check_results(made, gap_minutes, lookback_days)
    )
    made["check_summary"] = tables.put("check_summary", summary)
    made |= {f"failing_{name}": rows for name, rows in samples.items()}
    made["report_outcome"] = reports.write_report(
        spark, reports.report_sections(made), f"{tables.base}/report"
    )
    watched = {**made, LOGS: tables[LOGS], "quarantine": quarantine(tables)}
    made["monitor_summary"] = tables.put(
        "monitor_summary",
        monitors.monitor_summary(monitors.monitor_results(spark, watched, as_of_date)),
    )
    return made
