"""Row validation, routing and per-file accounting as column expressions.

A row's messages are built by one CASE per field, so a single scan yields the typed record,
the rejection reason and the counts.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.functions import clock, text
from clickloom.schema import (
    EVENT_COLUMNS, EVENT_NAMES, MESSAGE_ORDER, MSG_ABSENT, MSG_BLANK, MSG_EVENT_NAME,
    MSG_JSON_BAD, MSG_JSON_NOT_OBJECT, MSG_NOT_STRING, MSG_TS_BAD, MSG_TS_BLANK, MSG_TS_NULL,
)

# Optional array column of a source: the fields this row's file does not have at all.
ABSENT = "_absent"


def _object_text(cell: Column, data_type: T.DataType) -> Column:
    """Text of a JSON object, ``{}`` where there is none, NULL where the text is no object."""
    if isinstance(data_type, (T.StructType, T.MapType, T.VariantType)):
        return F.to_json(cell)
    is_object = text.starts_as_object(cell) & text.is_json(cell)
    return F.when(is_object, cell).when(cell.isNull() | F.lower(cell).isin("", "null"), "{}")


def annotate(raw: DataFrame) -> DataFrame:
    """Add the typed record, ``errors`` (array of "field: message") and ``is_valid``.

    Typed columns other than referrer are NULL exactly where the cell is not acceptable, so a
    row is valid iff none of them is. Columns of ``EVENT_COLUMNS`` that ``raw`` lacks count as
    absent in every row. The cells as read are kept under ``raw_<column>``; other columns of
    ``raw`` pass through.
    """
    present = set(raw.columns)
    others = [c for c in raw.columns if c not in EVENT_COLUMNS and c != ABSENT]
    per_row = [ABSENT] if ABSENT in present else []
    required = [f for f in MESSAGE_ORDER if f != "referrer"]
    source = raw.select(
        *others,
        *per_row,
        *[
            (F.col(c) if c in present else F.lit(None).cast("string")).alias(f"raw_{c}")
            for c in EVENT_COLUMNS
        ],
    )
    types = {c: source.schema[f"raw_{c}"].dataType for c in EVENT_COLUMNS}
    is_text = {c: isinstance(types[c], T.StringType) for c in EVENT_COLUMNS}
    source = source.select("*", *[
        (clock.strip(F.col(f"raw_{c}")) if is_text[c] else F.col(f"raw_{c}")).alias(f"cell_{c}")
        for c in required
    ])
    cell = {c: F.col(f"cell_{c}") for c in required}

    name = F.lower(cell["event_name"])
    accepted = {
        **{c: F.nullif(cell[c], F.lit("")) for c in ("client_id", "page_url", "user_agent")},
        "timestamp": clock.as_timestamp_ntz(cell["timestamp"], types["timestamp"]),
        "event_name": F.when(name.isin(*EVENT_NAMES), name),
        "event_data": _object_text(cell["event_data"], types["event_data"]),
    }
    for field in required:
        if field not in present:
            accepted[field] = F.lit(None).cast("timestamp_ntz" if field == "timestamp" else "string")
        elif per_row:
            accepted[field] = F.when(~F.array_contains(ABSENT, field), accepted[field])
    # One-element inline: a filter on the typed columns stays above it, so that no cell is parsed
    # once for the filter and again for the output. The record is a column before, as generated code
    # computes columns, but not what a generator is given.
    record = F.struct(*[accepted[f].alias(f) for f in required])
    typed = source.select("*", record.alias("_record")).select("*", F.inline(F.array("_record")))

    faults = {
        c: F.when(cell[c].isNull(), MSG_NOT_STRING).otherwise(MSG_BLANK)
        for c in ("client_id", "page_url", "user_agent")
    }
    faults["timestamp"] = F.when(cell["timestamp"].isNull(), MSG_TS_NULL)
    if is_text["timestamp"]:
        faults["timestamp"] = faults["timestamp"].when(cell["timestamp"] == "", MSG_TS_BLANK)
    faults["timestamp"] = faults["timestamp"].otherwise(MSG_TS_BAD)
    faults["event_name"] = F.lit(MSG_EVENT_NAME)
    faults["event_data"] = F.lit(MSG_JSON_BAD)
    if is_text["event_data"]:
        is_value = text.is_json(cell["event_data"])
        faults["event_data"] = F.when(is_value, MSG_JSON_NOT_OBJECT).otherwise(MSG_JSON_BAD)

    messages = []
    for field in required:
        fault = faults[field]
        if field not in present:
            fault = F.lit(MSG_ABSENT)
        elif per_row:
            fault = F.when(F.array_contains(ABSENT, field), MSG_ABSENT).otherwise(fault)
        messages.append(F.when(F.col(field).isNull(), F.concat(F.lit(f"{field}: "), fault)))
    return typed.select(
        *others,
        *[f"raw_{c}" for c in EVENT_COLUMNS],
        F.col("raw_referrer").alias("referrer"),
        *required,
        F.array_compact(F.array(*messages)).alias("errors"),
        reduce(Column.__and__, [F.col(f).isNotNull() for f in required]).alias("is_valid"),
    )


def valid_events(annotated: DataFrame, *keep: str) -> DataFrame:
    """Accepted rows as typed raw events; ``keep`` names further columns to carry."""
    return annotated.where("is_valid").select(
        *keep, "client_id", "timestamp", "event_name", "event_data", "page_url", "referrer",
        "user_agent",
    )


def quarantined(annotated: DataFrame, *keep: str) -> DataFrame:
    """Rejected rows: the seven columns as read, and why."""
    return annotated.where("NOT is_valid").select(
        *keep,
        *[F.col(f"raw_{c}").alias(c) for c in EVENT_COLUMNS],
        F.array_join("errors", " | ").alias("error_reason"),
    )


def file_log(annotated: DataFrame, run_timestamp: datetime, run_id: str = "",
             files: DataFrame | None = None) -> DataFrame:
    """One audit row per source file; ``files`` (column source_file) adds files without rows."""
    counts = annotated.groupBy("source_file").agg(
        F.count_if("is_valid").alias("rows_inserted"),
        F.count_if(~F.col("is_valid")).alias("rows_quarantined"),
    )
    return log_rows(counts, run_timestamp, run_id, files)


def log_rows(counts: DataFrame, run_timestamp: datetime, run_id: str = "",
             files: DataFrame | None = None) -> DataFrame:
    if files is not None:
        counts = files.join(counts, "source_file", "left")
    inserted = F.coalesce("rows_inserted", F.lit(0)).cast("bigint")
    rejected = F.coalesce("rows_quarantined", F.lit(0)).cast("bigint")
    status = (
        F.when((rejected > 0) & (inserted > 0), "partial_failure")
        .when(rejected > 0, "FAILED")
        .otherwise("COMPLETED")
    )
    stamp = run_timestamp.strftime("%Y-%m-%d %H:%M:%S.%f")
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.col("source_file").alias("filename"),
        F.lit(stamp).cast("timestamp_ntz").alias("run_timestamp"),
        (inserted + rejected).alias("rows_read"),
        inserted.alias("rows_inserted"),
        rejected.alias("rows_quarantined"),
        status.alias("status"),
    )


def validation_summary(annotated: DataFrame) -> DataFrame:
    """Dry run: files checked, rows passed, rows failed."""
    per_file = annotated.groupBy("source_file").agg(
        F.count_if("is_valid").alias("passed"), F.count_if(~F.col("is_valid")).alias("failed")
    )
    return totals(per_file)


def totals(per_file: DataFrame) -> DataFrame:
    return per_file.agg(
        F.count("source_file").alias("files_checked"),
        F.coalesce(F.sum("passed"), F.lit(0)).alias("rows_passed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("rows_failed"),
    )


def top_errors(annotated: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent messages; every message of a row counts."""
    return (
        annotated.where("NOT is_valid")
        .select(F.explode("errors").alias("message"))
        .groupBy("message")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "message")
        .limit(n)
    )
