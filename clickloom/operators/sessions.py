"""Sessions by inactivity gap.

A session starts when at least ``gap_minutes`` minute boundaries lie between an event and its
predecessor on the device. Events of one minute are therefore never split, and the rank of an
event depends only on its device and minute. Events are first combined per (device, minute) -
map-side, so copies and bursts vanish early - and only then ordered per device. A device has at
most 1,440 such rows a day however many events it sends, which keeps the ordered step small for
the heaviest device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.clock import boundary_diff, epoch_minute
from clickloom.functions.keys import session_key
from clickloom.operators.identity import with_user
from clickloom.schema import (
    CART_ADD, CHECKOUT_DONE, CHECKOUT_START, DIM_SESSIONS, EMAIL_CAPTURE, PAGE_VIEW,
    SESSION_GAP_MINUTES,
)

_FIRST_TOUCH = {
    "channel": "channel_group",
    "source": "utm_source",
    "medium": "utm_medium",
    "campaign": "utm_campaign",
    "platform": "platform",
    "os": "os",
    "browser": "browser",
}


def rank_minutes(minutes: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Add prev_minute_no, is_new and session_rank to distinct (client_id, minute_no) rows."""
    timeline = Window.partitionBy("client_id").orderBy("minute_no")
    gap = F.col("minute_no") - F.col("prev_minute_no")
    return (
        minutes.withColumn("prev_minute_no", F.lag("minute_no").over(timeline))
        .withColumn("is_new", F.when(F.coalesce(gap >= gap_minutes, F.lit(True)), 1).otherwise(0))
        .withColumn(
            "session_rank",
            F.sum("is_new").over(
                timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )


def activity_minutes(stg: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Per device and active minute: first and last time, events, previous time, session rank."""
    minutes = stg.groupBy("client_id", epoch_minute(F.col("timestamp")).alias("minute_no")).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count("*").alias("events"),
    )
    timeline = Window.partitionBy("client_id").orderBy("minute_no")
    return rank_minutes(minutes, gap_minutes).withColumn("prev_ts", F.lag("last_ts").over(timeline))


def sessionize(stg: DataFrame, user_map: DataFrame,
               gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Every event with its master user, session rank and session id."""
    minute = epoch_minute(F.col("timestamp"))
    minutes = stg.select("client_id", minute.alias("minute_no")).distinct()
    ranked = with_user(rank_minutes(minutes, gap_minutes), user_map).select(
        "client_id",
        "minute_no",
        "master_user_id",
        "session_rank",
        session_key(F.col("client_id"), F.col("session_rank")).alias("session_id"),
    )
    return (
        stg.withColumn("minute_no", minute)
        .join(ranked, ["client_id", "minute_no"], "left")
        .drop("minute_no")
    )


def _flag(event_name: str) -> Column:
    return F.max(F.when(F.col("event_name") == event_name, 1).otherwise(0))


def session_rollup(stg: DataFrame, user_map: DataFrame,
                   gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """One row per session: span, first-touch attributes, engagement counts and flags.

    First-touch attributes are those of the earliest event; among events of that instant the
    smallest attribute tuple is taken.
    """
    first = F.struct("timestamp", *[F.col(src).alias(name) for name, src in _FIRST_TOUCH.items()])
    minutes = stg.groupBy("client_id", epoch_minute(F.col("timestamp")).alias("minute_no")).agg(
        F.min(first).alias("first"),
        F.max("timestamp").alias("ended_at"),
        F.count("*").alias("actions"),
        F.count_if(F.col("event_name") == PAGE_VIEW).alias("page_views"),
        F.count_if(F.col("event_name") == CART_ADD).alias("cart_adds"),
        _flag(CHECKOUT_START).alias("did_checkout"),
        _flag(EMAIL_CAPTURE).alias("captured_email"),
        _flag(CHECKOUT_DONE).alias("converted"),
    )
    sessions = rank_minutes(minutes, gap_minutes).groupBy("client_id", "session_rank").agg(
        F.min("first").alias("first"),
        F.max("ended_at").alias("ended_at"),
        F.sum("actions").alias("actions_per_session"),
        F.sum("page_views").alias("page_views"),
        F.sum("cart_adds").alias("cart_adds"),
        F.max("did_checkout").alias("did_checkout"),
        F.max("captured_email").alias("captured_email"),
        F.max("converted").alias("converted"),
    )
    span = boundary_diff("second", F.col("started_at"), F.col("ended_at"))
    return (
        with_user(sessions, user_map)
        .withColumn("session_id", session_key(F.col("client_id"), F.col("session_rank")))
        .withColumn("started_at", F.col("first.timestamp"))
        .withColumn("session_duration_minutes", span.cast("double") / F.lit(60.0))
        .withColumns({name: F.col(f"first.{name}") for name in _FIRST_TOUCH})
        .select(*DIM_SESSIONS)
    )


def first_touch(sessions: DataFrame) -> DataFrame:
    return sessions.select("session_id", "client_id", "started_at", *_FIRST_TOUCH)


def funnel(sessions: DataFrame) -> DataFrame:
    """Sessions reaching each step. Session ids are unique, so counting rows counts ids."""
    def reached(column: str) -> Column:
        return F.count_if(F.col(column) > 0)

    return sessions.agg(
        F.count("session_id").alias("total_sessions"),
        reached("page_views").alias("step_1_view"),
        reached("cart_adds").alias("step_2_cart"),
        reached("did_checkout").alias("step_3_checkout"),
        reached("converted").alias("step_4_purchase"),
    )
