"""Which session an event falls into by time alone, independent of how sessions were built."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import epoch_hour, epoch_minute


# Rows of one (device, hour) that a task joins; busier hours are dealt to several.
HOT_ROWS = 1 << 20


def _dealt(events: DataFrame, spans: DataFrame, hot_rows: int,
           counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join with ``piece``: the events of a busy (device, hour) are dealt in turn, its spans to each.

    Hours are busy by the rows of ``counted``, or else of ``events``. The list of them is broadcast: it has at most one
    row per ``hot_rows`` of those.
    """
    keys = ["client_id", "hour_no"]
    counted = events if counted is None else counted
    busy = F.broadcast(
        counted.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
        .select(*keys, F.ceil(F.col("n") / F.lit(hot_rows)).alias("pieces"))
    )
    piece = F.pmod(F.monotonically_increasing_id(), F.col("pieces"))
    pieces = F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1)
    return (
        events.join(busy, keys, "left").withColumn("piece", F.coalesce(piece, F.lit(0))).drop("pieces"),
        spans.join(busy, keys, "left").withColumn("piece", F.explode(pieces)).drop("pieces"),
    )


def _contained(events: DataFrame, sessions: DataFrame, hot_rows: int = HOT_ROWS, stg: DataFrame | None = None) -> DataFrame:
    """Join on (client, hour, piece) and keep times within [started_at, ended_at].

    A session is listed under each hour it touches and an event under its own hour. Sessions of
    one device are at least a gap apart, so an hour meets only a few of them, and a heavy device
    is spread over its hours instead of pairing all its events with all its sessions. An hour that
    is too busy for one task is dealt in pieces, told by the rows of ``stg`` where these are quicker to count.
    """
    hours = F.sequence(epoch_hour(F.col("started_at")), epoch_hour(F.col("ended_at")))
    spans = (
        sessions.where("started_at <= ended_at")
        .select("client_id", "session_id", "started_at", "ended_at", F.explode(hours).alias("hour_no"))
    )
    inside = F.col("timestamp").between(F.col("started_at"), F.col("ended_at"))
    hour_no = epoch_hour(F.col("timestamp"))
    counted = stg.select("client_id", hour_no.alias("hour_no")) if stg is not None else None
    placed, listed = _dealt(events.withColumn("hour_no", hour_no), spans, hot_rows, counted)
    return (
        placed.join(listed, ["client_id", "hour_no", "piece"])
        .where(inside)
        .drop("hour_no", "piece", "started_at", "ended_at")
    )


def event_session_match(stg: DataFrame, sessions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events with the session whose span holds them."""
    events = stg.select("client_id", "timestamp", "event_name")
    return _contained(events, sessions, hot_rows)


def session_minutes(stg: DataFrame, sessions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events matched per session and minute: (session_id, client_id, minute_no, events).

    Events of one instant are combined first, so copies do not multiply in the join. Busy hours are told by
    the events themselves, which takes no second shuffle of the instants.
    """
    instants = stg.groupBy("client_id", "timestamp").agg(F.count("*").alias("n"))
    return (
        _contained(instants, sessions, hot_rows, stg)
        .groupBy("session_id", "client_id", epoch_minute(F.col("timestamp")).alias("minute_no"))
        .agg(F.sum("n").alias("events"))
    )
