"""Device-to-user stitching."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.clock import epoch_minute

# On-disk size up to which a user map is broadcast.
BROADCAST_BYTES = 8 * 1024 * 1024


def email_signals(stg: DataFrame) -> DataFrame:
    """Distinct sightings of an email on a device."""
    return stg.where("user_email IS NOT NULL").select("client_id", "user_email", "timestamp").distinct()


def stitch_identity(stg: DataFrame) -> DataFrame:
    """Latest email per device; at equal times the greater email.

    The maximum of (time, email) needs no distinct beforehand and combines map-side, so a
    device with many sightings sends one row per task.
    """
    latest = F.max(F.struct("timestamp", "user_email"))
    return (
        stg.where("user_email IS NOT NULL")
        .groupBy("client_id")
        .agg(latest.alias("latest"))
        .select("client_id", F.col("latest.user_email").alias("master_user_id"))
    )


def with_user(df: DataFrame, user_map: DataFrame) -> DataFrame:
    """Left join of at most calendar-many rows per device; unmapped devices stand for themselves."""
    return df.join(user_map, "client_id", "left").withColumn(
        "master_user_id", F.coalesce("master_user_id", "client_id")
    )


def _is_small(df: DataFrame, limit_bytes: int) -> bool:
    """Whether the optimizer's size estimate is within the limit; in memory a stored table may be several times larger."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) <= limit_bytes


def identity_join(stg: DataFrame, user_map: DataFrame,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Events with their master user.

    A user map of proven small size is broadcast. Beyond that, as a device may hold a large share
    of all events, they are not shuffled on the device: the user is first resolved for each
    (device, active minute), which the calendar bounds, and events join that on both columns.
    """
    if _is_small(user_map, broadcast_bytes):
        return with_user(stg, F.broadcast(user_map))
    minute = epoch_minute(F.col("timestamp"))
    active = stg.select("client_id", minute.alias("minute_no")).distinct()
    resolved = with_user(active, user_map).select(
        F.col("client_id").alias("resolved_id"), F.col("minute_no").alias("resolved_minute"), "master_user_id"
    )
    # null-safe: an event without time has no minute, but a device
    return (
        stg.withColumn("minute_no", minute)
        .join(
            resolved,
            F.col("client_id").eqNullSafe(F.col("resolved_id")) & F.col("minute_no").eqNullSafe(F.col("resolved_minute")),
            "left",
        )
        .drop("minute_no", "resolved_id", "resolved_minute")
    )
