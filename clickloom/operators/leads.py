"""Lead-to-purchase velocity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import boundary_diff
from clickloom.schema import CHECKOUT_DONE, EMAIL_CAPTURE


def _first(event_name: str) -> Column:
    return F.min(F.when(F.col("event_name") == event_name, F.col("timestamp")))


def lead_velocity(stg: DataFrame, user_map: DataFrame) -> DataFrame:
    """Days from a user's first email capture to the first purchase ever, where not negative.

    Each device is reduced to two times before the user map is joined. Devices without a user
    form one group with a NULL user.
    """
    devices = (
        stg.where(F.col("event_name").isin(EMAIL_CAPTURE, CHECKOUT_DONE))
        .groupBy("client_id")
        .agg(_first(EMAIL_CAPTURE).alias("lead"), _first(CHECKOUT_DONE).alias("buy"))
    )
    return (
        devices.join(user_map, "client_id", "left")
        .groupBy("master_user_id")
        .agg(F.min("lead").alias("lead_captured_at"), F.min("buy").alias("first_purchase_at"))
        .withColumn(
            "days_to_convert",
            boundary_diff("day", F.col("lead_captured_at"), F.col("first_purchase_at")),
        )
        .where("days_to_convert >= 0")
    )
