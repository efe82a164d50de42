"""Staging projection: identity, transaction, marketing and device fields of each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import web
from clickloom.schema import STG_EVENTS

_JSON_FIELDS = "user_email string, transaction_id string, revenue string, items string"


def _number(text: Column, on_bad_number: str) -> Column:
    if on_bad_number == "null":
        return text.try_cast("double")
    return text.cast("double")


def stage_events(raw_events: DataFrame, *keep: str, on_bad_number: str = "error") -> DataFrame:
    """Staged events; ``on_bad_number`` is "error" (fail the job) or "null".

    The JSON text is parsed once per row: giving the parser an option keeps the optimizer
    from splitting the struct into one parse per field.
    """
    body = F.from_json("event_data", _JSON_FIELDS, {"mode": "PERMISSIVE"})
    url, referrer, agent = F.col("page_url"), F.col("referrer"), F.col("user_agent")
    return raw_events.select(
        *keep,
        "client_id", "timestamp", "event_name", "page_url", "referrer", "user_agent",
        body["user_email"].alias("user_email"),
        body["transaction_id"].alias("transaction_id"),
        _number(body["revenue"], on_bad_number).alias("revenue"),
        body["items"].alias("items_json"),
        web.utm_param(url, "source").alias("utm_source"),
        web.utm_param(url, "medium").alias("utm_medium"),
        web.utm_param(url, "campaign").alias("utm_campaign"),
        web.channel_group(url, referrer).alias("channel_group"),
        web.platform(agent).alias("platform"),
        web.operating_system(agent).alias("os"),
        web.browser(agent).alias("browser"),
    ).select(*keep, *STG_EVENTS)
