"""Column names, record types and fixed texts shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The accepted event names.
EVENT_NAMES = (
    "page_viewed",
    "email_filled_on_popup",
    "product_added_to_cart",
    "checkout_started",
    "purchase",
    "checkout_completed",
)
PAGE_VIEW = "page_viewed"
EMAIL_CAPTURE = "email_filled_on_popup"
CART_ADD = "product_added_to_cart"
CHECKOUT_START = "checkout_started"
PURCHASE = "purchase"
CHECKOUT_DONE = "checkout_completed"

# The seven columns of a raw event, in file order, and those a file must bring.
EVENT_COLUMNS = (
    "client_id",
    "page_url",
    "referrer",
    "timestamp",
    "event_name",
    "event_data",
    "user_agent",
)
CORE_COLUMNS = tuple(c for c in EVENT_COLUMNS if c != "referrer")

# CSV cells that mean "no value".
NULL_TOKENS = ("", "null", "NULL", "None")

# Order in which the messages of one rejected row are listed.
MESSAGE_ORDER = (
    "client_id",
    "timestamp",
    "event_name",
    "event_data",
    "page_url",
    "referrer",
    "user_agent",
)

# Message texts (written after "field: ").
MSG_ABSENT = "Field required"
MSG_NOT_STRING = "Input should be a valid string"
MSG_BLANK = "Value error, required field is empty"
MSG_TS_NULL = "Value error, timestamp is null"
MSG_TS_BLANK = "Value error, timestamp is empty"
MSG_TS_BAD = "Value error, timestamp is not a valid datetime"
MSG_EVENT_NAME = "Input should be one of the known event names"
MSG_JSON_BAD = "Value error, event_data is not valid JSON"
MSG_JSON_NOT_OBJECT = "Value error, event_data JSON must be an object"

UNATTRIBUTED = "Direct/Unattributed"

SESSION_GAP_MINUTES = 30
LOOKBACK_DAYS = 7

_NTZ = T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_EVENTS = _struct(
    ("client_id", T.StringType(), False),
    ("timestamp", _NTZ, False),
    ("event_name", T.StringType(), False),
    ("event_data", T.StringType(), False),
    ("page_url", T.StringType(), False),
    ("referrer", T.StringType(), True),
    ("user_agent", T.StringType(), False),
)

PIPELINE_LOGS = _struct(
    ("run_id", T.StringType(), True),
    ("filename", T.StringType(), False),
    ("run_timestamp", _NTZ, False),
    ("rows_read", T.LongType(), False),
    ("rows_inserted", T.LongType(), False),
    ("rows_quarantined", T.LongType(), False),
    ("status", T.StringType(), False),
)

STG_EVENTS = (
    "client_id", "timestamp", "event_name", "page_url", "referrer", "user_agent",
    "user_email", "transaction_id", "revenue", "items_json",
    "utm_source", "utm_medium", "utm_campaign", "channel_group",
    "platform", "os", "browser",
)

DIM_SESSIONS = (
    "session_id", "master_user_id", "client_id", "started_at", "ended_at",
    "session_duration_minutes", "channel", "source", "medium", "campaign",
    "platform", "os", "browser", "actions_per_session", "page_views", "cart_adds",
    "did_checkout", "captured_email", "converted",
)

FCT_ATTRIBUTION = (
    "transaction_id", "purchaser_master_id", "revenue", "purchase_time",
    "lc_session_id", "lc_channel", "lc_source", "lc_medium",
    "fc_session_id", "fc_channel", "fc_source", "fc_medium",
)

FCT_ORDER_ITEMS = (
    "transaction_id", "timestamp", "client_id", "declared_order_revenue",
    "item_id", "item_name", "item_price", "quantity", "line_total",
)
