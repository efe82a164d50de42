from conftest import STG_DDL, at, stg_row
import pytest

from clickloom.operators.leads import lead_velocity
from clickloom.operators.orders import first_purchases, order_items
from clickloom.operators.stage import stage_events
from clickloom.schema import RAW_EVENTS

ONE = '[{"item_id":"a","item_name":"A","item_price":2.5,"quantity":2}]'
TWO = '[{"item_id":"a","item_price":"1.5","quantity":"2.0"},{"item_id":"b","item_price":3,"quantity":2.5},7]'


def done(client, time, txn, items, revenue=1.0):
    return stg_row(client, time, "checkout_completed", txn=txn, revenue=revenue, items=items)


def test_first_purchase_keeps_all_items(spark):
    stg = spark.createDataFrame([
        done("c", "2024-01-01 11:00", "T", ONE),
        done("c", "2024-01-01 10:00", "T", TWO),
        done("d", "2024-01-01 12:00", "T", ONE),
        done("c", "2024-01-01 10:00", None, ONE, revenue=8.0),
        done("c", "2024-01-01 09:00", None, None),
        done("e", "2024-01-01 09:00", "E", '{"item_id":"x"}'),
        stg_row("c", "2024-01-01 08:00", "purchase", txn="T", items=ONE),
    ], STG_DDL)
    assert first_purchases(stg).count() == 4
    rows = sorted((r["client_id"], r["item_id"] or "-", r["item_price"], r["quantity"], r["line_total"])
                  for r in order_items(stg).collect() if r["item_price"] is not None)
    assert rows == [("c", "a", 1.5, 2, 3.0), ("c", "b", 3.0, 3, 9.0), ("d", "a", 2.5, 2, 5.0)]
    # the third element is no object: a line without fields
    assert order_items(stg).where("item_price IS NULL").count() == 1


def test_bad_numbers_fail_or_become_null(spark):
    stg = spark.createDataFrame([done("c", "2024-01-01 11:00", "T", '[{"item_price":"abc","quantity":1}]')], STG_DDL)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        order_items(stg).collect()
    assert order_items(stg, on_bad_number="null").first()["line_total"] is None


def test_staging(spark):
    agent = "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile Safari/604.1"
    body = '{"user_email":"e@x","transaction_id":12,"revenue":1.50,"items":[ {"a": 1} ],"z":null}'
    raw = spark.createDataFrame([
        ("c", at("2024-01-01 10:00"), "page_viewed", body, "https://x/?utm_source=g&utm_medium=#f", None, agent),
        ("c", at("2024-01-01 10:00"), "page_viewed", '{"revenue":null,"items":null}', "https://x/utmost", "", "iPad Mobile"),
        ("c", at("2024-01-01 10:00"), "page_viewed", "{}", "https://x/", "https://YAHOO.com", "Android Tablet Chrome Edg"),
    ], RAW_EVENTS)
    a, b, c = stage_events(raw).collect()
    assert (a["user_email"], a["transaction_id"], a["revenue"], a["items_json"]) == ("e@x", "12", 1.5, '[{"a":1}]')
    assert (a["utm_source"], a["utm_medium"], a["utm_campaign"]) == ("g", "#f", "")
    assert (a["channel_group"], a["platform"], a["os"], a["browser"]) == ("Paid", "Mobile", "iOS", "Safari")
    assert (b["channel_group"], b["platform"], b["os"], b["browser"]) == ("Paid", "Tablet", "iOS", "Other")
    assert b["revenue"] is None and b["items_json"] is None and b["user_email"] is None
    assert (c["channel_group"], c["platform"], c["os"], c["browser"]) == ("Organic Search", "Tablet", "Android", "Edge")


def test_lead_velocity(spark):
    lead, buy = "email_filled_on_popup", "checkout_completed"
    stg = spark.createDataFrame([
        stg_row("a", "2024-01-01 23:59", lead), stg_row("b", "2024-01-02 00:01", buy),
        stg_row("c", "2024-01-01 12:00", lead), stg_row("c", "2024-01-01 09:00", buy),
        stg_row("d", "2024-01-05 12:00", lead), stg_row("d", "2024-01-02 09:00", buy),
        stg_row("e", "2024-01-01 12:00", lead), stg_row("f", "2024-01-04 12:00", buy),
        stg_row("g", "2024-01-01 12:00", lead),
    ], STG_DDL)
    users = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "v"), ("d", "w"), ("g", "x")],
                                  "client_id string, master_user_id string")
    got = {r["master_user_id"]: r["days_to_convert"] for r in lead_velocity(stg, users).collect()}
    assert got == {"u": 1, "v": 0, None: 3}
