"""Order line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.schema import CHECKOUT_DONE, FCT_ORDER_ITEMS


def first_purchases(stg: DataFrame) -> DataFrame:
    """First completed checkout per (transaction_id, client_id); NULL ids form one group.

    A minimum over (time, revenue, items) keeps one row and combines map-side, so a heavy key
    is never gathered in one place. At equal times the least (revenue, items) wins, NULLs first.
    """
    earliest = F.min(F.struct("timestamp", "revenue", "items_json"))
    return (
        stg.where(F.col("event_name") == CHECKOUT_DONE)
        .groupBy("transaction_id", "client_id")
        .agg(earliest.alias("earliest"))
        .select("transaction_id", "client_id", "earliest.*")
    )


def explode_items(df: DataFrame) -> DataFrame:
    """One row per element of ``items_json``; rows without a JSON array vanish."""
    return df.withColumn(
        "item_json", F.explode(F.from_json("items_json", "array<string>"))
    ).drop("items_json")


def _field(name: str) -> Column:
    return F.get_json_object("item_json", f"$.{name}")


def whole_number(text: Column, on_bad_number: str = "error") -> Column:
    """Text to a whole number; halves are rounded away from zero."""
    number = text.try_cast("double") if on_bad_number == "null" else text.cast("double")
    return F.round(number).cast("int")


def order_items(stg: DataFrame, on_bad_number: str = "error") -> DataFrame:
    """Line items of first purchases; a kept purchase keeps all its items."""
    def number(text: Column) -> Column:
        return text.try_cast("double") if on_bad_number == "null" else text.cast("double")

    return (
        explode_items(first_purchases(stg))
        .withColumnRenamed("revenue", "declared_order_revenue")
        .withColumns({
            "item_id": _field("item_id"),
            "item_name": _field("item_name"),
            "item_price": number(_field("item_price")),
            "quantity": whole_number(_field("quantity"), on_bad_number),
        })
        .withColumn("line_total", F.col("item_price") * F.col("quantity"))
        .select(*FCT_ORDER_ITEMS)
    )
