"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def session_key(client_id: Column, session_rank: Column) -> Column:
    return F.md5(F.concat(client_id, F.lit("-"), session_rank.cast("string")))


def purchase_key(client_id: Column, purchase_time: Column) -> Column:
    return F.md5(F.concat(client_id, purchase_time.cast("string")))
