"""Text cells: blanks, null tokens and JSON validity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from clickloom.functions.clock import strip
from clickloom.schema import NULL_TOKENS


def null_token_to_null(column: Column) -> Column:
    return F.when(column.isin(*NULL_TOKENS), F.lit(None)).otherwise(column)


def is_blank(column: Column) -> Column:
    return column.isNull() | (strip(column) == "")


def first_non_blank(columns: list[Column]) -> Column:
    """First value that is neither NULL nor blank; if all are, the last one, as read."""
    return reduce(lambda kept, nxt: F.when(is_blank(kept), nxt).otherwise(kept), columns)


_TAIL_MARK = "~clickloom-tail~"


def is_json(text: Column) -> Column:
    """True iff the whole text is exactly one strict JSON value.

    Spark's JSON functions stop after the first value, so the text is set before a marker in
    an array: the marker is the second element only if nothing else follows the value. They
    also accept single-quoted strings and raw control characters within strings; only rows
    that hold such characters pay for the extra test.
    """
    marked = F.concat(F.lit("["), text, F.lit(f',"{_TAIL_MARK}"]'))
    one_value = F.coalesce(F.get_json_object(marked, "$[1]") == _TAIL_MARK, F.lit(False))
    unescaped = F.regexp_replace(text, r"(?s)\\.", "")
    without_strings = F.regexp_replace(unescaped, r'"[^"\x00-\x1f]*"', "")
    suspicious = text.rlike(r"['\x00-\x1f]")
    return one_value & F.when(suspicious, ~without_strings.rlike("[\"']")).otherwise(F.lit(True))


def starts_as_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))
