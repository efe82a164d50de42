"""First- and last-click attribution within a lookback window.

The sessions a purchase may be credited to are those of the same user that started in
``[purchase_time - lookback, purchase_time]``. Only the first, the last and their number are
needed, so no purchase-session pair is ever formed: sessions and purchase times are laid on one
timeline per user and looked up "as of" a time, in two levels.

1. Within an hour of one user: running values over the ordered rows.
2. Across hours: one summary row per (user, hour), ordered per user, carries the last session,
   the next session and the session count over to hours that need them. Only hours that hold an end
   of a window are dealt back to their rows, each with what its ends ask for.

A user with a large share of all sessions is thus spread over his hours; the step that sees the
whole user handles one row per hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.clock import epoch_hour
from clickloom.functions.keys import purchase_key
from clickloom.operators.identity import identity_join
from clickloom.schema import CHECKOUT_DONE, FCT_ATTRIBUTION, LOOKBACK_DAYS

# Order of rows at one instant: window start, sessions, purchase. Sessions starting exactly at
# either end of the lookback window are inside it.
_OPENS, _SESSION, _CLOSES = 0, 1, 2

_CREDIT = ("session_id", "channel", "source", "medium")
_BUY = ("purchase_pk", "client_id", "purchase_time", "transaction_id", "revenue", "purchaser_master_id")


def purchases(stg: DataFrame, user_map: DataFrame) -> DataFrame:
    """Distinct completed checkouts with the purchasing user; duplicates collapse before the join."""
    distinct = (
        stg.where(F.col("event_name") == CHECKOUT_DONE)
        .select("client_id", "timestamp", "transaction_id", "revenue")
        .distinct()
    )
    return identity_join(distinct, user_map).select(
        purchase_key(F.col("client_id"), F.col("timestamp")).alias("purchase_pk"),
        "client_id",
        F.col("timestamp").alias("purchase_time"),
        "transaction_id",
        "revenue",
        F.col("master_user_id").alias("purchaser_master_id"),
    )


def _timeline(buys: DataFrame, sessions: DataFrame, lookback_days: int) -> DataFrame:
    """Session starts with their credit, and both ends of each purchase's lookback window with the purchase.

    Dealt out once: the windows within hours and the summaries of hours read the same shuffle, for which both need the same filter.
    """
    time = F.col("purchase_time")
    ends = F.array(
        F.struct(F.lit(_CLOSES).alias("kind"), time.alias("at")),
        F.struct(F.lit(_OPENS).alias("kind"), (time - F.expr(f"INTERVAL {int(lookback_days)} DAYS")).alias("at")),
    )
    lookups = buys.select(
        F.col("purchaser_master_id").alias("user"), F.struct(*_BUY).alias("buy"), F.inline(ends))
    marks = sessions.select(
        F.col("master_user_id").alias("user"), F.lit(_SESSION).alias("kind"), F.col("started_at").alias("at"),
        F.struct(*_CREDIT).alias("credit"))
    rows = lookups.unionByName(marks, allowMissingColumns=True)
    placed = rows.withColumn("hour_no", epoch_hour(F.col("at")))
    return placed.where("user IS NOT NULL AND hour_no IS NOT NULL").repartition("user", "hour_no")


def _carry_over(timeline: DataFrame) -> DataFrame:
    """Per (user, hour) with lookups: last session of earlier hours, first of later hours, sessions before.

    The last session is there where a window closes and the first where one opens; no other row asks for it.
    """
    # told by the purchase, so that this reads the columns, and thereby the shuffle, of the windows within hours
    is_session = F.col("buy").isNull()
    hours = timeline.groupBy("user", "hour_no").agg(
        F.max(F.when(is_session, F.struct("at", "credit"))).alias("last"),
        F.min(F.when(is_session, F.struct("at", "credit"))).alias("first"),
        F.count_if(F.col("kind") == _SESSION).alias("starts"),
        F.count_if(F.col("kind") == _OPENS).alias("opens"),
        F.count_if(F.col("kind") == _CLOSES).alias("closes"),
    )
    # of an hour with one session the credit travels once
    light = hours.select(
        "user", "hour_no", "starts", F.col("last.credit").alias("last"),
        F.when(F.col("starts") > 1, F.col("first.credit")).alias("other"),
        (F.col("opens") > 0).alias("opens"), (F.col("closes") > 0).alias("closes"),
    )
    forward = Window.partitionBy("user").orderBy("hour_no").rowsBetween(Window.unboundedPreceding, -1)
    backward = (
        Window.partitionBy("user").orderBy(F.desc("hour_no")).rowsBetween(Window.unboundedPreceding, -1)
    )
    # an hour's credit goes through the second sort once, and what it was told by the first only where it is asked for
    told = light.select(
        "user", "hour_no", "opens", "closes", F.coalesce("other", "last").alias("first"),
        F.when(F.col("closes"), F.last("last", ignorenulls=True).over(forward)).alias("carried_last"),
        F.coalesce(F.sum("starts").over(forward), F.lit(0)).alias("carried_starts"),
    )
    carried = told.select(
        "user", "hour_no", "opens", "closes", "carried_last", "carried_starts",
        F.last("first", ignorenulls=True).over(backward).alias("later"),
    )
    return carried.where("opens OR closes").select(
        "user", "hour_no", "carried_last", F.when(F.col("opens"), F.col("later")).alias("carried_first"), "carried_starts",
    )


def credited_sessions(buys: DataFrame, sessions: DataFrame,
                      lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Distinct purchases with a candidate, and their last_click, first_click, n_candidates.

    Purchases travel on the timeline, so nothing is joined back. The result is dealt by user and time.
    """
    timeline = _timeline(buys, sessions, lookback_days)
    rows = (Window.unboundedPreceding, Window.currentRow)
    # of sessions starting together the least is the first and the greatest the last
    up = Window.partitionBy("user", "hour_no").orderBy("at", "kind", "credit").rowsBetween(*rows)
    down = (
        Window.partitionBy("user", "hour_no").orderBy(F.desc("at"), F.desc("kind"), F.desc("credit")).rowsBetween(*rows)
    )
    closes = F.col("kind") == _CLOSES
    # each end takes along only what it asks for, and sessions nothing: the second sort is the wider one
    seen = timeline.select(
        "user", "hour_no", "kind", "at", "buy", "credit",
        F.when(closes, F.last("credit", ignorenulls=True).over(up)).alias("before"),
        F.count_if(F.col("kind") == _SESSION).over(up).alias("starts"),
    )
    within = seen.select(
        "user", "hour_no", "kind", "buy", "before", "starts",
        F.last("credit", ignorenulls=True).over(down).alias("after"),
    ).where(F.col("kind") != _SESSION)
    placed = within.join(_carry_over(timeline), ["user", "hour_no"]).select(
        "buy.*",
        F.when(closes, F.coalesce("before", "carried_last")).alias("last"),
        F.when(~closes, F.coalesce("after", "carried_first")).alias("first"),
        (F.col("starts") + F.col("carried_starts")).alias("starts"), "kind")
    # a purchase that is given twice has the same counts twice, so these are no sums
    return (
        placed.repartition("purchaser_master_id", "purchase_time")
        .groupBy(*_BUY)
        .agg(
            F.max("last").alias("last_click"),
            F.max("first").alias("first_click"),
            (F.max(F.when(closes, F.col("starts"))) - F.max(F.when(~closes, F.col("starts")))).alias("n_candidates"),
        )
        .where("n_candidates > 0")
    )


def attribution_candidates(buys: DataFrame, sessions: DataFrame,
                           lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Number of sessions in each purchase's lookback window, for purchases that have any."""
    return credited_sessions(buys, sessions, lookback_days).select(
        "purchase_pk", "transaction_id", "purchaser_master_id", "revenue", "purchase_time",
        "n_candidates",
    )


def attribution_ranks(buys: DataFrame, sessions: DataFrame,
                      lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Per purchase key: the sessions ranked first by recency and by age."""
    return credited_sessions(buys, sessions, lookback_days).select(
        "purchase_pk",
        F.col("last_click.session_id").alias("last_click_session_id"),
        F.col("first_click.session_id").alias("first_click_session_id"),
    ).distinct()


def attribute(buys: DataFrame, sessions: DataFrame,
              lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row per distinct purchase with a candidate session; others are dropped.

    Purchases that share device and time share one ranking, so only one of them - the least
    (transaction, revenue), NULLs last - is credited and the rest have NULL channels.
    """
    pk = Window.partitionBy("purchaser_master_id", "purchase_time", "client_id").orderBy(
        F.asc_nulls_last("transaction_id"), F.asc_nulls_last("revenue")
    )
    ranked = credited_sessions(buys, sessions, lookback_days).withColumn("pk_rank", F.row_number().over(pk))

    def credited(struct: str, field: str) -> Column:
        return F.when(F.col("pk_rank") == 1, F.col(f"{struct}.{field}"))

    return ranked.select(
        "transaction_id", "purchaser_master_id", "revenue", "purchase_time",
        *[credited("last_click", f).alias(f"lc_{f}") for f in _CREDIT],
        *[credited("first_click", f).alias(f"fc_{f}") for f in _CREDIT],
    ).select(*FCT_ATTRIBUTION)
