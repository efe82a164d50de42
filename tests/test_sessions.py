import hashlib
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import STG_DDL, at, stg_row
from pyspark.sql import functions as F

from clickloom.operators import identity, matching
from clickloom.operators.sessions import activity_minutes, first_touch, funnel, session_rollup, sessionize

NO_MAP = "client_id string, master_user_id string"


def rollup(spark, rows, user_map=(), gap=30):
    return session_rollup(
        spark.createDataFrame(rows, STG_DDL), spark.createDataFrame(list(user_map), NO_MAP), gap
    )


def test_minute_boundaries_not_elapsed_time(spark):
    rows = [stg_row("c", f"2024-01-01 {t}") for t in ("10:00:59", "10:30:00", "11:00:00")]
    assert rollup(spark, rows).count() == 3
    assert rollup(spark, [stg_row("c", "2024-01-01 10:00:00"), stg_row("c", "2024-01-01 10:29:59.9")]).count() == 1


def test_rollup_values(spark):
    rows = [
        stg_row("c", "2024-01-01 10:00:00.5", "checkout_started", channel="Paid"),
        stg_row("c", "2024-01-01 10:00:00.5", "page_viewed", channel="Direct"),
        stg_row("c", "2024-01-01 10:20:30", "page_viewed", channel="Referral"),
        stg_row("c", "2024-01-01 10:40:00", "checkout_completed"),
        stg_row("c", "2024-01-01 12:00:00", "purchase"),
    ]
    first, second = rollup(spark, rows, [("c", "u@x")]).orderBy("started_at").collect()
    assert first["session_id"] == hashlib.md5(b"c-1").hexdigest()
    assert second["session_id"] == hashlib.md5(b"c-2").hexdigest()
    assert first["master_user_id"] == "u@x"
    assert first["channel"] == "Direct"  # least of the two first events
    assert (first["actions_per_session"], first["page_views"], first["cart_adds"]) == (4, 2, 0)
    assert (first["did_checkout"], first["captured_email"], first["converted"]) == (1, 0, 1)
    assert first["session_duration_minutes"] == pytest.approx(2400 / 60)
    assert (second["converted"], second["session_duration_minutes"]) == (0, 0.0)


def brute_sessions(events, gap):
    """events: list of (client, time); returns client -> list of lists of times."""
    by_client = defaultdict(list)
    for client, time in events:
        by_client[client].append(time)
    out = {}
    for client, times in by_client.items():
        sessions, previous = [], None
        for time in sorted(times):
            minute = time.replace(second=0, microsecond=0)
            if previous is None or (minute - previous) >= timedelta(minutes=gap):
                sessions.append([])
            sessions[-1].append(time)
            previous = minute
        out[client] = sessions
    return out


def random_events(seed, n=1500, clients=12, hours=60):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    events = []
    for _ in range(n):
        client = "hot" if rng.random() < 0.35 else f"c{rng.randrange(clients)}"
        time = start + timedelta(milliseconds=rng.randrange(hours * 3600 * 1000))
        events += [(client, time)] * (1 if rng.random() < 0.9 else 3)
    return events


@pytest.mark.parametrize("seed,gap", [(1, 30), (2, 5)])
def test_against_brute_force(spark, seed, gap):
    events = random_events(seed)
    stg = spark.createDataFrame([stg_row(c, t.isoformat()) for c, t in events], STG_DDL).repartition(7)
    user_map = spark.createDataFrame([("hot", "u"), ("c0", "u")], NO_MAP)
    expected = brute_sessions(events, gap)
    got = {(r["client_id"], r["started_at"], r["ended_at"], r["actions_per_session"])
           for r in session_rollup(stg, user_map, gap).collect()}
    assert got == {(c, s[0], s[-1], len(s)) for c, sessions in expected.items() for s in sessions}

    ranks = {(c, t): i for c, sessions in expected.items() for i, s in enumerate(sessions, 1) for t in s}
    tagged = sessionize(stg, user_map, gap).collect()
    assert len(tagged) == len(events)
    for r in tagged:
        assert r["session_rank"] == ranks[r["client_id"], r["timestamp"]]
        assert r["master_user_id"] == ("u" if r["client_id"] in ("hot", "c0") else r["client_id"])

    for r in activity_minutes(stg, gap).where("prev_ts IS NOT NULL").collect():
        assert r["prev_ts"] == max(t for c, t in events if c == r["client_id"] and t < r["first_ts"])

    matched = matching.event_session_match(stg, session_rollup(stg, user_map, gap))
    assert matched.count() == len(events)
    joined = matched.exceptAll(
        sessionize(stg, user_map, gap).select("client_id", "timestamp", "event_name", "session_id"))
    assert joined.isEmpty()


def test_funnel_counts_distinct_ids(spark):
    events = random_events(3, n=300)
    names = ["page_viewed", "product_added_to_cart", "checkout_started", "checkout_completed"]
    stg = spark.createDataFrame(
        [stg_row(c, t.isoformat(), names[i % 4]) for i, (c, t) in enumerate(events)], STG_DDL)
    sessions = session_rollup(stg, spark.createDataFrame([], NO_MAP))
    steps = {"step_1_view": "page_views", "step_2_cart": "cart_adds", "step_3_checkout": "did_checkout",
             "step_4_purchase": "converted"}
    expected = sessions.agg(
        F.count_distinct("session_id").alias("total_sessions"),
        *[F.count_distinct(F.when(F.col(c) > 0, F.col("session_id"))).alias(s) for s, c in steps.items()],
    )
    assert funnel(sessions).first() == expected.first()
    assert first_touch(sessions).count() == sessions.count()


def test_latest_email_wins_and_ties_take_the_greater(spark):
    stg = spark.createDataFrame([
        stg_row("a", "2024-01-01 10:00", email="old@x"),
        stg_row("a", "2024-01-01 11:00", email="new@x"),
        stg_row("a", "2024-01-01 12:00"),
        stg_row("b", "2024-01-01 10:00", email="p@x"),
        stg_row("b", "2024-01-01 10:00", email="q@x"),
        stg_row("c", "2024-01-01 10:00"),
    ], STG_DDL)
    got = {r["client_id"]: r["master_user_id"] for r in identity.stitch_identity(stg).collect()}
    assert got == {"a": "new@x", "b": "q@x"}
    assert identity.email_signals(stg.unionByName(stg)).count() == 4


def test_identity_join_with_and_without_broadcast(spark, folder):
    events = random_events(4, n=200)
    stg = spark.createDataFrame([stg_row(c, t.isoformat()) for c, t in events], STG_DDL)
    spark.createDataFrame([("hot", "u"), ("c1", "v")], NO_MAP).write.parquet(folder + "/m")
    user_map = spark.read.parquet(folder + "/m")
    small = identity.identity_join(stg, user_map)
    large = identity.identity_join(stg, user_map, broadcast_bytes=0)
    assert small.count() == large.count() == len(events)
    assert small.select(sorted(small.columns)).exceptAll(large.select(sorted(large.columns))).isEmpty()


def test_user_of_an_event_without_time(spark, folder):
    stg = spark.createDataFrame([stg_row(c, "2024-01-01 10:00") for c in ("c", "d")], STG_DDL).withColumn(
        "timestamp", F.when(F.col("client_id") == "d", F.col("timestamp")))
    spark.createDataFrame([("c", "u"), ("d", "v")], NO_MAP).write.parquet(folder + "/m")
    user_map = spark.read.parquet(folder + "/m")
    for size in (identity.BROADCAST_BYTES, 0):
        got = {r["client_id"]: r["master_user_id"] for r in identity.identity_join(stg, user_map, broadcast_bytes=size).collect()}
        assert got == {"c": "u", "d": "v"}


def test_a_device_is_never_shuffled_whole(spark, folder):
    """Only rows already combined per (device, minute) are shuffled on the device alone."""
    spark.createDataFrame([stg_row("c", "2024-01-01 10:00")], STG_DDL).write.parquet(folder + "/stg")
    spark.createDataFrame([("c", "u")], NO_MAP).write.parquet(folder + "/map")
    stg, user_map = spark.read.parquet(folder + "/stg"), spark.read.parquet(folder + "/map")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [session_rollup(stg, user_map), sessionize(stg, user_map),
                  identity.identity_join(stg, user_map, broadcast_bytes=0)]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in frames]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        steps = [line for line in plan.splitlines() if re.search("Exchange|Aggregate|FileScan", line)]
        whole = [i for i, line in enumerate(steps) if re.search(r"hashpartitioning\(client_id#\d+, \d+\)", line)]
        assert whole
        for i in whole:
            child = steps[i + 1]
            combined = re.search(r"Aggregate\(keys?=\[client_id#\d+, \w+#", child)
            assert combined or "master_user_id" in child, child


def test_busy_hour_is_dealt_to_several_tasks(spark):
    """A third of all events, copies among them, lie in one hour of one device; adaptive execution is off."""
    rng = random.Random(5)
    start = at("2024-01-01 10:00")
    events = [("hot", start + timedelta(seconds=rng.randrange(40) * 60)) for _ in range(400)]
    events += [(f"c{rng.randrange(30)}", start + timedelta(minutes=rng.randrange(600))) for _ in range(800)]
    stg = spark.createDataFrame([stg_row(c, t.isoformat()) for c, t in events], STG_DDL).repartition(3)
    sessions = session_rollup(stg, spark.createDataFrame([], NO_MAP))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        match = matching.event_session_match(stg, sessions, hot_rows=50)
        # each event lies in one session, the one it was counted in
        assert match.count() == len(events)
        found = {r["session_id"]: r["count"] for r in match.groupBy("session_id").count().collect()}
        assert found == {r["session_id"]: r["actions_per_session"] for r in sessions.collect()}
        whole = matching.session_minutes(stg, sessions)
        assert whole.exceptAll(matching.session_minutes(stg, sessions, hot_rows=3)).isEmpty()
        hour = F.date_trunc("hour", "timestamp").cast("string").alias("hour_no")
        placed = stg.select("client_id", hour)
        dealt, spans = matching._dealt(placed, placed.distinct(), 50)
        sizes = {(r["client_id"], r["piece"]): r["count"] for r in dealt.groupBy("client_id", "hour_no", "piece").count().collect()}
        assert len([k for k in sizes if k[0] == "hot"]) >= 8 and max(sizes.values()) <= 100
        assert dealt.join(spans, ["client_id", "hour_no", "piece"]).count() == len(events)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_instants_are_shuffled_once(spark):
    """Busy hours are counted on the events, not on the instants, which would need these a second time."""
    stg = spark.createDataFrame([stg_row("c", "2024-01-01 10:00")], STG_DDL)
    sessions = spark.createDataFrame(
        [("s", "c", at("2024-01-01 10:00"), at("2024-01-01 10:00"))],
        "session_id string, client_id string, started_at timestamp_ntz, ended_at timestamp_ntz")
    minutes = matching.session_minutes(stg, sessions)
    plan = minutes._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(client_id#\d+, timestamp#\d+", plan)) == 1, plan
    assert [r["events"] for r in minutes.collect()] == [1]
