import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import STG_DDL, at, stg_row
from pyspark.sql import functions as F

from clickloom.operators import attribution

SESSIONS = ("session_id string, master_user_id string, started_at timestamp_ntz, channel string, source string, "
            "medium string")
BUYS = ("purchase_pk string, client_id string, purchase_time timestamp_ntz, transaction_id string, revenue double, "
        "purchaser_master_id string")


def session(sid, user, started, channel="Direct"):
    return (sid, user, at(started), channel, f"s-{sid}", f"m-{sid}")


def buy(txn, user, time, revenue=1.0, client="c"):
    return (f"{client}{time}", client, at(time), txn, revenue, user)


def run(spark, buys, sessions):
    df = attribution.attribute(spark.createDataFrame(buys, BUYS), spark.createDataFrame(sessions, SESSIONS))
    return {(r["transaction_id"], r["revenue"]): r for r in df.collect()}


def test_window_ends_are_inclusive(spark):
    sessions = [
        session("a", "u", "2024-01-01 10:00:00"),
        session("b", "u", "2024-01-05 10:00:00"),
        session("c", "u", "2024-01-08 10:00:00"),
        session("d", "u", "2024-01-08 10:00:01"),
        session("x", "v", "2024-01-08 09:00:00"),
    ]
    exact = run(spark, [buy("T", "u", "2024-01-08 10:00:00")], sessions)["T", 1.0]
    assert (exact["fc_session_id"], exact["lc_session_id"]) == ("a", "c")
    later = run(spark, [buy("T", "u", "2024-01-08 10:00:00.000001")], sessions)["T", 1.0]
    assert (later["fc_session_id"], later["lc_session_id"]) == ("b", "c")
    assert (later["lc_source"], later["fc_medium"]) == ("s-c", "m-b")


def test_purchase_without_session_is_dropped(spark):
    sessions = [session("a", "u", "2024-01-01 10:00"), session("b", "u", "2024-03-01 10:00")]
    assert run(spark, [buy("T", "u", "2024-02-01 10:00"), buy("U", "w", "2024-01-01 11:00")], sessions) == {}


def test_colliding_purchases_share_one_credit(spark):
    sessions = [session("a", "u", "2024-01-01 09:00", "Paid")]
    buys = [buy("T2", "u", "2024-01-01 10:00"), buy("T1", "u", "2024-01-01 10:00", 7.0),
            buy(None, "u", "2024-01-01 10:00", 9.0), buy("T1", "u", "2024-01-01 10:00", 3.0),
            buy("T3", "u", "2024-01-01 10:00", client="d")]
    got = run(spark, buys, sessions)
    assert len(got) == 5
    assert {k for k, r in got.items() if r["lc_channel"] == "Paid"} == {("T1", 3.0), ("T3", 1.0)}
    assert got["T2", 1.0]["lc_session_id"] is None and got["T2", 1.0]["fc_channel"] is None


def test_duplicate_events_collapse(spark):
    stg = spark.createDataFrame(
        [stg_row("c", "2024-01-01 10:00", "checkout_completed", txn="T", revenue=2.0)] * 5
        + [stg_row("c", "2024-01-01 10:00", "purchase", txn="T", revenue=2.0)], STG_DDL)
    buys = attribution.purchases(stg, spark.createDataFrame([("c", "u")], "client_id string, master_user_id string"))
    assert [tuple(r)[1:] for r in buys.collect()] == [("c", at("2024-01-01 10:00"), "T", 2.0, "u")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    """One user holds a third of everything; times are coarse so that ties are common."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def pick_user():
        return "hot" if rng.random() < 0.35 else f"u{rng.randrange(6)}"

    def pick_time(step):
        return start + timedelta(minutes=step * rng.randrange(20 * 24 * 60 // step))

    sessions = [(f"s{i:04d}", pick_user(), pick_time(30), rng.choice(["Paid", "Direct"]), "x", "y")
                for i in range(250)]
    buys = []
    for i in range(200):
        time, client = pick_time(15), f"c{rng.randrange(4)}"
        user = "hot" if client == "c0" else f"u-{client}" if rng.random() < 0.2 else pick_user()
        buys.append((f"{client}|{user}|{time}", f"{client}|{user}", time, f"T{i % 150}", float(i % 3), user))
    buys = list(dict.fromkeys(buys))

    by_user = defaultdict(list)
    for s in sessions:
        by_user[s[1]].append(s)
    by_pk = defaultdict(list)
    for b in buys:
        by_pk[b[0]].append(b)
    expected, counts = {}, {}
    for b in buys:
        window = [s for s in by_user[b[5]] if b[2] - timedelta(days=7) <= s[2] <= b[2]]
        if not window:
            continue
        counts[b] = len(window)
        winner = min(by_pk[b[0]], key=lambda x: (x[3], x[4])) == b
        last = max(window, key=lambda s: (s[2], s[0]))[0] if winner else None
        first = min(window, key=lambda s: (s[2], s[0]))[0] if winner else None
        expected[b[3], b[5], b[4], b[2]] = (last, first)

    buys_df = spark.createDataFrame(buys, BUYS).repartition(5)
    sessions_df = spark.createDataFrame(sessions, SESSIONS).repartition(5)
    got = {(r[0], r[1], r[2], r[3]): (r["lc_session_id"], r["fc_session_id"])
           for r in attribution.attribute(buys_df, sessions_df).collect()}
    assert got == expected and len(got) > 50
    n = {(r["purchase_pk"], r["transaction_id"], r["revenue"]): r["n_candidates"]
         for r in attribution.attribution_candidates(buys_df, sessions_df).collect()}
    assert n == {(b[0], b[3], b[4]): c for b, c in counts.items()}
    ranks = attribution.attribution_ranks(buys_df, sessions_df)
    assert ranks.count() == len({b[0] for b in counts})


def test_no_pairs_are_formed(spark):
    """Joins are on (user, hour) and (user, time) only, never on the user alone."""
    df = attribution.attribute(spark.createDataFrame([], BUYS), spark.createDataFrame([buy_ for buy_ in []], SESSIONS))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    for line in joins:
        assert line.count("=") >= 2, line


def test_purchases_and_sessions_are_shuffled_once_each_way(spark, folder):
    """One exchange onto the timeline, two for the summaries of hours, one back to purchases."""
    spark.createDataFrame([buy("T", "u", "2024-01-08 10:00:00")], BUYS).write.parquet(folder + "/b")
    spark.createDataFrame([session("a", "u", "2024-01-01 10:00:00")], SESSIONS).write.parquet(folder + "/s")
    df = attribution.attribute(spark.read.parquet(folder + "/b"), spark.read.parquet(folder + "/s"))
    for setting in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "false" if "adaptive" in setting else "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("+- Exchange ") == 4 and plan.count("ReusedExchange") == 1, plan


def test_purchase_given_twice_counts_its_sessions_once(spark):
    sessions = [session("a", "u", "2024-01-01 09:00"), session("b", "u", "2024-01-01 09:00")]
    twice = spark.createDataFrame([buy("T", "u", "2024-01-01 10:00")] * 2, BUYS)
    rows = attribution.attribution_candidates(twice, spark.createDataFrame(sessions, SESSIONS)).collect()
    assert [r["n_candidates"] for r in rows] == [2]


def test_only_hours_with_lookups_are_dealt_back(spark):
    """An hour of sessions alone is summed up for its user, but not sent on; each end gets only the credit it asks for."""
    sessions = [session(f"s{day}{hour}", "u", f"2024-01-0{day} {hour}:10") for day in (1, 2, 3) for hour in (10, 11, 12)]
    timeline = attribution._timeline(
        spark.createDataFrame([buy("T", "u", "2024-01-09 11:00")], BUYS), spark.createDataFrame(sessions, SESSIONS), 7)
    rows = attribution._carry_over(timeline).orderBy("hour_no").collect()
    assert [(r["carried_last"], r["carried_first"] and r["carried_first"]["session_id"], r["carried_starts"]) for r in rows[:1]] == [
        (None, "s212", 4)]
    assert [(r["carried_last"]["session_id"], r["carried_first"], r["carried_starts"]) for r in rows[1:]] == [("s312", None, 9)]
