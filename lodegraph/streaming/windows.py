"""Streaming: windowed totals of events, and orphan references kept as state between batches.

The batch operators have no streaming counterpart in what they rebuild; these are extras.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) per tumbling window; events later than `late` are left out."""
    e = events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return e.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n) of sessions that end after a pause of `gap`."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


#: Order of changes at one instant: a record is there before it is referred to, and until it is deleted.
_RANK = {"arrive": 0, "refer": 1, "delete": 2}


def pending_orphans(changes: DataFrame, shards: int = 16, horizon: str = "30 days", late: str = "1 day") -> DataFrame:
    """(key, ref_id, status, at) of a stream of (key, kind, ref_id, ts), kind in arrive, delete, refer.

    State per key and shard of references: the number of live records and the references made so far. A
    reference that finds no live record opens; an arrival resolves all that wait; the deletion of the last
    live record reopens those it held. The changes of a batch are taken in order of their time, at one
    instant in the order arrive, refer, delete; changes of an earlier time in a later batch count when they
    come, those behind the watermark are left out. `shards` divides the references of a hot key, whose
    arrivals and deletions go to every shard. A reference older than `horizon` leaves the state, as
    'expired' where it still waits, which bounds the state by the references of that span."""
    span = int(pd.Timedelta(horizon) / pd.Timedelta("1us"))
    # The session tells times apart from their zone, the state keeps plain microseconds.
    shard = F.when(F.col("kind") == "refer", F.array(F.pmod(F.xxhash64("ref_id"), F.lit(shards)))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    spread = changes.filter("key is not null and ts is not null").withWatermark("ts", late).select("key", "kind", "ref_id", "ts", F.unix_micros("ts").alias("us"), F.explode(shard).alias("shard"))

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        live, ids, times, waits = state.get if state.exists else (0, [], [], [])
        refs = [[i, t, w] for i, t, w in zip(ids, times, waits)]
        out: list[tuple] = []
        if not state.hasTimedOut:
            rows = [r for pdf in batches for r in zip(pdf["us"], pdf["kind"], pdf["ref_id"])]
            for us, kind, ref in sorted(rows, key=lambda r: (r[0], _RANK[r[1]])):
                if kind == "refer":
                    refs.append([int(ref), int(us), live == 0])
                    if live == 0:
                        out.append((int(ref), "opened", us))
                    continue
                was, live = live, live + 1 if kind == "arrive" else max(0, live - 1)
                if (was == 0) != (live == 0):
                    for r in refs:
                        r[2] = live == 0
                        out.append((r[0], "reopened" if live == 0 else "resolved", us))
        now = state.getCurrentWatermarkMs() * 1000
        if now > 0:
            out += [(i, "expired", now) for i, t, w in refs if t + span <= now and w]
            refs = [r for r in refs if r[1] + span > now]
        if not refs and live == 0:
            state.remove()
        else:
            state.update((live, [r[0] for r in refs], [r[1] for r in refs], [r[2] for r in refs]))
            if refs:
                state.setTimeoutTimestamp(max(min(r[1] for r in refs) + span, now + 1000) // 1000 + 1)
        yield pd.DataFrame([(key[0], r, s, t) for r, s, t in out], columns=["key", "ref_id", "status", "us"])

    kept = spread.groupBy("key", "shard").applyInPandasWithState(update, "key string, ref_id long, status string, us long", "live int, ids array<long>, times array<long>, waits array<boolean>", "append", GroupStateTimeout.EventTimeTimeout)
    return kept.select("key", "ref_id", "status", F.timestamp_micros("us").alias("at"))
