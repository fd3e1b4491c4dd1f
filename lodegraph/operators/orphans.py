"""References to records that do not exist, kept as keyed pending-orphan state.

Every key carries a small state: how many records answer to it at all, how many have arrived and how
many of those are live. Arrivals and deletions move the state, references probe it at their own time.
The state is snapshotted at the start of every period in which a key has events, so that one key's
timeline is worked on in many tasks: (key, period) is the unit of work, and only one pre-aggregated row
per key and period takes part in the running totals over the whole timeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.session import clean_key

#: Length of the periods between two snapshots of the keyed state.
SNAPSHOT_PERIOD = "day"
#: Events of one key and period beyond which that period is divided, and into what.
HOT_EVENTS, HOT_PERIOD = 1_000_000, "minute"


def parent_rows(df: DataFrame, keys: list[str], arrived: str, gone: str | None = None) -> DataFrame:
    """(space-free key, arrived, gone) of every key that a record answers to."""
    ks = F.array_distinct(F.filter(F.array(*[clean_key(k) for k in keys]), lambda k: k.isNotNull()))
    return df.select(
        F.explode(ks).alias("key"),
        F.col(arrived).alias("arrived"),
        (F.col(gone) if gone else F.lit(None).cast("timestamp")).alias("gone"),
    )


def references(df: DataFrame, table: str, row_id: str, key: str, at: str) -> DataFrame:
    """(ref_table, row_id, key, at) of the references that are neither null nor blank."""
    return df.select(F.lit(table).alias("ref_table"), F.col(row_id).cast("long").alias("row_id"), clean_key(key).alias("key"), F.col(at).alias("at")).filter("key is not null")


def _parent_events(parents: DataFrame) -> DataFrame:
    """A record arrives (+1 arrived, +1 live) and is gone (-1 live); gone before it arrives, it never lives.

    Pre-aggregated by key and instant, so that copies of a record are one event."""
    moves = F.array(
        F.struct(F.col("arrived").alias("ts"), F.lit(1).alias("d_arrived"), F.lit(1).alias("d_live")),
        F.when(F.col("gone").isNotNull(), F.struct(F.greatest("arrived", "gone").alias("ts"), F.lit(0).alias("d_arrived"), F.lit(-1).alias("d_live"))),
    )
    return (
        parents.filter("arrived is not null")
        .select("key", F.explode(moves).alias("m"))
        .filter("m is not null")
        .select("key", "m.*")
        .groupBy("key", "ts")
        .agg(F.sum("d_arrived").alias("d_arrived"), F.sum("d_live").alias("d_live"))
    )


def running_totals(points: DataFrame, moves: DataFrame, values: list[str], period: str = SNAPSHOT_PERIOD, inclusive: bool = True, hot_events: int | None = None) -> DataFrame:
    """Points (key, ts, point) with the totals of the moves (key, ts, values) of their key up to their time.

    inclusive: a move at the very time of a point counts. The totals are snapshotted at the start of every
    period in which a key has points; (key, period) is what one task works on, and only one pre-aggregated
    row per key and period enters the running totals of the key's whole timeline. A period in which a key
    has more than `hot_events` (HOT_EVENTS) events is divided into minutes; such periods are at most as many as the
    events divided by that number, so they are broadcast."""
    at = F.coalesce("ts", F.timestamp_seconds(F.lit(-62135596800)))
    bucket: Column = F.date_trunc(period, at)
    zero = [F.lit(0).cast("long").alias(v) for v in values]
    kind = points.schema["point"].dataType
    events = moves.select("key", "ts", F.lit(1).alias("rank"), *[F.col(v).cast("long").alias(v) for v in values], F.lit(None).cast(kind).alias("point")).unionByName(
        points.select("key", "ts", F.lit(2 if inclusive else 0).alias("rank"), *zero, "point")
    )
    events = events.withColumn("bucket", bucket)
    hot = events.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > (HOT_EVENTS if hot_events is None else hot_events)).select("key", "bucket", F.lit(True).alias("hot"))
    events = events.join(F.broadcast(hot), ["key", "bucket"], "left").withColumn("bucket", F.when(F.col("hot"), F.date_trunc(HOT_PERIOD, at)).otherwise(F.col("bucket"))).drop("hot")
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = events.groupBy("key", "bucket").agg(*[F.sum(v).alias(v) for v in values], F.count("point").alias("n_points"))
    snapshots = per.select("key", "bucket", "n_points", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"snap_{v}") for v in values]).filter("n_points > 0").drop("n_points")
    w = Window.partitionBy("key", "bucket").orderBy("ts", "rank").rowsBetween(Window.unboundedPreceding, 0)
    inside = events.withColumns({f"in_{v}": F.sum(v).over(w) for v in values}).filter("point is not null")
    return inside.join(snapshots, ["key", "bucket"]).select("key", "ts", "point", *[(F.col(f"snap_{v}") + F.col(f"in_{v}")).alias(v) for v in values])


def probe(refs: DataFrame, parents: DataFrame, period: str = SNAPSHOT_PERIOD) -> DataFrame:
    """Every reference with its state: refs' columns + n_known, n_arrived, n_live.

    parents: key, arrived, gone. refs: at least key and at. A null time of a reference sees nothing
    arrived; a record without arrival time is known but never arrives. Columns of `refs` besides key and
    at pass through unchanged, whatever their names, as they travel in one struct."""
    points = refs.select("key", F.col("at").alias("ts"), F.struct(*refs.columns).alias("point"))
    known = parents.groupBy("key").agg(F.count(F.lit(1)).alias("n_known"))
    seen = running_totals(points, _parent_events(parents), ["d_arrived", "d_live"], period)
    at_all = F.col("ts").isNotNull()
    return seen.join(known, "key", "left").select(
        "point.*", F.coalesce("n_known", F.lit(0)).alias("n_known"), F.when(at_all, F.col("d_arrived")).otherwise(0).alias("n_arrived"), F.when(at_all, F.col("d_live")).otherwise(0).alias("n_live")
    )


def orphan_references(refs: DataFrame, parents: DataFrame, period: str = SNAPSHOT_PERIOD) -> DataFrame:
    """References without a live record at their time, with reason and month.

    reason: missing = nothing answers to the key at all; late = something does, nothing has arrived;
    deleted = all that arrived is gone. A reference without time counts as missing or late, its period
    is null."""
    return (
        probe(refs, parents, period)
        .filter("n_live <= 0")
        .withColumns(
            {
                "reason": F.when(F.col("n_known") == 0, "missing").when(F.col("n_arrived") == 0, "late").otherwise("deleted"),
                "period": F.date_format("at", "yyyy-MM"),
            }
        )
        .drop("n_known", "n_arrived", "n_live")
    )


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month and reason."""
    return orphans.groupBy("ref_table", "period", "reason").agg(F.count(F.lit(1)).alias("n_orphans"))


def pending_by_month(refs: DataFrame, parents: DataFrame, period: str = SNAPSHOT_PERIOD) -> DataFrame:
    """Snapshots of the pending orphans: references opened, resolved, reopened and still pending per month.

    A reference opens when it finds no live record at its time, is resolved when a record of its key
    comes to life and reopened when the last live one goes. A change of a key's state counts the references
    made before it by running totals, so no reference meets another one. Null times are left out."""
    timed = refs.filter("at is not null")
    opened = probe(timed, parents, period).filter("n_live <= 0").groupBy("ref_table", F.date_format("at", "yyyy-MM").alias("period")).agg(F.count(F.lit(1)).alias("opened"))
    moves = _parent_events(parents)
    line = Window.partitionBy("key").orderBy("ts")
    state = moves.withColumn("live", F.sum("d_live").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("was", F.coalesce(F.lag("live").over(line), F.lit(0)))
    flips = state.filter("(live > 0) <> (was > 0)").select("key", "ts", (F.col("live") > 0).alias("lives"))
    # The totals are kept per key and referring table.
    made = timed.groupBy("key", "ref_table", F.col("at").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    both = F.concat_ws("|", "ref_table", "key").alias("key")
    points = flips.join(made.select("key", "ref_table").distinct(), "key").select(both, "ts", F.struct("ref_table", "lives").alias("point"))
    changed = running_totals(points, made.select(both, "ts", "n"), ["n"], period, inclusive=False)
    turned = changed.groupBy("point.ref_table", F.date_format("ts", "yyyy-MM").alias("period")).agg(
        F.sum(F.when(F.col("point.lives"), F.col("n")).otherwise(0)).alias("resolved"), F.sum(F.when(F.col("point.lives"), 0).otherwise(F.col("n"))).alias("reopened")
    )
    per = opened.join(turned, ["ref_table", "period"], "full_outer").na.fill(0, ["opened", "resolved", "reopened"])
    run = Window.partitionBy("ref_table").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("pending", F.sum(F.col("opened") - F.col("resolved") + F.col("reopened")).over(run))
