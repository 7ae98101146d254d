"""Gap-based sessionisation that does not put one user's events in one task.

A plain ``lag(ts) over (partition by user order by ts)`` sorts all events of
a user in a single task; a user with a third of all events would stall the
job. Here the time line of a user with more than ``rows_per_part`` events is cut
at quantiles of that user's own event times, so a burst inside an hour is cut
where it is dense; other users have one bucket. One count per user tells whether
any cut is needed; then:

* the gap test between neighbours of one bucket runs in a window
  partitioned by ``(user, bucket)``;
* whether a bucket's first event starts a session, and the latest start
  before a bucket, come from a per-``(user, bucket)`` aggregate (one row per
  bucket, not per event) and a window over those rows;
* the session an event belongs to is identified by the ``(ts, event_id)`` of
  its starting event: the latest start inside the bucket, else the bucket's
  first event if it starts one, else the start carried from earlier buckets.

A session is "new" when there is no earlier event of the user or the event is
more than ``gap_seconds`` after the previous one (ties ordered by id).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import epoch_micros
from tessera.session import written

DEFAULT_GAP_SECONDS = 6 * 3600
# Events of one user that a window partition holds, about: any number gives the same sessions.
ROWS_PER_PART = 200_000
QUANTILE_ACCURACY = 10_000


def _with_buckets(ev: DataFrame, user: str, rows_per_part: int) -> tuple[DataFrame, bool]:
    """Add ``_b``: the number of the user's time cuts up to the event (0 for users that need none); and whether any user is cut.

    The cuts of all heavy users come from one aggregate over their events; the
    table of cuts has a row per heavy user and is joined as its size allows
    (AQE broadcasts it, or splits the heavy users' side of the join).
    """
    per_user = ev.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    most = per_user.agg(F.max("_n")).first()[0] or 0
    if most <= rows_per_part:
        return ev.withColumn("_b", F.lit(0)), False
    parts = -(-most // rows_per_part)
    heavy = per_user.where(F.col("_n") > rows_per_part).select(F.col(user).alias("_heavy"))
    grid = [i / parts for i in range(1, parts)]
    cuts = written(ev.join(heavy, F.col(user).eqNullSafe(F.col("_heavy")), "left_semi").groupBy(F.col(user).alias("_heavy"))
                   .agg(F.percentile_approx("_us", grid, max(QUANTILE_ACCURACY, 10 * parts)).alias("_cuts")), "session-cuts")
    joined = ev.join(cuts, F.col(user).eqNullSafe(F.col("_heavy")), "left")
    before = F.size(F.filter("_cuts", lambda c: c <= F.col("_us")))
    return joined.withColumn("_b", F.coalesce(before, F.lit(0))).drop("_heavy", "_cuts"), True


def _within_cuts(events: DataFrame, user: str, ts: str, tie: str, gap_seconds: int,
                 rows_per_part: int) -> tuple[DataFrame, int, bool]:
    """(events with the latest session start seen inside their bucket, the gap in microseconds, whether any user is cut)."""
    gap_us = int(gap_seconds * 1_000_000)
    ev, cut = _with_buckets(events.withColumn("_us", epoch_micros(events, ts)), user, rows_per_part)
    key = F.struct(F.col("_us").alias("us"), F.col(tie).alias("id"))
    in_bucket = Window.partitionBy(user, "_b").orderBy("_us", tie)
    running = in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag("_us").over(in_bucket)
    inner = ev.withColumn("_inner_start", F.when(prev.isNotNull() & (F.col("_us") - prev > F.lit(gap_us)), key))
    return inner.withColumn("_inner_last", F.max("_inner_start").over(running)), gap_us, cut


def _within_buckets(events: DataFrame, user: str, ts: str, tie: str, gap_seconds: int,
                    rows_per_part: int) -> tuple[DataFrame, int]:
    """(events with the latest session start seen inside their bucket, the gap in microseconds)."""
    return _within_cuts(events, user, ts, tie, gap_seconds, rows_per_part)[:2]


def _bucketed(events: DataFrame, user: str, ts: str, tie: str, gap_seconds: int,
              rows_per_part: int) -> tuple[DataFrame, DataFrame]:
    """(events with in-bucket start info, one row per (user, bucket) with the
    bucket's own first start if any and the start carried from earlier buckets)."""
    inner, gap_us = _within_buckets(events, user, ts, tie, gap_seconds, rows_per_part)
    key = F.struct(F.col("_us").alias("us"), F.col(tie).alias("id"))
    per_bucket = inner.groupBy(user, "_b").agg(
        F.min(key).alias("_first"), F.max("_us").alias("_last_us"), F.max("_inner_start").alias("_inner_max"))
    carry_w = Window.partitionBy(user).orderBy("_b")
    prev_last = F.lag("_last_us").over(carry_w)
    first_new = prev_last.isNull() | (F.col("_first.us") - prev_last > F.lit(gap_us))
    buckets = (per_bucket
               .withColumn("_first_start", F.when(first_new, F.col("_first")))
               .withColumn("_bucket_last_start", F.coalesce("_inner_max", "_first_start")))
    buckets = buckets.select(
        user, "_b", "_first_start",
        F.max("_bucket_last_start").over(carry_w.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    return inner, buckets


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", tie: str = "event_id",
               gap_seconds: int = DEFAULT_GAP_SECONDS, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Add ``session_start_us`` / ``session_start_id`` (the key of the session's
    first event) and ``new_session`` to every event.

    One window pass over the events, partitioned by ``(user, bucket)``, finds
    the starts that are visible inside a bucket (gap to the previous event of
    the same bucket). A per-``(user, bucket)`` aggregate over that same
    partitioning keeps the bucket's first event, last event and last inner
    start; a window over those per-bucket rows decides whether each bucket's
    first event starts a session and carries the latest start forward. One
    join brings the carry back.
    """
    inner, buckets = _bucketed(events, user, ts, tie, gap_seconds, rows_per_part)
    out = inner.join(buckets, [user, "_b"], "left").withColumn(
        "_start", F.coalesce("_inner_last", "_first_start", "_carry"))
    return (out.withColumn("session_start_us", F.col("_start.us"))
            .withColumn("session_start_id", F.col("_start.id"))
            .withColumn("new_session", (F.col("_start.us") == F.col("_us")) & (F.col("_start.id") == F.col(tie)))
            .drop("_start", "_carry", "_first_start", "_inner_start", "_inner_last", "_b", "_us"))


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", tie: str = "event_id",
             gap_seconds: int = DEFAULT_GAP_SECONDS, rows_per_part: int = ROWS_PER_PART,
             sums: dict[str, Column] | None = None, sets: dict[str, Column] | None = None) -> DataFrame:
    """One row per session: user, session_start, session_end, n_events, duration_us.

    ``sums`` / ``sets`` add, per session, the sum of an event expression or the
    distinct values of one. Events are read and sorted once: inside the
    ``(user, bucket)`` partitioning they are reduced to the pieces of sessions
    within a bucket (which are the sessions if no user is cut) and those to one row per
    bucket (its pieces in an array, no more than the events of a bucket). Only bucket rows are shuffled by
    user, where one window finds which bucket opens a session and carries the
    latest start forward.
    """
    sums, sets = sums or {}, sets or {}
    inner, gap_us, cut = _within_cuts(events, user, ts, tie, gap_seconds, rows_per_part)
    key = F.struct(F.col("_us").alias("us"), F.col(tie).alias("id"))
    pieces = inner.groupBy(user, "_b", "_inner_last").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), F.min(key).alias("first"),
        F.max("_us").alias("max_us"), *[F.sum(e).alias(k) for k, e in sums.items()],
        *[F.collect_set(e).alias(k) for k, e in sets.items()])
    if not cut:  # every user has one bucket, so the pieces are the sessions
        return pieces.select(user, F.col("min_ts").alias("session_start"), F.col("max_ts").alias("session_end"), F.col("n").alias("n_events"),
                             (F.col("max_us") - F.col("first.us")).alias("duration_us"), *sums, *sets)
    own = ["n", "min_ts", "max_ts", "max_us", *sums, *sets]
    buckets = pieces.groupBy(user, "_b").agg(
        F.min("first").alias("_first"), F.max("max_us").alias("_last_us"), F.max("_inner_last").alias("_inner_max"),
        F.collect_list(F.struct("_inner_last", F.col("first.us").alias("min_us"), *own)).alias("_pieces"))
    carry_w = Window.partitionBy(user).orderBy("_b")
    prev_last = F.lag("_last_us").over(carry_w)
    opens = prev_last.isNull() | (F.col("_first.us") - prev_last > F.lit(gap_us))
    opened = (buckets.withColumn("_first_start", F.when(opens, F.col("_first")))
              .withColumn("_latest", F.coalesce("_inner_max", "_first_start")))
    carried = opened.withColumn("_carry", F.max("_latest").over(carry_w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = carried.select(user, "_first_start", "_carry", F.explode("_pieces").alias("p")).select(
        user, F.coalesce("p._inner_last", "_first_start", "_carry").alias("_start"), "p.min_us",
        *[F.col(f"p.{c}").alias(c) for c in own])
    return (rows.groupBy(user, "_start")
            .agg(F.min("min_ts").alias("session_start"), F.max("max_ts").alias("session_end"),
                 F.sum("n").alias("n_events"), (F.max("max_us") - F.min("min_us")).alias("duration_us"),
                 *[F.sum(k).alias(k) for k in sums],
                 *[F.array_distinct(F.flatten(F.collect_list(k))).alias(k) for k in sets])
            .drop("_start"))


def behavior_from_events(events: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Per-user behaviour table from a click stream (user_id, ts, event_type).

    avg_session_duration (minutes), pages_per_session (events per session),
    bounce_rate (share of one-event sessions), cart_abandonment_rate
    (1 - purchases / (purchases + views)), email_open_rate (click share),
    social_media_engagement (signups), support_tickets (errors),
    product_categories_visited (distinct event types). The event counts ride on
    the sessions, so the events are scanned once.
    """
    et = F.col("event_type")
    kinds = {"_purchases": "purchase", "_views": "view", "_clicks": "click", "_signups": "signup", "_errors": "error"}
    s = sessions(events, gap_seconds=gap_seconds,
                 sums={k: F.when(et == v, 1).otherwise(0) for k, v in kinds.items()}, sets={"_types": et})
    out = s.groupBy("user_id").agg(
        F.sum("n_events").alias("n_events"), F.count(F.lit(1)).alias("n_sessions"),
        (F.avg("duration_us") / F.lit(60e6)).alias("avg_session_duration"),
        F.avg(F.col("n_events").cast("double")).alias("pages_per_session"),
        (F.count_if(F.col("n_events") == 1) / F.count(F.lit(1))).alias("bounce_rate"),
        *[F.sum(k).alias(k) for k in kinds], F.array_distinct(F.flatten(F.collect_list("_types"))).alias("_types"))
    cart = F.lit(1.0) - F.try_divide(F.col("_purchases").cast("double"),
                                     (F.col("_purchases") + F.col("_views")).cast("double"))
    return out.select(
        F.col("user_id").alias("customer_id"), "n_events", "n_sessions", "avg_session_duration",
        "pages_per_session", "bounce_rate", cart.alias("cart_abandonment_rate"),
        (F.col("_clicks") / F.col("n_events")).alias("email_open_rate"),
        F.col("_signups").alias("social_media_engagement"), F.col("_errors").alias("support_tickets"),
        F.size("_types").cast("long").alias("product_categories_visited"))
