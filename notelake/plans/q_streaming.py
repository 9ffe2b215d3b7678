"""Streaming jobs (T1-T4), each registered with the batch SQL of the same result.

Every query writes its table to the shared folder in two random halves of several files, runs the
job after each, runs it once more on nothing new, and replays all files under a new checkpoint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions.mail import base_name
from notelake.operators import threads as T
from notelake.plans import bindings as B
from notelake.plans import oracle as O
from notelake.plans.q_calendar import PLAN_SQL
from notelake.plans.registry import register
from notelake.session import read_table, shared_path
from notelake.streaming import jobs as S


def two_runs(spark, df, key: str, run):
    """The result of ``run(stream, ckpt)`` after two arrivals, an empty run and a replay."""
    path, ckpt = shared_path(spark, "stream-in"), shared_path(spark, "stream-ckpt")
    half = F.pmod(F.xxhash64(key), F.lit(2))
    for k in (0, 1):
        df.filter(half == k).repartition(2).write.mode("append").parquet(path)
        run(S.table_stream(spark, path, df.schema, max_files=1), ckpt)
    run(S.table_stream(spark, path, df.schema, max_files=1), ckpt)
    return run(S.table_stream(spark, path, df.schema), ckpt + "-replay")


@register("stream_notify_once", f"""
SELECT printf('%012d', event_id) AS message_id, user_id FROM events WHERE event_type = '{B.NOTIFY_LABEL}'""")
def q_stream_notify_once(spark, sf_dir):
    """One notification per message id over several runs and a replay."""
    out = shared_path(spark, "stream-notify")

    def run(stream, ckpt):
        s = stream.filter(F.col("event_type") == B.NOTIFY_LABEL).select(F.format_string("%012d", "event_id").alias("message_id"), "user_id")
        return S.stream_notify(s, out, ckpt)

    return two_runs(spark, read_table(spark, sf_dir, "events"), "event_id", run)


_ALL_THREADS = O.with_ctes(O.MESSAGE_ROWS, O.THREAD_SENDERS) + """,
hits AS (SELECT DISTINCT account, thread_id FROM messages),""" + O.THREAD_AGG


@register("stream_thread_summary", _ALL_THREADS + " SELECT * FROM summary")
def q_stream_thread_summary(spark, sf_dir):
    """T4: A20 of both accounts over a stream of conversation turns, equal to the batch summary."""
    out = shared_path(spark, "stream-threads")

    def run(stream, ckpt):
        both = F.explode(F.array(F.lit(B.MAIN_ACCOUNT), F.lit(B.ALT_ACCOUNT)))
        rows = B._message_rows(stream).withColumn("account", both)
        return S.stream_latest(T.thread_summary(rows, B.OWN_ADDRESSES, B.as_of(), url_base=B.THREAD_URL),
                               ["account", "thread_id"], out, ckpt)

    return two_runs(spark, read_table(spark, sf_dir, "conversations"), "turn", run)


@register("stream_sync_new", """
WITH om AS (SELECT o_orderkey, o_orderstatus,
                   strftime(o_orderdate, '%Y-%m-%d') || '_' || o_orderpriority AS base_name FROM orders)
SELECT o_orderkey, base_name FROM om
WHERE o_orderstatus <> 'F' AND base_name NOT IN (SELECT base_name FROM om WHERE o_orderstatus = 'F')""")
def q_stream_sync_new(spark, sf_dir):
    """Streamed sync of open orders as messages, skipping base names that
    already exist as notes (the finished orders' names) and messages written before."""
    o = read_table(spark, sf_dir, "orders")
    existing = o.filter(F.col("o_orderstatus") == "F").select(base_name("o_orderdate", "o_orderpriority").alias("base_name"))
    out = shared_path(spark, "stream-sync")

    def run(stream, ckpt):
        rows = stream.filter(F.col("o_orderstatus") != "F").select("o_orderkey", base_name("o_orderdate", "o_orderpriority").alias("base_name"))
        return S.stream_sync(rows, existing, out, ckpt, key=["o_orderkey"])

    return two_runs(spark, o, "o_orderkey", run)


@register("stream_calendar", "WITH " + PLAN_SQL + """,
last AS (SELECT title, day, arg_max(description, {'sheet': sheet, 'row': row, 'col': col_pos}) AS description
         FROM ev WHERE NOT stale GROUP BY title, day)
SELECT title, strftime(day, '%Y-%m-%d') AS day, description FROM last
UNION ALL SELECT title, strftime(day, '%Y-%m-%d'), description FROM ex WHERE (title, day) NOT IN (SELECT (title, day) FROM last)""")
def q_stream_calendar(spark, sf_dir):
    """Sheets re-synced as their rows arrive, equal to the batch calendar."""
    out = shared_path(spark, "stream-calendar")

    def run(stream, ckpt):
        return S.stream_calendar(stream, B.existing_events(spark, sf_dir), out, ckpt, F.lit(B.CAL_NOW).cast("timestamp_ntz"),
                                 B.calendar_rules(spark), B.CAL_TAG, B.CAL_SOURCE)

    got = two_runs(spark, B.sheet_rows(spark, sf_dir), "row", run)
    return got.select("title", F.date_format("day", "yyyy-MM-dd").alias("day"), "description")
