"""Q8 ``pitch_status`` and Q9 ``find_offers`` / ``thread_transcript`` on the
conversation-derived mailbox, plus their operators (J6, A20, A21, W4, L1, L7, P10,
X7, X8, W7, X23, X26, X40, X41)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions.mail import age_label
from notelake.operators import threads as T
from notelake.plans import bindings as B
from notelake.plans import oracle as O
from notelake.plans.registry import register
from notelake.session import shared_path


def _since():
    return F.timestamp_add("DAY", F.lit(-B.LOOKBACK_DAYS), B.as_of())


def pitch_threads(spark, sf_dir):
    msgs = B.messages(spark, sf_dir)
    lab = T.labelled_threads(msgs, B.OFFER_LABEL, _since())
    return T.thread_summary(lab, B.OWN_ADDRESSES, B.as_of(), url_base=B.THREAD_URL)


_PITCH_SQL = O.with_ctes(O.MESSAGE_ROWS, O.THREAD_SENDERS, O.LABELLED, O.THREAD_AGG)


@register("labelled_threads", _PITCH_SQL.replace("WITH ", "WITH ", 1) + """
SELECT account, thread_id, message_id FROM messages
WHERE (account, thread_id) IN (SELECT account, thread_id FROM hits)""")
def q_labelled_threads(spark, sf_dir):
    msgs = B.messages(spark, sf_dir)
    return T.labelled_threads(msgs, B.OFFER_LABEL, _since()).select("account", "thread_id", "message_id")


@register("thread_summary", _PITCH_SQL + "SELECT * FROM summary")
def q_thread_summary(spark, sf_dir):
    return pitch_threads(spark, sf_dir)


_DEDUP = f"""
SELECT * EXCLUDE (account), account FROM summary
QUALIFY row_number() OVER (PARTITION BY thread_id
                           ORDER BY CASE account WHEN '{B.MAIN_ACCOUNT}' THEN 1 ELSE 2 END, account) = 1"""


@register("pitch_status", _PITCH_SQL + _DEDUP)
def q_pitch_status(spark, sf_dir):
    best = T.first_per_thread(pitch_threads(spark, sf_dir), B.account_ranks(spark))
    return T.order_pitches(best)


@register("pitch_positions", _PITCH_SQL + f"""
SELECT thread_id, row_number() OVER (ORDER BY status <> 'NEEDS REPLY', days_since DESC, thread_id) - 1 AS position FROM ({_DEDUP})""")
def q_pitch_positions(spark, sf_dir):
    """L1: the place of each thread in the report."""
    best = T.first_per_thread(pitch_threads(spark, sf_dir), B.account_ranks(spark))
    return T.order_pitches(best, "position").select("thread_id", "position")


@register("pitch_status_counts", _PITCH_SQL + f"""
SELECT status, count(*) AS threads FROM ({_DEDUP}) GROUP BY status""")
def q_pitch_status_counts(spark, sf_dir):
    return T.status_counts(T.first_per_thread(pitch_threads(spark, sf_dir), B.account_ranks(spark)))


@register("pitch_age_labels", _PITCH_SQL + """
SELECT account, thread_id,
       CASE WHEN days_since = 0 THEN 'today' ELSE CAST(days_since AS VARCHAR) || 'd ago' END AS age
FROM summary""")
def q_pitch_age_labels(spark, sf_dir):
    return pitch_threads(spark, sf_dir).select("account", "thread_id", age_label("days_since").alias("age"))


@register("pitch_report", _PITCH_SQL + f"SELECT thread_id, subject, status, days_since FROM ({_DEDUP})")
def q_pitch_report(spark, sf_dir):
    """K6: the report written as JSON and read back."""
    path = shared_path(spark, "report")
    T.write_report(T.first_per_thread(pitch_threads(spark, sf_dir), B.account_ranks(spark)), path)
    return spark.read.schema("thread_id string, subject string, status string, days_since long").json(path)
