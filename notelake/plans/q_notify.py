"""Q7 ``notify_labelled`` on purchase events."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import notify as NT
from notelake.plans import bindings as B
from notelake.plans.registry import ORACLE, register
from notelake.session import shared_path

_OWN = ", ".join(f"'{o}'" for o in B.NOTIFY_OWN)

CANDS_SQL = f"""
cands0 AS (
  SELECT event_id, printf('%012d', event_id) AS message_id, ts, 'User ' || CAST(user_id AS VARCHAR) AS sender,
         'user' || CAST(user_id AS VARCHAR) || '@shop.example' AS sender_email,
         'Order of ' || CAST(value AS VARCHAR) AS subject, props AS snippet,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, 'shop@own.example' AS account,
         '{B.THREAD_URL}' || printf('%012d', event_id) AS url
  FROM events WHERE event_type = '{B.NOTIFY_LABEL}'
),
cands AS (
  SELECT * FROM cands0
  UNION ALL SELECT * REPLACE ('sales@own.example' AS account) FROM cands0 WHERE event_id % 7 = 0
),
posted AS (SELECT DISTINCT message_id FROM cands WHERE ts < TIMESTAMP '{B.NOTIFY_POSTED_BEFORE}'),
routed AS (
  SELECT *, CASE WHEN message_id IN (SELECT message_id FROM posted) THEN 'skipped_dup'
                 WHEN lower(sender_email) IN ({_OWN}) THEN 'skipped_self'
                 WHEN row_number() OVER (PARTITION BY message_id ORDER BY account) > 1 THEN 'skipped_dup'
                 ELSE 'posted' END AS outcome
  FROM cands
),
cut AS (SELECT max(message_id) AS cut, count(*) AS n FROM
        (SELECT message_id FROM routed WHERE outcome = 'posted' ORDER BY message_id LIMIT {B.NOTIFY_LIMIT})),
consumed AS (SELECT r.* FROM routed r, cut WHERE cut.n < {B.NOTIFY_LIMIT} OR r.message_id <= cut.cut)"""


def routed(spark, sf_dir):
    return NT.route_candidates(B.notify_candidates(spark, sf_dir), B.notify_posted_before(spark, sf_dir),
                               B.NOTIFY_OWN)


@register("notify_outcomes", "WITH " + CANDS_SQL + " SELECT message_id, account, outcome FROM routed")
def q_notify_outcomes(spark, sf_dir):
    """J5 (already posted, tested first; the same id twice), P5 (own sender), A22 routing."""
    return NT.order_candidates(routed(spark, sf_dir).select("message_id", "account", "outcome"))


_COUNTS = """
SELECT count(*) FILTER (WHERE outcome = 'posted' AND NOT failed) AS posted,
       count(*) FILTER (WHERE outcome = 'skipped_dup') AS skipped_dup,
       count(*) FILTER (WHERE outcome = 'skipped_self') AS skipped_self,
       count(*) FILTER (WHERE outcome = 'posted' AND failed) AS errors
FROM (SELECT *, event_id % 101 = 0 AS failed FROM {})"""


def _failed():
    return F.col("message_id").cast("long") % 101 == 0


@register("notify_stats", "WITH " + CANDS_SQL + _COUNTS.format("routed"))
def q_notify_stats(spark, sf_dir):
    """A22 over the whole run; every 101st delivery stands for a failed one."""
    return NT.notify_stats(NT.take_posts(routed(spark, sf_dir)), _failed())


@register("notify_stats_limited", "WITH " + CANDS_SQL + _COUNTS.format("consumed"))
def q_notify_stats_limited(spark, sf_dir):
    """The counters of the prefix consumed before the post limit (the limit is the feature)."""
    return NT.notify_stats(NT.take_posts(routed(spark, sf_dir), B.NOTIFY_LIMIT), _failed())


def _ell(c: str, n: int) -> str:
    return f"(CASE WHEN length({c}) > {n} THEN substr({c}, 1, {n - 1}) || '…' ELSE {c} END)"


@register("notify_payloads", "WITH " + CANDS_SQL + f"""
SELECT message_id,
       ':bell: ' || {_ell("coalesce(nullif(subject, ''), '(no subject)')", 140)} AS header,
       '*From*' || chr(10) || {_ell("coalesce(nullif(sender, ''), 'unknown')", 80)} || chr(10) || '`'
         || coalesce(sender_email, '') || '`' AS from_field,
       '*Inbox*' || chr(10) || account AS inbox_field,
       CASE WHEN coalesce(snippet, '') <> '' THEN '_' || {_ell('snippet', 300)} || '_' END AS snippet_block,
       ':calendar: ' || coalesce(date, '') || '  •  <' || url || '|Open in mail>' AS context
FROM routed WHERE outcome = 'posted'""")
def q_notify_payloads(spark, sf_dir):
    """R6 + X9: the texts of every message posted in this run."""
    c = routed(spark, sf_dir)
    return NT.notification_payload(c.filter(F.col("outcome") == NT.POST), **NT.SHOWN)


@register("notify_outbox", "WITH " + CANDS_SQL + """
SELECT message_id, to_json({'blocks': list_filter([
    json_object('type', 'header', 'text', json_object('type', 'plain_text', 'text', ':bell: ' || subject, 'emoji', true)),
    json_object('type', 'section', 'fields', json_array(
        json_object('type', 'mrkdwn', 'text', '*From*' || chr(10) || sender || chr(10) || '`' || sender_email || '`'),
        json_object('type', 'mrkdwn', 'text', '*Inbox*' || chr(10) || account))),
    CASE WHEN coalesce(snippet, '') <> '' THEN
        json_object('type', 'section', 'text', json_object('type', 'mrkdwn', 'text', '_' || snippet || '_')) END,
    json_object('type', 'context', 'elements', json_array(json_object('type', 'mrkdwn',
        'text', ':calendar: ' || date || '  •  <' || url || '|Open in mail>')))], lambda b: b IS NOT NULL)})::VARCHAR AS payload
FROM routed WHERE outcome = 'posted'""")
def q_notify_outbox(spark, sf_dir):
    """K4: one nested JSON document per posted message, whole texts."""
    c = routed(spark, sf_dir).filter(F.col("outcome") == NT.POST)
    return NT.payload_json(NT.notification_payload(c))


_OUTBOX = ORACLE["notify_outbox"]


@register("notify_outbox_lines", f"SELECT payload FROM ({_OUTBOX})")
def q_notify_outbox_lines(spark, sf_dir):
    """K4: the outbox written as lines and read back."""
    path = shared_path(spark, "outbox")
    NT.write_outbox(NT.notification_payload(routed(spark, sf_dir).filter(F.col("outcome") == NT.POST)), path)
    return spark.read.text(path).select(F.col("value").alias("payload"))


@register("notify_positions", "WITH " + CANDS_SQL + """
SELECT message_id, account, row_number() OVER (ORDER BY message_id, account) - 1 AS position FROM routed""")
def q_notify_positions(spark, sf_dir):
    """L2: the place of each candidate in the run."""
    return NT.order_candidates(routed(spark, sf_dir).select("message_id", "account"), "position")


@register("notify_state", "WITH " + CANDS_SQL + f"""
SELECT message_id, TIMESTAMP '{B.AS_OF}' AS last_run FROM (
  SELECT message_id FROM posted UNION SELECT message_id FROM routed WHERE outcome = 'posted')""")
def q_notify_state(spark, sf_dir):
    """K5: all ids posted after the run, with the time of the run."""
    c = routed(spark, sf_dir).filter(F.col("outcome") == NT.POST)
    return NT.write_state(B.notify_posted_before(spark, sf_dir), c, B.as_of())
