"""Q1/Q2 routing and naming on the order-derived message stream:
P1-P3, P15, J4, X10, X11, W1, A1, A2, A26."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions import mail as M
from notelake.operators import history as H
from notelake.operators import naming as N
from notelake.operators import routing as R
from notelake.plans import bindings as B
from notelake.plans.registry import register
from notelake.session import shared_path

SKIP_SQL = ", ".join(f"'{s}'" for s in B.SKIP_LABELS)


def safe_name_sql(c: str, n: int) -> str:
    s = f"regexp_replace(coalesce({c}, ''), '[<>:\"/\\\\|?*\\x00-\\x1f]', '', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
    s = f"(CASE WHEN length({s}) > {n} THEN regexp_replace(substr({s}, 1, {n}), '\\s+$', '') ELSE {s} END)"
    return f"(CASE WHEN {s} = '' THEN 'untitled' ELSE {s} END)"


ORDER_MSGS_SQL = f"""
om0 AS (
  SELECT o_orderkey AS msg_id, o_orderkey::VARCHAR AS message_id,
         CASE WHEN o_orderkey % 41 <> 0 THEN o_orderpriority END AS account, [o_orderstatus, 'INBOX'] AS labels,
         CASE WHEN o_orderkey % 43 <> 0 THEN o_orderdate END AS ts, o_orderkey % 6 <> 0 AS header_dated,
         CASE WHEN o_orderkey % 9 = 0 THEN o_orderpriority || ' v1.5' ELSE o_orderpriority END AS subject,
         o_orderkey % 3 AS attachments,
         o_totalprice = floor(o_totalprice) AS failed, o_orderstatus AS status
  FROM orders
),
om AS (SELECT *, strftime(ts, '%Y-%m-%d') || '_' || {safe_name_sql('subject', 60)} AS base_name FROM om0),
existing AS (SELECT DISTINCT base_name FROM om WHERE status = 'F' AND msg_id % 2 = 0),
routed AS (
  SELECT om.*, CASE WHEN failed THEN 'errors'
                    WHEN header_dated AND base_name IN (SELECT base_name FROM existing WHERE base_name IS NOT NULL) THEN 'skipped_exists'
                    WHEN list_has_any(labels, [{SKIP_SQL}]) THEN 'skipped_label'
                    WHEN ts IS NULL THEN 'skipped_nodate'
                    ELSE 'created' END AS outcome
  FROM om
)"""


def _order_msgs(spark, sf_dir):
    m = B.order_messages(spark, sf_dir)
    return m.withColumn("base_name", M.base_name("ts", "subject"))


def routed(spark, sf_dir, dry_run=False):
    """Classified messages (written once, since counts and names both read them) and the
    existing note names."""
    m = _order_msgs(spark, sf_dir)
    existing = m.filter((F.col("status") == "F") & (F.col("msg_id") % 2 == 0) & F.col("base_name").isNotNull()).select("base_name")
    return R.classify_api(m, B.SKIP_LABELS, existing, F.col("failed"), dry_run=dry_run), existing


@register("sync_outcomes", "WITH " + ORDER_MSGS_SQL + """
SELECT msg_id, account, base_name, outcome FROM routed""")
def q_sync_outcomes(spark, sf_dir):
    """P15 (API order) with J4 against existing notes and X10/X11 base names."""
    r, _ = routed(spark, sf_dir)
    return r.select("msg_id", "account", "base_name", "outcome")


@register("sync_names", "WITH " + ORDER_MSGS_SQL + """
SELECT msg_id, base_name,
       base_name || CASE WHEN n = 0 THEN '' ELSE '_' || CAST(n AS VARCHAR) END AS unique_name
FROM (SELECT r.*, row_number() OVER (PARTITION BY r.base_name ORDER BY ts, msg_id) - 1
                  + (r.base_name IN (SELECT base_name FROM existing WHERE base_name IS NOT NULL))::INT AS n
      FROM routed r WHERE outcome = 'created')""")
def q_sync_names(spark, sf_dir):
    """Collision-free note names for created messages, seeded with existing ones."""
    r, existing = routed(spark, sf_dir)   # an undated header skips the "exists" test, so names can meet (Q17)
    created = r.filter(F.col("outcome") == "created").select("msg_id", "ts", "base_name")
    named = N.assign_unique_names(created, "base_name", ["ts", "msg_id"], existing=existing,
                                  id_col="msg_id")
    return named.select("msg_id", "base_name", "unique_name")


_STATS_SQL = """
SELECT CASE WHEN grouping(account) = 1 THEN 'TOTAL' ELSE account END AS account,
       count(*) FILTER (WHERE outcome = 'errors') AS errors,
       count(*) FILTER (WHERE outcome = 'skipped_label') AS skipped_label,
       count(*) FILTER (WHERE outcome = 'skipped_nodate') AS skipped_nodate,
       count(*) FILTER (WHERE outcome = 'skipped_exists') AS skipped_exists,
       count(*) FILTER (WHERE outcome = 'created') AS created,
       count(*) FILTER (WHERE outcome = 'would_create') AS would_create,
       count(*) AS messages,
       count(*) FILTER (WHERE outcome IN ('created', 'would_create')) AS created_total
FROM routed GROUP BY ROLLUP (account)"""


@register("sync_stats", "WITH " + ORDER_MSGS_SQL + _STATS_SQL)
def q_sync_stats(spark, sf_dir):
    """A2: per-account counters and a TOTAL row."""
    r, _ = routed(spark, sf_dir)
    return R.sync_stats(r)


@register("sync_stats_dry_run", "WITH " + ORDER_MSGS_SQL.replace("ELSE 'created' END AS outcome", "ELSE 'would_create' END AS outcome") + _STATS_SQL)
def q_sync_stats_dry_run(spark, sf_dir):
    """K8: the counters of a dry run."""
    r, _ = routed(spark, sf_dir, dry_run=True)
    return R.sync_stats(r)


@register("sync_by_id", "WITH " + ORDER_MSGS_SQL + f"""
SELECT msg_id, CASE WHEN failed THEN 'errors' WHEN header_dated AND status = 'F' AND msg_id % 2 = 0 THEN 'skipped_exists'
                    WHEN list_has_any(labels, [{SKIP_SQL}]) THEN 'skipped_label' WHEN ts IS NULL THEN 'skipped_nodate'
                    ELSE 'created' END AS outcome FROM om""")
def q_sync_by_id(spark, sf_dir):
    """J4 on the message id (Q18): mails that share date and subject are told apart."""
    m = _order_msgs(spark, sf_dir)
    known = m.filter((F.col("status") == "F") & (F.col("msg_id") % 2 == 0)).select("message_id")
    return R.classify_api(m, B.SKIP_LABELS, known, F.col("failed"), key="message_id").select("msg_id", "outcome")


@register("history_probe", "WITH " + ORDER_MSGS_SQL + """
SELECT msg_id, status = 'F' AND msg_id % 2 = 0 AS known FROM om""")
def q_history_probe(spark, sf_dir):
    """J4, J5 against a bucketed history of message ids, which is read without an exchange."""
    m = _order_msgs(spark, sf_dir)
    path = shared_path(spark, "history")
    table = "history_" + path.rsplit("-", 1)[1]
    H.save_history(m.filter((F.col("status") == "F") & (F.col("msg_id") % 2 == 0)).select("message_id"), table, ["message_id"], 8, path)
    return H.known(m, table, ["message_id"]).select("msg_id", "known")


@register("new_messages", "WITH " + ORDER_MSGS_SQL + """
SELECT msg_id FROM om WHERE NOT coalesce(base_name IN (SELECT base_name FROM existing WHERE base_name IS NOT NULL), false)""")
def q_new_messages(spark, sf_dir):
    """J4 as a filter."""
    m = _order_msgs(spark, sf_dir)
    existing = m.filter((F.col("status") == "F") & (F.col("msg_id") % 2 == 0)).select("base_name")
    return R.drop_existing(m, existing).select("msg_id")


@register("capped_listing", "WITH " + ORDER_MSGS_SQL + """
SELECT msg_id, account FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY ts DESC NULLS LAST, message_id) AS rn FROM om)
WHERE rn <= 100""")
def q_capped_listing(spark, sf_dir):
    """The latest 100 messages of each account (the limit is the feature)."""
    return R.cap_per_account(B.order_messages(spark, sf_dir), 100).select("msg_id", "account")


@register("failure_digest", "WITH " + ORDER_MSGS_SQL + f""", stats AS ({_STATS_SQL})
SELECT count(*) AS accounts_with_errors,
       string_agg(account || ': ' || CAST(errors AS VARCHAR) || ' errors', '; ' ORDER BY account) AS digest
FROM stats WHERE account IS DISTINCT FROM 'TOTAL' AND errors > 0""")
def q_failure_digest(spark, sf_dir):
    """Digest line of accounts with errors."""
    r, _ = routed(spark, sf_dir)
    return R.failure_digest(R.sync_stats(r))


_IMPORT_SQL = f"""
SELECT msg_id,
       CASE WHEN failed THEN 'errors'
            WHEN list_has_any(labels, [{SKIP_SQL}]) THEN 'skipped_label'
            WHEN ts IS NULL THEN 'skipped_nodate'
            WHEN ts < TIMESTAMP '{B.IMPORT_CUTOFF}' THEN 'skipped_old'
            ELSE 'created' END AS outcome
FROM om"""


def import_routed(spark, sf_dir):
    m = B.order_messages(spark, sf_dir)
    return R.classify_mbox(m, B.SKIP_LABELS, F.lit(B.IMPORT_CUTOFF).cast("timestamp_ntz"), F.col("failed"))


@register("import_outcomes", "WITH " + ORDER_MSGS_SQL + _IMPORT_SQL)
def q_import_outcomes(spark, sf_dir):
    """P15 (mailbox order) with the P2 cutoff."""
    return import_routed(spark, sf_dir).select("msg_id", "outcome")


@register("import_stats", "WITH " + ORDER_MSGS_SQL + f"""
SELECT outcome, count(*) AS n, sum(CASE WHEN outcome = 'created' THEN attachments ELSE 0 END)::BIGINT AS attachments
FROM ({_IMPORT_SQL}) i JOIN om USING (msg_id) GROUP BY outcome""")
def q_import_stats(spark, sf_dir):
    """A1: outcome counts of an import, with the attachments extracted."""
    return R.import_stats(import_routed(spark, sf_dir), "attachments")


@register("lookback_window", "WITH " + ORDER_MSGS_SQL + f"""
SELECT msg_id, account FROM om
WHERE ts >= TIMESTAMP '{B.SYNC_AS_OF}' - INTERVAL {B.SYNC_DAYS} DAY
  AND NOT list_has_any(labels, [{SKIP_SQL}])""")
def q_lookback_window(spark, sf_dir):
    """P3 (last N days before as_of) and P1 (label exclusion)."""
    m = B.order_messages(spark, sf_dir)
    m = R.lookback(m, "ts", F.lit(B.SYNC_AS_OF).cast("timestamp_ntz"), days=B.SYNC_DAYS)
    return R.exclude_labels(m, B.SKIP_LABELS).select("msg_id", "account")


@register("cutoff_filter", "WITH " + ORDER_MSGS_SQL + f"""
SELECT msg_id FROM om WHERE ts >= TIMESTAMP '{B.IMPORT_CUTOFF}'""")
def q_cutoff_filter(spark, sf_dir):
    """Drop messages older than the cutoff."""
    m = B.order_messages(spark, sf_dir)
    return R.since(m, "ts", F.lit(B.IMPORT_CUTOFF).cast("timestamp_ntz")).select("msg_id")
