"""Mail scalars (X1, X2, X4, X9, X21, X24, X25, X40) and Q9 (offers, transcript)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions import mail as M
from notelake.operators import threads as T
from notelake.plans import bindings as B
from notelake.plans import oracle as O
from notelake.plans.registry import register

_MODES = ("mbox", "api", "slack", "thread")


def _sender_cols_sql():
    out = []
    for m in _MODES:
        n, a = O.sender_sql("from_str", m)
        out.append(f"{n} AS {m}_name, {a} AS {m}_address")
    return ",\n  ".join(out)


@register("sender_parts", O.with_ctes(O.SENDERS) + f"""
SELECT id, from_str,
  {_sender_cols_sql()},
  {O.email_domain_sql('from_str')} AS domain
FROM senders""")
def q_sender_parts(spark, sf_dir):
    """X1 in all four modes and X2 over every customer-derived From string."""
    s = B.senders(spark, sf_dir)
    cols = []
    for m in _MODES:
        p = M.split_sender("from_str", m)
        cols += [p["name"].alias(f"{m}_name"), p["address"].alias(f"{m}_address")]
    return s.select("id", "from_str", *cols, M.email_domain("from_str").alias("domain"))


@register("header_lookup", O.with_ctes(O.MESSAGE_ROWS) + """
, h AS (
  SELECT account, message_id,
         [{'name': 'From', 'value': from_hdr}, {'name': 'subject', 'value': subject},
          {'name': 'Subject', 'value': 'second ' || message_id}] AS headers
  FROM messages
)
SELECT account, message_id,
       coalesce(list_filter(headers, lambda x: lower(x.name) = 'subject')[1].value, '') AS subject_api,
       list_filter(headers, lambda x: x.name = 'Subject')[-1].value AS subject_exact,
       coalesce(list_filter(headers, lambda x: lower(x.name) = 'to')[1].value, '') AS to_api
FROM h""")
def q_header_lookup(spark, sf_dir):
    """Case-insensitive first-wins lookup against exact-case last-wins lookup."""
    m = B.messages(spark, sf_dir)
    hv = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    h = m.select("account", "message_id", F.array(
        hv("From", F.col("from_hdr")), hv("subject", F.col("subject")),
        hv("Subject", F.concat(F.lit("second "), F.col("message_id")))).alias("headers"))
    return h.select("account", "message_id",
                    M.header("headers", "Subject", "api").alias("subject_api"),
                    M.header("headers", "Subject", "exact").alias("subject_exact"),
                    M.header("headers", "To", "api").alias("to_api"))


@register("message_dates", O.with_ctes(O.MESSAGE_ROWS) + f"""
SELECT account, message_id, date_hdr,
       {O.mail_date_sql('date_hdr')} AS header_ts,
       coalesce({O.mail_date_sql('date_hdr')}, epoch_ms(internal_ms)) AS message_ts,
       CASE WHEN coalesce({O.mail_date_sql('date_hdr')}, epoch_ms(internal_ms)) IS NULL
            THEN 'skipped_nodate' ELSE 'dated' END AS date_outcome
FROM messages""")
def q_message_dates(spark, sf_dir):
    """X24 header date parsing and X25 fallback to internalDate."""
    m = B.messages(spark, sf_dir)
    ts = M.message_ts("date_hdr", F.col("internal_ms").cast("string"))
    return m.select("account", "message_id", "date_hdr",
                    M.parse_mail_date("date_hdr").alias("header_ts"),
                    ts.alias("message_ts"),
                    F.when(ts.isNull(), "skipped_nodate").otherwise("dated").alias("date_outcome"))


_OFFERS_SQL = O.with_ctes(O.MESSAGE_ROWS, O.THREAD_SENDERS, O.LABELLED) + f""",
oagg AS (
  SELECT account, thread_id,
         arg_min_null(subject, k) AS first_subject,
         arg_min_null(s_name, k) AS first_name, arg_min_null(s_addr, k) AS first_addr,
         arg_min_null(s_name, k) FILTER (WHERE NOT own) AS ext_name,
         arg_min_null(s_addr, k) FILTER (WHERE NOT own) AS ext_addr,
         count(*) FILTER (WHERE NOT own) AS n_ext,
         max(internal_ms) AS last_ms
  FROM snd2 WHERE (account, thread_id) IN (SELECT account, thread_id FROM hits)
  GROUP BY account, thread_id
),
offers AS (
  SELECT thread_id, coalesce(first_subject, '(no subject)') AS subject,
         CASE WHEN n_ext > 0 THEN ext_name ELSE first_name END AS brand,
         CASE WHEN n_ext > 0 THEN ext_addr ELSE first_addr END AS brand_email,
         CAST(floor(date_diff('second', epoch_ms(last_ms), TIMESTAMP '{B.AS_OF}') / 86400) AS BIGINT) AS days_since,
         account
  FROM oagg
  QUALIFY row_number() OVER (PARTITION BY thread_id
                             ORDER BY CASE account WHEN '{B.MAIN_ACCOUNT}' THEN 1 ELSE 2 END, account) = 1
)
"""


def offers(spark, sf_dir):
    msgs = B.messages(spark, sf_dir)
    since = F.timestamp_add("DAY", F.lit(-B.LOOKBACK_DAYS), B.as_of())
    lab = T.labelled_threads(msgs, B.OFFER_LABEL, since)
    summ = T.offer_summary(lab, B.OWN_ADDRESSES, B.as_of())
    return T.first_per_thread(summ, B.account_ranks(spark))


@register("find_offers", _OFFERS_SQL + "SELECT * FROM offers")
def q_find_offers(spark, sf_dir):
    """Q9 list: open offers, one per thread, first account wins."""
    return offers(spark, sf_dir)


MATCH_TERM = "Offer 1"


@register("match_offers", _OFFERS_SQL + f"""
SELECT * FROM offers
WHERE contains(lower(coalesce(subject, '')), lower('{MATCH_TERM}'))
   OR contains(lower(coalesce(brand, '')), lower('{MATCH_TERM}'))
   OR contains(lower(coalesce(brand_email, '')), lower('{MATCH_TERM}'))""")
def q_match_offers(spark, sf_dir):
    """P10: substring search over subject, brand and address."""
    return T.match_offers(offers(spark, sf_dir), MATCH_TERM)


@register("match_offers_outcome", _OFFERS_SQL + f"""
SELECT count(*) AS hits,
       CASE WHEN count(*) = 0 THEN 'none' WHEN count(*) = 1 THEN 'one' ELSE 'many' END AS outcome
FROM offers
WHERE contains(lower(coalesce(subject, '')), lower('{MATCH_TERM}'))
   OR contains(lower(coalesce(brand, '')), lower('{MATCH_TERM}'))
   OR contains(lower(coalesce(brand_email, '')), lower('{MATCH_TERM}'))""")
def q_match_offers_outcome(spark, sf_dir):
    return T.match_cardinality(T.match_offers(offers(spark, sf_dir), MATCH_TERM))


_LS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def strip_quotes_sql(c: str) -> str:
    lines = f"list_filter(string_split_regex(coalesce({c}, ''), '{_LS}'), lambda l: NOT starts_with({_STRIP.format('l')}, '>'))"
    pos = f"list_position(list_transform({lines}, lambda l: regexp_matches({_STRIP.format('l')}, '^On .+ wrote:$')), true)"
    kept = f"(CASE WHEN coalesce({pos}, 0) > 0 THEN {lines}[1:{pos} - 1] ELSE {lines} END)"
    return _STRIP.format(f"array_to_string({kept}, chr(10))")


@register("thread_transcript", O.with_ctes(O.MESSAGE_ROWS, O.THREAD_SENDERS, O.LABELLED) + f"""
SELECT account, thread_id, message_id, internal_ms, seq,
       CASE WHEN own THEN 'us' ELSE s_name || ' <' || s_addr || '>' END AS who,
       coalesce(subject, '') AS subject,
       {strip_quotes_sql("CASE WHEN body = '' THEN NULL ELSE body END")} AS body
FROM snd2 WHERE (account, thread_id) IN (SELECT account, thread_id FROM hits)""")
def q_thread_transcript(spark, sf_dir):
    """Q9 dump of every labelled thread: speaker (X41), body decoded from URL-safe
    base64 (X21), quotes stripped (X8, W7), whole."""
    msgs = B.messages(spark, sf_dir)
    since = F.timestamp_add("DAY", F.lit(-B.LOOKBACK_DAYS), B.as_of())
    lab = T.labelled_threads(msgs, B.OFFER_LABEL, since)
    lab = lab.withColumn("body", M.decode_b64url("body_b64"))
    return T.ordered_thread(T.thread_transcript(lab, B.OWN_ADDRESSES))


@register("ellipsis_subjects", O.with_ctes(O.MESSAGE_ROWS) + """
SELECT account, message_id,
       CASE WHEN length(coalesce(subject, '(no subject)') || ' / ' || body) > 70
            THEN substr(coalesce(subject, '(no subject)') || ' / ' || body, 1, 69) || '…'
            ELSE coalesce(subject, '(no subject)') || ' / ' || body END AS short,
       'https://mail.example/#inbox/' || message_id AS link
FROM messages""")
def q_ellipsis(spark, sf_dir):
    """X9 truncation with an ellipsis and X40 deep links."""
    m = B.messages(spark, sf_dir)
    text = F.concat(F.coalesce("subject", F.lit("(no subject)")), F.lit(" / "), F.col("body"))
    return m.select("account", "message_id", M.ellipsis(text, 70).alias("short"),
                    M.deep_link(F.col("message_id"), B.THREAD_URL).alias("link"))
