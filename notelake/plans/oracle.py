"""DuckDB twins of the bindings in ``notelake.plans.bindings`` (SQL text only).

These strings are the independent oracle: they restate each binding and each
operator rule in plain SQL over the driver's views.
"""

from __future__ import annotations

from notelake.plans.bindings import (ALT_ACCOUNT, AS_OF, BASE_TS, LOOKBACK_DAYS, MAIN_ACCOUNT,
                                     OFFER_LABEL, OWN_ADDRESSES, THREAD_URL)

NL = "chr(10)"

MESSAGE_ROWS = f"""
msg_base AS (
  SELECT conv_id, turn, role, text,
         TIMESTAMP '{BASE_TS}' + to_seconds(conv_id * 1800 + turn * 300) AS ts
  FROM conversations
),
msg_rows AS (
  SELECT CAST(conv_id AS VARCHAR) AS thread_id,
         printf('%d-%04d', conv_id, turn) AS message_id,
         turn AS seq, role, ts,
         epoch_ms(ts) AS internal_ms,
         CASE WHEN role = 'assistant' THEN '"Own Team" <Team@Own.example>'
              WHEN role = 'system' THEN 'alerts@service.example'
              ELSE printf('"Contact %d" <contact%d@brand%d.example>', conv_id, conv_id, conv_id % 20) END AS from_hdr,
         'client@brand.example' AS to_hdr,
         CASE WHEN conv_id % 4 = 0 THEN (CASE WHEN turn % 2 = 1 THEN 'Late ' || conv_id END)
              WHEN turn = 0 THEN 'Offer ' || conv_id
              ELSE 'Re: Offer ' || conv_id END AS subject,
         CASE WHEN turn % 7 = 3 THEN NULL
              WHEN turn % 11 = 4 THEN 'garbage date'
              WHEN turn % 13 = 6 THEN strftime(ts, '%-d %b %Y %H:%M:%S') || ' EST'
              WHEN turn % 5 = 1 THEN strftime(ts, '%-d %b %Y %H:%M:%S') || ' -0700'
              WHEN turn % 5 = 2 THEN strftime(ts, '%a, %-d %b %Y %H:%M:%S') || ' +0000 (UTC)'
              ELSE strftime(ts, '%a, %-d %b %Y %H:%M:%S') || ' GMT' END AS date_hdr,
         CASE WHEN role = 'system' THEN ['{OFFER_LABEL}', 'INBOX']
              WHEN turn % 3 = 0 THEN ['INBOX', 'UNREAD']
              ELSE ['INBOX'] END AS labels,
         CASE WHEN turn > 0 THEN text || {NL} || '> quoted line' || {NL} || 'On ' || strftime(ts, '%Y-%m-%d')
                                  || ' Contact wrote:' || {NL} || '> earlier text'
              ELSE text END AS body
  FROM msg_base
),
messages AS (
  SELECT *, '{MAIN_ACCOUNT}' AS account FROM msg_rows
  UNION ALL
  SELECT *, '{ALT_ACCOUNT}' AS account FROM msg_rows
)"""

SENDER_RE = r"^(.*?)\s*<(.+?)>"


def sender_name_thread(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '{SENDER_RE}') THEN "
            f"regexp_replace(regexp_replace(regexp_extract({c}, '{SENDER_RE}', 1), '^\\s+|\\s+$', '', 'g'), '^\"+|\"+$', '', 'g') "
            f"ELSE regexp_replace({c}, '^\\s+|\\s+$', '', 'g') END")


def sender_addr_thread(c: str) -> str:
    return (f"lower(CASE WHEN regexp_matches({c}, '{SENDER_RE}') THEN "
            f"regexp_replace(regexp_extract({c}, '{SENDER_RE}', 2), '^\\s+|\\s+$', '', 'g') "
            f"ELSE regexp_replace({c}, '^\\s+|\\s+$', '', 'g') END)")


OWN_LIST = ", ".join(f"'{a}'" for a in OWN_ADDRESSES)

THREAD_SENDERS = f"""
snd AS (
  SELECT *, {sender_name_thread('from_hdr')} AS s_name, {sender_addr_thread('from_hdr')} AS s_addr,
         internal_ms * 1000000 + seq AS k
  FROM messages
),
snd2 AS (SELECT *, s_addr IN ({OWN_LIST}) AS own FROM snd)"""

LABELLED = f"""
hits AS (
  SELECT DISTINCT account, thread_id FROM messages
  WHERE list_contains(labels, '{OFFER_LABEL}')
    AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY
)"""

THREAD_AGG = f"""
tagg AS (
  SELECT account, thread_id,
         arg_min_null(subject, k) AS first_subject,
         arg_max_null(subject, k) AS last_subject,
         arg_max_null(s_name, k) AS last_name,
         arg_max_null(s_addr, k) AS last_addr,
         arg_min_null(s_name, k) FILTER (WHERE NOT own) AS ext_name,
         arg_min_null(s_addr, k) FILTER (WHERE NOT own) AS ext_addr,
         count(*) FILTER (WHERE NOT own) AS n_ext,
         max(internal_ms) AS last_ms,
         count(*) AS messages
  FROM snd2 WHERE (account, thread_id) IN (SELECT account, thread_id FROM hits)
  GROUP BY account, thread_id
),
summary AS (
  SELECT account, thread_id,
         coalesce(nullif(first_subject, ''), nullif(last_subject, ''), '(no subject)') AS subject,
         CASE WHEN n_ext > 0 THEN coalesce(nullif(ext_name, ''), ext_addr)
              ELSE coalesce(nullif(last_name, ''), last_addr) END AS brand,
         CASE WHEN n_ext > 0 THEN ext_addr ELSE last_addr END AS brand_email,
         CASE WHEN last_addr IN ({OWN_LIST}) THEN 'WAITING ON THEM' ELSE 'NEEDS REPLY' END AS status,
         CAST(floor(date_diff('second', epoch_ms(last_ms), TIMESTAMP '{AS_OF}') / 86400) AS BIGINT) AS days_since,
         strftime(epoch_ms(last_ms), '%Y-%m-%d') AS last_date,
         messages,
         '{THREAD_URL}' || thread_id AS url
  FROM tagg
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


SENDERS = """
senders AS (
  SELECT c_custkey AS id,
    CASE c_custkey % 6
      WHEN 0 THEN '"' || c_name || ', ' || c_mktsegment || '" <' || lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example>'
      WHEN 1 THEN '  ' || lower(replace(c_name, '#', '.')) || '@' || upper(lower(c_mktsegment)) || '.Example '
      WHEN 2 THEN ''
      WHEN 3 THEN 'No Address ' || c_name
      WHEN 4 THEN 'x@y@' || lower(c_mktsegment) || '.example'
      ELSE c_name || ' < ' || lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example >' END AS from_str
  FROM customer
)"""


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def sender_sql(c: str, mode: str) -> tuple[str, str]:
    hit = f"regexp_matches({c}, '{SENDER_RE}')"
    g1 = f"regexp_extract({c}, '{SENDER_RE}', 1)"
    g2 = f"regexp_extract({c}, '{SENDER_RE}', 2)"
    name = f"regexp_replace({strip_sql(g1)}, '^\"+|\"+$', '', 'g')"
    tr = strip_sql(c)
    if mode == "mbox":
        return f"CASE WHEN {hit} THEN {name} ELSE {c} END", f"CASE WHEN {hit} THEN {g2} ELSE '' END"
    if mode == "api":
        return f"CASE WHEN {hit} THEN {name} ELSE {c} END", f"CASE WHEN {hit} THEN {g2} ELSE {c} END"
    if mode == "slack":
        return f"CASE WHEN {hit} THEN {name} ELSE {tr} END", f"CASE WHEN {hit} THEN {strip_sql(g2)} ELSE {tr} END"
    if mode == "thread":
        return (f"CASE WHEN {hit} THEN {name} ELSE {tr} END",
                f"lower(CASE WHEN {hit} THEN {strip_sql(g2)} ELSE {tr} END)")
    raise ValueError(mode)


def email_domain_sql(c: str) -> str:
    s1 = f"regexp_replace(regexp_replace({strip_sql(c)}, '^\"+|\"+$', '', 'g'), '^''+|''+$', '', 'g')"
    inner = f"regexp_extract({s1}, '<([^>]+)>', 1)"
    s2 = f"(CASE WHEN {inner} <> '' THEN {inner} ELSE {s1} END)"
    return f"(CASE WHEN contains({s2}, '@') THEN lower({strip_sql(f'string_split({s2}, {chr(39)}@{chr(39)})[-1]')}) END)"


_WD = r"(?i:mon|tue|wed|thu|fri|sat|sun),\s+"
_CORE = r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2})"
_OFF = r"(?:[+-]\d{4}|[+-]\d{2}:\d{2}|Z)"


def mail_date_sql(c: str) -> str:
    s = strip_sql(c)
    cleaned = strip_sql(f"regexp_replace(regexp_replace({c}, '\\s*\\([^)]*\\)\\s*$', ''), '\\s*[+-]\\d{{4}}\\s*$', '')")
    shapes = [f"^(?:{_WD})?{_CORE}\\s+{_OFF}$", f"^{_WD}{_CORE}\\s+(?i:UTC|GMT)$", f"^{_WD}{_CORE}$"]
    cands = [f"CASE WHEN regexp_matches({s}, '{p}') THEN regexp_extract({s}, '{p}', 1) END" for p in shapes]
    cp = f"^(?:{_WD})?{_CORE}$"
    cands.append(f"CASE WHEN regexp_matches({cleaned}, '{cp}') THEN regexp_extract({cleaned}, '{cp}', 1) END")
    core = f"regexp_replace(coalesce({', '.join(cands)}), '\\s+', ' ', 'g')"
    return f"try_strptime({core}, '%d %b %Y %H:%M:%S')"
