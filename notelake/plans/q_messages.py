"""Messages as documents: S2, R3, A25, X6, X7, P6, P7, R2, J14, K7, X17, K1, S10 and Q2."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions import mail as M
from notelake.operators import parts as P
from notelake.operators import render as RD
from notelake.operators import sync as SY
from notelake.plans import bindings as B
from notelake.plans import oracle as O
from notelake.plans.q_sync import safe_name_sql
from notelake.plans.q_text import html_to_text_sql
from notelake.plans.registry import register
from notelake.session import materialise, read_table, shared_path
from notelake.sources.messages import read_messages, rejected_messages
from notelake.sources.vault import existing_names

# Fixed values of the binding.
DOMAIN_BRANDS = [("brand3.example", "Brand Three"), ("service.example", "Alerts")]
SUBJECT_BRANDS = [("Offer 12", 1), ("Offer 1", 2)]
SAVED = ["2024-01-01_file 0 0.pdf"]
SKIP = ["OFFERS"]


def write_documents(spark, sf_dir) -> str:
    """The conversations of one mailbox as message documents, one JSON object a line, and some
    lines that are none. Shapes: nested multipart with plain text and HTML, HTML only with an
    attachment, a bare text payload, and no readable body."""
    m = B._message_rows(read_table(spark, sf_dir, "conversations"))
    t = F.col("seq") % 4
    node = ("struct<mimeType:string,filename:string,headers:array<struct<name:string,value:string>>,"
            "body:struct<data:string,attachmentId:string>,parts:array<{}>>")
    leaf = "struct<mimeType:string,filename:string,body:struct<data:string,attachmentId:string>>"
    mid = "struct<mimeType:string,filename:string,body:struct<data:string,attachmentId:string>,parts:array<" + leaf + ">>"
    b64 = lambda c: F.translate(F.base64(F.encode(c, "UTF-8")), "+/", "-_")
    none = F.lit(None).cast("string")
    a_leaf = lambda mime, data: F.struct(F.lit(mime), none, F.struct(data, none)).cast(leaf)
    html = F.concat(F.lit("<p>"), F.col("body"), F.lit("</p>"))
    text = lambda mime, data: F.struct(F.lit(mime), none, F.struct(data, none), F.lit(None).cast(f"array<{leaf}>")).cast(mid)
    multi = F.struct(F.lit("multipart/alternative"), none, F.struct(none, none),
                     F.array(a_leaf("text/plain", b64(F.col("body"))), a_leaf("text/html", b64(html)))).cast(mid)
    name = F.concat(F.lit("file "), F.col("thread_id"), F.lit(" "), F.col("seq").cast("string"),
                    F.when(F.col("seq") % 8 == 1, ".PDF").when(F.col("seq") % 8 == 0, ".pdf").otherwise(".png"))
    attached = F.struct(F.lit("application/octet-stream"), name, F.struct(b64(F.col("message_id")), F.concat(F.lit("att"), "message_id")),
                        F.lit(None).cast(f"array<{leaf}>")).cast(mid)
    parts = (F.when(t == 0, F.array(multi, attached)).when(t == 1, F.array(attached, text("text/html", b64(html))))
             .when(t == 3, F.array(attached, text("text/plain", F.lit("####")))))
    headers = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for n, c in (
        ("From", "from_hdr"), ("To", "to_hdr"), ("subject", "subject"), ("DATE", "date_hdr"))])
    payload = F.struct(F.when(t == 2, "text/plain").otherwise("multipart/mixed"), none, headers,
                       F.struct(F.when(t == 2, b64(F.col("body"))), none), parts).cast(node.format(mid))
    doc = F.to_json(F.struct(F.lit(B.MAIN_ACCOUNT).alias("account"), F.col("message_id").alias("id"), F.col("thread_id").alias("threadId"),
                             F.col("labels").alias("labelIds"), F.col("internal_ms").cast("string").alias("internalDate"),
                             F.substring("body", 1, 40).alias("snippet"), payload.alias("payload")))
    bad = m.filter("seq = 0").select(F.concat(F.lit('{"id": "broken'), "thread_id").alias("value"))
    path = shared_path(spark, "messages")
    m.select(doc.alias("value")).unionAll(bad).write.text(path)
    return path


def scanned(spark, sf_dir):
    return read_messages(spark, write_documents(spark, sf_dir))


_BODY = f"""CASE WHEN body = '' THEN '(no readable body)'
     ELSE CASE seq % 4 WHEN 0 THEN body WHEN 2 THEN body WHEN 3 THEN '(no readable body)'
          WHEN 1 THEN {html_to_text_sql("'<p>' || body || '</p>'")} END END"""
_FILE = "'file ' || thread_id || ' ' || seq || CASE seq % 8 WHEN 1 THEN '.PDF' WHEN 0 THEN '.pdf' ELSE '.png' END"
_SUBJ = "coalesce(nullif(subject, ''), '(no subject)')"
_DATE = O.mail_date_sql("date_hdr")

DOCS = O.with_ctes(O.MESSAGE_ROWS) + f""",
msg AS (
  SELECT *, {_BODY} AS shown, CASE WHEN seq % 4 <> 2 THEN {_FILE} END AS file,
         coalesce({_DATE}, epoch_ms(internal_ms)) AS mts, {_DATE} IS NOT NULL AS dated
  FROM msg_rows
)"""


@register("message_scan", DOCS + """
SELECT message_id, thread_id, array_to_string(labels, ',') AS labels, internal_ms, substr(body, 1, 40) AS snippet FROM msg""")
def q_message_scan(spark, sf_dir):
    """Message documents; broken lines are left out."""
    return scanned(spark, sf_dir).select("message_id", "thread_id", F.array_join("labels", ",").alias("labels"), "internal_ms", "snippet")


@register("message_rejects", "SELECT '{\"id\": \"broken' || conv_id AS line, 'not_json' AS reason FROM conversations WHERE turn = 0")
def q_message_rejects(spark, sf_dir):
    """The lines that the scan leaves out, with the reason."""
    return rejected_messages(spark, write_documents(spark, sf_dir)).select("line", "reason")


@register("message_parts", DOCS + """,
n AS (
  SELECT message_id, '0' AS path, CASE WHEN seq % 4 = 2 THEN 'text/plain' ELSE 'multipart/mixed' END AS mime, seq % 4 <> 2 AS has_parts FROM msg
  UNION ALL SELECT message_id, '0.0', 'multipart/alternative', true FROM msg WHERE seq % 4 = 0
  UNION ALL SELECT message_id, '0.0.0', 'text/plain', false FROM msg WHERE seq % 4 = 0
  UNION ALL SELECT message_id, '0.0.1', 'text/html', false FROM msg WHERE seq % 4 = 0
  UNION ALL SELECT message_id, CASE WHEN seq % 4 = 0 THEN '0.1' ELSE '0.0' END, 'application/octet-stream', false FROM msg WHERE seq % 4 <> 2
  UNION ALL SELECT message_id, '0.1', CASE seq % 4 WHEN 1 THEN 'text/html' ELSE 'text/plain' END, false FROM msg WHERE seq % 4 IN (1, 3)
) SELECT * FROM n""")
def q_message_parts(spark, sf_dir):
    """Every node of the part trees with its path."""
    p = P.flatten_parts(scanned(spark, sf_dir))
    return p.select("message_id", F.array_join(F.col("part_path").cast("array<string>"), ".").alias("path"), "mime", "has_parts")


@register("message_bodies", DOCS + " SELECT message_id, shown AS body FROM msg")
def q_message_bodies(spark, sf_dir):
    """A25 + X6 over plain, HTML-only, bare and unreadable messages; whole bodies."""
    m = materialise(scanned(spark, sf_dir), "scanned")
    return P.message_bodies(m, P.flatten_parts(m)).select("message_id", "body")


@register("first_plain_bodies", DOCS + " SELECT message_id, body FROM msg WHERE seq % 4 IN (0, 2) AND body <> ''")
def q_first_plain(spark, sf_dir):
    """The first plain body of each message that has one."""
    return P.first_plain(P.flatten_parts(scanned(spark, sf_dir))).select("message_id", "body")


_ATT = f"""
SELECT message_id, file AS filename, strftime(mts, '%Y-%m-%d') || '_' || file AS out_name
FROM msg WHERE file IS NOT NULL AND lower(file) LIKE '%.pdf'
  AND strftime(mts, '%Y-%m-%d') || '_' || file NOT IN ({', '.join(f"'{s}'" for s in SAVED)})"""


def _new_attachments(spark, sf_dir):
    m = scanned(spark, sf_dir)
    ts = M.message_ts(M.header("headers", "Date"), "internal_ms")
    parts = P.flatten_parts(m.withColumn("day", F.date_format(ts, "yyyy-MM-dd")), ["message_id", "day"])
    named = P.attachment_names(P.extractable(P.explode_attachments(parts)), "day")
    return P.drop_saved(named, spark.createDataFrame([(s,) for s in SAVED], "name string"), ["message_id", "part_path"])


@register("new_attachments", DOCS + _ATT)
def q_new_attachments(spark, sf_dir):
    """Attachments to save with their output names."""
    return _new_attachments(spark, sf_dir).select("message_id", "filename", "out_name")


@register("attachment_table", DOCS + f"SELECT out_name, message_id AS content FROM ({_ATT})")
def q_attachment_table(spark, sf_dir):
    """K7: the attachment table written and read back."""
    path = shared_path(spark, "attachments")
    P.write_attachments(_new_attachments(spark, sf_dir), path, ["message_id", "part_path"])
    return spark.read.parquet(path).select("out_name", F.col("content").cast("string").alias("content"))


@register("mailbox_attachment_names", DOCS + """,
a AS (SELECT message_id, strftime(mts, '%Y-%m-%d') || '_shared' AS stem FROM msg WHERE file IS NOT NULL)
SELECT message_id, stem || CASE WHEN rn = 1 THEN '' ELSE '_' || (rn - 1) END || '.pdf' AS out_name
FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY message_id) AS rn FROM a)""")
def q_mailbox_attachment_names(spark, sf_dir):
    """W1 on attachments: equal names of a day are numbered before the extension."""
    m = scanned(spark, sf_dir)
    ts = M.message_ts(M.header("headers", "Date"), "internal_ms")
    parts = P.explode_attachments(P.flatten_parts(m.withColumn("day", F.date_format(ts, "yyyy-MM-dd")), ["message_id", "day"]))
    named = P.attachment_names(parts.withColumn("filename", F.lit("shared?.pdf")), "day", "mbox", ["message_id"])
    return named.select("message_id", "out_name")


def _note_sql(style: str, name: str, brand: str, attached: str | None = None) -> str:
    """``attached``: the lines on attachments, if they are other than those of the one ``file``."""
    sname, saddr = O.sender_sql("from_hdr", style)
    q = lambda c: f"'\"' || {c} || '\"'"
    nl = "chr(10)"
    labels = "list_sort(list_filter(labels, lambda l: l <> 'UNREAD'))"
    lab = f"'[' || array_to_string(list_transform({labels}, lambda l: '\"' || l || '\"'), ', ') || ']'"
    stamp = "strftime(mts, '%Y-%m-%dT%H:%M:%S')"
    subj = q(f"replace({_SUBJ}, '\"', '''')")
    if style == "mbox":
        props = ["'type: email'", f"'account: ' || {q('account')}", f"'from: ' || {q(sname)}", f"'from_email: ' || {q(saddr)}",
                 f"'to: ' || {q('substr(to_hdr, 1, 200)')}", f"'subject: ' || {subj}", f"'date: ' || {stamp}", f"'labels: ' || {lab}",
                 "'status: unprocessed'"]
    else:
        props = ["'type: email'", f"'sender: ' || {q(sname)}", f"'sender_email: ' || {q(saddr)}", f"'recipient: ' || {q('substr(to_hdr, 1, 200)')}",
                 f"'subject: ' || {subj}", f"'email_date: ' || {stamp}", f"'account: ' || {q('account')}", f"'labels: ' || {lab}",
                 f"'related_brand: ' || CASE WHEN {brand} <> '' THEN {q(brand)} ELSE '' END", "'related_campaign:'", "'related_contact:'",
                 "'tags:'", "'  - email'", "'created: ' || strftime(mts, '%Y-%m-%d')", "'status: unprocessed'"]
    saved = f"(file IS NOT NULL AND lower(file) LIKE '%.pdf' AND strftime(mts, '%Y-%m-%d') || '_' || file NOT IN ({', '.join(repr(s) for s in SAVED)}))"
    out = "strftime(mts, '%Y-%m-%d') || '_' || file"
    lines = ["'**From:** ' || from_hdr", "'**To:** ' || to_hdr", "'**Date:** ' || strftime(mts, '%Y-%m-%d %H:%M')", "'**Account:** ' || account",
             f"'**Labels:** ' || CASE WHEN len({labels}) > 0 THEN array_to_string({labels}, ', ') ELSE 'none' END"]
    tail = f"CASE WHEN file IS NOT NULL THEN '**Attachments:** ' || file || {nl} ELSE '' END"
    if style == "api":
        tail = f"CASE WHEN {brand} <> '' THEN '**Brand:** [[' || {brand} || ']]' || {nl} ELSE '' END || {tail}" \
               f" || CASE WHEN {saved} THEN '**Saved:** [[' || {out} || ']]' || {nl} ELSE '' END"
    else:
        tail += f" || CASE WHEN {saved} THEN {nl} || '**Saved attachments:**' || {nl} || '- [[attachments/' || {out} || '|' || file || ']]' || {nl} ELSE '' END"
    tail = attached or tail
    join = f" || {nl} || "
    return (f"'---' || {nl} || {join.join(props)} || {nl} || '---' || {nl} || {nl} || '# ' || {_SUBJ} || {nl} || {nl} || {join.join(lines)} || {nl} || {tail}"
            f" || {nl} || '---' || {nl} || {nl} || shown || {nl}")


_BRAND = ("coalesce(CASE " + " ".join(f"WHEN {O.email_domain_sql(O.sender_sql('from_hdr', 'api')[1])} = '{d}' THEN '{b}'" for d, b in DOMAIN_BRANDS) + " END, CASE "
          + " ".join(f"WHEN contains(lower(coalesce(subject, '')), lower('{b}')) THEN '{b}'" for b, _ in SUBJECT_BRANDS) + " END, '')")

SYNC = DOCS + f""",
acc AS (SELECT *, '{B.MAIN_ACCOUNT}' AS account, strftime(mts, '%Y-%m-%d') || '_' || {safe_name_sql(_SUBJ, 60)} AS base_name FROM msg),
had AS (SELECT DISTINCT base_name FROM acc WHERE thread_id::INT % 10 = 0 AND seq = 1),
out AS (
  SELECT *, CASE WHEN dated AND base_name IN (SELECT base_name FROM had) THEN 'skipped_exists'
                 WHEN list_has_any(labels, ['{SKIP[0]}']) THEN 'skipped_label' WHEN mts IS NULL THEN 'skipped_nodate' ELSE 'created' END AS outcome,
         {_BRAND} AS brand
  FROM acc
),
made AS (
  SELECT *, row_number() OVER (PARTITION BY base_name ORDER BY internal_ms, message_id) - 1
            + (base_name IN (SELECT base_name FROM had))::INT AS n FROM out WHERE outcome = 'created'
),
notes AS (SELECT message_id, base_name || CASE WHEN n = 0 THEN '' ELSE '_' || n END AS name, {_note_sql('api', 'name', 'brand')} AS content FROM made)"""


def synced(spark, sf_dir):
    """(classified messages, notes) of one run of Q2, where some names are taken already."""
    msgs = materialise(scanned(spark, sf_dir), "scanned")
    none = spark.createDataFrame([], "name string")
    base = SY.classify_messages(msgs, none, SKIP)
    had = base.filter((F.col("thread_id").cast("int") % 10 == 0) & F.col("message_id").endswith("-0001")).select("base_name").distinct()
    classified = materialise(SY.classify_messages(msgs, had, SKIP), "classified")
    domains = spark.createDataFrame(DOMAIN_BRANDS, "domain string, brand string")
    ranked = spark.createDataFrame(SUBJECT_BRANDS, "brand string, rank int")
    saved = spark.createDataFrame([(s,) for s in SAVED], "name string")
    return classified, SY.build_notes(classified, had, domains, ranked, saved)


@register("sync_messages", SYNC + " SELECT message_id, name, content FROM notes")
def q_sync_messages(spark, sf_dir):
    """Q2 from message documents to note texts: S2, P15, X24, X25, W1, J1, J2, R3, X6, P6, P7, J14, X17."""
    return synced(spark, sf_dir)[1].select("message_id", "name", "content")


@register("sync_messages_again", SYNC + """
SELECT outcome, count(*) AS messages FROM (
  SELECT CASE WHEN dated AND (base_name IN (SELECT base_name FROM had) OR base_name IN (SELECT name FROM notes)) THEN 'skipped_exists'
              WHEN list_has_any(labels, ['OFFERS']) THEN 'skipped_label' WHEN mts IS NULL THEN 'skipped_nodate' ELSE 'created' END AS outcome
  FROM out) GROUP BY outcome""")
def q_sync_again(spark, sf_dir):
    """K1 + S10: the notes written as a table, and the outcomes of a second run against it (Q17:
    only messages without a dated header are created again)."""
    classified, notes = synced(spark, sf_dir)
    path = shared_path(spark, "notes")
    RD.write_notes(notes, path)
    had = classified.filter((F.col("thread_id").cast("int") % 10 == 0) & F.col("message_id").endswith("-0001")).select(F.col("base_name").alias("name"))
    known = existing_names(spark.read.parquet(path)).unionByName(had)
    cols = [c for c in classified.columns if c not in ("subject", "from_hdr", "to_hdr", "date_hdr", "header_dated", "ts", "base_name", "outcome")]
    again = SY.classify_messages(classified.select(*cols), known, SKIP)
    return again.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


_TWO_ACCOUNTS = DOCS + f""",
two AS (
  SELECT *, '{B.MAIN_ACCOUNT}' AS account FROM msg UNION ALL SELECT *, '{B.ALT_ACCOUNT}' FROM msg WHERE thread_id::INT % 3 <> 0
),
acc AS (SELECT *, strftime(mts, '%Y-%m-%d') || '_' || {safe_name_sql(_SUBJ, 60)} AS base_name, {_BRAND} AS brand,
               list_has_any(labels, ['{SKIP[0]}']) AS skipped FROM two),
had AS (SELECT DISTINCT base_name FROM acc WHERE thread_id::INT % 10 = 0 AND seq = 1),
run_a AS (
  SELECT *, CASE WHEN dated AND base_name IN (SELECT base_name FROM had) THEN 'skipped_exists' WHEN skipped THEN 'skipped_label'
                 WHEN mts IS NULL THEN 'skipped_nodate' ELSE 'created' END AS outcome FROM acc WHERE account = '{B.MAIN_ACCOUNT}'
),
first_made AS (
  SELECT *, row_number() OVER (PARTITION BY base_name ORDER BY internal_ms, message_id) - 1
            + (base_name IN (SELECT base_name FROM had))::INT AS n FROM run_a WHERE outcome = 'created'
),
first_names AS (SELECT base_name || CASE WHEN n = 0 THEN '' ELSE '_' || n END AS name FROM first_made),
run_b AS (
  SELECT *, CASE WHEN dated AND (base_name IN (SELECT base_name FROM had) OR base_name IN (SELECT name FROM first_names)) THEN 'skipped_exists'
                 WHEN skipped THEN 'skipped_label' WHEN mts IS NULL THEN 'skipped_nodate' ELSE 'created' END AS outcome
  FROM acc WHERE account = '{B.ALT_ACCOUNT}'
),
second_made AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.base_name ORDER BY internal_ms, message_id) - 1
              + (s.base_name IN (SELECT base_name FROM had))::INT + coalesce(u.used, 0) AS n
  FROM run_b s LEFT JOIN (SELECT base_name, count(*) AS used FROM first_made GROUP BY base_name) u USING (base_name) WHERE outcome = 'created'
),
outcomes AS (SELECT account, message_id, outcome FROM run_a UNION ALL SELECT account, message_id, outcome FROM run_b),
made AS (SELECT *, 0 AS turn_no FROM first_made UNION ALL SELECT *, 1 FROM second_made),
files AS (SELECT *, strftime(mts, '%Y-%m-%d') || '_' || file AS out_name FROM made WHERE lower(file) LIKE '%.pdf'),
kept AS (SELECT account, message_id, out_name FROM files WHERE out_name NOT IN ({', '.join(f"'{s}'" for s in SAVED)})
         QUALIFY row_number() OVER (PARTITION BY out_name ORDER BY turn_no, internal_ms, account, message_id) = 1),
told AS (SELECT made.*, kept.out_name FROM made LEFT JOIN kept USING (account, message_id)),
notes AS (SELECT account, message_id, base_name || CASE WHEN n = 0 THEN '' ELSE '_' || n END AS name, {_note_sql(
    'api', 'name', 'brand', "CASE WHEN brand <> '' THEN '**Brand:** [[' || brand || ']]' || chr(10) ELSE '' END "
    "|| CASE WHEN file IS NOT NULL THEN '**Attachments:** ' || file || chr(10) ELSE '' END "
    "|| CASE WHEN out_name IS NOT NULL THEN '**Saved:** [[' || out_name || ']]' || chr(10) ELSE '' END")} AS content FROM told)"""


def _synced_accounts(spark, sf_dir):
    """One run over two mailboxes that share most of their mails, where some names are taken already."""
    one = materialise(scanned(spark, sf_dir), "scanned")
    both = one.unionByName(one.filter(F.col("thread_id").cast("int") % 3 != 0).withColumn("account", F.lit(B.ALT_ACCOUNT)))
    base = SY.classify_messages(one, spark.createDataFrame([], "name string"), SKIP)
    had = base.filter((F.col("thread_id").cast("int") % 10 == 0) & F.col("message_id").endswith("-0001")).select("base_name").distinct()
    return SY.sync_accounts(both, [B.MAIN_ACCOUNT, B.ALT_ACCOUNT], had, SKIP, spark.createDataFrame(DOMAIN_BRANDS, "domain string, brand string"),
                            spark.createDataFrame(SUBJECT_BRANDS, "brand string, rank int"), spark.createDataFrame([(s,) for s in SAVED], "name string"))


@register("sync_accounts", _TWO_ACCOUNTS + " SELECT account, message_id, name, content FROM notes")
def q_sync_accounts(spark, sf_dir):
    """Q2 over two accounts: the second one sees the notes and attachments of the first."""
    return _synced_accounts(spark, sf_dir)[1].select("account", "message_id", "name", "content")


@register("sync_accounts_outcomes", _TWO_ACCOUNTS + " SELECT account, message_id, outcome FROM outcomes")
def q_sync_accounts_outcomes(spark, sf_dir):
    """P15 and J4 over two accounts."""
    return _synced_accounts(spark, sf_dir)[0].select("account", "message_id", "outcome")


@register("mailbox_notes", DOCS + f""",
acc AS (SELECT *, '{B.MAIN_ACCOUNT}' AS account FROM msg)
SELECT message_id, {_note_sql('mbox', 'name', "''")} AS content FROM acc""")
def q_mailbox_notes(spark, sf_dir):
    """X17 in the mailbox style, with X22 links."""
    m = B._message_rows(read_table(spark, sf_dir, "conversations")).withColumn("account", F.lit(B.MAIN_ACCOUNT))
    sender = M.split_sender("from_hdr", "mbox")
    docs = materialise(scanned(spark, sf_dir), "scanned")
    parts = materialise(P.flatten_parts(docs.withColumn("day", F.date_format(M.message_ts(M.header("headers", "Date"), "internal_ms"), "yyyy-MM-dd")),
                                        ["account", "message_id", "day"]), "parts")
    bodies = P.message_bodies(docs, parts).select("message_id", F.col("body").alias("shown"))
    listed = P.explode_attachments(parts).groupBy("message_id").agg(F.array_sort(F.collect_list("filename")).alias("attachment_names"))
    new = P.drop_saved(P.attachment_names(P.extractable(P.explode_attachments(parts)), "day"), spark.createDataFrame([(s,) for s in SAVED], "n string"))
    kept = new.groupBy("message_id").agg(F.collect_list(F.struct(F.col("filename").alias("original"), F.col("out_name").alias("saved"))).alias("saved_names"))
    rows = m.join(bodies, "message_id").join(listed, "message_id", "left").join(kept, "message_id", "left") \
        .withColumn("ts", M.message_ts("date_hdr", "internal_ms")).withColumn("body", F.col("shown")) \
        .withColumn("sender_name", sender["name"]).withColumn("sender_address", sender["address"]) \
        .withColumn("display_labels", F.array_sort(F.array_except("labels", F.array(F.lit("UNREAD"))))) \
        .withColumn("attachment_names", F.coalesce("attachment_names", F.array().cast("array<string>"))) \
        .withColumn("saved_names", F.coalesce("saved_names", F.array().cast("array<struct<original:string,saved:string>>")))
    return rows.select("message_id", RD.render_note("mbox").alias("content"))
