"""Q3 ``enrich_notes`` on document notes and supplier brand profiles (X3, X12-X16,
X19, S9, W2, J1, J12, U6, P9, K2, A3-A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions import notes as NF
from notelake.operators import enrich as EN
from notelake.plans import bindings as B
from notelake.plans.oracle import email_domain_sql
from notelake.operators.snapshots import NoteTable
from notelake.plans.registry import register
from notelake.session import materialise, read_table, shared_path

NL = "chr(10)"
ST = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def st(c):
    return ST.format(c)


def fm_sql(c: str) -> tuple[str, str, str]:
    """(has_fm, entries list, body) SQL for a content column."""
    p = f"strpos(substr({c}, 4), {NL} || '---')"
    has = f"(starts_with({c}, '---') AND {p} > 0)"
    fm_text = st(f"substr({c}, 4, {p} - 1)")
    body = f"(CASE WHEN {has} THEN substr({c}, {p} + 7) ELSE {c} END)"
    unq = "regexp_replace(regexp_replace({}, '^\"+|\"+$', '', 'g'), '^''+|''+$', '', 'g')"
    ent = (f"(CASE WHEN {has} THEN list_transform(list_filter(string_split({fm_text}, {NL}), lambda l: "
           f"contains(l, ':') AND NOT starts_with({st('l')}, '-') AND NOT starts_with({st('l')}, '#')), "
           f"lambda l: {{'k': {st('split_part(l, chr(58), 1)')}, "
           f"'v': {unq.format(st('substr(l, strpos(l, chr(58)) + 1)'))}}}) ELSE [] END)")
    return has, ent, body


def get_sql(ent: str, key: str) -> str:
    return f"coalesce(list_filter({ent}, lambda e: e.k = '{key}')[-1].v, '')"


_PROFILE_EMAIL = r"\|\s*[^|]+\s*\|\s*([a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+)\s*\|"
_FIXED = ", ".join(f"('{d}', '{b}')" for d, b in B.FIXED_DOMAINS)
_GENERIC = ", ".join(f"'{g}'" for g in B.GENERIC_DOMAINS)


def _notes_sql() -> str:
    k = "doc_id"
    addr = (f"coalesce(nullif(regexp_extract(text, '{B.EMAIL_RE}', 0), ''), "
            f"'writer' || CAST({k} AS VARCHAR) || '@' || source || '.example')")
    typ = f"CASE {k} % 10 WHEN 7 THEN 'Capture' WHEN 9 THEN 'note' ELSE 'email' END"
    sender = (f"CASE {k} % 4 WHEN 0 THEN 'from_email: \"' || addr || '\"' "
              f"WHEN 1 THEN 'from: \"Writer ' || CAST({k} AS VARCHAR) || ' <' || addr || '>\"' "
              f"WHEN 2 THEN 'sender_email: ' || addr ELSE 'account: main' END")
    fm = (f"'---' || {NL} || 'type: ' || typ || {NL} || sender || {NL} || 'subject: \"Doc ' || CAST({k} AS VARCHAR) "
          f"|| '\"' || {NL} || 'related_brand:' || {NL} || 'status: unprocessed' || {NL} || '---' || {NL} || {NL} "
          f"|| '# Doc ' || CAST({k} AS VARCHAR) || {NL} || {NL} || '**From:** Writer ' || CAST({k} AS VARCHAR) "
          f"|| ' <' || addr || '>' || {NL} || {NL} || text || {NL} || "
          f"CASE WHEN {k} % 8 = 5 THEN {NL} || '## Related' || {NL} || '- [[Old Brand]]' || {NL} ELSE '' END")
    return f"""
n0 AS (SELECT doc_id, source, text, {addr} AS addr FROM documents),
n1 AS (SELECT *, {typ} AS typ, {sender} AS sender FROM n0),
notes AS (
  SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS path, source AS folder,
         CASE WHEN doc_id % 25 = 3 THEN text ELSE {fm} END AS content
  FROM n1
)"""


def _profiles_sql() -> str:
    k = "s_suppkey"
    content = (f"'---' || {NL} || CASE WHEN {k} % 4 <> 0 THEN 'company: \"' || s_name || '\"' || {NL} ELSE '' END "
               f"|| 'domain: src' || CAST({k} % 25 AS VARCHAR) || '.example' || {NL} "
               f"|| 'contact_email: sales@mail' || CAST({k} % 13 AS VARCHAR) || '.example.com' || {NL} || '---' || {NL} "
               f"|| CASE WHEN {k} % 8 <> 0 THEN '# ' || s_name || ' Inc' || {NL} || {NL} ELSE '' END "
               f"|| '| Name | Email | Role |' || {NL} || '| Rep | rep' || CAST({k} AS VARCHAR) || '@partner' "
               f"|| CAST({k} % 9 AS VARCHAR) || '.example | Sales |' || {NL}")
    has, ent, body = fm_sql("content")
    company = get_sql(ent, "company")
    return f"""
profiles AS (SELECT 'Supplier ' || CAST({k} AS VARCHAR) || '.md' AS file, {content} AS content FROM supplier),
prof AS (
  SELECT file, content, {body} AS body,
         coalesce(nullif({company}, ''), nullif({st("regexp_extract(content, '(?m)^# (.+)$', 1)")}, ''),
                  regexp_replace(file, '\\.md$', '')) AS brand,
         lower(trim({get_sql(ent, 'domain')})) AS d_domain,
         {email_domain_sql(get_sql(ent, 'contact_email'))} AS d_contact
  FROM profiles
),
claims AS (
  SELECT d_domain AS domain, brand, file, 0 AS pos FROM prof
  UNION ALL SELECT d_contact, brand, file, 1 FROM prof
  UNION ALL SELECT {email_domain_sql('e.addr')}, brand, file, e.i + 1
  FROM (SELECT brand, file, unnest(regexp_extract_all(body, '{_PROFILE_EMAIL}', 1)) AS addr,
               unnest(range(1, len(regexp_extract_all(body, '{_PROFILE_EMAIL}', 1)) + 1)) AS i FROM prof) e
),
allc AS (
  SELECT lower(domain) AS domain, brand, '' AS file, -1 AS pos, 0 AS src FROM (VALUES {_FIXED}) t(domain, brand)
  UNION ALL
  SELECT domain, brand, file, pos, 1 FROM claims
  WHERE coalesce(domain, '') <> '' AND domain NOT IN ({_GENERIC})
),
domain_map AS (
  SELECT domain, brand FROM allc QUALIFY row_number() OVER (PARTITION BY domain ORDER BY src, file, pos) = 1
)"""


def _rewrite_sql() -> str:
    """X14 and X15 on the notes to update, step by step."""
    return f"""
up0 AS (
  SELECT n.path, d.brand, substr(content, 4, strpos(substr(content, 4), {NL} || '---') - 1) AS block,
         substr(content, strpos(substr(content, 4), {NL} || '---') + 7) AS body
  FROM notes n JOIN dec d ON n.path = d.path WHERE d.decision = 'updated'
),
up1 AS (
  SELECT path, brand, body, regexp_extract(body, '(?m)^## Related\\s*\\n', 0) AS hdr,
         contains(body, '[[' || brand || ']]') OR regexp_matches(body, '\\[\\[' || regexp_escape(brand) || '\\|[^\\]]+\\]\\]') AS linked,
         CASE WHEN regexp_matches(block, '(?m)^related_brand:')
              THEN regexp_replace(block, '(?m)^(related_brand:)[ \\t]*.*$', '\\1 "' || brand || '"', 'g')
              ELSE regexp_replace(block, '\\s+$', '') || {NL} || 'related_brand: "' || brand || '"' END AS block
  FROM up0
),
rewritten AS (
  SELECT path, '---' || block || {NL} || '---' ||
         CASE WHEN linked THEN body
              WHEN hdr <> '' THEN substr(body, 1, strpos(body, hdr) + length(hdr) - 1) || '- [[' || brand || ']]' || {NL}
                                  || substr(body, strpos(body, hdr) + length(hdr))
              ELSE regexp_replace(body, '\\s+$', '') || {NL} || {NL} || '## Related' || {NL} || '- [[' || brand || ']]' || {NL} END AS new_content
  FROM up1
)"""


def _decisions_sql() -> str:
    has, ent, body = fm_sql("content")
    typ = f"lower({get_sql(ent, 'type')})"
    from_line = "regexp_extract(body, '\\*\\*From:\\*\\*\\s*(.+)', 1)"
    dom = (f"coalesce({email_domain_sql(get_sql('ent', 'from_email'))}, {email_domain_sql(get_sql('ent', 'from'))}, "
           f"{email_domain_sql(get_sql('ent', 'sender_email'))}, {email_domain_sql(f'nullif({from_line}, {chr(39)}{chr(39)})')})")
    return rf"""
np AS (SELECT path, content, {has} AS has, {ent} AS ent, {body} AS body FROM notes),
nd AS (
  SELECT path, content, body, ent,
         CASE WHEN has AND lower({get_sql('ent', 'type')}) IN ('email', 'capture', '') THEN {dom} END AS domain
  FROM np
),
dec AS (
  SELECT nd.path, nd.domain, m.brand,
         CASE WHEN nd.domain IS NULL THEN 'no_sender' WHEN m.brand IS NULL THEN 'no_match'
              WHEN {get_sql('ent', 'related_brand')} = m.brand
                   AND (contains(body, '[[' || m.brand || ']]')
                        OR regexp_matches(body, '\[\[' || regexp_escape(m.brand) || '\|[^\]]+\]\]'))
              THEN 'already_linked' ELSE 'updated' END AS decision
  FROM nd LEFT JOIN domain_map m ON nd.domain = m.domain
)"""


CTE = "WITH " + _notes_sql() + "," + _profiles_sql() + "," + _decisions_sql()


def domain_map(spark, sf_dir):
    return EN.build_domain_map(B.fixed_domains(spark), B.brand_profiles(spark, sf_dir), B.generic_domains(spark))


def decisions(spark, sf_dir):
    """(parsed notes, domain map, decisions); the first two are written once."""
    parsed = EN.parse_notes(B.doc_notes(spark, sf_dir))
    dm = materialise(domain_map(spark, sf_dir), "domain-map")
    return parsed, dm, EN.enrich_decisions(parsed, dm)


@register("note_frontmatter", "WITH " + _notes_sql() + f""",
np AS (SELECT path, {fm_sql('content')[0]} AS has, {fm_sql('content')[1]} AS ent FROM notes)
SELECT path, has AS has_frontmatter, len(list_distinct(list_transform(ent, lambda e: e.k))) AS n_keys,
       {get_sql('ent', 'type')} AS type, {get_sql('ent', 'related_brand')} AS related_brand,
       {get_sql('ent', 'status')} AS status, {get_sql('ent', 'from')} AS from_value
FROM np""")
def q_note_frontmatter(spark, sf_dir):
    """Frontmatter map (last duplicate wins, empty values kept)."""
    n = NF.with_frontmatter(B.doc_notes(spark, sf_dir))
    fm = F.col("fm")
    return n.select("path", F.col("has_fm").alias("has_frontmatter"), F.size(F.map_keys(fm)).alias("n_keys"),
                    NF.fm_get(fm, "type").alias("type"), NF.fm_get(fm, "related_brand").alias("related_brand"),
                    NF.fm_get(fm, "status").alias("status"), NF.fm_get(fm, "from").alias("from_value"))


@register("email_notes", "WITH " + _notes_sql() + f""",
np AS (SELECT path, {fm_sql('content')[0]} AS has, {fm_sql('content')[1]} AS ent FROM notes)
SELECT path FROM np WHERE has AND lower({get_sql('ent', 'type')}) IN ('email', 'capture', '')""")
def q_email_notes(spark, sf_dir):
    """E-mail notes by their type property."""
    notes = materialise(B.doc_notes(spark, sf_dir), "notes")   # rendered once, not once a reference of the filter
    return EN.email_notes(notes).select("path")


@register("domain_map", CTE + " SELECT domain, brand FROM domain_map")
def q_domain_map(spark, sf_dir):
    """W2 first-wins domain map over fixed map and profiles."""
    return domain_map(spark, sf_dir)


@register("enrich_decisions", CTE + " SELECT path, domain, brand, decision FROM dec")
def q_enrich_decisions(spark, sf_dir):
    """X3 sender domain, J1 lookup, X16 decision."""
    return decisions(spark, sf_dir)[2]


@register("enrich_stats", CTE + """
SELECT count(*) AS scanned, count(*) FILTER (WHERE decision IN ('updated', 'already_linked')) AS matched,
       count(*) FILTER (WHERE decision = 'updated') AS updated,
       count(*) FILTER (WHERE decision = 'already_linked') AS already_linked,
       count(*) FILTER (WHERE decision = 'no_sender') AS no_sender,
       count(*) FILTER (WHERE decision = 'no_match') AS no_match
FROM dec""")
def q_enrich_stats(spark, sf_dir):
    """A3 counters."""
    return EN.enrich_stats(decisions(spark, sf_dir)[2])


@register("updates_by_brand", CTE + """
SELECT brand, count(*) AS updated FROM dec WHERE decision = 'updated' GROUP BY brand""")
def q_updates_by_brand(spark, sf_dir):
    """A4: updated notes per brand."""
    return EN.updates_by_brand(decisions(spark, sf_dir)[2]).orderBy(F.desc("updated"), "brand")


@register("domains_by_brand", CTE + """
SELECT brand, count(*) AS domains FROM domain_map GROUP BY brand""")
def q_domains_by_brand(spark, sf_dir):
    """A5: domains per brand."""
    return EN.domains_by_brand(domain_map(spark, sf_dir))


@register("enrich_rewrites", CTE + "," + _rewrite_sql() + " SELECT path, new_content FROM rewritten")
def q_enrich_rewrites(spark, sf_dir):
    """The rewritten text of every updated note."""
    parsed, _, dec = decisions(spark, sf_dir)
    return EN.rewritten_notes(parsed, dec)


@register("enrich_second_pass", CTE + "," + _rewrite_sql() + """
SELECT n.path, CASE WHEN decision = 'updated' THEN 'already_linked' ELSE decision END AS decision,
       md5(coalesce(new_content, content)) AS content_md5
FROM notes n JOIN dec d ON n.path = d.path LEFT JOIN rewritten r ON r.path = n.path""")
def q_enrich_second_pass(spark, sf_dir):
    """K2 + X13-X15: apply the updates and enrich the new snapshot again; every updated note
    is now already linked (enrichment is idempotent)."""
    parsed, dm, dec = decisions(spark, sf_dir)
    snap = EN.apply_note_updates(parsed.select("path", "content"), EN.rewritten_notes(parsed, dec))
    again = EN.parse_notes(snap)
    return EN.enrich_decisions(again, dm).select("path", "decision").join(
        again.select("path", F.md5("content").alias("content_md5")), "path")


@register("note_versions", """
SELECT coalesce(source, '') || '/' || doc_id || '.md' AS path, '2024-0' || (doc_id % 6 + 1) AS email_month,
       md5(CASE WHEN doc_id % 6 = 2 AND doc_id % 5 = 0 THEN 'changed ' || doc_id ELSE coalesce(text, '') END) AS content_md5
FROM documents WHERE doc_id % 6 >= 1""")
def q_note_versions(spark, sf_dir):
    """Notes added by month in two runs, some of one month written again, a run
    repeated, and the notes from a month on read back."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    rows = d.select("doc_id", F.concat(F.coalesce("source", F.lit("")), F.lit("/"), k.cast("string"), F.lit(".md")).alias("path"),
                    F.coalesce("text", F.lit("")).alias("content"), F.concat(F.lit("2024-0"), (k % 6 + 1).cast("string")).alias("email_month"))
    t = NoteTable(spark, shared_path(spark, "note-versions"))
    t.append(rows.filter(k % 2 == 0).drop("doc_id"), "even")
    t.append(rows.filter(k % 2 == 1).drop("doc_id"), "odd")
    changed = rows.filter((k % 6 == 2) & (k % 5 == 0)).withColumn("content", F.concat(F.lit("changed "), k.cast("string"))).drop("doc_id")
    t.update(changed, "changed")
    t.append(rows.drop("doc_id"), "odd")
    return t.read(since="2024-02").select("path", "email_month", F.md5("content").alias("content_md5"))
