"""Q10 ``build_campaigns`` and Q11 ``repeat_analysis`` on the orders/customer ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import ledger as L
from notelake.plans import bindings as B
from notelake.plans.registry import register
from notelake.session import shared_path

_STRIP = "regexp_replace(coalesce({}, ''), '^\\s+|\\s+$', '', 'g')"


def s(c: str) -> str:
    return _STRIP.format(c)


LEDGER_ROWS_SQL = """
lj AS (SELECT o.*, c.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
ledger_rows AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'REC ' || c_mktsegment || ' ' || CAST(year(o_orderdate) AS VARCHAR)
              ELSE 'ONE-OFF ' || CAST(year(o_orderdate) AS VARCHAR) END AS tab,
         CASE WHEN o_orderstatus = 'F' THEN c_mktsegment END AS tab_brand,
         CAST(year(o_orderdate) AS VARCHAR) AS year,
         CASE WHEN o_orderstatus = 'F' THEN 'recurring' ELSE 'one-off' END AS kind,
         o_orderkey AS row_no,
         CASE WHEN o_orderstatus = 'F' AND c_mktsegment = 'MACHINERY' THEN ['http', 'Analytics'] END AS drop_words,
         o_orderstatus = 'F' AND c_mktsegment = 'FURNITURE' AS brand_in_column,
         CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN 'Client Name'
              WHEN o_orderkey % 53 = 0 THEN 'https://shop.example' WHEN o_orderkey % 59 = 0 THEN 'Analytics team'
              WHEN o_orderkey % 11 = 0 THEN replace(c_name, 'Customer#', 'Cust ') || ' '
              ELSE c_name END AS creator_raw,
         CASE WHEN o_orderstatus <> 'F' OR (c_mktsegment = 'FURNITURE' AND o_orderkey % 3 <> 0) THEN
              CASE WHEN o_orderkey % 83 = 0 THEN '' ELSE 'Brand#' || CAST((o_orderkey * 7919) % 4001 AS VARCHAR) END
         END AS brand_raw,
         strftime(o_orderdate, '%B') AS month,
         CASE o_orderkey % 5 WHEN 0 THEN '$' || printf('%.2f', o_totalprice)
              WHEN 1 THEN printf('%d,%03d', CAST(floor(o_totalprice / 1000) AS BIGINT), CAST(floor(o_totalprice) % 1000 AS BIGINT))
              WHEN 2 THEN '' WHEN 3 THEN '0' ELSE '1.2.3' END AS rate_raw,
         CASE o_orderkey % 6 WHEN 0 THEN 'Paid' WHEN 1 THEN 'Unpaid' WHEN 2 THEN 'Invoice sent'
              WHEN 3 THEN 'pending' WHEN 4 THEN '' END AS invoice_raw,
         CASE WHEN o_orderstatus = 'F' THEN
              CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '1 reel + ' || CAST(o_orderkey % 3 AS VARCHAR) || ' stories' END
         END AS deliverables,
         CASE WHEN o_orderstatus = 'F' OR year(o_orderdate) % 2 = 0 THEN o_orderpriority END AS campaign_type,
         CASE WHEN o_orderstatus <> 'F' AND year(o_orderdate) % 2 <> 0 THEN o_orderpriority END AS campaign_type_alt,
         CASE WHEN o_orderstatus <> 'F' THEN
              CASE o_orderkey % 3 WHEN 0 THEN 'Approved' WHEN 1 THEN 'pending approval' ELSE '' END
         END AS approval_raw
  FROM lj
),
creators AS (SELECT c_name AS name, 'rec' || CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal >= 0),
creator_aliases AS (SELECT lower(replace(c_name, 'Customer#', 'Cust ')) AS alias, lower(c_name) AS name FROM customer),
brands AS (
  SELECT name, 'b_' || lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) AS id
  FROM (SELECT DISTINCT p_brand AS name FROM part UNION SELECT DISTINCT c_mktsegment FROM customer)
),
brand_aliases AS (SELECT * FROM (VALUES ('machinery', NULL), ('household', 'furniture')) t(alias, name))"""

RECORDS_SQL = LEDGER_ROWS_SQL + f""",
valid AS (
  SELECT *, CASE WHEN kind = 'one-off' THEN {s('brand_raw')}
                 WHEN brand_in_column THEN {s('coalesce(brand_raw, tab_brand)')} ELSE tab_brand END AS brand_name
  FROM ledger_rows
  WHERE {s('creator_raw')} <> '' AND {s('creator_raw')} <> 'Client Name'
    AND (kind <> 'one-off' OR {s('brand_raw')} <> '')
    AND NOT (drop_words IS NOT NULL AND (contains(creator_raw, 'http') OR contains(creator_raw, 'Analytics')))
),
resolved AS (
  SELECT v.*,
         (SELECT id FROM creators cr WHERE lower({s('cr.name')}) =
            coalesce((SELECT name FROM creator_aliases ca WHERE lower({s('ca.alias')}) = lower({s('v.creator_raw')})),
                     lower({s('v.creator_raw')}))) AS creator_id,
         (SELECT id FROM brands b WHERE lower({s('b.name')}) =
            CASE WHEN EXISTS (SELECT 1 FROM brand_aliases ba WHERE lower({s('ba.alias')}) = lower({s('v.brand_name')}))
                 THEN (SELECT lower(name) FROM brand_aliases ba WHERE lower({s('ba.alias')}) = lower({s('v.brand_name')}))
                 ELSE lower({s('v.brand_name')}) END) AS brand_id
  FROM valid v
),
priced AS (
  SELECT *, replace(replace({s('rate_raw')}, ',', ''), '$', '') AS rs,
         lower({s('invoice_raw')}) AS inv
  FROM resolved
),
records AS (
  SELECT tab, kind, row_no,
         brand_name || ' x ' || {s('creator_raw')} || ' - ' || {s('month')} || ' ' || year AS name,
         {s('month')} || ' ' || year AS month,
         CASE WHEN kind = 'one-off' OR brand_in_column THEN {s("coalesce(campaign_type, campaign_type_alt, '')")}
              WHEN {s('deliverables')} <> '' THEN {s('deliverables')}
              ELSE {s("coalesce(campaign_type, campaign_type_alt, '')")} END AS deliverables,
         CASE WHEN kind = 'one-off' THEN 'Flat Fee' ELSE 'Retainer' END AS deal_type,
         CASE WHEN kind <> 'one-off' THEN 'Repeat Brand' END AS inbound_source,
         CASE WHEN contains(inv, 'paid') THEN 'Paid' ELSE 'Fully Executed' END AS stage,
         CASE WHEN regexp_matches(rs, '^[0-9.]+$') AND TRY_CAST(rs AS DOUBLE) <> 0 THEN TRY_CAST(rs AS DOUBLE) END AS rate,
         brand_id, creator_id,
         CASE WHEN contains(inv, 'paid') THEN 'Paid'
              WHEN contains(inv, 'sent') OR contains(inv, 'invoiced') THEN 'Invoiced'
              WHEN contains(inv, 'pending') THEN 'Pending' END AS payment_status,
         CASE WHEN kind = 'one-off' AND contains(lower({s('approval_raw')}), 'approv') THEN 'Approved' END AS approval
  FROM priced
)"""


def records(spark, sf_dir):
    aliases, creators, brand_aliases, brands = B.ledger_dictionaries(spark, sf_dir)
    return L.build_records(B.ledger_rows(spark, sf_dir), aliases, creators, brand_aliases, brands)


@register("ledger_records", "WITH " + RECORDS_SQL + " SELECT * FROM records")
def q_ledger_records(spark, sf_dir):
    """R4 with P8, X28-X31, J10, J11."""
    return records(spark, sf_dir)


@register("ledger_batches", "WITH " + RECORDS_SQL + """
SELECT CAST(floor((rn - 1) / 10) AS BIGINT) AS batch, count(*) AS records,
       '{"records":[' || string_agg(fields, ',' ORDER BY rn) || ']}' AS payload
FROM (SELECT row_number() OVER (ORDER BY kind DESC, tab, row_no) AS rn,
        '{"fields":{"Name":' || to_json(name) || ',"Month":' || to_json(month) || ',"Deliverables":' || to_json(deliverables)
        || ',"Deal Type":' || to_json(deal_type) || coalesce(',"Inbound Source":' || to_json(inbound_source), '')
        || ',"Pipeline Stage":' || to_json(stage) || coalesce(',"Rate":' || to_json(rate), '')
        || coalesce(',"Brand":[' || to_json(brand_id) || ']', '') || coalesce(',"Creator":[' || to_json(creator_id) || ']', '')
        || coalesce(',"Payment Status":' || to_json(payment_status), '')
        || coalesce(',"Content Approval Status":' || to_json(approval), '') || '}}' AS fields FROM records)
GROUP BY 1""")
def q_ledger_batches(spark, sf_dir):
    """Upload batches of 10 in ledger order (recurring tabs first)."""
    r = records(spark, sf_dir).withColumn("kind_rank", F.when(F.col("kind") == "recurring", 0).otherwise(1))
    return L.to_batches(r, ["kind_rank", "tab", "row_no"])


@register("ledger_record_counts", "WITH " + RECORDS_SQL + """
SELECT CASE WHEN grouping(kind) = 1 THEN 'total' ELSE kind END AS kind, count(*) AS records FROM records GROUP BY ROLLUP (kind)""")
def q_ledger_record_counts(spark, sf_dir):
    """Recurring, one-off and total record counts."""
    return L.record_counts(records(spark, sf_dir))


@register("repeat_tab_volume", "WITH " + LEDGER_ROWS_SQL + f"""
SELECT tab, tab_brand, year, count(*) AS deal_months, count(DISTINCT {s('creator_raw')}) AS creators
FROM ledger_rows WHERE kind = 'recurring' AND {s('creator_raw')} <> ''
GROUP BY tab, tab_brand, year""")
def q_repeat_tab_volume(spark, sf_dir):
    """Deal-months and creators per recurring tab (header-text rows kept, Q9)."""
    return L.tab_volume(B.ledger_rows(spark, sf_dir))


@register("repeat_tab_creators", "WITH " + LEDGER_ROWS_SQL + f"""
SELECT DISTINCT tab, {s('creator_raw')} AS creator FROM ledger_rows WHERE kind = 'recurring' AND {s('creator_raw')} <> ''""")
def q_repeat_tab_creators(spark, sf_dir):
    """Creators of each recurring tab."""
    return L.tab_creators(B.ledger_rows(spark, sf_dir))


@register("repeat_brand_volume", "WITH " + LEDGER_ROWS_SQL + f"""
SELECT tab_brand, count(*) AS deal_months, count(DISTINCT {s('creator_raw')}) AS creators
FROM ledger_rows WHERE kind = 'recurring' AND {s('creator_raw')} <> '' GROUP BY tab_brand""")
def q_repeat_brand_volume(spark, sf_dir):
    """Per brand across years, creator sets unioned."""
    return L.brand_volume(B.ledger_rows(spark, sf_dir))


ONEOFFS_SQL = LEDGER_ROWS_SQL + f""",
oneoffs AS (
  SELECT {s('brand_raw')} AS brand, {s('creator_raw')} AS creator, tab FROM ledger_rows
  WHERE kind = 'one-off' AND {s('creator_raw')} <> '' AND {s('brand_raw')} <> ''
),
per_brand AS (SELECT brand, count(*) AS deals FROM oneoffs GROUP BY brand)"""


@register("repeat_oneoff_matrix", "WITH " + ONEOFFS_SQL + """
SELECT brand, creator, count(*) AS deals FROM oneoffs GROUP BY brand, creator""")
def q_repeat_oneoff_matrix(spark, sf_dir):
    """One-off deals by brand and creator."""
    return L.oneoff_matrix(B.ledger_rows(spark, sf_dir))


@register("repeat_brands", "WITH " + ONEOFFS_SQL + """
SELECT CASE WHEN deals >= 2 THEN 'repeat' ELSE 'single' END AS class, count(*) AS brands, CAST(sum(deals) AS BIGINT) AS deals
FROM per_brand GROUP BY 1""")
def q_repeat_brands(spark, sf_dir):
    """Repeat versus single one-off brands."""
    return L.repeat_brands(B.ledger_rows(spark, sf_dir))


@register("repeat_shares", "WITH " + ONEOFFS_SQL + f""",
t AS (
  SELECT (SELECT count(*) FROM ledger_rows WHERE kind = 'recurring' AND {s('creator_raw')} <> '') AS recurring,
         (SELECT CAST(coalesce(sum(deals), 0) AS BIGINT) FROM per_brand) AS oneoff,
         (SELECT CAST(coalesce(sum(deals), 0) AS BIGINT) FROM per_brand WHERE deals >= 2) AS repeat_oneoff
)
SELECT recurring, oneoff, recurring + oneoff AS total,
       round(recurring * 100.0 / nullif(recurring + oneoff, 0), 4) AS recurring_pct,
       round(oneoff * 100.0 / nullif(recurring + oneoff, 0), 4) AS oneoff_pct,
       recurring + repeat_oneoff AS actual_recurring,
       oneoff - repeat_oneoff AS actual_oneoff,
       round((recurring + repeat_oneoff) * 100.0 / nullif(recurring + oneoff, 0), 4) AS actual_recurring_pct,
       round((oneoff - repeat_oneoff) * 100.0 / nullif(recurring + oneoff, 0), 4) AS actual_oneoff_pct
FROM t""")
def q_repeat_shares(spark, sf_dir):
    """recurring/one-off shares and corrected shares."""
    return L.deal_shares(B.ledger_rows(spark, sf_dir))


@register("repeat_creator_oneoffs", "WITH " + ONEOFFS_SQL + """
SELECT creator, count(*) AS deals FROM oneoffs GROUP BY creator""")
def q_repeat_creator_oneoffs(spark, sf_dir):
    """One-off deals per creator."""
    return L.order_counts(L.creator_oneoffs(B.ledger_rows(spark, sf_dir)), "deals", "creator")


@register("repeat_oneoff_tabs", "WITH " + LEDGER_ROWS_SQL + f"""
SELECT tab, count(*) FILTER (WHERE {s('creator_raw')} <> '' AND {s('brand_raw')} <> '') AS deals,
       count(DISTINCT CASE WHEN {s('brand_raw')} <> '' THEN {s('brand_raw')} END) AS brands
FROM ledger_rows WHERE kind = 'one-off' GROUP BY tab""")
def q_repeat_oneoff_tabs(spark, sf_dir):
    """Per one-off tab, deals and distinct brands."""
    return L.oneoff_tab_stats(B.ledger_rows(spark, sf_dir))


@register("ledger_csv_roundtrip", "WITH " + LEDGER_ROWS_SQL + f"""
SELECT 'REC ' || year AS tab, 'recurring' AS kind, year, {s('creator_raw')} AS creator, {s('rate_raw')} AS rate,
       {s('invoice_raw')} AS invoice, count(*) AS rows
FROM ledger_rows WHERE kind = 'recurring' GROUP BY ALL
UNION ALL
SELECT 'ONE-OFF ' || year, 'one-off', year, {s('creator_raw')}, {s('rate_raw')}, {s('invoice_raw')}, count(*)
FROM ledger_rows WHERE kind = 'one-off' GROUP BY ALL""")
def q_ledger_csv_roundtrip(spark, sf_dir):
    """The ledger written as header CSVs (a byte order mark on the first header, sheet
    headers, one folder per kind and year) in the shared folder, read back by the ledger reader."""
    base, years = _write_tabs(spark, sf_dir)
    tabs = [(f"{base}/kind={k}/year={y}", f"{'REC' if k == 'recurring' else 'ONE-OFF'} {y}", None, y, k) for k, y in years]
    back = L.read_ledger(spark, tabs)
    clean = lambda c: L._s(c)
    return back.groupBy("tab", "kind", "year", clean("creator_raw").alias("creator"), clean("rate_raw").alias("rate"),
                        clean("invoice_raw").alias("invoice")).agg(F.count(F.lit(1)).alias("rows"))


@register("ledger_csv_rows", "WITH " + LEDGER_ROWS_SQL + """
SELECT kind, year, count(*) AS rows FROM ledger_rows GROUP BY kind, year""")
def q_ledger_csv_rows(spark, sf_dir):
    """Rows of each CSV counted without its header (one header line per part file)."""
    base, years = _write_tabs(spark, sf_dir)
    out = None
    for k, y in years:
        n = L.count_rows(spark, f"{base}/kind={k}/year={y}").select(
            F.lit(k).alias("kind"), F.lit(y).alias("year"), (F.col("rows") - 1).alias("rows"))
        out = n if out is None else out.unionAll(n)
    return out


def _write_tabs(spark, sf_dir):
    """One CSV file per kind and year under sheet headers; the paths' (kind, year) list, which
    is as long as there are tabs."""
    rows = B.ledger_rows(spark, sf_dir)
    base = shared_path(spark, "ledger")
    inv = {v: k for k, v in L.RENAMES.items()}
    names = ["\ufeff" + inv[c] if i == 0 else inv[c] for i, c in enumerate(L.LEDGER_COLUMNS)]
    out = rows.select("kind", "year", *[F.col(c).alias(n) for c, n in zip(L.LEDGER_COLUMNS, names)])
    out.repartition("kind", "year").write.partitionBy("kind", "year").option("header", True) \
        .option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(base)
    return base, sorted(map(tuple, rows.select("kind", "year").distinct().collect()))
