"""Q12 ``plan_calendar`` on event-derived schedule sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import calendar as C
from notelake.plans import bindings as B
from notelake.plans.registry import register

_EXCL = " OR ".join(f"contains(lower(sheet), '{w}')" for w in C.EXCLUDED_SHEET_WORDS)
_BRAND = "CASE " + " ".join(f"WHEN contains(lower(sheet), '{k}') THEN '{b}'" for k, b, _ in B.CAL_RULES) + \
    " ELSE split_part(sheet, ' ', 1) END"
_LABELS = ", ".join(f"('{c}', '{l}', {i})" for i, (c, l) in enumerate(C.DATE_LABELS))

# thousands separators by hand, up to three decimals without trailing zeros
_RATE = ("format('{:,}', CAST(floor(rate) AS BIGINT)) || "
         "rtrim(rtrim(substr(printf('%.3f', rate - floor(rate)), 2), '0'), '.')")
_TEXT = f"""'Creator: ' || client || chr(10) || 'Brand: ' || brand || ' (' || sheet || ')' || chr(10)
           || 'Type: ' || coalesce(type, '') || chr(10) || 'Deliverables: ' || trim(coalesce(deliverables, ''))
           || CASE WHEN coalesce(rate, 0) <> 0 THEN chr(10) || 'Rate: $' || {_RATE} ELSE '' END
           || chr(10) || chr(10) || '{B.CAL_SOURCE}'"""

PLAN_SQL = f"""
rows0 AS (
  SELECT CASE event_type WHEN 'error' THEN 'Affiliate error log' WHEN 'signup' THEN 'Alpha Beta signups'
              WHEN 'purchase' THEN 'BETA purchases' WHEN 'click' THEN 'One-Off clicks' ELSE 'View collabs' END AS sheet,
         event_id AS row,
         CASE WHEN event_id % 5 = 0 THEN 'Creator ' || CAST(user_id AS VARCHAR) ELSE '' END AS client,
         CASE WHEN event_id % 11 <> 0 THEN upper(event_type) END AS type,
         CASE WHEN event_id % 13 <> 0 THEN props END AS deliverables,
         CASE WHEN event_id % 4 = 0 THEN 0.0 WHEN event_id % 4 <> 1 THEN floor(value * 1000) / 4 END::DOUBLE AS rate,
         CAST(ts AS DATE) AS reel,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) + 1 END AS story_1,
         CAST(ts AS DATE) + 2 AS story_2, CAST(NULL AS DATE) AS story_3,
         CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS record
  FROM events
),
rows1 AS (
  SELECT * EXCLUDE (client),
         last_value(nullif(trim(client), '') IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS client
  FROM rows0 WHERE NOT ({_EXCL})
),
rows2 AS (SELECT *, {_BRAND} AS brand FROM rows1 WHERE client IS NOT NULL),
dates AS (
  SELECT sheet, row, client, brand, type, deliverables, rate, label, col_pos, day FROM (
    SELECT *, unnest([{{'label': 'Reel', 'col_pos': 0, 'day': reel}}, {{'label': 'Story #1', 'col_pos': 1, 'day': story_1}},
                      {{'label': 'Story #2', 'col_pos': 2, 'day': story_2}}, {{'label': 'Story #3', 'col_pos': 3, 'day': story_3}},
                      {{'label': 'Record', 'col_pos': 6, 'day': record}}], recursive := true) FROM rows2)
  WHERE day IS NOT NULL
),
ev AS (
  SELECT sheet, row, col_pos, day,
         '{B.CAL_TAG} ' || client || ' - ' || brand || ' ' || label AS title, {_TEXT} AS description,
         day::TIMESTAMP < TIMESTAMP '{B.CAL_NOW}' - INTERVAL 7 DAY AS stale
  FROM dates
),
ex AS (
  SELECT title, day, arg_min(description, row) AS description FROM (
    SELECT '{B.CAL_TAG} ' || client || ' - Beta Reel' AS title, reel AS day, row,
           CASE WHEN row % 20 = 0 THEN {_TEXT} ELSE 'older text' END AS description
    FROM (SELECT *, 'Beta' AS brand FROM rows0) WHERE row % 10 = 0 AND sheet = 'BETA purchases')
  GROUP BY title, day
),
seen AS (
  SELECT ev.*, coalesce(lag(ev.description) OVER (PARTITION BY ev.title, ev.day ORDER BY sheet, row, col_pos),
                        ex.description) AS prev
  FROM ev LEFT JOIN ex ON ev.title = ex.title AND ev.day = ex.day WHERE NOT stale
),
plan AS (
  SELECT sheet, row, col_pos, day, title, description, stale,
         CASE WHEN prev IS NULL THEN 'created' WHEN prev = description THEN 'skipped' ELSE 'updated' END AS outcome
  FROM seen
  UNION ALL
  SELECT sheet, row, col_pos, day, title, description, stale, 'skipped' FROM ev WHERE stale
)"""


def plan(spark, sf_dir):
    return C.plan_calendar(B.sheet_rows(spark, sf_dir), B.existing_events(spark, sf_dir),
                           F.lit(B.CAL_NOW).cast("timestamp_ntz"), B.calendar_rules(spark), B.CAL_TAG, B.CAL_SOURCE)


@register("calendar_plan", "WITH " + PLAN_SQL +
          " SELECT sheet, row, col_pos, strftime(day, '%Y-%m-%d') AS day, title, description, outcome FROM plan")
def q_calendar_plan(spark, sf_dir):
    """P11, W3 + P16, X32, R1, P12, X33, J13 + W5 fold."""
    return plan(spark, sf_dir).select("sheet", "row", "col_pos", F.date_format("day", "yyyy-MM-dd").alias("day"),
                                      "title", "description", "outcome")


@register("calendar_events", "WITH " + PLAN_SQL + """,
last AS (SELECT title, day, arg_max(description, {'sheet': sheet, 'row': row, 'col': col_pos}) AS description
         FROM ev WHERE NOT stale GROUP BY title, day)
SELECT title, strftime(day, '%Y-%m-%d') AS day, description FROM last
UNION ALL SELECT title, strftime(day, '%Y-%m-%d'), description FROM ex WHERE (title, day) NOT IN (SELECT (title, day) FROM last)""")
def q_calendar_events(spark, sf_dir):
    """The calendar after the fold (T3's table)."""
    out = C.events_after(plan(spark, sf_dir), B.existing_events(spark, sf_dir))
    return out.select("title", F.date_format("day", "yyyy-MM-dd").alias("day"), "description")


@register("calendar_colours", "WITH " + PLAN_SQL + f"""
SELECT DISTINCT sheet, brand, CASE brand {' '.join(f"WHEN '{b}' THEN '{c}'" for b, c in B.CAL_COLOURS)}
       ELSE '{B.CAL_COLOUR}' END AS colour FROM rows2""")
def q_calendar_colours(spark, sf_dir):
    """Brand and colour of each schedule sheet."""
    sheets = C.schedule_sheets(B.sheet_rows(spark, sf_dir)).select("sheet").distinct()
    return C.brand_colour(C.sheet_brand(sheets, B.calendar_rules(spark)), B.calendar_colours(spark), B.CAL_COLOUR) \
        .select("sheet", "brand", "colour")


@register("calendar_stats", "WITH " + PLAN_SQL + """
SELECT coalesce(sheet, 'TOTAL') AS sheet, count(*) FILTER (WHERE outcome = 'created') AS created,
       count(*) FILTER (WHERE outcome = 'updated') AS updated, count(*) FILTER (WHERE outcome = 'skipped') AS skipped
FROM plan GROUP BY ROLLUP (sheet)""")
def q_calendar_stats(spark, sf_dir):
    """A23 per sheet and total."""
    return C.calendar_stats(plan(spark, sf_dir))


@register("calendar_cells", """
SELECT event_id AS row, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS reel,
       strftime(CAST(ts AS DATE) + 2, '%Y-%m-%d') AS story_2, CAST(NULL AS VARCHAR) AS story_3,
       CAST(NULL AS VARCHAR) AS follow_up, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS us_date
FROM events""")
def q_calendar_cells(spark, sf_dir):
    """Text, serial-number, zero and non-date cells to dates."""
    c = B.sheet_cells(spark, sf_dir)
    fmt = lambda d: F.date_format(d, "yyyy-MM-dd")
    return c.select("row", fmt(C.cell_to_date(F.col("reel_text"))).alias("reel"),
                    fmt(C.cell_to_date(F.lit(None).cast("string"), F.col("story_2_serial"))).alias("story_2"),
                    fmt(C.cell_to_date(F.lit(None).cast("string"), F.col("story_3_serial"))).alias("story_3"),
                    fmt(C.cell_to_date(F.col("follow_up_text"))).alias("follow_up"),
                    fmt(C.cell_to_date(F.col("us_text"))).alias("us_date"))


# Sheets as the spreadsheet has them: headers in several spellings, one of them only in part.
_HEADS = {"BETA purchases": {"client": "Client Name ", "type": "Campiagn Type", "rate": "Rate $", "reel": "Reel Date"},
          "One-Off clicks": {"client": "client", "type": "My type of campaign", "rate": "AMOUNT", "reel": "Reel Date (new)"}}


@register("sheet_scan", "WITH " + PLAN_SQL + """
SELECT sheet, row, client, type, CAST(NULL AS VARCHAR) AS deliverables, rate, strftime(reel, '%Y-%m-%d') AS reel,
       CAST(NULL AS VARCHAR) AS record FROM rows0 WHERE sheet IN ('BETA purchases', 'One-Off clicks')""")
def q_sheet_scan(spark, sf_dir):
    """Sheets whose headers are resolved exactly or in part, absent columns null."""
    rows, out = B.sheet_rows(spark, sf_dir), None
    for sheet, heads in _HEADS.items():
        raw = rows.filter(F.col("sheet") == sheet).select("row", *[F.col(c).alias(h) for c, h in heads.items()])
        got = C.scan_sheet(raw, sheet, "row").select("sheet", "row", "client", "type", "deliverables", F.col("rate").cast("double"), "reel", "record")
        out = got if out is None else out.unionAll(got)
    return out
