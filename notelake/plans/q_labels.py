"""Label sets on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import labels as L
from notelake.operators import routing as R
from notelake.plans import bindings as B
from notelake.plans.registry import register

HIDDEN = ["Unread", "Opened"]
SKIP = ["error"]
REQUIRED = "purchase"

_DAILY = """
daily AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
         array_to_string(list_sort(list_distinct(list(event_type))) || ['Unread'], ' , ') AS label_header
  FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d')
),
parsed AS (
  SELECT user_id, day, label_header,
         list_distinct(list_transform(string_split(label_header, ','),
                                      lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS labels
  FROM daily
)"""


@register("label_sets", "WITH " + _DAILY + f"""
SELECT user_id, day,
       array_to_string(list_sort(labels), ',') AS labels,
       array_to_string(list_sort(list_filter(labels, lambda x: x NOT IN ('Unread', 'Opened'))), ',') AS display,
       list_has_any(labels, ['error']) AS skip,
       list_contains(labels, '{REQUIRED}') AS required
FROM parsed""")
def q_label_sets(spark, sf_dir):
    """R5 parse, U3/L8 display labels, U4 skip test, P4 required-label test."""
    d = B.daily_labels(spark, sf_dir).withColumn("labels", L.parse_labels("label_header"))
    return d.select("user_id", "day",
                    F.array_join(F.array_sort("labels"), ",").alias("labels"),
                    F.array_join(L.display_labels("labels", HIDDEN), ",").alias("display"),
                    R.labels_meet("labels", SKIP).alias("skip"),
                    F.array_contains("labels", REQUIRED).alias("required"))


@register("label_filters", "WITH " + _DAILY + f"""
SELECT user_id, day FROM parsed
WHERE NOT list_has_any(labels, ['error']) AND list_contains(labels, '{REQUIRED}')""")
def q_label_filters(spark, sf_dir):
    """P1 exclusion then P4 requirement."""
    d = B.daily_labels(spark, sf_dir).withColumn("labels", L.parse_labels("label_header"))
    return R.with_label(R.exclude_labels(d, SKIP), REQUIRED).select("user_id", "day")


@register("user_label_union", "WITH " + _DAILY + """
SELECT user_id, array_to_string(list_sort(list_distinct(flatten(list(labels)))), ',') AS labels
FROM parsed GROUP BY user_id""")
def q_user_label_union(spark, sf_dir):
    """Union of the daily label sets per user."""
    d = B.daily_labels(spark, sf_dir).withColumn("labels", L.parse_labels("label_header"))
    u = L.union_labels(d, ["user_id"])
    return u.select("user_id", F.array_join("labels", ",").alias("labels"))
