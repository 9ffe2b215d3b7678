"""Deal ledger: S5, S6, P8, X28-X31, J10, J11, R4, K3/W8, A13-A19, A24.

Ledger tabs are header CSVs whose columns keep the spreadsheet's names (a
trailing space in ``"Client Name "``, the misspelling ``"Campiagn Type"``). All
cells are strings. Tabs are unioned by name with missing columns allowed, with
``tab``, ``brand``, ``year`` and ``kind`` (recurring / one-off) as constants per tab.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws
from notelake.operators.sequence import ordinal_within, sorted_by

# Ledger header names as written in the sheets.
CREATOR_COL = "Client Name "
HEADER_TEXT = "Client Name"
RENAMES = {
    "Client Name ": "creator_raw", "Brand": "brand_raw", "Month": "month",
    "Rate $": "rate_raw", "Deliverables": "deliverables", "Campiagn Type": "campaign_type",
    "Campaign Type": "campaign_type_alt", "Invoice Status": "invoice_raw",
    "Approval Status": "approval_raw",
}
LEDGER_COLUMNS = list(RENAMES.values())


def read_ledger(spark: SparkSession, tabs: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Read ``(path, tab, brand, year, kind)`` header CSVs (strings only, never
    inferred), rename the sheet headers, union by name."""
    out = None
    for path, tab, brand, year, kind in tabs:
        df = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8") \
            .option("inferSchema", False).csv(path)
        df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
        df = df.select(*[F.col(f"`{c}`").alias(RENAMES[c]) for c in df.columns if c in RENAMES])
        df = df.withColumn("tab", F.lit(tab)).withColumn("tab_brand", F.lit(brand)) \
               .withColumn("year", F.lit(year)).withColumn("kind", F.lit(kind))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return normalise(out)


#: Rule columns of a tab: words whose presence in the creator marks a junk row, and whether
#: the tab names its brand in a column (its deliverables are then the campaign type).
TAB_RULES = {"drop_words": "array<string>", "brand_in_column": "boolean"}


def normalise(df: DataFrame) -> DataFrame:
    """Add absent ledger and rule columns as null (Q6: a short row reads as empty, not an error)."""
    absent = {c: "string" for c in LEDGER_COLUMNS} | TAB_RULES
    return df.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in df.columns})


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a headerless CSV (header line included), as a one-row DataFrame."""
    return spark.read.option("header", False).option("multiLine", True).csv(path) \
        .agg(F.count(F.lit(1)).cast("long").alias("rows"))


def _s(c) -> Column:
    return strip_ws(F.coalesce(col_of(c), F.lit("")))


def valid_rows(df: DataFrame, drop_header_text: bool = True) -> DataFrame:
    """Drop rows with an empty creator, rows repeating the header text (ledger
    build only, Q9), rows whose creator holds one of the tab's ``drop_words``, and one-off
    rows without a brand."""
    df = normalise(df)
    creator = _s("creator_raw")
    cond = creator != ""
    if drop_header_text:
        cond = cond & (creator != HEADER_TEXT)
    cond = cond & ~F.coalesce(F.exists("drop_words", lambda w: F.contains(creator, w)), F.lit(False))
    cond = cond & ((F.col("kind") != "one-off") | (_s("brand_raw") != ""))
    return df.filter(cond)


def parse_rate(c) -> Column:
    """Strip, drop ``,`` and ``$``; digits with dots only; ``1.2.3`` -> null
    (Q5); zero counts as absent."""
    s = F.replace(F.replace(_s(c), F.lit(","), F.lit("")), F.lit("$"), F.lit(""))
    v = F.when(s.rlike(r"^[0-9.]+$"), s.try_cast("double"))
    return F.when(v != 0, v)


def payment_status(c) -> Column:
    """Contains ``paid`` -> Paid (so ``unpaid`` is Paid, Q4), ``sent``/``invoiced``
    -> Invoiced, ``pending`` -> Pending, else null."""
    s = F.lower(_s(c))
    return (F.when(s.contains("paid"), "Paid")
            .when(s.contains("sent") | s.contains("invoiced"), "Invoiced")
            .when(s.contains("pending"), "Pending"))


def deal_stage(payment) -> Column:
    """Paid when the payment status is Paid, else Fully Executed."""
    return F.when(col_of(payment) == "Paid", "Paid").otherwise("Fully Executed")


def approval(c) -> Column:
    """``Approved`` when the cell contains ``approv`` (any case)."""
    return F.when(F.lower(_s(c)).contains("approv"), "Approved")


def record_name(brand, creator, month, year) -> Column:
    """``<brand> x <creator> - <month> <year>``."""
    return F.concat_ws("", col_of(brand), F.lit(" x "), col_of(creator), F.lit(" - "),
                       col_of(month), F.lit(" "), col_of(year))


def resolve_creator(df: DataFrame, aliases: DataFrame, creators: DataFrame) -> DataFrame:
    """Lowercase trimmed name -> alias (else itself) -> creator id or null.
    Dictionaries are broadcast only when their checked size allows."""
    a = aliases.select(F.lower(_s("alias")).alias("_c_alias"), F.col("name").alias("_c_canon"))
    c = creators.select(F.lower(_s("name")).alias("_c_key"), F.col("id").alias("creator_id"))
    key = F.lower(_s("creator_raw"))
    j = df.withColumn("_c_name", key).join(a, F.col("_c_name") == F.col("_c_alias"), "left")
    j = j.withColumn("_c_key0", F.coalesce(F.col("_c_canon"), F.col("_c_name")))
    j = j.join(c, F.col("_c_key0") == F.col("_c_key"), "left")
    return j.drop("_c_name", "_c_alias", "_c_canon", "_c_key0", "_c_key")


def resolve_brand(df: DataFrame, aliases: DataFrame, brands: DataFrame, name_col: str = "brand_name") -> DataFrame:
    """As J10, but an alias mapped to null means no link (does not fall back to
    the name itself)."""
    a = aliases.select(F.lower(_s("alias")).alias("_b_alias"), F.col("name").alias("_b_canon"),
                       F.lit(True).alias("_b_found"))
    b = brands.select(F.lower(_s("name")).alias("_b_key"), F.col("id").alias("brand_id"))
    j = df.withColumn("_b_name", F.lower(_s(name_col))).join(
        a, F.col("_b_name") == F.col("_b_alias"), "left")
    j = j.withColumn("_b_key0", F.when(F.col("_b_found"), F.lower(F.col("_b_canon"))).otherwise(F.col("_b_name")))
    j = j.join(b, F.col("_b_key0") == F.col("_b_key"), "left")
    return j.drop("_b_name", "_b_alias", "_b_canon", "_b_found", "_b_key0", "_b_key")


def build_records(rows: DataFrame, creator_aliases: DataFrame, creators: DataFrame,
                  brand_aliases: DataFrame, brands: DataFrame) -> DataFrame:
    """One deal record per valid ledger row (all tab kinds in one transform): one-off tabs
    and recurring tabs with ``brand_in_column`` take the brand from its column and the
    deliverables from the campaign type, other recurring tabs have the tab's brand.

    Optional fields are null when absent, so ``to_json`` leaves them out."""
    v = valid_rows(rows)
    oneoff = F.col("kind") == "one-off"
    own_brand = F.coalesce(F.col("brand_in_column"), F.lit(False))
    v = v.withColumn("brand_name", F.when(oneoff, _s("brand_raw")).when(own_brand, _s(F.coalesce("brand_raw", "tab_brand")))
                     .otherwise(F.col("tab_brand")))
    v = resolve_brand(resolve_creator(v, creator_aliases, creators), brand_aliases, brands)
    pay = payment_status("invoice_raw")
    campaign = F.coalesce(F.col("campaign_type"), F.col("campaign_type_alt"), F.lit(""))
    deliv = F.when(oneoff | own_brand, _s(campaign)).otherwise(
        F.when(_s("deliverables") != "", _s("deliverables")).otherwise(_s(campaign)))
    month = _s("month")
    return v.select(
        "tab", "kind", "row_no",
        record_name(F.col("brand_name"), _s("creator_raw"), month, F.col("year")).alias("name"),
        F.concat_ws(" ", month, F.col("year")).alias("month"),
        deliv.alias("deliverables"),
        F.when(oneoff, "Flat Fee").otherwise("Retainer").alias("deal_type"),
        F.when(~oneoff, F.lit("Repeat Brand")).alias("inbound_source"),
        deal_stage(pay).alias("stage"),
        parse_rate("rate_raw").alias("rate"),
        "brand_id", "creator_id",
        pay.alias("payment_status"),
        F.when(oneoff, approval("approval_raw")).alias("approval"),
    )


def record_fields() -> Column:
    """The sparse upload record of a row of R4; absent optional fields are null, so ``to_json``
    leaves them out."""
    return F.struct(
        F.col("name").alias("Name"), F.col("month").alias("Month"),
        F.col("deliverables").alias("Deliverables"), F.col("deal_type").alias("Deal Type"),
        F.col("inbound_source").alias("Inbound Source"), F.col("stage").alias("Pipeline Stage"),
        F.col("rate").alias("Rate"),
        F.when(F.col("brand_id").isNotNull(), F.array("brand_id")).alias("Brand"),
        F.when(F.col("creator_id").isNotNull(), F.array("creator_id")).alias("Creator"),
        F.col("payment_status").alias("Payment Status"),
        F.col("approval").alias("Content Approval Status"))


def to_batches(records: DataFrame, order: Sequence[str], size: int = 10) -> DataFrame:
    """K3 + W8: consecutive batches of ``size`` records in ``order`` with the upload document
    ``{"records": [{"fields": {...}}]}``. The batch index comes from the distributed ordinal of
    the keys alone (``order`` is unique); each batch is bounded by ``size``."""
    slim = records.select(F.struct(*order).alias("_key"), F.struct(record_fields().alias("fields")).alias("_record"))
    placed = ordinal_within(records.select(*order), [], list(order), out="_pos").select(F.struct(*order).alias("_at"), "_pos")
    b = slim.join(placed.hint("merge"), F.col("_key").eqNullSafe(F.col("_at"))) \
        .select("_pos", "_record", F.floor(F.col("_pos") / size).cast("long").alias("batch"))
    inside = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_record"))), lambda x: x["_record"])
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("records"),
                                  F.to_json(F.struct(inside.alias("records"))).alias("payload"))


def record_counts(records: DataFrame) -> DataFrame:
    """Records per kind plus the total."""
    r = records.rollup("kind").agg(F.grouping("kind").alias("_all"), F.count(F.lit(1)).alias("records"))
    return r.select(F.when(F.col("_all") == 1, F.lit("total")).otherwise(F.col("kind")).alias("kind"), "records")


# ---- repeat analysis (A13-A19) -------------------------------------------------

def _creator() -> Column:
    return _s("creator_raw")


def tab_volume(rows: DataFrame) -> DataFrame:
    """Recurring tabs: deal-months (rows with a creator) and distinct creators."""
    r = rows.filter((F.col("kind") == "recurring") & (_creator() != ""))
    return r.groupBy("tab", "tab_brand", "year").agg(
        F.count(F.lit(1)).alias("deal_months"),
        F.count_distinct(_creator()).alias("creators"))


def tab_creators(rows: DataFrame) -> DataFrame:
    """The creators of each recurring tab, one row per tab and creator."""
    r = rows.filter((F.col("kind") == "recurring") & (_creator() != ""))
    return r.select("tab", _creator().alias("creator")).distinct()


def brand_volume(rows: DataFrame) -> DataFrame:
    """Recurring deal-months and distinct creators per brand over all years."""
    r = rows.filter((F.col("kind") == "recurring") & (_creator() != ""))
    return r.groupBy("tab_brand").agg(F.count(F.lit(1)).alias("deal_months"),
                                      F.count_distinct(_creator()).alias("creators"))


def _oneoffs(rows: DataFrame) -> DataFrame:
    r = rows.filter((F.col("kind") == "one-off") & (_creator() != "") & (_s("brand_raw") != ""))
    return r.select(_s("brand_raw").alias("brand"), _creator().alias("creator"), "tab")


def oneoff_matrix(rows: DataFrame) -> DataFrame:
    """One-off deals per brand and creator."""
    return _oneoffs(rows).groupBy("brand", "creator").agg(F.count(F.lit(1)).alias("deals"))


def repeat_brands(rows: DataFrame, min_deals: int = 2) -> DataFrame:
    """One-off brands with ``min_deals`` or more deals are repeat, one deal is single."""
    per = _oneoffs(rows).groupBy("brand").agg(F.count(F.lit(1)).alias("deals"))
    return per.groupBy(F.when(F.col("deals") >= min_deals, "repeat").otherwise("single").alias("class")) \
        .agg(F.count(F.lit(1)).alias("brands"), F.sum("deals").cast("long").alias("deals"))


def deal_shares(rows: DataFrame, min_deals: int = 2) -> DataFrame:
    """Recurring and one-off shares, and the corrected shares that count repeat
    one-off brands as recurring. Empty input gives null shares (Q23)."""
    rec = rows.filter((F.col("kind") == "recurring") & (_creator() != "")).select(
        F.lit(1).alias("recurring"), F.lit(0).alias("oneoff"), F.lit(0).alias("repeat_oneoff"))
    per = _oneoffs(rows).groupBy("brand").agg(F.count(F.lit(1)).alias("deals"))
    one = per.select(F.lit(0).alias("recurring"), F.col("deals").alias("oneoff"),
                     F.when(F.col("deals") >= min_deals, F.col("deals")).otherwise(0).alias("repeat_oneoff"))
    t = rec.unionByName(one).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                                   for c in ("recurring", "oneoff", "repeat_oneoff")])
    total = F.col("recurring") + F.col("oneoff")
    pct = lambda n: F.round(F.try_divide(n * F.lit(100.0), total), 4)
    return t.select("recurring", "oneoff", total.alias("total"),
                    pct(F.col("recurring")).alias("recurring_pct"), pct(F.col("oneoff")).alias("oneoff_pct"),
                    (F.col("recurring") + F.col("repeat_oneoff")).alias("actual_recurring"),
                    (F.col("oneoff") - F.col("repeat_oneoff")).alias("actual_oneoff"),
                    pct(F.col("recurring") + F.col("repeat_oneoff")).alias("actual_recurring_pct"),
                    pct(F.col("oneoff") - F.col("repeat_oneoff")).alias("actual_oneoff_pct"))


def order_counts(df: DataFrame, count: str, *key: str, position: str | None = None) -> DataFrame:
    """L3: counts descending, ties by key."""
    return sorted_by(df, [F.desc(count), *key], position)


def creator_oneoffs(rows: DataFrame) -> DataFrame:
    """One-off deals per creator."""
    return _oneoffs(rows).groupBy("creator").agg(F.count(F.lit(1)).alias("deals"))


def oneoff_tab_stats(rows: DataFrame) -> DataFrame:
    """Per one-off tab, deals with creator and brand, and distinct brands
    (counted even where the creator is empty)."""
    r = rows.filter(F.col("kind") == "one-off")
    both = (_creator() != "") & (_s("brand_raw") != "")
    return r.groupBy("tab").agg(
        F.count_if(both).alias("deals"),
        F.count_distinct(F.when(_s("brand_raw") != "", _s("brand_raw"))).alias("brands"))
