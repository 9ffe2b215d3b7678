"""Q12 ``plan_calendar``: S8, P11, P16, W3, R1, X27, P12, X32, X33, J13, W5, A23."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.operators.brands import first_contained
from notelake.operators.sequence import last_within

# Sheet-name words that mark non-schedule sheets; header names of each logical
# column in order of preference; date columns with their labels in order.
EXCLUDED_SHEET_WORDS = ["agencies", "affiliate", "commission"]
SHEET_COLUMNS = {
    "client": ["client name", "client"], "month": ["month"],
    "type": ["campaign type", "campiagn type", "type"], "deliverables": ["deliverables"],
    "rate": ["rate $", "rate", "amount"], "reel": ["reel date"],
    "story_1": ["story share #1 date", "story #1 date"], "story_2": ["story share #2 date", "story #2 date"],
    "story_3": ["story share #3 date", "story #3 date"], "live": ["live date"],
    "follow_up": ["follow up date"], "record": ["record date"],
}
DATE_LABELS = [("reel", "Reel"), ("story_1", "Story #1"), ("story_2", "Story #2"), ("story_3", "Story #3"),
               ("live", "Live"), ("follow_up", "Follow-Up"), ("record", "Record")]


def resolve_columns(headers: Sequence[str], spec: dict[str, Sequence[str]]) -> dict[str, str | None]:
    """Header resolution on the schema only (driver-side, no data): lowercase and
    trim the headers; each logical column takes the first exact name match, else the
    first partial match (names in order, then headers in order), else None."""
    norm = [h.lower().strip() for h in headers]
    out: dict[str, str | None] = {}
    for logical, names in spec.items():
        hit = next((headers[norm.index(n.lower())] for n in names if n.lower() in norm), None)
        if hit is None:
            hit = next((headers[i] for n in names for i, h in enumerate(norm) if n.lower() in h), None)
        out[logical] = hit
    return out


def schedule_sheets(df: DataFrame) -> DataFrame:
    """Drop sheets whose lowercase name contains an excluded word."""
    low = F.lower(F.col("sheet"))
    bad = F.lit(False)
    for w in EXCLUDED_SHEET_WORDS:
        bad = bad | low.contains(w)
    return df.filter(~bad)


def scan_sheet(raw: DataFrame, sheet: str, order: str, spec: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One sheet with the logical columns of ``spec`` (absent ones null, all strings) from
    a frame whose columns are the sheet's headers; ``order`` is its row number column. A sheet
    without data rows gives none."""
    hit = resolve_columns([c for c in raw.columns if c != order], spec or SHEET_COLUMNS)
    return raw.select(F.lit(sheet).alias("sheet"), F.col(order).alias("row"), *[
        (F.lit(None) if h is None else F.col(f"`{h}`")).cast("string").alias(c) for c, h in hit.items()])


def sheet_brand(df: DataFrame, rules: DataFrame, sheet: str = "sheet", out: str = "brand") -> DataFrame:
    """The brand of the first rule (``keyword, brand, rank``) whose keyword occurs in the
    sheet name, else the first word of the name."""
    return first_contained(df, F.col(sheet), rules, out=out) \
        .withColumn(out, F.coalesce(out, F.split(F.col(sheet), " ")[0]))


def brand_colour(df: DataFrame, colours: DataFrame, default: str, brand: str = "brand", out: str = "colour") -> DataFrame:
    """The colour of each row's brand from ``colours(brand, colour)``, else the default."""
    c = colours.select(F.col("brand").alias(brand), F.col("colour").alias(out))
    return df.join(c, brand, "left").withColumn(out, F.coalesce(out, F.lit(default)))


def fill_down(df: DataFrame, col: str, part: str, order: str) -> DataFrame:
    """Carry the last non-blank value of ``col`` down the rows of each ``part``; ``order``
    is unique in it. Rows before the first value stay null (dropped by P16). A sheet of any
    size is spread over ranges of its rows."""
    v = F.when(F.trim(F.col(col)) != "", F.trim(F.col(col)))
    return last_within(df, [part], [order], v, col)


# Date texts that cells hold, tried in order (names of months in English).
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy",
                "d MMM yyyy", "d MMMM yyyy", "M-d-yyyy", "M/d/yy"]


def cell_to_date(text: Column, number: Column | None = None) -> Column:
    """A date cell: a serial number (days since 1899-12-30, 0 = no date), else a text in
    one of ``DATE_FORMATS``, with or without a weekday before it and a time after it; anything
    else is no date."""
    s = F.regexp_replace(F.trim(text), r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    s = F.regexp_replace(s, r"[T\s]+\d{1,2}:\d{2}.*$", "")
    d = F.coalesce(*[F.try_to_date(s, f) for f in DATE_FORMATS])
    if number is not None:
        serial = F.when(number != 0, F.date_add(F.lit("1970-01-01").cast("date"), F.floor(number - 25569).cast("int")))
        return F.coalesce(serial, d)
    return d


def date_cells(rows: DataFrame) -> Column:
    """The date columns of a row as an array of ``(label, col_pos, day)`` in the fixed column
    order; absent columns and empty cells are dropped."""
    present = [(c, l, i) for i, (c, l) in enumerate(DATE_LABELS) if c in rows.columns]
    st = F.array(*[F.struct(F.lit(l).alias("label"), F.lit(i).alias("col_pos"), F.col(c).alias("day"))
                   for c, l, i in present])
    return F.filter(st, lambda d: d["day"].isNotNull())


def unpivot_dates(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The seven date columns to ``(label, date)`` rows in the fixed column order
    (``col_pos``); absent columns and empty cells are dropped."""
    return rows.select(*ids, F.explode(date_cells(rows)).alias("d")).select(*ids, "d.label", "d.col_pos", "d.day")


def plan_calendar(sheet_rows: DataFrame, existing: DataFrame, now: Column, rules: DataFrame, tag: str,
                  source: str, stale_days: int = 7) -> DataFrame:
    """Q12: rows -> (title, day, description) events with the fold outcome
    created / updated / skipped (dates whose midnight is more than ``stale_days`` before
    ``now`` count as skipped, P12). ``tag`` starts each title, ``source`` ends each
    description."""
    return fold_upserts(calendar_events(sheet_rows, now, rules, tag, source, stale_days), existing)


def calendar_events(sheet_rows: DataFrame, now: Column, rules: DataFrame, tag: str, source: str, stale_days: int = 7) -> DataFrame:
    """``sheet, row, col_pos, day, title, description, stale``: the events that the rows make (P11, W3, P16,
    X32, R1, X33, P12)."""
    rows = named_rows(sheet_rows, rules)
    dates = unpivot_dates(rows, ["sheet", "row", "client", "brand", "type", "deliverables", "rate"])
    return dates.select("sheet", "row", "col_pos", "day", event_title(tag, F.col("label")).alias("title"),
                        event_text(source).alias("description"), is_stale(F.col("day"), now, stale_days).alias("stale"))


def row_events(sheet_rows: DataFrame, now: Column, rules: DataFrame, tag: str, source: str, stale_days: int = 7) -> DataFrame:
    """``sheet, row, description, dates``: the events of ``calendar_events`` that are not stale, one row for
    each sheet row that has any; ``dates`` is an array of ``(col_pos, day, title)``. The description,
    which the events of a row share, is made and kept once."""
    rows = named_rows(sheet_rows, rules)
    live = F.filter(date_cells(rows), lambda d: F.coalesce(~is_stale(d["day"], now, stale_days), F.lit(False)))
    dates = F.transform(live, lambda d: F.struct(d["col_pos"].alias("col_pos"), d["day"].alias("day"),
                                                 event_title(tag, d["label"]).alias("title")))
    return rows.select("sheet", "row", event_text(source).alias("description"), dates.alias("dates")).filter(F.size("dates") > 0)


def named_rows(sheet_rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of schedule sheets with a client (P11, W3, P16) and the brand of their sheet."""
    rows = schedule_sheets(sheet_rows)
    return sheet_brand(fill_down(rows, "client", "sheet", "row").filter(F.col("client").isNotNull()), rules)


def event_title(tag: str, label: Column) -> Column:
    return F.concat_ws(" ", F.lit(tag), F.concat_ws(" - ", "client", F.concat_ws(" ", "brand", label)))


def is_stale(day: Column, now: Column, stale_days: int) -> Column:
    """Midnight of the day is more than ``stale_days`` before ``now``."""
    return day.cast("timestamp_ntz") < F.timestamp_add("DAY", F.lit(-stale_days), now)


def event_text(source: str) -> Column:
    """The description: absent type and deliverables keep their line, an absent or zero
    rate drops it; rates have thousands separators and up to three decimals."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.concat_ws("\n",
                       F.concat(F.lit("Creator: "), F.col("client")),
                       F.concat(F.lit("Brand: "), F.col("brand"), F.lit(" ("), F.col("sheet"), F.lit(")")),
                       F.concat(F.lit("Type: "), blank("type")),
                       F.concat(F.lit("Deliverables: "), blank("deliverables")),
                       F.when(F.coalesce(F.col("rate"), F.lit(0.0)) != 0,
                              F.concat(F.lit("Rate: $"), F.expr("format_number(rate, '#,##0.###')"))),
                       F.lit(f"\n{source}"))


def fold_upserts(ev: DataFrame, existing: DataFrame) -> DataFrame:
    """W5 + J13: per (title, day) in (sheet, row, column) order, the state before a
    row is the previous row's description, or the existing event's for the first
    row: none -> created, equal -> skipped, else updated. A (title, day) of any size is
    spread over ranges of its rows."""
    order = ["sheet", "row", "col_pos"]
    ex = existing.groupBy("title", "day").agg(F.min("description").alias("_existing"))
    live = last_within(ev.filter(~F.col("stale")), ["title", "day"], order, F.col("description"), "_before", include_self=False)
    live = live.join(ex, ["title", "day"], "left")
    prev = F.coalesce("_before", "_existing")
    live = live.withColumn("outcome", F.when(prev.isNull(), "created")
                           .when(prev == F.col("description"), "skipped").otherwise("updated")).drop("_existing", "_before")
    stale = ev.filter(F.col("stale")).withColumn("outcome", F.lit("skipped"))
    return live.unionByName(stale)


def events_after(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """The calendar after the plan: the last description of each (title, day) stands, other
    events stay."""
    last = plan.filter(~F.col("stale")).groupBy("title", "day").agg(
        F.max_by("description", F.struct("sheet", "row", "col_pos")).alias("description"))
    return last.unionByName(existing.select("title", "day", "description").join(last, ["title", "day"], "left_anti"))


def calendar_stats(plan: DataFrame, total_label: str = "TOTAL") -> DataFrame:
    """Created, updated, skipped per sheet and in total."""
    o = F.col("outcome")
    r = plan.rollup("sheet").agg(F.grouping("sheet").alias("_all"), F.count_if(o == "created").alias("created"),
                                 F.count_if(o == "updated").alias("updated"),
                                 F.count_if(o == "skipped").alias("skipped"))
    return r.select(F.when(F.col("_all") == 1, F.lit(total_label)).otherwise(F.col("sheet")).alias("sheet"),
                    "created", "updated", "skipped")
