"""Message filters and outcome routing: U1, P1-P4, P15, J4, L6, A1, A2, A26.

Routing never drops rows: every message gets an ``outcome`` and filters are
applied on it afterwards, so counts (A1, A2) and writes (K1) come from one
classified DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from notelake.functions.common import col_of
from notelake.operators.sequence import ordinal_within

MBOX_OUTCOMES = ["errors", "skipped_label", "skipped_nodate", "skipped_old", "created"]
API_OUTCOMES = ["errors", "skipped_label", "skipped_nodate", "skipped_exists", "created", "would_create"]


def union_accounts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The messages of several mailboxes with the ``account`` each came from; columns that
    one of them lacks are null there."""
    out = None
    for account, df in frames.items():
        tagged = df.withColumn("account", F.lit(account))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def labels_meet(labels, skip: Sequence[str]) -> Column:
    """U4: label set intersects ``skip``."""
    return F.arrays_overlap(col_of(labels), F.array(*[F.lit(s) for s in skip]))


def exclude_labels(df: DataFrame, skip: Sequence[str], labels: str = "labels") -> DataFrame:
    """Drop messages whose labels meet the skip set (null label sets are kept)."""
    return df.filter(~F.coalesce(labels_meet(labels, skip), F.lit(False)))


def since(df: DataFrame, ts: str, cutoff: Column | None) -> DataFrame:
    """Keep ``ts >= cutoff`` (strict drop of older rows); no cutoff keeps all."""
    return df if cutoff is None else df.filter(F.col(ts) >= cutoff)


def lookback(df: DataFrame, ts: str, as_of: Column, days: int | None = None,
             after: Column | None = None, where: Column | None = None) -> DataFrame:
    """Explicit predicate, else ``ts >= after``, else the last ``days`` days
    before ``as_of``. ``as_of`` is a parameter so a rerun gives the same rows."""
    if where is not None:
        return df.filter(where)
    if after is not None:
        return df.filter(F.col(ts) >= after)
    if days is not None:
        return df.filter(F.col(ts) >= F.timestamp_add("DAY", F.lit(-days), as_of))
    return df


def with_label(df: DataFrame, label: str, labels: str = "labels") -> DataFrame:
    """Messages carrying ``label``."""
    return df.filter(F.array_contains(labels, label))


def classify_mbox(df: DataFrame, skip: Sequence[str], cutoff: Column | None,
                  failed: Column, labels: str = "labels", ts: str = "ts") -> DataFrame:
    """P15 (mailbox import): first of errors, skipped_label, skipped_nodate,
    skipped_old, created."""
    out = (F.when(failed, "errors")
           .when(F.coalesce(labels_meet(labels, skip), F.lit(False)), "skipped_label")
           .when(F.col(ts).isNull(), "skipped_nodate"))
    if cutoff is not None:
        out = out.when(F.col(ts) < cutoff, "skipped_old")
    return df.withColumn("outcome", out.otherwise("created"))


def classify_api(df: DataFrame, skip: Sequence[str], existing: DataFrame, failed: Column,
                 dry_run: bool = False, labels: str = "labels", ts: str = "ts",
                 key: str = "base_name", header_dated: str = "header_dated") -> DataFrame:
    """P15 (API sync): errors, then skipped_exists (J4: the key is already a note; only
    tested when the Date header parsed, Q17), skipped_label, skipped_nodate, else created /
    would_create.

    ``existing`` holds one column of existing keys: note stems for ``key="base_name"`` (two
    mails of a day with the same first 60 characters of subject are then one, Q18), or message
    ids for ``key="message_id"``. The probe is a left join with a marker, so no row is lost."""
    ex = existing.select(F.col(existing.columns[0]).alias(key)).distinct().withColumn("_exists", F.lit(True))
    j = df.join(ex, key, "left")
    out = (F.when(F.coalesce(failed, F.lit(False)), "errors")
           .when(F.coalesce(F.col(header_dated), F.lit(False)) & F.coalesce(F.col("_exists"), F.lit(False)), "skipped_exists")
           .when(F.coalesce(labels_meet(labels, skip), F.lit(False)), "skipped_label")
           .when(F.col(ts).isNull(), "skipped_nodate")
           .otherwise("would_create" if dry_run else "created"))
    return j.withColumn("outcome", out).drop("_exists")


def drop_existing(df: DataFrame, existing: DataFrame, key: str = "base_name") -> DataFrame:
    """J4 as a filter: left anti join on the key."""
    ex = existing.select(F.col(existing.columns[0]).alias(key))
    return df.join(ex, key, "left_anti")


def cap_per_account(df: DataFrame, n: int, ts: str = "ts", account: str = "account") -> DataFrame:
    """The ``n`` latest messages of each account (the listing limit of a sync, only on
    request). Up to the session's limit on group limits (1,000) each task keeps the ``n`` latest of
    an account before the exchange, so what is shuffled does not grow with an account; beyond it
    a distributed position, so an account of any size is spread."""
    order = [F.col(ts).desc_nulls_last(), F.col("message_id").asc()]
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        place = F.row_number().over(Window.partitionBy(account).orderBy(*order))
        return df.withColumn("_pos", place).filter(F.col("_pos") <= n).drop("_pos")
    return ordinal_within(df, [account], order, out="_pos").filter(F.col("_pos") < n).drop("_pos")


def observed(df: DataFrame, counters: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with counters that the write of it fills in the same pass (A1, A3, A7, A22, A23): write the
    frame, then read the values with ``.get``. A condition counts the rows that meet it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()]), seen


def import_stats(classified: DataFrame, attachments: str | None = None) -> DataFrame:
    """A1: messages per outcome, and with ``attachments`` (a column with the number extracted
    from a message) the attachments extracted from the created ones."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if attachments:
        took = F.when(F.col("outcome") == "created", F.coalesce(F.col(attachments), F.lit(0)))
        aggs.append(F.coalesce(F.sum(took), F.lit(0)).cast("long").alias("attachments"))
    return classified.groupBy("outcome").agg(*aggs)


def sync_stats(classified: DataFrame, account: str = "account", total_label: str = "TOTAL") -> DataFrame:
    """A2: per-account outcome counters plus a total row (ROLLUP); ``created_total``
    adds would_create so a dry run reports what a real run would create."""
    aggs = [F.count_if(F.col("outcome") == o).alias(o) for o in API_OUTCOMES]
    r = classified.rollup(account).agg(F.grouping(account).alias("_all"), *aggs, F.count(F.lit(1)).alias("messages"))
    return r.select(F.when(F.col("_all") == 1, F.lit(total_label)).otherwise(F.col(account)).alias(account),
                    *API_OUTCOMES, "messages",
                    (F.col("created") + F.col("would_create")).alias("created_total"))


def failure_digest(stats: DataFrame, account: str = "account", total_label: str = "TOTAL") -> DataFrame:
    """One text line per account with errors, in account order (bounded by the
    number of accounts)."""
    bad = stats.filter(~F.col(account).eqNullSafe(total_label) & (F.col("errors") > 0))
    return bad.agg(F.count(F.lit(1)).alias("accounts_with_errors"),
                   F.expr(f"listagg(concat({account}, ': ', cast(errors as string), ' errors'), '; ') "
                          f"WITHIN GROUP (ORDER BY {account})").alias("digest"))
