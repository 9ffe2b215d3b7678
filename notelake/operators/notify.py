"""Q7 ``notify_labelled``: J5, P5, A22, W9, X9, R6, K4, K5, L2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.operators.sequence import sorted_by
from notelake.functions.mail import ellipsis

DUP, SELF, POST = "skipped_dup", "skipped_self", "posted"


def route_candidates(cands: DataFrame, posted: DataFrame, own: Sequence[str]) -> DataFrame:
    """J5 + P5 + A22 routing: already posted (tested first), own sender, else post. An id that
    comes more than once (say from two accounts) is posted once, for the first account; the
    others are dups, as the id is in the state by then."""
    p = posted.select(F.col(posted.columns[0]).alias("message_id")).distinct().withColumn("_dup", F.lit(True))
    first = cands.groupBy("message_id").agg(F.min("account").alias("_first"), F.count(F.lit(1)).alias("_n")) \
        .filter("_n > 1").drop("_n")
    j = cands.join(p, "message_id", "left").join(first, "message_id", "left")
    own_l = [o.lower() for o in own]
    self_sent = F.lower(F.coalesce("sender_email", F.lit(""))).isin(own_l)
    again = F.col("_first").isNotNull() & (F.col("account") != F.col("_first"))
    out = (F.when(F.col("_dup").isNotNull(), DUP).when(self_sent, SELF).when(again, DUP).otherwise(POST))
    return j.withColumn("outcome", out).drop("_dup", "_first")


def take_posts(routed: DataFrame, limit: int | None = None) -> DataFrame:
    """W9 + L2: candidates are processed in message-id order and the run stops after
    ``limit`` posts; only the consumed prefix counts. Without a limit (the default) all are
    consumed. The cut is the id of the ``limit``-th post: a top-k, as a scalar subquery."""
    if limit is None:
        return routed
    top = routed.filter(F.col("outcome") == POST).select("message_id").orderBy("message_id").limit(limit)
    cut = top.agg(F.when(F.count(F.lit(1)) == limit, F.max("message_id")).alias("cut")).scalar()
    return routed.filter(cut.isNull() | (F.col("message_id") <= cut))


def order_candidates(msgs: DataFrame, position: str | None = None) -> DataFrame:
    """L2: by message id ascending, as strings; of one id by account."""
    return sorted_by(msgs, ["message_id", "account"], position)


def notify_stats(consumed: DataFrame, errors: Column | None = None) -> DataFrame:
    """Posted, skipped_dup, skipped_self and errors over the consumed rows. ``errors``
    marks rows whose delivery failed (they are not counted as posted)."""
    o, bad = F.col("outcome"), F.lit(False) if errors is None else F.coalesce(errors, F.lit(False))
    return consumed.agg(F.count_if((o == POST) & ~bad).alias("posted"), F.count_if(o == DUP).alias("skipped_dup"),
                        F.count_if(o == SELF).alias("skipped_self"), F.count_if((o == POST) & bad).alias("errors"))


#: The lengths that the chat service shows.
SHOWN = dict(subject_chars=140, sender_chars=80, snippet_chars=300)


def notification_payload(msgs: DataFrame, subject_chars: int | None = None, sender_chars: int | None = None,
                         snippet_chars: int | None = None) -> DataFrame:
    """R6 + X9: the texts of a notification: header, sender and inbox fields, the snippet only
    when there is one, and the context line. Whole texts by default; with numbers of characters
    (``SHOWN``, as the chat service limits block lengths) longer ones end in an ellipsis."""
    cut = lambda c, n: c if n is None else ellipsis(c, n)
    subject = cut(F.coalesce(F.when(F.col("subject") != "", F.col("subject")), F.lit("(no subject)")), subject_chars)
    sender = F.coalesce(F.when(F.col("sender") != "", F.col("sender")), F.lit("unknown"))
    snippet = F.when(F.coalesce(F.col("snippet"), F.lit("")) != "",
                     F.concat(F.lit("_"), cut(F.col("snippet"), snippet_chars), F.lit("_")))
    return msgs.select(
        "message_id",
        F.concat(F.lit(":bell: "), subject).alias("header"),
        F.concat(F.lit("*From*\n"), cut(sender, sender_chars), F.lit("\n`"), F.coalesce("sender_email", F.lit("")),
                 F.lit("`")).alias("from_field"),
        F.concat(F.lit("*Inbox*\n"), F.col("account")).alias("inbox_field"),
        snippet.alias("snippet_block"),
        F.concat(F.lit(":calendar: "), F.coalesce("date", F.lit("")), F.lit("  •  <"), F.col("url"),
                 F.lit("|Open in mail>")).alias("context"))


def payload_json(payloads: DataFrame) -> DataFrame:
    """K4 + R6: one JSON document per message: a header block, a section with two fields, the
    snippet section only when there is a snippet, and a context block."""
    text = lambda kind, c: F.struct(F.lit(kind).alias("type"), F.col(c).alias("text"))
    shape = ("struct<type:string,text:struct<type:string,text:string,emoji:boolean>,"
             "fields:array<struct<type:string,text:string>>,elements:array<struct<type:string,text:string>>>")
    none = F.lit(None)
    block = lambda kind, t=none, f=none, e=none: F.struct(
        F.lit(kind).alias("type"), t.alias("text"), f.alias("fields"), e.alias("elements")).cast(shape)
    plain = F.struct(F.lit("plain_text").alias("type"), F.col("header").alias("text"), F.lit(True).alias("emoji"))
    mrkdwn = F.struct(F.lit("mrkdwn").alias("type"), F.col("snippet_block").alias("text"), F.lit(None).cast("boolean").alias("emoji"))
    blocks = F.array_compact(F.array(
        block("header", plain), block("section", f=F.array(text("mrkdwn", "from_field"), text("mrkdwn", "inbox_field"))),
        F.when(F.col("snippet_block").isNotNull(), block("section", mrkdwn)),
        block("context", e=F.array(text("mrkdwn", "context")))))
    return payloads.select("message_id", F.to_json(F.struct(blocks.alias("blocks"))).alias("payload"))


def write_outbox(payloads: DataFrame, path: str) -> None:
    """K4: the JSON documents as a table of lines."""
    payload_json(payloads).select("payload").write.text(path)


def write_state(posted_before: DataFrame, posted_now: DataFrame, last_run: Column | None = None,
                cap: int | None = None) -> DataFrame:
    """K5: the ids posted so far and when the state was written: all of them (an id that falls
    out would be posted again), or with ``cap`` only that many of the largest (Q21)."""
    ids = posted_before.select(F.col(posted_before.columns[0]).alias("message_id")) \
        .unionByName(posted_now.select("message_id")).distinct()
    if cap is not None:
        ids = ids.orderBy(F.desc("message_id")).limit(cap)
    return ids if last_run is None else ids.withColumn("last_run", last_run)
