"""Thread operators: J6, A20, A21, W4, L1, L7, P10, X7, X8, W7 (jobs Q8, Q9).

Messages carry ``account, thread_id, seq, internal_ms, from_hdr, subject, labels``.
A thread's order is ``(internal_ms, seq)``. Every per-thread result is a partial
aggregate (``min_by``/``max_by``/``count``), so a hot thread is combined map-side
and never collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.operators.sequence import sorted_by
from notelake.functions.common import col_of, strip_ws
from notelake.functions.mail import days_since, deep_link, ms_to_ntz, speaker, split_sender

NEEDS_REPLY = "NEEDS REPLY"
WAITING = "WAITING ON THEM"
NO_SUBJECT = "(no subject)"


def _order_key() -> Column:
    return F.struct(F.col("internal_ms"), F.col("seq"))


def is_own(address, own: Sequence[str]) -> Column:
    return col_of(address).isin([a.lower() for a in own])


def labelled_threads(msgs: DataFrame, label: str, since: Column,
                     keys: Sequence[str] = ("account", "thread_id")) -> DataFrame:
    """All messages of the threads that hold at least one message carrying
    ``label`` at or after ``since``. Left semi join on the thread key; the probe side
    is the distinct set of labelled keys."""
    hits = (msgs.filter(F.array_contains("labels", label) & (F.col("ts") >= since))
            .select(*keys).distinct())
    return msgs.join(hits, list(keys), "left_semi")


def thread_summary(msgs: DataFrame, own: Sequence[str], as_of: Column,
                   keys: Sequence[str] = ("account", "thread_id"),
                   url_base: str = "https://mail.example/#inbox/") -> DataFrame:
    """One row per thread.

    subject: first message's Subject, else the last one's, else ``(no subject)``;
    brand: the first sender outside ``own`` (else the last sender), name else address;
    status: ``WAITING ON THEM`` when an own address spoke last, else ``NEEDS REPLY``.
    """
    snd = split_sender("from_hdr", "thread")
    m = msgs.select(*keys, "seq", "internal_ms", "subject",
                    snd["name"].alias("s_name"), snd["address"].alias("s_addr"))
    m = m.withColumn("k", _order_key()).withColumn("own", is_own("s_addr", own))
    who = F.struct("s_name", "s_addr")
    agg = m.groupBy(*keys).agg(
        F.min_by("subject", "k").alias("first_subject"),
        F.max_by("subject", "k").alias("last_subject"),
        F.max_by(who, "k").alias("last_from"),
        F.min_by(who, F.when(~F.col("own"), F.col("k"))).alias("first_ext"),
        F.max("internal_ms").alias("last_ms"),
        F.count(F.lit(1)).alias("messages"),
    )
    nz = lambda c: F.when(c != "", c)  # noqa: E731  python truthiness of a string
    contact = F.coalesce(F.col("first_ext"), F.col("last_from"))
    last_dt = ms_to_ntz("last_ms")
    return agg.select(
        *keys,
        F.coalesce(nz(F.col("first_subject")), nz(F.col("last_subject")), F.lit(NO_SUBJECT)).alias("subject"),
        F.coalesce(nz(contact["s_name"]), contact["s_addr"]).alias("brand"),
        contact["s_addr"].alias("brand_email"),
        F.when(is_own(F.col("last_from")["s_addr"], own), F.lit(WAITING)).otherwise(F.lit(NEEDS_REPLY)).alias("status"),
        days_since(last_dt, as_of).alias("days_since"),
        F.date_format(last_dt, "yyyy-MM-dd").alias("last_date"),
        F.col("messages"),
        deep_link(F.col("thread_id"), url_base).alias("url"),
    )


def first_per_thread(threads: DataFrame, ranks: DataFrame) -> DataFrame:
    """Keep one row per thread, the one from the best-ranked account.

    Implemented as a partial aggregate (``min_by`` over the rank) instead of a
    ranking window, so no per-thread sort is needed. ``ranks`` is the small account
    list (one row per configured mailbox)."""
    cols = [c for c in threads.columns if c != "thread_id"]
    ranked = threads.join(ranks, "account", "left")
    last = F.coalesce(F.col("account_rank"), F.lit((1 << 31) - 1))   # an account without a rank comes last
    best = ranked.groupBy("thread_id").agg(
        F.min_by(F.struct(*cols), F.struct(last.alias("rank"), F.col("account"))).alias("r"))
    return best.select("thread_id", *[F.col("r")[c].alias(c) for c in cols])


def order_pitches(threads: DataFrame, position: str | None = None) -> DataFrame:
    """L1: NEEDS REPLY first, then most stale first (stable by thread id)."""
    return sorted_by(threads, [F.col("status") != NEEDS_REPLY, F.desc("days_since"), "thread_id"], position)


def status_counts(threads: DataFrame) -> DataFrame:
    """Threads per status section."""
    return threads.groupBy("status").agg(F.count(F.lit(1)).alias("threads"))


def offer_summary(msgs: DataFrame, own: Sequence[str], as_of: Column,
                  keys: Sequence[str] = ("account", "thread_id")) -> DataFrame:
    """The draft tool's variant of A20: subject of the first message only (else the
    placeholder), contact defaults to the first sender rather than the last."""
    snd = split_sender("from_hdr", "thread")
    m = (msgs.select(*keys, "seq", "internal_ms", "subject",
                     snd["name"].alias("s_name"), snd["address"].alias("s_addr"))
         .withColumn("k", _order_key()).withColumn("own", is_own("s_addr", own)))
    who = F.struct("s_name", "s_addr")
    agg = m.groupBy(*keys).agg(
        F.min_by("subject", "k").alias("first_subject"),
        F.min_by(who, "k").alias("first_from"),
        F.min_by(who, F.when(~F.col("own"), F.col("k"))).alias("first_ext"),
        F.max("internal_ms").alias("last_ms"),
    )
    contact = F.coalesce(F.col("first_ext"), F.col("first_from"))
    return agg.select(
        *keys,
        F.coalesce(F.col("first_subject"), F.lit(NO_SUBJECT)).alias("subject"),
        contact["s_name"].alias("brand"),
        contact["s_addr"].alias("brand_email"),
        days_since(ms_to_ntz("last_ms"), as_of).alias("days_since"),
    )


def match_offers(offers: DataFrame, term: str) -> DataFrame:
    """P10: offers whose subject, brand or address contains ``term`` (case-insensitive),
    with the number of hits so a caller can tell none / one / many apart."""
    t = term.lower()
    hit = (F.lower(F.coalesce("subject", F.lit(""))).contains(t)
           | F.lower(F.coalesce("brand", F.lit(""))).contains(t)
           | F.lower(F.coalesce("brand_email", F.lit(""))).contains(t))
    return offers.filter(hit)


def match_cardinality(matches: DataFrame) -> DataFrame:
    """P10 outcome: ``none`` / ``one`` / ``many`` from a distributed count."""
    n = F.count(F.lit(1))
    return matches.agg(n.alias("hits"), F.when(n == 0, "none").when(n == 1, "one")
                       .otherwise("many").alias("outcome"))


# Line separators recognised by Python's str.splitlines.
LINE_SPLIT = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"
STOP_LINE = r"^On .+ wrote:$"


def take_until(lines, stop_regex: str = STOP_LINE) -> Column:
    """The lines before the first one whose stripped text matches ``stop_regex``."""
    arr = col_of(lines)
    pos = F.array_position(F.transform(arr, lambda l: strip_ws(l).rlike("(?d)" + stop_regex)), True)
    return F.when(pos > 0, F.slice(arr, 1, (pos - 1).cast("int"))).otherwise(arr)


def strip_quotes(text) -> Column:
    """Drop lines whose stripped text starts with ``>``, stop at the first
    ``On ... wrote:`` line, join with newlines and strip."""
    lines = F.split(F.coalesce(col_of(text), F.lit("")), LINE_SPLIT)
    lines = F.filter(lines, lambda l: ~strip_ws(l).startswith(">"))
    return strip_ws(F.array_join(take_until(lines), "\n"))


def thread_transcript(msgs: DataFrame, own: Sequence[str], max_body: int | None = None,
                      keys: Sequence[str] = ("account", "thread_id")) -> DataFrame:
    """Q9 transcript rows: one row per message with its thread order key (L7:
    ``internal_ms, seq``), the speaker label (X41) and the body with quotes removed
    (X7, X8), cut to ``max_body`` characters if that is given. Ordering is left to ``ordered_thread`` so no single
    task has to rank a whole (possibly huge) thread."""
    snd = split_sender("from_hdr", "thread")
    body = strip_quotes(F.col("body"))
    return msgs.select(
        *keys, "message_id", "internal_ms", "seq",
        speaker(snd["name"], snd["address"], is_own(snd["address"], own)).alias("who"),
        F.coalesce(F.col("subject"), F.lit("")).alias("subject"),
        (body if max_body is None else F.substring(body, 1, max_body)).alias("body"),
    )


def ordered_thread(transcript: DataFrame, keys: Sequence[str] = ("account", "thread_id")) -> DataFrame:
    """Messages in thread order, as a distributed range-partitioned sort."""
    return transcript.orderBy(*keys, "internal_ms", "seq")


def write_report(threads: DataFrame, path: str) -> None:
    """K6: the open threads as JSON documents, one a line."""
    threads.write.json(path)
