"""Q2 ``sync_messages``: scanned messages to notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelake.functions import mail as M
from notelake.operators import brands as BR
from notelake.operators import parts as P
from notelake.operators.labels import display_labels
from notelake.operators.naming import assign_unique_names
from notelake.operators.render import render_note
from notelake.operators.routing import classify_api
from notelake.session import materialise

KEYS = ["account", "message_id"]


def classify_messages(msgs: DataFrame, existing: DataFrame, skip: Sequence[str], dry_run: bool = False) -> DataFrame:
    """Headers, dates (X24, X25), base names (X11) and outcomes (P15) of scanned messages."""
    h = msgs.select("*", *[M.header("headers", n).alias(c) for n, c in (
        ("Subject", "subject"), ("From", "from_hdr"), ("To", "to_hdr"), ("Date", "date_hdr"))])
    read = h.select("*", M.parse_mail_date("date_hdr").alias("header_ts"))     # in steps: each is used more than once
    dated = read.select(*h.columns, F.col("header_ts").isNotNull().alias("header_dated"),
                        F.coalesce("header_ts", M.ms_to_ntz("internal_ms")).alias("ts"))
    subject = F.coalesce(F.when(F.col("subject") != "", F.col("subject")), F.lit("(no subject)"))
    named = materialise(dated.withColumn("base_name", M.base_name("ts", subject, ascii_only=True)), "sync-named")
    return classify_api(named, skip, existing, F.col("message_id").isNull(), dry_run)


def name_notes(classified: DataFrame, existing: DataFrame) -> DataFrame:
    """``KEYS, name`` of the created messages (W1): equal base names are numbered in order of time
    and id, after the names that exist."""
    created = classified.filter("outcome = 'created'").select(
        *KEYS, "internal_ms", "base_name", F.concat_ws("/", *KEYS).alias("key"))
    return assign_unique_names(created, "base_name", ["internal_ms", "account", "message_id"], existing=existing, id_col="key", out="name") \
        .select(*KEYS, "name")


def build_notes(classified: DataFrame, existing: DataFrame, domains: DataFrame, brands_ranked: DataFrame,
                saved: DataFrame, hidden: Sequence[str] = ("UNREAD",), max_chars: int | None = None,
                names: DataFrame | None = None) -> DataFrame:
    """``account, message_id, name, ts, content`` of the created messages: unique names (W1),
    brands (J1, J2), bodies (R3, X6), attachments (P6, P7, J14) and the note text (X17). ``names``
    are those given already; of attachments of equal names the first in order of ``account_rank``
    (if there is one), time, id and part is saved."""
    created = materialise(classified.filter("outcome = 'created'"), "sync-created")
    names = name_notes(created, existing) if names is None else names
    order = [*(["account_rank"] if "account_rank" in created.columns else []), "internal_ms", *KEYS]
    parts = materialise(P.flatten_parts(created.withColumn("day", F.date_format("ts", "yyyy-MM-dd")), [*order, "day"]), "sync-parts")
    bodies = P.message_bodies(created, parts, KEYS, max_chars)
    attached = P.explode_attachments(parts)
    all_names = attached.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("part_path", "filename"))).alias("listed"))
    new = P.drop_saved(P.attachment_names(P.extractable(attached), "day"), saved, [*order, "part_path"])
    kept = new.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("part_path", F.col("filename").alias("original"), F.col("out_name").alias("saved")))).alias("kept"))
    sender = M.split_sender("from_hdr", "api")
    head = created.select(*KEYS, "ts", "subject", "from_hdr", "to_hdr", sender["name"].alias("sender_name"),
                          sender["address"].alias("sender_address"), M.email_domain(sender["address"]).alias("domain"),
                          display_labels("labels", hidden).alias("display_labels"))
    branded = BR.brand_from_subject(BR.lookup_brand(head, domains), brands_ranked)
    rows = branded.join(names, KEYS).join(bodies, KEYS).join(all_names, KEYS, "left").join(kept, KEYS, "left")
    empty = lambda t: F.array().cast(t)
    rows = rows.withColumn("attachment_names", F.coalesce(F.transform("listed", lambda x: x["filename"]), empty("array<string>"))) \
        .withColumn("saved_names", F.coalesce(F.transform("kept", lambda x: F.struct(x["original"], x["saved"])),
                                              empty("array<struct<original:string,saved:string>>")))
    return rows.select(*KEYS, "name", "ts", render_note("api").alias("content"))


def sync_accounts(msgs: DataFrame, accounts: Sequence[str], existing: DataFrame, skip: Sequence[str], domains: DataFrame,
                  brands_ranked: DataFrame, saved: DataFrame, hidden: Sequence[str] = ("UNREAD",),
                  max_chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(classified, notes)`` of one run over several accounts, in the order of the list: the notes
    of earlier accounts exist for later ones, so a mail that two accounts hold becomes one note, and
    names and attachments are numbered on from there. Only outcomes and names depend on the
    accounts before; the notes of all are built at once."""
    known = existing.select(F.col(existing.columns[0]).alias("name"))
    classified, names = None, None
    for rank, account in enumerate(accounts):
        one = materialise(classify_messages(msgs.filter(F.col("account") == account), known, skip)
                          .withColumn("account_rank", F.lit(rank)), "sync-classified")
        given = materialise(name_notes(one, known), "sync-names")
        known = known.unionByName(given.select("name"))
        classified = one if classified is None else classified.unionByName(one)
        names = given if names is None else names.unionByName(given)
    return classified, build_notes(classified, known, domains, brands_ranked, saved, hidden, max_chars, names)
