"""Q1 ``import_mailbox``: scanned messages, of one part or of many, to notes and attachments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions import mail as M
from notelake.functions.common import strip_ws
from notelake.functions.mime import decoded_words
from notelake.functions.text import choose_body
from notelake.operators import mime as MI
from notelake.operators import parts as P
from notelake.operators.labels import display_labels, parse_labels
from notelake.operators.naming import assign_unique_names
from notelake.operators.render import render_note
from notelake.operators.routing import classify_mbox
from notelake.session import materialise


def with_headers(messages: DataFrame) -> DataFrame:
    """``messages(content BINARY, ...)`` with ``headers`` (folded lines unfolded), ``mime`` and
    ``text`` (what follows the first blank line, invalid UTF-8 replaced)."""
    t = messages.withColumn("_all", F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n", "\n"))
    at = F.locate("\n\n", "_all")
    cut = t.select("*", F.when(at > 0, F.substring("_all", F.lit(1), at - 1)).otherwise(F.col("_all")).alias("_head"),
                   F.when(at > 0, F.substring("_all", at + 2, F.length("_all"))).otherwise("").alias("text"))
    lines = F.filter(F.split(F.regexp_replace("_head", r"\n[ \t]+", " "), "\n"), lambda x: x.contains(":"))
    named = cut.select("*", F.transform(lines, lambda x: F.struct(
        strip_ws(F.substring_index(x, ":", 1)).alias("name"),
        strip_ws(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value"))).alias("headers"))
    mime = F.lower(strip_ws(F.substring_index(M.header("headers", "Content-Type"), ";", 1)))
    return named.select(*messages.columns, "headers", F.coalesce(F.nullif(mime, F.lit("")), F.lit("text/plain")).alias("mime"), "text")


def import_mailbox(messages: DataFrame, account: str, skip: Sequence[str], cutoff: Column | None = None,
                   hidden: Sequence[str] = ("Unread", "Opened"), existing: DataFrame | None = None,
                   saved: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(classified, notes, attachments)`` of scanned messages (S1): outcomes in the mailbox order
    (P15: labels, date, cutoff) with the number of attachments saved; ``file, seq, name, ts, content``
    of the created ones (W1 in file order; bodies of all their parts, A25); and ``file, seq,
    part_path, filename, out_name, content`` of what is saved (P6, R2: equal names of a day are
    numbered over all messages, after those in ``saved``)."""
    order = ["file", "seq", "part_path"]
    h = with_headers(messages)
    read = h.select("file", "seq", *[decoded_words(M.header("headers", n)).alias(c) for n, c in (
        ("Subject", "subject"), ("From", "from_hdr"), ("To", "to_hdr"))], *[M.header("headers", n).alias(c) for n, c in (
            ("Date", "date_hdr"), ("X-Gmail-Labels", "label_hdr"))])
    dated = read.select("*", M.parse_rfc_date("date_hdr").alias("ts"), parse_labels("label_hdr").alias("labels"))
    found = materialise(classify_mbox(dated, skip, cutoff, F.lit(False)), "import-classified")
    subject = F.coalesce(F.when(F.col("subject") != "", F.col("subject")), F.lit("(no subject)"))
    made = found.filter("outcome = 'created'").select(
        "*", M.base_name("ts", subject).alias("base_name"), F.format_string("%s#%012d", "file", "seq").alias("key"))
    names = assign_unique_names(made.select("key", "base_name"), "base_name", ["key"], existing=existing, id_col="key", out="name")

    entities = materialise(MI.split_entities(messages.join(made.select("file", "seq"), ["file", "seq"], "left_semi")), "import-entities")
    bodies = MI.entity_bodies(entities)
    listed = materialise(MI.entity_attachments(entities).join(made.select("file", "seq", F.date_format("ts", "yyyy-MM-dd").alias("day")), ["file", "seq"]),
                         "import-attachments")
    kept = P.extractable(listed, MI.SAVED_EXTENSIONS).filter("raw <> ''")
    attachments = materialise(P.attachment_names(kept, "day", "mbox", order, existing=saved).select(
        *order, "filename", "out_name", F.encode("raw", "ISO-8859-1").alias("content")), "import-saved")
    all_names = listed.groupBy("file", "seq").agg(F.array_sort(F.collect_list(F.struct("part_path", "filename"))).alias("listed"))
    links = attachments.groupBy("file", "seq").agg(F.array_sort(F.collect_list(F.struct(
        "part_path", F.col("filename").alias("original"), F.col("out_name").alias("saved")))).alias("kept"))

    sender = M.split_sender("from_hdr", "mbox")
    empty = lambda t: F.array().cast(t)
    rows = made.join(names.select("key", "name"), "key").join(bodies, ["file", "seq"], "left").join(all_names, ["file", "seq"], "left") \
        .join(links, ["file", "seq"], "left").select(
        "file", "seq", "name", "ts", "subject", "from_hdr", "to_hdr", F.lit(account).alias("account"),
        sender["name"].alias("sender_name"), sender["address"].alias("sender_address"), display_labels("labels", hidden).alias("display_labels"),
        choose_body("plain", "html").alias("body"),
        F.coalesce(F.transform("listed", lambda x: x["filename"]), empty("array<string>")).alias("attachment_names"),
        F.coalesce(F.transform("kept", lambda x: F.struct(x["original"], x["saved"])),
                   empty("array<struct<original:string,saved:string>>")).alias("saved_names"))
    counted = attachments.groupBy("file", "seq").agg(F.count(F.lit(1)).alias("attachments"))
    classified = found.join(counted, ["file", "seq"], "left").withColumn("attachments", F.coalesce("attachments", F.lit(0).cast("long")))
    return classified, rows.select("file", "seq", "name", "ts", render_note("mbox").alias("content")), attachments
