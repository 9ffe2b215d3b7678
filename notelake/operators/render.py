"""Note rendering and the note sink: X17, K1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions.notes import attachment_links

#: Fixed value: where the recipient property can be cut (Q25).
RECIPIENT_CHARS = 200


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))


def render_note(style: str, recipient_chars: int | None = None) -> Column:
    """The note text of a message row. Columns: ``account, from_hdr, to_hdr, subject, ts,
    display_labels, sender_name, sender_address, body, attachment_names`` (array),
    ``saved_names`` (array of ``struct<original, saved>``) and, in the ``api`` style, ``brand``.

    ``mbox`` writes type, account, from, from_email, to, subject, date, labels, status; ``api``
    writes sender, sender_email, recipient, subject, email_date, account, labels,
    related_brand, related_campaign, related_contact, tags, created, status. Double quotes in
    the subject property become single ones. ``recipient_chars`` cuts the recipient property."""
    subject = F.coalesce(F.when(F.col("subject") != "", F.col("subject")), F.lit("(no subject)"))
    to = F.coalesce("to_hdr", F.lit(""))
    cut = to if recipient_chars is None else F.substring(to, 1, recipient_chars)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T"), F.date_format("ts", "HH:mm:ss"))
    labels = F.concat(F.lit("["), F.array_join(F.transform("display_labels", _quoted), ", "), F.lit("]"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    prop_subject = line("subject", _quoted(F.replace(subject, F.lit('"'), F.lit("'"))))
    if style == "mbox":
        block = [F.lit("type: email"), line("account", _quoted(F.col("account"))), line("from", _quoted(F.col("sender_name"))),
                 line("from_email", _quoted(F.col("sender_address"))), line("to", _quoted(cut)), prop_subject,
                 line("date", stamp), line("labels", labels), F.lit("status: unprocessed")]
    elif style == "api":
        brand = F.when(F.coalesce("brand", F.lit("")) != "", _quoted(F.col("brand"))).otherwise(F.lit(""))
        block = [F.lit("type: email"), line("sender", _quoted(F.col("sender_name"))), line("sender_email", _quoted(F.col("sender_address"))),
                 line("recipient", _quoted(cut)), prop_subject, line("email_date", stamp), line("account", _quoted(F.col("account"))),
                 line("labels", labels), line("related_brand", brand), F.lit("related_campaign:"), F.lit("related_contact:"),
                 F.lit("tags:"), F.lit("  - email"), line("created", F.date_format("ts", "yyyy-MM-dd")), F.lit("status: unprocessed")]
    else:
        raise ValueError(f"unknown note style {style!r}")
    bold = lambda key, value: F.concat(F.lit(f"**{key}:** "), value)
    shown = F.when(F.size("display_labels") > 0, F.array_join("display_labels", ", ")).otherwise("none")
    names, saved = F.col("attachment_names"), F.col("saved_names")
    head = [bold("From", F.coalesce("from_hdr", F.lit(""))), bold("To", to), bold("Date", F.date_format("ts", "yyyy-MM-dd HH:mm")),
            bold("Account", F.col("account")), bold("Labels", shown)]
    if style == "api":
        head.append(F.when(F.coalesce("brand", F.lit("")) != "", F.concat(F.lit("**Brand:** [["), "brand", F.lit("]]"))))
    head.append(F.when(F.size(names) > 0, bold("Attachments", F.array_join(names, ", "))))
    if style == "api":
        head.append(F.when((F.size(names) > 0) & (F.size(saved) > 0), bold("Saved", F.array_join(
            F.transform(saved, lambda x: F.concat(F.lit("[["), x["saved"], F.lit("]]"))), ", "))))
        links = F.lit("")
    else:
        links = F.when(F.size(saved) > 0, F.concat(F.lit("\n\n**Saved attachments:**\n"), attachment_links("saved_names"))) \
            .otherwise(F.lit(""))
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *block), F.lit("\n---\n\n# "), subject, F.lit("\n\n"),
                    F.concat_ws("\n", *head), links, F.lit("\n\n---\n\n"), F.col("body"), F.lit("\n"))


def write_notes(notes: DataFrame, path: str, mode: str = "append") -> None:
    """K1: ``notes(name, ts, content)`` as a note table by month; the path column is the name
    with ``.md``."""
    notes.select(F.concat("name", F.lit(".md")).alias("path"), "content", F.date_format("ts", "yyyy-MM").alias("email_month")) \
        .write.mode(mode).partitionBy("email_month").parquet(path)
