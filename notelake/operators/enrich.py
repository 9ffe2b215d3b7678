"""Q3 note enrichment: W2, J12, U6, X3, J1, X13-X16, K2, A3-A5, P9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions import notes as NF
from notelake.functions.mail import email_domain
from notelake.session import materialise


def build_domain_map(fixed: DataFrame, profiles: DataFrame, generic: DataFrame) -> DataFrame:
    """Domain -> brand. The fixed map claims first; then, profile by
    profile in file-name order (Q20), its ``domain`` property, its
    ``contact_email`` domain and its contact-table addresses in order. Profile
    domains in the generic list are dropped (never the fixed ones). The first claim
    on a domain holds (``min_by`` over the claim order, a partial aggregate)."""
    p = NF.with_frontmatter(profiles.select("file", "content"))
    p = p.select("file", "fm", "body", NF.profile_brand("fm", "content", F.regexp_replace("file", r"\.md$", "")).alias("brand"))
    claims = [
        p.select(F.lower(F.trim(NF.fm_get("fm", "domain"))).alias("domain"), "brand", "file", F.lit(0).alias("pos")),
        p.select(email_domain(NF.fm_get("fm", "contact_email")).alias("domain"), "brand", "file", F.lit(1).alias("pos")),
        p.select(F.posexplode(NF.contact_emails("body")).alias("i", "addr"), "brand", "file")
         .select(email_domain("addr").alias("domain"), "brand", "file", (F.col("i") + 2).alias("pos")),
    ]
    prof = claims[0].unionByName(claims[1]).unionByName(claims[2]).filter(F.coalesce(F.col("domain"), F.lit("")) != "")
    prof = prof.join(generic.select(F.lower("domain").alias("domain")), "domain", "left_anti")
    allc = fixed.select(F.lower("domain").alias("domain"), "brand", F.lit("").alias("file"), F.lit(-1).alias("pos"),
                        F.lit(0).alias("src")).unionByName(prof.withColumn("src", F.lit(1)))
    return allc.groupBy("domain").agg(F.min_by("brand", F.struct("src", "file", "pos")).alias("brand"))


def is_email(has_fm="has_fm", fm="fm") -> Column:
    """The note has frontmatter and its lowercase ``type`` is email, capture or empty."""
    return F.col(has_fm) & F.lower(NF.fm_get(fm, "type")).isin("email", "capture", "")


def email_notes(notes: DataFrame) -> DataFrame:
    """P9 as a filter; only the one property is read, as a filter is evaluated below projections."""
    has, fm_text, _ = NF.frontmatter_parts(F.col("content"))
    kind = F.lower(NF.entry_value(NF.frontmatter_entries(has, fm_text), "type"))
    return notes.filter(has & kind.isin("email", "capture", ""))


def parse_notes(notes: DataFrame) -> DataFrame:
    """``path, content, fm, body, domain`` of each note, written once: X12 and the sender domain
    (X3, null for notes that are not e-mails) are read by every later step."""
    n = NF.with_frontmatter(notes.select("path", "content"))
    n = n.select("*", F.when(is_email(), NF.sender_domain("fm", "body")).alias("domain"))
    return materialise(n.drop("has_fm"), "notes-parsed")


def enrich_decisions(parsed: DataFrame, domain_map: DataFrame) -> DataFrame:
    """J1 + X16 on ``parse_notes``: per note the sender domain, the brand and the decision:
    no_sender, no_match, already_linked (property equal and link present) or updated. Notes
    that are not e-mails count as no_sender (Q16)."""
    n = parsed.join(domain_map, "domain", "left")
    linked = (NF.fm_get("fm", "related_brand") == F.col("brand")) & NF.has_wikilink("body", F.col("brand"))
    decision = (F.when(F.col("domain").isNull(), "no_sender")
                .when(F.col("brand").isNull(), "no_match")
                .when(linked, "already_linked").otherwise("updated"))
    return n.select("path", "domain", "brand", decision.alias("decision"))


def rewritten_notes(parsed: DataFrame, decisions: DataFrame) -> DataFrame:
    """X14 + X15: ``path, new_content`` of the notes to update: the property in the frontmatter
    and the link in the body."""
    upd = decisions.filter("decision = 'updated'").select("path", "brand")
    n = parsed.select("path", "content", "body").join(upd, "path")
    head = F.substring("content", F.lit(1), F.length("content") - F.length("body"))
    parts = n.select("path", "brand", "body", head.alias("head"))
    return parts.select("path", F.concat(NF.upsert_property("head", "related_brand", F.col("brand")),
                                         NF.insert_related("body", F.col("brand"))).alias("new_content"))


def apply_note_updates(notes: DataFrame, updates: DataFrame) -> DataFrame:
    """K2: new snapshot of the note table: changed notes replaced, others kept."""
    upd = updates.select("path", F.col("new_content").alias("_new"))
    return notes.join(upd, "path", "left").select(
        *[c for c in notes.columns if c != "content"], F.coalesce("_new", "content").alias("content"))


def enrich_stats(decisions: DataFrame) -> DataFrame:
    """A3: scanned, matched, updated, already_linked, no_sender, no_match."""
    d = F.col("decision")
    return decisions.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(d.isin("updated", "already_linked")).alias("matched"),
        F.count_if(d == "updated").alias("updated"),
        F.count_if(d == "already_linked").alias("already_linked"),
        F.count_if(d == "no_sender").alias("no_sender"),
        F.count_if(d == "no_match").alias("no_match"))


def updates_by_brand(decisions: DataFrame) -> DataFrame:
    """A4: updated notes per brand."""
    return decisions.filter(F.col("decision") == "updated").groupBy("brand").agg(F.count(F.lit(1)).alias("updated"))


def domains_by_brand(domain_map: DataFrame) -> DataFrame:
    """A5: number of domains per brand (the domains themselves are the rows of the map)."""
    return domain_map.groupBy("brand").agg(F.count(F.lit(1)).alias("domains"))
