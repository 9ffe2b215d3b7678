"""Markdown note functions: X12-X17, X19, X22, S9 helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws
from notelake.functions.mail import email_domain


def frontmatter_parts(content) -> tuple[Column, Column, Column]:
    """Split a note into ``(has_fm, fm_text, body)``: frontmatter runs from a leading
    ``---`` to the next ``\\n---`` after index 3; the body starts after it."""
    c = col_of(content)
    end = F.locate("\n---", c, 4)
    has = c.startswith("---") & (end > 0)
    fm_text = F.when(has, strip_ws(F.substring(c, F.lit(4), end - 4)))
    body = F.when(has, F.substring(c, end + 4, 1 << 30)).otherwise(c)
    return has, fm_text, body


def _unquote(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip_ws(c), '^"+|"+$', ""), "^'+|'+$", "")


def frontmatter_entries(has, fm_text) -> Column:
    """The ``key: value`` lines of a frontmatter text: lines holding ``:`` that do not start
    with ``-`` or ``#``; key before the first colon (stripped), value after it (stripped and
    unquoted)."""
    lines = F.split(F.when(col_of(has), col_of(fm_text)), "\n")
    keep = F.filter(lines, lambda l: l.contains(":") & ~F.regexp_like(l, F.lit(r"(?U)^\s*[-#]")))
    return F.coalesce(F.transform(keep, lambda l: F.struct(
        strip_ws(F.substring_index(l, ":", 1)).alias("key"),
        _unquote(F.substring(l, F.instr(l, ":") + 1, F.length(l))).alias("value"))), F.array().cast("array<struct<key:string,value:string>>"))


def entry_value(entries, key: str) -> Column:
    """X12 for one property: the last value of ``key``, ``""`` without one."""
    hit = F.filter(col_of(entries), lambda e: e["key"] == key)
    return F.coalesce(F.try_element_at(hit, F.lit(-1))["value"], F.lit(""))


def entries_to_map(entries) -> Column:
    """Entries as a map, the last duplicate key wins. ``entries`` is to be a column of its
    own, as it is used for each key."""
    ent = col_of(entries)
    keys = F.array_distinct(F.transform(ent, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(ent, lambda e: e["key"] == k), -1)["value"]))


def with_frontmatter(df: DataFrame, content: str = "content") -> DataFrame:
    """``df`` with ``has_fm``, ``fm`` (X12: property map, empty without frontmatter) and ``body``,
    in steps, so that each part is computed once a row."""
    has, fm_text, body = frontmatter_parts(F.col(content))
    cut = df.select("*", has.alias("has_fm"), fm_text.alias("_fm_text"), body.alias("body"))
    listed = cut.select("*", frontmatter_entries("has_fm", "_fm_text").alias("_entries"))
    return listed.select(*df.columns, "has_fm", entries_to_map("_entries").alias("fm"), "body")


def fm_get(fm, key: str) -> Column:
    return F.coalesce(F.try_element_at(col_of(fm), F.lit(key)), F.lit(""))


def sender_domain(fm, body) -> Column:
    """Domain from ``from_email``, then ``from``, then ``sender_email``, then the
    first ``**From:**`` line of the body."""
    # The pattern of the body's sender line.
    line = F.regexp_extract(col_of(body), r"(?d)\*\*From:\*\*\s*(.+)", 1)
    return F.coalesce(email_domain(fm_get(fm, "from_email")), email_domain(fm_get(fm, "from")),
                      email_domain(fm_get(fm, "sender_email")), email_domain(F.when(line != "", line)))


def has_wikilink(body, name) -> Column:
    """``[[name]]`` or ``[[name|...]]`` in the body (case-sensitive)."""
    b, n = col_of(body), col_of(name)
    return b.contains(F.concat(F.lit("[["), n, F.lit("]]"))) | \
        F.regexp_like(b, F.concat(F.lit(r"\[\[\Q"), n, F.lit(r"\E\|[^\]]+\]\]")))


def upsert_property(content, key: str, value) -> Column:
    """Set ``key: "value"`` in the frontmatter: replace an existing line, else
    append at the end of the block. Only blanks and tabs after the colon are
    consumed (Q1 fix: an empty property does not swallow the next line)."""
    c, v = col_of(content), col_of(value)
    end = F.locate("\n---", c, 4)
    has = c.startswith("---") & (end > 0)
    block = F.substring(c, F.lit(4), end - 4)
    rest = F.substring(c, end, 1 << 30)
    line = F.concat(F.lit(f"{key}: \""), v, F.lit('"'))
    exists = block.rlike(f"(?md)^{key}:")
    replaced = F.regexp_replace(block, F.lit(f"(?md)^({key}:)[ \\t]*.*$"),
                                F.concat(F.lit("$1 \""), F.regexp_replace(v, r"([\\$])", r"\\$1"), F.lit('"')))
    appended = F.concat(F.regexp_replace(block, r"(?U)\s+$", ""), F.lit("\n"), line)
    return F.when(has, F.concat(F.lit("---"), F.when(exists, replaced).otherwise(appended), rest)).otherwise(c)


def insert_related(body, name) -> Column:
    """Unless already linked, put ``- [[name]]`` under an existing ``## Related``
    header, else append a ``## Related`` section."""
    b, n = col_of(body), col_of(name)
    item = F.concat(F.lit("- [["), n, F.lit("]]\n"))
    hdr_re = r"(?md)^## Related\s*\n"
    hdr = F.regexp_extract(b, hdr_re, 0)
    split_at = F.regexp_instr(b, F.lit(hdr_re)) + F.length(hdr)
    under = F.concat(F.substring(b, F.lit(1), split_at - 1), item, F.substring(b, split_at, 1 << 30))
    section = F.concat(F.regexp_replace(b, r"(?U)\s+$", ""), F.lit("\n\n## Related\n"), item)
    return F.when(has_wikilink(b, n), b).when(hdr != "", under).otherwise(section)


def contact_emails(body) -> Column:
    """Addresses in the second cell of markdown table rows."""
    # The pattern of a contact-table row.
    return F.regexp_extract_all(col_of(body),
                                F.lit(r"\|\s*[^|]+\s*\|\s*([a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+)\s*\|"), 1)


def profile_brand(fm, content, stem) -> Column:
    """Brand of a profile: ``company`` property, else the first H1, else the file stem."""
    company = _unquote(fm_get(fm, "company"))
    h1 = strip_ws(F.regexp_extract(col_of(content), r"(?md)^# (.+)$", 1))
    return F.coalesce(F.when(company != "", company), F.when(h1 != "", h1), col_of(stem))


def attachment_links(names) -> Column:
    """``[[attachments/<saved>|<original>]]`` link lines from
    ``array<struct<original, saved>>``."""
    return F.array_join(F.transform(col_of(names), lambda x: F.concat(
        F.lit("- [[attachments/"), x["saved"], F.lit("|"), x["original"], F.lit("]]"))), "\n")
