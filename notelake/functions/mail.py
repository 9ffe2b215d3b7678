"""Column expressions over mail headers.

All functions take and return ``Column`` objects and use JVM built-ins only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws

# Sender pattern "name <address>", matched from the start of the header.
SENDER_RE = r"(?dU)^(.*?)\s*<(.+?)>"


def split_sender(c, mode: str = "api") -> Column:
    """Split a From header into ``struct(name, address)``.

    The name is whitespace-trimmed, then stripped of surrounding double quotes.
    Without ``<...>`` the fallback depends on ``mode``:

    * ``mbox``   name = header, address = ``""``
    * ``api``    name = header, address = header (address kept as written)
    * ``slack``  name = address = trimmed header; a matched address is trimmed
    * ``thread`` name = trimmed header, address = lowercase trimmed header; on a
      match the address is trimmed and lowercased as well.
    """
    s = F.coalesce(col_of(c), F.lit(""))
    hit = s.rlike(SENDER_RE)
    raw_name = F.regexp_extract(s, SENDER_RE, 1)
    name = F.regexp_replace(strip_ws(raw_name), r'^"+|"+$', "")
    addr = F.regexp_extract(s, SENDER_RE, 2)
    trimmed = strip_ws(s)
    if mode == "mbox":
        out_name, out_addr = F.when(hit, name).otherwise(s), F.when(hit, addr).otherwise(F.lit(""))
    elif mode == "api":
        out_name, out_addr = F.when(hit, name).otherwise(s), F.when(hit, addr).otherwise(s)
    elif mode == "slack":
        out_name = F.when(hit, name).otherwise(trimmed)
        out_addr = F.when(hit, strip_ws(addr)).otherwise(trimmed)
    elif mode == "thread":
        out_name = F.when(hit, name).otherwise(trimmed)
        out_addr = F.lower(F.when(hit, strip_ws(addr)).otherwise(trimmed))
    else:
        raise ValueError(f"unknown sender mode {mode!r}")
    return F.struct(out_name.alias("name"), out_addr.alias("address"))


def email_domain(c) -> Column:
    """Domain of an address: strip blanks and quotes, prefer ``<...>``, take the
    text after the last ``@``, trim and lowercase; null when there is no ``@``."""
    s = strip_ws(col_of(c))
    s = F.regexp_replace(F.regexp_replace(s, r'^"+|"+$', ""), r"^'+|'+$", "")
    inner = F.regexp_extract(s, r"<([^>]+)>", 1)
    s = F.when(inner != "", inner).otherwise(s)
    dom = F.lower(strip_ws(F.substring_index(s, "@", -1)))
    return F.when(s.contains("@"), dom)


def header(headers, name: str, mode: str = "api") -> Column:
    """Header lookup in ``array<struct<name,value>>``.

    ``api``: case-insensitive, first match wins, ``""`` when absent.
    ``exact``: exact-case, last match wins (dictionary semantics), null when absent.
    """
    h = col_of(headers)
    if mode == "api":
        hit = F.filter(h, lambda x: F.lower(x["name"]) == name.lower())
        return F.coalesce(F.try_element_at(hit, F.lit(1))["value"], F.lit(""))
    if mode == "exact":
        hit = F.filter(h, lambda x: x["name"] == name)
        return F.try_element_at(hit, F.lit(-1))["value"]
    raise ValueError(mode)


def ellipsis(c, n: int) -> Column:
    """Keep at most ``n`` characters; longer text becomes n-1 characters + '…'."""
    s = col_of(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n - 1), F.lit("…"))).otherwise(s)


def safe_name(c, max_len: int = 80, ascii_only: bool = False) -> Column:
    """File-name-safe text: (optionally drop non-ASCII), drop ``<>:"/\\|?*`` and
    control characters, collapse whitespace, trim, cut to ``max_len`` and right-trim,
    ``untitled`` when nothing is left."""
    s = F.coalesce(col_of(c), F.lit(""))
    if ascii_only:
        s = F.regexp_replace(s, r"[^\x00-\x7F]", "")
    s = F.regexp_replace(s, r'[<>:"/\\|?*\x00-\x1f]', "")
    s = strip_ws(F.regexp_replace(s, r"(?U)\s+", " "))
    s = F.when(F.length(s) > max_len, F.regexp_replace(F.substring(s, 1, max_len), r"(?U)\s+$", "")).otherwise(s)
    return F.when(s == "", F.lit("untitled")).otherwise(s)


def base_name(ts, subject, ascii_only: bool = False) -> Column:
    """X11: ``yyyy-MM-dd_<safe subject, 60 characters>``."""
    return F.concat(F.date_format(col_of(ts), "yyyy-MM-dd"), F.lit("_"),
                    safe_name(subject, 60, ascii_only))


def decode_b64url(c) -> Column:
    """URL-safe base64 to text; invalid UTF-8 replaced, undecodable input -> null."""
    s = col_of(c)
    raw = F.try_to_binary(F.translate(s, "-_", "+/"), F.lit("base64"))
    decoded = F.make_valid_utf8(raw.cast("string"))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(
        F.when(decoded == "", F.lit(None).cast("string")).otherwise(decoded))


# Accepted mail date shapes (Python strptime formats
# "%a, %d %b %Y %H:%M:%S %z", "%a, %d %b %Y %H:%M:%S %Z", "%d %b %Y %H:%M:%S %z",
# "%a, %d %b %Y %H:%M:%S", then, with a trailing comment and offset removed,
# "%a, %d %b %Y %H:%M:%S" and "%d %b %Y %H:%M:%S").
# The parts of those shapes: weekday, day to second, offset.
_WD = r"(?i:mon|tue|wed|thu|fri|sat|sun),\s+"
_CORE = r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2})"
_OFF = r"(?:[+-]\d{4}|[+-]\d{2}:\d{2}|Z)"
DATE_SHAPES = [
    rf"^(?:{_WD})?{_CORE}\s+{_OFF}$",
    rf"^{_WD}{_CORE}\s+(?i:UTC|GMT)$",
    rf"^{_WD}{_CORE}$",
]
DATE_CLEANED_SHAPE = rf"^(?:{_WD})?{_CORE}$"


def parse_mail_date(c) -> Column:
    """Mail Date header to TIMESTAMP_NTZ keeping the sender's wall clock.

    Accepts the four strptime shapes above; failing those, a trailing ``(comment)``
    and then a trailing ``+hhmm`` offset are removed and two shapes retried. The zone
    is dropped, never converted. Anything else is null.
    """
    raw = col_of(c)
    s = strip_ws(raw)
    cleaned = strip_ws(F.regexp_replace(F.regexp_replace(raw, r"\s*\([^)]*\)\s*$", ""),
                                        r"\s*[+-]\d{4}\s*$", ""))
    cands = [F.when(s.rlike(p), F.regexp_extract(s, p, 1)) for p in DATE_SHAPES]
    cands.append(F.when(cleaned.rlike(DATE_CLEANED_SHAPE), F.regexp_extract(cleaned, DATE_CLEANED_SHAPE, 1)))
    core = F.regexp_replace(F.coalesce(*cands), r"\s+", " ")
    parts = F.split(F.regexp_replace(core, ":", " "), " ")
    month = F.instr(F.lit(MONTHS), F.upper(parts[1]))
    return F.when(month % 3 == 1, F.try_make_timestamp_ntz(
        parts[2].cast("int"), ((month + 2) / 3).cast("int"), parts[0].cast("int"),
        parts[3].cast("int"), parts[4].cast("int"), parts[5].cast("int")))


# The RFC shape of a mailbox Date header: optional weekday, day, month name, year of
# two or four digits, time with optional seconds, optional zone and comment.
RFC_DATE = (r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*[\s-]+(\d{2}|\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
            r"(?:\s+(?:[+-]\d{4}|[A-Za-z]{1,5}))?(?:\s*\([^)]*\))?$")


def parse_rfc_date(c) -> Column:
    """X24 in the mailbox import: RFC dates to TIMESTAMP_NTZ with the sender's wall clock (two
    digits of a year are 1969 to 2068); anything else is null."""
    s = strip_ws(col_of(c))
    part = lambda i: F.regexp_extract(s, RFC_DATE, i)
    month = F.instr(F.lit(MONTHS), F.upper(part(2)))
    year = part(3).try_cast("int")
    full = F.when(F.length(part(3)) == 2, year + F.when(year < 69, 2000).otherwise(1900)).otherwise(year)
    return F.when(month % 3 == 1, F.try_make_timestamp_ntz(
        full, ((month + 2) / 3).cast("int"), part(1).try_cast("int"), part(4).try_cast("int"), part(5).try_cast("int"),
        F.coalesce(part(6).try_cast("int"), F.lit(0))))


# Month abbreviations in calendar order.
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def ms_to_ntz(ms) -> Column:
    """Epoch milliseconds to a UTC wall-clock TIMESTAMP_NTZ, independent of session zone."""
    return F.timestamp_add("MILLISECOND", col_of(ms).cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def ntz_to_ms(ts) -> Column:
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col_of(ts))


def message_ts(date_header, internal_ms) -> Column:
    """Parsed Date header, else ``internalDate`` (epoch ms, UTC), else null."""
    return F.coalesce(parse_mail_date(date_header), ms_to_ntz(col_of(internal_ms).try_cast("bigint")))


def days_since(ts, as_of) -> Column:
    """Whole days elapsed from ``ts`` to ``as_of`` (floor), both NTZ."""
    secs = F.timestamp_diff("SECOND", col_of(ts), col_of(as_of))
    return F.floor(secs / F.lit(86400)).cast("bigint")


def age_label(days) -> Column:
    """``today`` for 0, else ``Nd ago``."""
    d = col_of(days)
    return F.when(d == 0, F.lit("today")).otherwise(F.concat(d.cast("string"), F.lit("d ago")))


def deep_link(c, base: str) -> Column:
    """Link to a message or thread id under a configurable base address."""
    return F.concat(F.lit(base), col_of(c))


def speaker(name, address, is_own, own_label: str = "us") -> Column:
    """Own side label, else ``name <address>``."""
    return F.when(col_of(is_own), F.lit(own_label)).otherwise(
        F.concat(col_of(name), F.lit(" <"), col_of(address), F.lit(">")))
