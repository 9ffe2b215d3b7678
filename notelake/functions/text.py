"""Text transforms: X5 (HTML to text), X6 (body choice)."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from notelake.functions.common import col_of, strip_ws

TRUNCATED = "\n\n...(truncated)..."
NO_BODY = "(no readable body)"

# The entity names of HTML5 come from the standard library's table: names with a semicolon, and
# the older ones that also stand without one.
_NAMED = {k: v for k, v in html.entities.html5.items() if k.endswith(";")}
_BARE = {k: v for k, v in html.entities.html5.items() if not k.endswith(";")}
_BARE_RE = "^(" + "|".join(sorted(_BARE, key=lambda k: (-len(k), k))) + ")"
# Numeric references 128 to 159 stand for the characters of Windows-1252.
_CP1252 = {str(c): chr(c) if c in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([c]).decode("cp1252") for c in range(0x80, 0xA0)}


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.from_json(F.lit(json.dumps(table)), "map<string,string>"), key)   # folded to a constant


def _char(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numeric(code: Column) -> Column:
    """The text of a numeric reference: Windows-1252 for 128-159, U+FFFD for zero, surrogates
    and numbers beyond Unicode, nothing for other control codes and non-characters."""
    replaced = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    dropped = (code.between(1, 8) | (code == 11) | code.between(14, 31) | code.between(127, 159)
               | code.between(0xFDD0, 0xFDEF) | ((code % 65536) >= 65534))
    return (F.when(code.isNull() | replaced, F.lit("\ufffd")).when(code == 13, F.lit("\r"))
            .when(code.between(0x80, 0x9F) & _lookup(_CP1252, code.cast("string")).isNotNull(), _lookup(_CP1252, code.cast("string")))
            .when(dropped, F.lit("")).otherwise(_char(code)))


def _decode_piece(p: Column) -> Column:
    """What follows an ``&``: the decoded reference it begins with and the rest, or itself."""
    num = F.regexp_extract(p, r"^#([0-9]+);?", 1)
    hexa = F.regexp_extract(p, r"^#[xX]([0-9a-fA-F]+);?", 1)
    name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]{0,31};)", 1)
    bare = F.regexp_extract(p, _BARE_RE, 1)
    small = lambda s: F.regexp_replace(s, "^0+(?=.)", "")
    code = F.when(num != "", F.when(F.length(small(num)) > 9, F.lit(1 << 30)).otherwise(small(num).try_cast("long"))) \
        .when(hexa != "", F.when(F.length(small(hexa)) > 8, F.lit(1 << 30)).otherwise(F.conv(hexa, 16, 10).try_cast("long")))
    rest = lambda pattern: F.regexp_replace(p, pattern, "")
    return (F.when((num != "") | (hexa != ""), F.concat(_numeric(code), rest(r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?")))
            .when((name != "") & _lookup(_NAMED, name).isNotNull(),
                  F.concat(_lookup(_NAMED, name), F.substring(p, F.length(name) + 1, F.length(p))))
            .when(bare != "", F.concat(_lookup(_BARE, bare), F.substring(p, F.length(bare) + 1, F.length(p))))
            .otherwise(F.concat(F.lit("&"), p)))


def unescape_entities(c) -> Column:
    """HTML entity decoding, every HTML5 name and numeric reference, once from left to right:
    the text is split at ``&`` and each piece decoded by itself. Texts without an ``&`` are left
    as they are."""
    s = col_of(c)
    pieces = F.split(s, "&", -1)
    decoded = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _decode_piece), ""))
    return F.when(s.contains("&"), decoded).otherwise(s)


def html_to_text(c) -> Column:
    """Ten fixed steps: drop style/script blocks, ``<br>`` and closing block tags
    to newlines, ``<li>`` to ``- ``, links to ``text (url)``, strip tags, decode
    entities, squeeze 3+ newlines, squeeze blanks and tabs, strip."""
    # The patterns of the ten steps, which results must follow.
    s = col_of(c)
    s = F.regexp_replace(s, r"(?is)<(style|script)[^>]*>.*?</\1>", "")
    s = F.regexp_replace(s, r"(?i)<br\s*/?\s*>", "\n")
    s = F.regexp_replace(s, r"(?i)</(p|div|tr|li|h[1-6])>", "\n")
    s = F.regexp_replace(s, r"(?i)<li[^>]*>", "- ")
    s = F.regexp_replace(s, r'(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', "$2 ($1)")
    s = F.regexp_replace(s, r"<[^>]+>", "")
    s = unescape_entities(s)
    s = F.regexp_replace(s, r"\n{3,}", "\n\n")
    s = F.regexp_replace(s, r"[ \t]+", " ")
    return strip_ws(s)


def cut_body(c, n: int | None) -> Column:
    """The text, or with ``n`` its first ``n`` characters and a marker if it is longer."""
    s = col_of(c)
    return s if n is None else F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(TRUNCATED))).otherwise(s)


def choose_body(plain, html, n: int | None = None) -> Column:
    """Plain text if any, else the HTML through X5, else a placeholder; whole by default,
    cut at ``n`` characters with a marker if that is given."""
    p, h = col_of(plain), col_of(html)
    body = (F.when(p.isNotNull(), p)
            .when(h.isNotNull(), html_to_text(h))
            .otherwise(F.lit(NO_BODY)))
    return cut_body(body, n)
