"""Column expressions over raw mail: header blocks, parameters, transfer encodings, charsets and
encoded words. Raw text is held with one character a byte (ISO-8859-1), so every step up to the
charset works on strings; lines end with ``\\n``.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from notelake.functions.common import col_of, strip_ws

# A line of a header block, an encoded word.
HEADER_LINE = r"^(?:From |[!-9;-~]*:|[ \t])"
ENCODED_WORD = r"=\?([^?]*)\?([qQbB])\?([^?\n]*)\?="
#: Single-byte charsets; the characters of their upper halves come from the standard library's codecs.
SINGLE_BYTE = [*[f"windows-{n}" for n in range(1250, 1259)], *[f"iso-8859-{n}" for n in (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16)],
               "koi8-r", "koi8-u", "cp437", "cp850", "mac-roman"]
_HIGH = "".join(map(chr, range(128, 256)))
_MARK = "\x01"      # set around encoded words while a header is read


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def raw_text(content) -> Column:
    """Bytes as one character each, lines ending with a newline."""
    return F.replace(F.decode(col_of(content), "ISO-8859-1"), F.lit("\r\n"), F.lit("\n"))


def _bytes(c: Column) -> Column:
    return F.encode(c, "ISO-8859-1")


def split_head(entity) -> Column:
    """``struct(head, body)`` of a message or part: the header block ends at a blank line or, without
    one, before the first line that is no header."""
    e = col_of(entity)
    blank = F.locate("\n\n", e)
    top = F.split(F.when(blank > 0, F.substring(e, F.lit(1), blank - 1)).otherwise(e), "\n", -1)
    rest = lambda at: F.substring(e, at.cast("int"), F.length(e))
    both = lambda head, body: F.struct(head.alias("head"), body.alias("body"))
    read = lambda x: _let(F.array_join(F.when(x["other"] == 0, x["lines"]).otherwise(
        F.slice(x["lines"], F.lit(1), F.greatest(x["other"] - 1, F.lit(0)).cast("int"))), "\n"), lambda head: (
            F.when(x["other"] == 0, both(head, F.when(x["blank"] > 0, rest(x["blank"] + 2)).otherwise(F.lit(""))))
            .when(x["other"] == 1, both(F.lit(""), e)).otherwise(both(head, rest(F.length(head) + 2)))))
    lines = _let(top, lambda t: F.struct(t.alias("lines"), F.array_position(F.transform(t, lambda x: x.rlike(HEADER_LINE)), False).alias("other"),
                                         blank.alias("blank")))
    return F.when(F.startswith(e, F.lit("\n")), both(F.lit(""), rest(F.lit(2)))).otherwise(_let(lines, read))


def header_value(head, name: str) -> Column:
    """The first header of that name in a header block, unfolded and stripped; null if absent."""
    unfolded = F.regexp_replace(col_of(head), r"\n[ \t]+", " ")
    hit = F.regexp_extract_all(unfolded, F.lit(rf"(?im)^{name}[ \t]*:(.*)$"), 1)
    return strip_ws(F.get(hit, F.lit(0)))


def parameter(value, name: str) -> Column:
    """A parameter of a header value, quoted or bare; null if absent."""
    v = col_of(value)
    quoted = F.regexp_extract_all(v, F.lit(rf'(?i);\s*{name}\s*=\s*"((?:[^"\\]|\\.)*)"'), 1)
    bare = F.regexp_extract_all(v, F.lit(rf'(?i);\s*{name}\s*=\s*([^";\s][^;]*)'), 1)
    return F.coalesce(F.regexp_replace(F.get(quoted, F.lit(0)), r"\\(.)", "$1"), strip_ws(F.get(bare, F.lit(0))))


def hex_escapes(c: Column, mark: str) -> Column:
    """``mark`` and two hexadecimal digits are the byte they name; other marks stay."""
    byte = lambda p: F.concat(F.decode(F.unhex(F.substring(p, 1, 2)), "ISO-8859-1"), F.substring(p, F.lit(3), F.length(p)))
    read = lambda p, i: F.when(i == 0, p).when(p.rlike("^[0-9A-Fa-f]{2}"), byte(p)).otherwise(F.concat(F.lit(mark), p))
    return F.array_join(F.transform(F.split(c, "[" + mark + "]", -1), read), "")


def base64_text(c: Column) -> Column:
    """Base64 with line ends or other characters in between, and with or without padding; null where
    a single character is left over."""
    return _let(F.regexp_replace(c, "[^A-Za-z0-9+/]", ""), lambda x: F.decode(F.try_to_binary(
        F.rpad(x, (F.ceil(F.length(x) / 4) * 4).cast("int"), "="), F.lit("base64")), "ISO-8859-1"))


def transfer_decoded(body, encoding) -> Column:
    """A part's body without its transfer encoding; bodies with no or another encoding as they are."""
    b, kind = col_of(body), F.lower(F.coalesce(col_of(encoding), F.lit("")))
    return F.when(kind == "quoted-printable", hex_escapes(F.replace(b, F.lit("=\n"), F.lit("")), "=")) \
        .when(kind == "base64", base64_text(b)).otherwise(b)


def _upper_halves() -> dict[str, str]:
    """Names of charsets of one byte a character, in lower case with hyphens, to their characters 128 to 255."""
    table = {"us-ascii": "\ufffd" * 128, "ascii": "\ufffd" * 128, **dict.fromkeys(("iso-8859-1", "iso8859-1", "latin1", "latin-1", "l1"), _HIGH)}
    for name in SINGLE_BYTE:
        upper = "".join(bytes([b]).decode(name, "replace") for b in range(128, 256))
        table |= dict.fromkeys((name, name.replace("windows-", "cp"), name.replace("iso-", "iso")), upper)
    return table


def charset_text(raw, charset) -> Column:
    """Text of raw bytes in a charset (null: UTF-8); bytes without a character are U+FFFD. Null where
    the charset is none of UTF-8, ASCII, Latin-1 and the single-byte ones above."""
    r = col_of(raw)
    halves = F.from_json(F.lit(json.dumps(_upper_halves())), "map<string,string>")       # a constant
    return _let(F.lower(F.replace(F.coalesce(col_of(charset), F.lit("utf-8")), F.lit("_"), F.lit("-"))), lambda kind: F.when(
        kind.isin("utf-8", "utf8"), F.make_valid_utf8(_bytes(r).cast("string"))).otherwise(
            F.call_function("translate", r, F.lit(_HIGH), F.try_element_at(halves, kind))))


def known_charset(name: str) -> bool:
    try:
        return codecs.lookup(name)._is_text_encoding      # transforms as "hex" are none
    except LookupError:
        return False


@F.pandas_udf(StringType())
def other_charset_text(raw: pd.Series, charset: pd.Series) -> pd.Series:
    """The few bodies in charsets of several bytes a character (the JVM functions have none);
    null where the charset is unknown."""
    return pd.Series([bytes(b).decode(c, "replace") if b is not None and c and known_charset(c) else None for b, c in zip(raw, charset)])


def decoded_words(header) -> Column:
    """A header with its encoded words decoded: neighbours of one charset are joined, white space
    between two words is dropped, and what is left is joined by blanks. A header with a word whose
    data or charset cannot be read stays as it is."""
    part = lambda w, i: F.regexp_extract(w, ENCODED_WORD, i)
    data = lambda w: F.when(F.lower(part(w, 2)) == "b", base64_text(part(w, 3))).otherwise(
        hex_escapes(F.replace(part(w, 3), F.lit("_"), F.lit(" ")), "="))
    token = lambda charset, text: F.struct(charset.alias("charset"), text.alias("text"))
    none = F.lit(None).cast("string")

    def inner(h: Column) -> Column:
        near = F.regexp_replace(F.replace(h, F.lit(_MARK), F.lit("")), r"(?<=\?=)\s+(?=" + ENCODED_WORD + ")", "")
        pieces = F.split(F.regexp_replace(near, "(" + ENCODED_WORD + ")", f"{_MARK}$1{_MARK}"), _MARK, -1)     # every second one is a word
        tokens = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, token(F.lower(part(p, 1)), data(p))).otherwise(
            token(none, F.when(i == 0, F.regexp_replace(p, r"^\s+", "")).otherwise(p))))
        joined = F.aggregate(
            F.filter(tokens, lambda t: t["charset"].isNotNull() | (t["text"] != "")), F.array().cast("array<struct<charset:string,text:string>>"),
            lambda acc, t: F.when(F.try_element_at(acc, F.lit(-1))["charset"] == t["charset"], F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(token(t["charset"], F.concat(F.try_element_at(acc, F.lit(-1))["text"], t["text"]))))).otherwise(F.concat(acc, F.array(t))))
        texts = F.transform(joined, lambda t: F.when(t["charset"].isNull(), t["text"]).otherwise(charset_text(t["text"], t["charset"])))
        return _let(texts, lambda x: F.when(F.exists(x, lambda t: t.isNull()), h).otherwise(strip_ws(F.array_join(x, " "))))

    return _let(col_of(header), lambda h: F.when(h.rlike(ENCODED_WORD), inner(h)).otherwise(h))


def file_name(disposition, content_type) -> Column:
    """The file name of a part: ``filename`` of the disposition, else ``name`` of the type, each also
    as ``filename*`` with a charset and as numbered pieces. Null if absent."""
    return F.coalesce(_named(col_of(disposition), "filename"), _named(col_of(content_type), "name"))


def _named(value: Column, name: str) -> Column:
    star = rf'(?i);\s*{name}(?:\*(\d+))?(\*)?\s*=\s*("[^"]*"|[^";\s]*)'
    pieces = F.array_sort(F.transform(F.regexp_extract_all(value, F.lit(rf'(?i);\s*{name}\*\d*\*?\s*=\s*(?:"[^"]*"|[^";\s]*)'), 0), lambda p: F.struct(
        F.coalesce(F.regexp_extract(p, star, 1).try_cast("int"), F.lit(0)).alias("at"), (F.regexp_extract(p, star, 2) == "*").alias("escaped"),
        F.replace(F.regexp_extract(p, star, 3), F.lit('"'), F.lit("")).alias("text"))))
    joined = lambda x: F.array_join(F.transform(x, lambda p: F.when(p["escaped"], hex_escapes(p["text"], "%")).otherwise(p["text"])), "")
    read = lambda x: F.when(F.get(x, F.lit(0))["escaped"], _let(joined(x), lambda t: charset_text(
        F.regexp_replace(t, "^[^']*'[^']*'", ""), F.nullif(F.regexp_extract(t, "^([^']*)'", 1), F.lit(""))))) \
        .when(F.size(x) > 0, joined(x))
    return F.coalesce(parameter(value, name), _let(pieces, read))
