"""Text, date and JSON column functions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressroom.functions.urls import col, let


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(""))


def clean_text(value: Column | str) -> Column:
    """Collapse every run of Unicode blanks to one space, strip, empty becomes null."""
    # trim() first needs the runs collapsed, which leaves plain spaces only.
    return F.nullif(F.trim(F.regexp_replace(col(value), r"(?U)[\s\x1c-\x1f]+", " ")), F.lit(""))


def word_count(value: Column | str) -> Column:
    words = F.coalesce(F.size(F.split(clean_text(value), " ")), F.lit(0))
    return F.when(words > 0, words).otherwise(0).cast("bigint")


def content_length(value: Column | str) -> Column:
    """Length in code points, null counts as 0."""
    return F.coalesce(F.char_length(col(value)), F.lit(0)).cast("bigint")


#: Named entities of HTML with their closing semicolon, as one map literal.
_NAMED = json.dumps({f"&{name}": text for name, text in html5.items() if name.endswith(";")})
_ENTITY = r"&(?:#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+);"


def _glyph(piece: Column) -> Column:
    """The character of one numeric entity of any length; an illegal number becomes the replacement character."""
    digits = F.regexp_extract(piece, r"^&#[xX]?0*+([0-9A-Fa-f]*+);", 1)
    number = F.when(piece.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    point = F.when(F.length(digits) <= 7, F.coalesce(number.try_cast("int"), F.lit(0))).otherwise(0x110000)

    def text(n: Column) -> Column:
        # Four big-endian bytes decoded as UTF-32 are exactly one code point.
        legal = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        safe = F.when(legal, n).otherwise(0xFFFD)
        return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")

    return let(point, text)


def decode_entities(value: Column) -> Column:
    """Decode every entity of a text once; what decoding gives is not decoded again, unknown names stay as they are."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def character(piece: Column) -> Column:
        return F.when(piece.startswith("&#"), _glyph(piece)).otherwise(F.coalesce(F.try_element_at(named, piece), piece))

    def decoded(text: Column) -> Column:
        between = F.split(text, _ENTITY, -1)
        found = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
        joined = F.zip_with(between, found, lambda t, e: F.concat(t, F.when(e.isNull(), "").otherwise(character(e))))
        return F.array_join(joined, "")

    return let(value, lambda v: F.when(v.contains("&"), decoded(v)).otherwise(v))


def strip_html(value: Column | str) -> Column:
    """Text between the tags of a fragment, pieces joined by one space; script and style bodies go.

    A ``<`` that no ``>`` closes before the next one is text. Possessive repeats run without a stack frame per character.
    """
    no_code = F.regexp_replace(col(value), r"(?is)<(script|style|template)\b[^>]*+>.*?</\1\s*+>|<!--.*?-->", " ")
    no_tags = F.regexp_replace(no_code, r"(?s)</?[A-Za-z!?](?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+>", " ")
    return clean_text(decode_entities(no_tags))


_ISO_LIKE = r"^\d{4}-\d{1,2}-\d{1,2}"
_RFC822 = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})\s+(\d{1,2}:\d{2})(:\d{2})?\s*(.*)$"
_DISPLAY = r"(\d{1,2}/\d{1,2}/\d{4}),?\s*(\d{1,2}:\d{2})"
_GMT = r"GMT\s*([+-])(\d{1,2})(?::?(\d{2}))?"

# Zone names of RFC 822 dates as offsets.
ZONE_OFFSETS = {
    "": "+00:00", "Z": "+00:00", "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}


def _iso_instant(text: Column) -> Column:
    return F.when(text.rlike(_ISO_LIKE), F.regexp_replace(text, r"\s+([+-]\d{2}:?\d{2}|Z)$", "$1").try_cast("timestamp"))


def _rfc822_instant(text: Column) -> Column:
    zone_names = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])

    def offset(zone: Column) -> Column:
        return F.when(zone.rlike(r"^[+-]\d{2}:?\d{2}$"), F.regexp_replace(zone, r"^(...):?(..)$", "$1:$2")).otherwise(
            F.try_element_at(zone_names, zone)
        )

    def instant(g: Column) -> Column:
        seconds = F.coalesce(blank_to_null(F.get(g, 4)), F.lit(":00"))
        plain = F.concat(F.get(g, 0), F.lit(" "), F.initcap(F.get(g, 1)), F.lit(" "), F.get(g, 2), F.lit(" "), F.get(g, 3))
        return F.try_to_timestamp(F.concat(plain, seconds, F.lit(" "), let(F.upper(F.get(g, 5)), offset)), F.lit("d MMM yyyy H:mm:ss XXX"))

    fields = F.split(F.regexp_replace(text, _RFC822, "$1\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6"), "\u0001")
    return F.when(text.rlike(_RFC822), let(fields, instant))


def _display_instant(text: Column) -> Column:
    sign = F.coalesce(blank_to_null(F.regexp_extract(text, _GMT, 1)), F.lit("+"))
    hours = F.lpad(F.regexp_extract(text, _GMT, 2), 2, "0")
    minutes = F.rpad(F.regexp_extract(text, _GMT, 3), 2, "0")
    plain = F.concat_ws(" ", F.regexp_extract(text, _DISPLAY, 1), F.regexp_extract(text, _DISPLAY, 2))
    stamped = F.concat(plain, F.lit(" "), sign, hours, F.lit(":"), minutes)
    return F.when(text.rlike(_DISPLAY), F.try_to_timestamp(stamped, F.lit("d/M/yyyy H:mm XXX")))


def parse_published_at(value: Column | str) -> Column:
    """Instant of a publication text: ISO 8601, RFC 822, or ``weekday, d/M/yyyy, HH:mm (GMT+7)``.

    Text without an offset counts as UTC. Unreadable text gives null.
    """
    return let(clean_text(value), lambda t: F.coalesce(_iso_instant(t), _rfc822_instant(t), _display_instant(t)))


def iso_timestamp(ts: Column | str) -> Column:
    """ISO 8601 text with a numeric offset; a zero fraction is left out."""

    def text(t: Column) -> Column:
        full = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
        return F.replace(full, F.lit(".000000"), F.lit(""))

    return text(col(ts).cast("timestamp"))


# Display texts for missing fields in run logs.
NO_TITLE = "Không tiêu đề"
NO_DATE = "Không rõ ngày"
NO_AUTHOR = "N/A"
NO_REASON = "Không rõ nguyên nhân"


def text_or(value: Column | str, default: str) -> Column:
    """The value, or a display default when it is null or empty."""
    return F.coalesce(blank_to_null(value), F.lit(default))


def json_text(value: Column) -> Column:
    """Text form of a VARIANT field; null, empty text, the number zero, false and empty containers count as missing."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    number = ~kind.isin("STRING", "BOOLEAN") & ~kind.rlike("^(ARRAY|OBJECT)")
    zero = number & (F.try_variant_get(value, "$", "double") == 0)
    missing = F.when(kind == "STRING", text == "").otherwise(text.isin("false", "[]", "{}") | F.coalesce(zero, F.lit(False)))
    return F.when(~missing, text)


def nested_get(value: Column, dotted: Column | str) -> Column:
    """Value under a dotted path of object keys; null as soon as one step is missing."""
    p = F.lit(dotted) if isinstance(dotted, str) else dotted
    keys = F.transform(F.split(p, r"\."), lambda k: F.concat(F.lit('["'), k, F.lit('"]')))
    return F.when(p != "", F.try_variant_get(value, F.concat(F.lit("$"), F.array_join(keys, "")), "variant"))
