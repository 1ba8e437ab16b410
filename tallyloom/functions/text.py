"""Text, date and hash helpers built from Spark SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, col

# Spellings of "missing" that delimited releases use for a code.
MISSING_CODES = ("nan", "<na>")

# White space and line breaks of Unicode text.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Named HTML entities decoded in page text.
ENTITIES = {
    "&nbsp;": "\xa0",
    "&middot;": "·",
    "&copy;": "©",
    "&reg;": "®",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&bull;": "•",
    "&sect;": "§",
    "&deg;": "°",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&amp;": "&",
}


# A character reference: decimal, hexadecimal or by name.
REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]+);"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once. A long text expression that is named twice
    would otherwise run twice, and again at every level that names its result twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_code(c: ColumnLike) -> Column:
    """Strip blanks and literal quote marks; spellings of "missing" become null."""
    bare = F.btrim(strip(col(c).cast("string")), F.lit("'"))
    return F.when(~F.lower(bare).isin(*MISSING_CODES), bare)


def collapse_whitespace(c: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(col(c), f"[{BLANKS}]+", " "))


def strip(c: ColumnLike) -> Column:
    """Remove white space at both ends."""
    return F.btrim(col(c), F.lit(BLANKS))


def trimmed_lines(c: ColumnLike) -> Column:
    """Lines without surrounding white space, empty ones dropped."""
    lines = F.transform(F.split(col(c), f"[{LINE_BREAKS}]+"), strip)
    return F.array_join(F.filter(lines, lambda line: F.length(line) > 0), "\n")


def slug(c: ColumnLike) -> Column:
    """Lower case, runs of anything but a-z and 0-9 become one underscore."""
    return F.btrim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def decode_entities(c: ColumnLike) -> Column:
    """Decode numeric character references and the common named entities, in one pass."""
    return let(col(c), _decode)


def _character(code: Column) -> Column:
    """The character of a code point; the replacement character for one that names none."""
    none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    known = F.when(none, F.lit(0xFFFD)).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")


def _decode(text: Column) -> Column:
    """Text between references and the characters they stand for, in turn. What a reference decodes
    to is not read again, and an unknown name stays as it is."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def one(reference: Column) -> Column:
        digits = F.regexp_extract(reference, "^&#([0-9]+);$", 1)
        hexadecimal = F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+);$", 1)
        return (
            F.when(digits != "", _character(digits.try_cast("bigint")))
            .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(names, reference), reference))
        )

    references = F.transform(F.regexp_extract_all(text, F.lit(f"({REFERENCE})"), 1), one)
    between = F.split(text, REFERENCE, -1)
    pieces = F.zip_with(between, references, lambda t, r: F.concat(t, F.coalesce(r, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def to_date_lenient(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date, null where unreadable."""
    return F.try_to_timestamp(col(c).cast("string"), F.lit(fmt)).cast("date")


def to_date_strict(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; the job fails on text that is no date."""
    return F.to_date(col(c).cast("string"), fmt)


def month_code(c: ColumnLike) -> Column:
    """``2024-12`` to the period code ``M12``."""
    return F.concat(F.lit("M"), F.lpad(F.split_part(col(c), F.lit("-"), F.lit(2)), 2, "0"))


def quarter_label(c: ColumnLike) -> Column:
    """A date to ``2024-Q3``; such labels compare in time order as text."""
    return F.concat(F.year(col(c)), F.lit("-Q"), F.quarter(col(c)))


def snippet(text: ColumnLike, needle: str, before: int = 160, width: int = 420) -> Column:
    """Text around the first case-insensitive hit, whitespace collapsed."""
    at = F.instr(F.lower(col(text)), F.lit(needle.lower()))
    start = F.greatest(F.lit(1), at - before)
    return collapse_whitespace(F.substring(col(text), start, F.lit(width)))


def contains_text(text: ColumnLike, needle: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` are ordinary characters."""
    return F.lower(col(text)).contains(needle.lower())


def content_sha256(c: ColumnLike) -> Column:
    return F.sha2(col(c).cast("binary"), 256)
