"""Text columns: decoding, line splitting, stripping."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters at which a text is cut into lines, after newlines are unified.
LINE_BREAKS = "\r\n|[\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029]"

# Characters removed from both ends of a line.
BLANKS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Two noncharacters in a row stand in for a genuine U+FFFD while bad bytes are dropped.
_KEPT = "\ufdd0\ufdd1"


def decode_text(content: Column) -> Column:
    """Bytes to text: UTF-8, bad bytes dropped, newlines unified."""
    raw = content.cast("string")
    bad = F.lit("\ufffd")
    cleaned = F.replace(F.make_valid_utf8(F.replace(raw, bad, F.lit(_KEPT))), bad, F.lit(""))
    text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(cleaned, F.lit(_KEPT), bad))
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(
        text
    )


def split_lines(text: Column) -> Column:
    """Array of lines; a final line break does not open another line."""
    pieces = F.split(text, LINE_BREAKS)
    open_end = F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return F.slice(pieces, F.lit(1), F.size(pieces) - open_end)


def count_split_lines(text: Column) -> Column:
    pieces = F.split(text, LINE_BREAKS)
    return (F.size(pieces) - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)).cast("bigint")


def count_newlines(text: Column) -> Column:
    """Number of lines when only the newline character ends a line."""
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return (breaks + F.when((text != "") & ~F.endswith(text, F.lit("\n")), 1).otherwise(0)).cast(
        "bigint"
    )


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)
