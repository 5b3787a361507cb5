"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from requestmill.schemas import NA_TOKENS

# The characters Python's str.strip() removes, ASCII ones first.
ASCII_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WHITESPACE = ASCII_BLANKS + (
    "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_blanks(text: Column) -> Column:
    """Remove blanks of every kind at both ends; ``trim`` alone only knows spaces.

    The search through the long list is left to texts that are not plain ASCII.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_BLANKS))).otherwise(
        F.btrim(text, F.lit(WHITESPACE))
    )


def clean_text(text: Column, missing: str = "NAN") -> Column:
    """Strip, upper-case, and turn the ``missing`` marker into NULL."""
    return F.nullif(F.upper(strip_blanks(text)), F.lit(missing))


def null_if_token(column: str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """NULL when the column's whole text is one of ``tokens``, as it stands.

    Written as SQL text, since a long list built of columns costs one call to the
    JVM for every token.
    """
    escaped = (t.replace("\\", "\\\\").replace("'", "\\'") for t in tokens)
    listed = ", ".join(f"'{t}'" for t in escaped)
    name = "`" + column.replace("`", "``") + "`"
    return F.expr(f"CASE WHEN {name} NOT IN ({listed}) THEN {name} END")


def look_up(text: Column, mapping: Mapping[str, str]) -> Column:
    """Replace known values; pass the others through."""
    pairs = [F.lit(x) for x in chain.from_iterable(mapping.items())]
    return F.coalesce(F.create_map(*pairs)[text], text) if pairs else text


def is_filled(text: Column) -> Column:
    """Present and not blank; trailing blanks do not count."""
    return text.isNotNull() & (F.rtrim(text) != "")


def equals_ignoring_case(text: Column, literal: str) -> Column:
    return F.lower(text) == literal.lower()


def preview(text: Column, length: int = 50) -> Column:
    """The first ``length`` characters and three dots, for display."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))
