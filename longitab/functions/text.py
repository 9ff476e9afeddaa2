"""Text functions, all JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .recode import _c

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_all(col: Column | str) -> Column:
    """Strip every kind of white space (plain ``trim`` strips spaces only)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def paste(*cols: Column | str, sep: str = " ", null_text: str | None = "NA") -> Column:
    """Join texts; a null part reads ``null_text``, or nulls the result if None."""
    parts = [_c(c).cast("string") for c in cols]
    if null_text is not None:
        parts = [F.coalesce(p, F.lit(null_text)) for p in parts]
    glued = [parts[0]]
    for part in parts[1:]:
        glued += [F.lit(sep), part]
    return F.concat(*glued)


def extract_first(col: Column | str, pattern: str) -> Column:
    """First match of ``pattern`` (look-around allowed), null if there is none."""
    return F.regexp_substr(_c(col), F.lit(pattern))


def replace_first(col: Column | str, pattern: str, new: str) -> Column:
    """Replace only the first match; ``new`` may not refer to groups."""
    safe = new.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(col), f"(?s)\\A(.*?)(?:{pattern})", "$1" + safe)


def replace_all(col: Column | str, pattern: str, new: str = "") -> Column:
    return F.regexp_replace(_c(col), pattern, new)


def split_item(col: Column | str, sep: str, i: int) -> Column:
    """The i-th (1-based) part; null when the text has fewer parts."""
    return F.try_element_at(F.split(_c(col), _literal(sep)), F.lit(i))


def tokens(col: Column | str, sep: str = ";") -> Column:
    """Array of the parts between literal separators, empty ones included."""
    return F.split(_c(col), _literal(sep))


def strip_digits(col: Column | str) -> Column:
    return replace_all(col, r"\p{Nd}")


def strip_notes(col: Column | str) -> Column:
    """Remove bracketed notes that are not empty."""
    return replace_all(col, r"\([^)]+\)")


def normalise_list(col: Column | str, notes: bool = True, closing: bool = True) -> Column:
    """Free-text list -> ``;`` list.

    Takes out digits, then bracketed notes, turns commas into separators and
    drops a separator at the end; the second and last steps can be left out.
    """
    text = strip_digits(col)
    if notes:
        text = strip_notes(text)
    text = F.replace(text, F.lit(","), F.lit(";"))
    return replace_all(text, ";$") if closing else text


def plain_text(col: Column | str, dtype: str) -> Column:
    """Value as text: whole doubles without ``.0``, ISO dates; no exponent from 1e-20 to 1e38."""
    c = _c(col)
    if dtype not in ("double", "float"):
        return c.cast("string")
    size = F.abs(c)
    exact = F.regexp_replace(c.cast("decimal(38,9)").cast("string"), r"0+$", "")
    return (
        F.when((c == F.floor(c)) & (size < 9e18), c.cast("bigint").cast("string"))
        .when((size >= 9e18) & (size < 1e38), c.cast("decimal(38,0)").cast("string"))
        .when((size >= 1e7) & (size < 9e18), exact)
        .when((size < 1e-3) & (size >= 1e-20), F.regexp_replace(c.cast("decimal(38,36)").cast("string"), r"0+$", ""))
        .otherwise(c.cast("string"))
    )


def _literal(sep: str) -> str:
    """Pattern for a separator; a plain character stays one, which splits fastest."""
    return re.escape(sep)
