"""Cleaning expressions used by ingestion and staging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["strip_text", "upper_code", "parse_date", "to_number", "to_int", "null_tokens"]

# Python's str.strip() removes every Unicode whitespace character: the White_Space
# characters of Unicode (Java's (?U)\s), so tabs, NBSP and U+3000 are stripped too.
# Trimmed as a set: a pattern for both ends is tried at every place of the text, and its
# code, once a column, makes the generated method of a whole cleaning too long to be compiled.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"

# The text tokens pandas' CSV reader turns into missing values.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(c, F.lit(WHITE_SPACE))


def upper_code(c) -> Column:
    return F.upper(strip_text(c))


def null_tokens(c, tokens=PANDAS_NULL_TOKENS) -> Column:
    """Null when the raw text is one of ``tokens`` (the pandas reader's list)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> DATE, unparsable or partial values -> null (never an error)."""
    c = F.col(c) if isinstance(c, str) else c
    parsed = F.try_to_timestamp(strip_text(c), F.lit(fmt)).cast("date")
    if fmt != "yyyy-MM-dd":
        return parsed
    # a date that reads back as the same text needs no formatter (which knows no year 0)
    day = c.try_cast("date")
    return F.when((c >= "0001") & (day.cast("string") == c), day).otherwise(parsed)


def to_number(c) -> Column:
    """Text -> DOUBLE, bad value -> null (``pd.to_numeric(errors='coerce')``)."""
    c = F.col(c) if isinstance(c, str) else c
    return strip_text(c).try_cast("double")


def to_int(c) -> Column:
    """Text -> BIGINT; a fraction is rounded, half away from zero ('3.0' is 3, '3.7' is 4); bad values -> null.

    The way over DECIMAL keeps every 64-bit count exact (a DOUBLE holds 53 bits).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(strip_text(c).try_cast("decimal(38,6)"), 0).try_cast("bigint")
