"""Text, time and hash semantics that the operators share, as Column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import WHITE, WHITE_CHARS


def java(pattern: str) -> str:
    """A shared pattern for Spark: look-around for ASCII word boundaries, as Java's own are Unicode-aware."""
    return pattern.replace("{s}", f"[{WHITE}]").replace("{S}", f"[^{WHITE}]").replace("{w}", WHITE).replace("{<}", "(?<![A-Za-z0-9_])").replace("{>}", "(?![A-Za-z0-9_])")


def re2(pattern: str) -> str:
    """The same for an RE2 engine, whose word boundaries are ASCII."""
    return pattern.replace("{s}", f"[{WHITE}]").replace("{S}", f"[^{WHITE}]").replace("{w}", WHITE).replace("{<}", r"\b").replace("{>}", r"\b")


def found(col: Column, pattern: str) -> Column:
    return col.rlike(java(pattern))


def replaced(col: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(col, F.lit(java(pattern)), F.lit(by))


def extracted(col: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(col, java(pattern), group)


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def trimmed(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(col, F.lit(WHITE_CHARS))


def collapsed(col: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(replaced(col, r"{s}+", " "))


def utf16_length(col: Column) -> Column:
    """Length in UTF-16 units: characters beyond the basic plane count twice."""
    return F.length(col) + F.length(F.regexp_replace(col, r"[^\x{10000}-\x{10FFFF}]", ""))


def sha24(col: Column) -> Column:
    return F.substring(F.sha2(col, 256), 1, 24)


def sha12(col: Column) -> Column:
    return F.substring(F.sha2(col, 256), 1, 12)


def epoch_ms(col: Column) -> Column:
    """Milliseconds from a number or text: numbers under 1e10 are seconds, digits in text are numbers, other text is an ISO time; else null."""
    text = F.trim(col.cast("string"))
    number = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.cast("double"))
    scaled = F.when(number < 1e10, number * 1000).otherwise(number)
    return F.coalesce(scaled.cast("long"), F.unix_millis(F.try_to_timestamp(text)))


def month_of(ms: Column) -> Column:
    """YYYY-MM in the session's time zone."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM")


def redacted_path(path: Column, home: str) -> Column:
    return F.regexp_replace(path, "^" + re.escape(home.rstrip("/")) + "(?=/|$)", "~")


def ratio(part: Column, whole: Column) -> Column:
    """Share to four places, 0 of nothing."""
    return F.when(whole > 0, F.round(part / whole, 4)).otherwise(F.lit(0.0))
