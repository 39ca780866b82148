"""Column functions for comment text and codes. All stay in generated JVM code; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a link, a mention and a symbol. Letters and digits of every script are kept.
URL = r"https?://\S+|www\.\S+"
MENTION = r"@[\p{L}\p{N}_]+"
SYMBOL = r"[^\p{L}\p{N}_\s]"
SYMBOL_STRICT = r"[^\p{L}\p{N}\s]"
BLANKS = r"\s+"


def _scrub(text: Column, symbols: str) -> Column:
    for pattern in (URL, MENTION, symbols, BLANKS):
        text = F.regexp_replace(text, pattern, " ")
    return F.trim(text)


def clean_text(text: Column) -> Column:
    """Lower-cased words only: links, mentions and symbols become blanks, blanks collapse, null becomes ''.

    The underscore counts as a word character here.
    """
    return _scrub(F.lower(F.coalesce(text, F.lit(""))), SYMBOL)


def clean_text_strict(text: Column) -> Column:
    """As :func:`clean_text`, but the underscore is a symbol too and null stays null."""
    return _scrub(F.lower(text), SYMBOL_STRICT)


def _keeps(text: Column, first: str, cleaned: Column) -> Column:
    """True where ``cleaned`` is not empty, decided from the first character where that is enough.

    A word character at the very start survives cleaning unless a link begins there, so most rows need no cleaning
    to be kept.
    """
    return text.rlike(rf"(?i)^\s*(?!https?://|www\.){first}") | (cleaned != "")


def has_words(text: Column) -> Column:
    """Whether :func:`clean_text` leaves anything."""
    return F.coalesce(_keeps(text, r"[\p{L}\p{N}_]", clean_text(text)), F.lit(False))


def has_words_strict(text: Column) -> Column:
    """Whether :func:`clean_text_strict` leaves anything."""
    return F.coalesce(_keeps(text, r"[\p{L}\p{N}]", clean_text_strict(text)), F.lit(False))


def safe_integer(value: Column) -> Column:
    """The value as an int, 0 where it is null, unreadable or out of range."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def clean_country_code(code: Column) -> Column:
    """First two letters, upper case; ``Unknown`` where there are none."""
    return F.coalesce(F.substring(F.upper(F.nullif(F.trim(code), F.lit(""))), 1, 2), F.lit("Unknown"))


def classify_engagement(total: Column, *, high: int = 20, medium: int = 5, low: int = 0) -> Column:
    """Tier of a like-plus-reply total."""
    return (
        F.when(total >= high, "high").when(total >= medium, "medium").when(total > low, "low").otherwise("none")
    )


def word_count(text: Column) -> Column:
    """Number of words of cleaned text, which has single blanks between words and none at the ends."""
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, " ")))


def known_or(value: Column, default: str) -> Column:
    """``default`` where the value is null or blank."""
    return F.when(F.trim(value) != "", value).otherwise(F.lit(default))


def name_key(value: Column, default: str) -> Column:
    """Grouping key of a free-text name: trimmed, lower case, ``default`` where blank."""
    return F.coalesce(F.nullif(F.lower(F.trim(value)), F.lit("")), F.lit(default))


def text_ellipsis(text: Column, length: int = 40) -> Column:
    """A plot label: the first ``length`` characters and three dots."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def parse_rfc3339(text: Column) -> Column:
    """Instant of an RFC 3339 string such as ``2026-06-02T00:00:00Z``; null where unreadable."""
    return F.try_to_timestamp(text)


def to_rfc3339(instant: Column) -> Column:
    """RFC 3339 text in UTC whatever the session's time zone, fractions of a second only where present."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("Z"))


def utc_now() -> Column:
    return F.current_timestamp()
