"""Lenient scalar conversions as Catalyst expressions.

Every function takes the text of a value and, where it matters, its JSON kind
(`schema_of_variant` of the value: STRING, BIGINT, DECIMAL(p,s), DOUBLE,
BOOLEAN, ...). Without a kind the text is taken as a JSON string. A value that
cannot be converted gives NULL; the caller decides whether that is an error.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words accepted as booleans, in any letter case.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]

# Date patterns, tried in this order, and the slash form of a
# timestamp. One letter for month and day accepts one or two digits.
DATE_PATTERNS = ["yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "yyyy/M/d"]
SLASH_TIMESTAMP = "yyyy/M/d H:m:sX"

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _text(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _is_string(kind: Column | None) -> Column:
    return F.lit(True) if kind is None else kind == "STRING"


def _is_number(kind: Column | None) -> Column:
    if kind is None:
        return F.lit(False)
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")


def _bit(text: Column, kind: Column | None) -> Column:
    """1 or 0 for a JSON boolean, NULL for everything else."""
    if kind is None:
        return F.lit(None).cast("int")
    return F.when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0))


# A cast that fails is paid for with a Java exception, far dearer than a pattern, so a
# text is only cast when it looks right.
_WHOLE = r"^\s*[+-]?\d{1,19}\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NOT_FINITE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def to_long(text: Column | str, kind: Column | None = None, type_name: str = "bigint") -> Column:
    """Whole number; fractions are cut towards zero, booleans become 1 and 0."""
    text = _text(text)
    cut = text.try_cast("decimal(38,18)").try_cast(type_name)
    return (
        F.when(text.rlike(_WHOLE), text.try_cast(type_name))
        .when(text.rlike(_NUMBER) & (text.contains(".") | ~_is_string(kind)), cut)
        .otherwise(_bit(text, kind).cast(type_name))
    )


def to_double(text: Column | str, kind: Column | None = None, type_name: str = "double") -> Column:
    """Floating number. Java's `1.5d` / `1.5f` spelling is not accepted."""
    text = _text(text)
    number = text.rlike(_NUMBER) | text.rlike(_NOT_FINITE)
    return F.when(number, text.try_cast(type_name)).otherwise(_bit(text, kind).cast(type_name))


def to_decimal(text: Column | str, type_name: str) -> Column:
    text = _text(text)
    return F.when(text.rlike(_NUMBER), text.try_cast(type_name))


def to_boolean(text: Column | str, kind: Column | None = None) -> Column:
    """The ten words, else truthiness: non-empty text, non-zero number, non-empty container."""
    text = _text(text)
    word = F.lower(text)
    from_string = (
        F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False).otherwise(text != "")
    )
    if kind is None:
        return F.when(text.isNotNull(), from_string)
    return (
        F.when(text.isNull(), None)
        .when(_is_string(kind), from_string)
        .when(kind == "BOOLEAN", text == "true")
        .when(_is_number(kind), text.try_cast("double") != 0)
        .otherwise(~text.isin("{}", "[]"))
    )


def to_date_lenient(text: Column | str, kind: Column | None = None) -> Column:
    """Four patterns in order, then ISO (a timestamp gives its own calendar date)."""
    text = _text(text)
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.substring(text, 1, 10).try_cast("date"))
    for pattern in DATE_PATTERNS:
        looks = "^" + re.sub("M|d", r"\\d{1,2}", pattern.replace("yyyy", r"\Y{4}")).replace(r"\Y", r"\d") + "$"
        parsed = parsed.when(text.rlike(looks), F.try_to_date(text, pattern))
    parsed = parsed.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
    return F.when(_is_string(kind), parsed)


def to_timestamp_lenient(text: Column | str, kind: Column | None = None) -> Column:
    """ISO with `Z` or offset, two plain forms, or epoch seconds for a number.

    A text without a zone is UTC whatever the session time zone is: the zone is
    written into the text before the cast.
    """
    text = _text(text)
    zoned = text.rlike(r"[T ].*(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$")
    day_only = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    no_seconds = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}$")
    full = (
        F.when(zoned, text)
        .when(day_only, F.concat(text, F.lit(" 00:00:00Z")))
        .when(no_seconds, F.concat(text, F.lit(":00Z")))
        .when(text.contains(":"), F.concat(text, F.lit("Z")))
    )
    slash = F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(SLASH_TIMESTAMP))
    parsed = F.when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2} "), slash).otherwise(full.try_cast("timestamp"))
    from_number = F.timestamp_seconds(text.try_cast("double"))
    return F.when(_is_string(kind), parsed).when(_is_number(kind), from_number)


def epoch_seconds(iso_text: Column | str) -> Column:
    """ISO text to Unix seconds; NULL when it does not parse."""
    return F.unix_seconds(to_timestamp_lenient(iso_text))


def epoch_millis(iso_text: Column | str, default: int | None = None) -> Column:
    """ISO text to Unix milliseconds, with an optional value for unparsable text."""
    millis = F.unix_millis(to_timestamp_lenient(iso_text))
    return millis if default is None else F.coalesce(millis, F.lit(default).cast("bigint"))


def iso_minus_seconds(iso_text: Column | str, seconds: int) -> Column:
    """ISO text moved back; text that does not parse is returned unchanged."""
    text = _text(iso_text)
    moved = to_timestamp_lenient(text) - F.make_dt_interval(secs=F.lit(seconds))
    return F.coalesce(iso_text_of(moved), text)


def iso_text_of(timestamp: Column) -> Column:
    """Timestamp to ISO text with seconds and `Z`, in UTC."""
    in_utc = F.convert_timezone(None, F.lit("UTC"), timestamp.cast("timestamp_ntz"))
    return F.date_format(in_utc, ISO_SECONDS)
