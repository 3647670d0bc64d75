"""Text columns: identifiers, keys, hashes, log hygiene, pattern checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# ---- fixed values: patterns and formats ----
ALERT_MESSAGE = r'(?s)^.*?: "(.*?)" to(.*) ([^ ]*)\z'
COMPLETE_SUFFIX = r"(_\d+)?_complete$"
TERMINAL_SEQUENCES = r"\x1B\[[0-9;]*+[A-Za-z]|\x1B\][^\x07]*+\x07"
CONTROL_CHARACTERS = r"[\p{Cc}\p{Cf}\x{2028}\x{2029}]"
UUID_PATTERN = r"^[a-zA-Z0-9]{8}-([a-zA-Z0-9]{4}-){3}[a-zA-Z0-9]{12}$"
ISO_8601_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?$"
SEMVER_PATTERN = r"^v?\d+\.\d+\.\d+([-+]\w+)?$"
MASK = "█"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
# ---- end of fixed values ----


def alert_answer(message: Column) -> Column:
    """The quoted answer of an alert message, null if the message has another shape."""
    return F.when(message.rlike(ALERT_MESSAGE), F.regexp_extract(message, ALERT_MESSAGE, 1))


def alert_field(message: Column) -> Column:
    """``alerts_`` + the last word of an alert message, lower-cased."""
    return F.when(
        message.rlike(ALERT_MESSAGE),
        F.concat(F.lit("alerts_"), F.lower(F.regexp_extract(message, ALERT_MESSAGE, 3))),
    )


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros; never shortens, a sign stays in front, null stays null."""
    text = text.cast("string")
    signed = text.rlike("^[+-]")
    padded = F.when(
        signed,
        F.concat(text.substr(1, 1), F.lpad(F.substring(text, 2, 2**31 - 1), width - 1, "0")),
    ).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) < width, padded).otherwise(text)


def responder_id(number: Column) -> Column:
    """``R`` and a six-digit number."""
    return F.concat(F.lit("R"), zero_pad(number, 6))


def strip_zeros(text: Column) -> Column:
    """Drop leading zeros of an integer text of any length; other text is kept."""
    text = text.cast("string")
    bare = F.regexp_replace(F.trim(text), r"^\+?(-?)0+(?=\d)|^\+", "$1")
    return F.when(text.rlike(INTEGER_TEXT), bare).otherwise(text)


def to_instance(value: Column) -> Column:
    """Text, float or NaN to a nullable int, fractions cut."""
    return value.try_cast("double").try_cast("int")


def key_part(df: DataFrame, name: str) -> Column:
    """One column as it appears in a composite key: booleans as 0/1, null as empty."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        column = column.cast("int")
    return F.coalesce(column.cast("string"), F.lit(""))


def with_composite_key(df: DataFrame, columns: list[str], name: str = "cache_key") -> DataFrame:
    """Add the columns joined with ``:``."""
    return df.withColumn(name, F.concat_ws(":", *[key_part(df, c) for c in columns]))


def short_md5(text: Column, length: int = 12) -> Column:
    """The first hex digits of the MD5 of a text."""
    return F.substring(F.md5(text), 1, length)


def sanitize(text: Column) -> Column:
    """Remove line breaks, terminal sequences and control or format characters."""
    one_line = F.regexp_replace(text, r"[\r\n]", "")
    return F.regexp_replace(one_line, f"{TERMINAL_SEQUENCES}|{CONTROL_CHARACTERS}", "")


def redact(text: Column) -> Column:
    """A mask as long as the text, one character if it is empty or missing."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.repeat(F.lit(MASK), F.greatest(F.char_length(text), F.lit(1)))


def strip_complete(text: Column) -> Column:
    """Instrument name of a ``…_complete`` field, without its number."""
    return F.regexp_replace(text, COMPLETE_SUFFIX, "")


def matches(text: Column, pattern: str = UUID_PATTERN) -> Column:
    """Pattern check (identifier by default)."""
    return text.rlike(pattern)
