"""Column -> Column helpers. All built-in expressions: they stay inside
whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form Python's int() accepts (surrounding blanks,
# optional sign, ASCII digits with single underscores between them).
INT_TEXT_RE = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"

PLAIN_DIGITS_RE = r"^[0-9]+$"

# Fixed value: the text form Python's float() accepts (digits with single
# underscores, optional point and exponent; the three special words).
FLOAT_TEXT_RE = (
    r"^\s*[+-]?(?:(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?|(?i:inf(?:inity)?|nan))\s*$"
)
WEI = "decimal(38,0)"
SECONDS_PER_DAY = 86400


def is_int_text(c: Column) -> Column:
    """True when ``c`` is integer text in the strict sense above.

    A plain cast is not the same test: ``'5.0'`` and ``'1e3'`` cast to
    decimal, ``'1_000'`` does not.
    """
    return F.coalesce(c.rlike(INT_TEXT_RE), F.lit(False))


def _int_digits(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), "_", "")


def _or_fail(parsed: Column, c: Column, what: str) -> Column:
    """``parsed``, or a failed job where it is null: the check is part of the
    expression, so it holds whatever ``spark.sql.ansi.enabled`` says."""
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit(f"malformed {what}: "), F.coalesce(c.cast("string"), F.lit("null")))))


def must(present: Column, message: Column) -> Column:
    """A filter condition that is true, or fails the job: unlike a check in a
    projected column, column pruning cannot remove it."""
    return F.when(present, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


#: What a fault code can name: its number and the field.
FAULT_KINDS = {1: "gas", 2: "block_timestamp"}


def fault_code(kind: int, parsed: Column, c: Column) -> Column:
    """A malformed field as one number, null where it was parsed: its kind and
    the first 14 bytes of its text. A number has a fixed width, so that a hash
    aggregate can carry it (a text would make it a sort)."""
    text = F.substring(F.rpad(F.hex(F.coalesce(c.cast("string"), F.lit("null")).cast("binary")), 28, "0"), 1, 28)
    digits = F.concat(F.lit(f"{kind:02X}"), text)
    high = F.conv(F.substring(digits, 1, 14), 16, 10).cast("decimal(17,0)")
    low = F.conv(F.substring(digits, 15, 16), 16, 10).cast("decimal(20,0)")
    return F.when(parsed.isNull(), (high * F.lit(str(1 << 64)).cast("decimal(20,0)") + low).cast(WEI))


def fault_text(code: Column) -> Column:
    """The message that a fault code stands for."""
    unit = F.lit(str(1 << 64)).cast("decimal(20,0)")
    high = F.lpad(F.hex(F.call_function("div", code, unit)), 14, "0")
    low = F.lpad(F.conv((code % unit).cast("decimal(20,0)").cast("string"), 10, 16), 16, "0")
    digits = F.concat(high, low)
    text = F.rtrim(F.unhex(F.substring(digits, 3, 28)).cast("string"), F.lit("\0"))
    field = F.lit("field")
    for kind, name in FAULT_KINDS.items():
        field = F.when(F.substring(digits, 1, 2) == f"{kind:02X}", F.lit(name)).otherwise(field)
    return F.concat(F.lit("malformed "), field, F.lit(": "), text)


def int_or_null(c: Column, dtype: str = "bigint") -> Column:
    """Integer text as a number; null for anything else, also for a number that
    does not fit ``dtype``."""
    # Plain digits (the common case) cast directly; blanks, signs and
    # underscores take the cleaning path.
    return F.when(c.rlike(PLAIN_DIGITS_RE), c.try_cast(dtype)).when(is_int_text(c), _int_digits(c).try_cast(dtype))


def strict_int(c: Column, dtype: str = "bigint", what: str = "integer field") -> Column:
    """Parse integer text, failing the job on anything else, also on a number
    that does not fit ``dtype``.

    Fields other than the validity probe are parsed unguarded: a malformed
    value is a data error and must not be skipped silently.
    """
    return _or_fail(int_or_null(c, dtype), c, what)


def wei(c: Column, what: str = "wei amount") -> Column:
    """Exact 38-digit wei amount."""
    return strict_int(c, WEI, what)


def is_float_text(c: Column) -> Column:
    """True when Python's ``float()`` accepts ``c``. A plain cast is not the
    same test: it takes ``21000d`` and ``0x1p3`` and refuses ``1_000``."""
    return F.coalesce(c.rlike(FLOAT_TEXT_RE), F.lit(False))


def double_or_null(c: Column) -> Column:
    """Float text as a number; null for anything that Python's ``float()`` refuses."""
    return F.when(c.rlike(PLAIN_DIGITS_RE), c.try_cast("double")).when(is_float_text(c), _int_digits(c).try_cast("double"))


def to_double(c: Column, what: str = "number") -> Column:
    """Python ``float(text)``; anything it refuses stops the job."""
    return _or_fail(double_or_null(c), c, what)


def truncate_to_long(c: Column, what: str = "number") -> Column:
    """Python ``int(float)``: truncation toward zero."""
    return _or_fail(c.try_cast("bigint"), c, what)


def epoch_day(seconds: Column) -> Column:
    """UTC calendar date of an epoch-second count, independent of session zone."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int"))


def month_label(seconds: Column) -> Column:
    """Epoch seconds -> ``MM-yyyy`` label of the UTC month."""
    return F.date_format(epoch_day(seconds), "MM-yyyy")


def label_to_date(label: Column) -> Column:
    """``MM-yyyy`` label -> first day of that month."""
    return F.to_date(label, "MM-yyyy")


def label_to_ym(label: Column) -> Column:
    """``MM-yyyy`` label -> sortable ``yyyy-MM`` label."""
    return F.date_format(label_to_date(label), "yyyy-MM")


def hex_byte_count(h: Column) -> Column:
    """Bytes encoded by a ``0x``-prefixed hex string: ``(len - 2) / 2``.

    The empty string gives -1.0, as the plain formula does.
    """
    return hex_digit_count(h).cast("double") / F.lit(2.0)


def hex_digit_count(h: Column) -> Column:
    """Hex digits after the ``0x``: twice the bytes, as a whole number."""
    return (F.length(h) - F.lit(2)).cast("bigint")


def squash_spaces(c: Column) -> Column:
    """Remove every blank: ``'Fake ICO'`` -> ``'FakeICO'``."""
    return F.regexp_replace(c, " ", "")


def is_truthy_text(c: Column) -> Column:
    """Python truthiness of a string value: not null and not empty."""
    return c.isNotNull() & (c != F.lit(""))


def flag_to_bool(c: Column) -> Column:
    """A validated ``True``/``False`` text flag as a boolean."""
    return c == F.lit("True")
