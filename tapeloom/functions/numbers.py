"""Number rules: text to double, double to text, missing values, display."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted spellings of a floating-point number in text.
FLOAT_TEXT = (
    r"(?i)^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:e[+-]?\d+(?:_\d+)*)?|inf|infinity|nan)\s*$"
)
# Text a browser turns into a number.
BROWSER_TEXT = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|Infinity)\s*$"
# The accepted spellings of a whole number in text.
INT_TEXT = r"^\s*[+-]?\d+(?:_\d+)*\s*$"
BROWSER_HEX = r"^\s*0[xX][0-9a-fA-F]{1,15}\s*$"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parse_float(text: Column) -> Column:
    """Double from text; NULL where the text is no number.

    The cast alone is too lax (``1.0d``) and too strict (``1_000``), so the
    spelling is checked first.
    """
    return F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def parse_int(text: Column) -> Column:
    """BIGINT from text; NULL where the text is no whole number."""
    digits = F.regexp_replace(text, r"[_\s]", "")
    return F.when(text.rlike(INT_TEXT), digits.try_cast("bigint"))


def browser_number(text: Column, is_boolean: Column) -> Column:
    """Number a browser makes of a JSON value given as text, NULL for NaN."""
    return (
        F.when(text.rlike(BROWSER_TEXT), text.try_cast("double"))
        .when(text.isin("true", "false"), F.when(is_boolean, F.when(text == "true", 1.0).otherwise(0.0)))
        .when(F.trim(text) == "", F.lit(0.0))
        .when(text.rlike(BROWSER_HEX), F.conv(F.substring(F.trim(text), 3, 15), 16, 10).try_cast("double"))
    )


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double with ``.0`` on whole numbers.

    Plain notation from 1e-4 up to 1e16, else ``1e-05`` style.
    """
    size = F.abs(value)
    plain = F.regexp_replace(
        F.when((size >= 1e-4) & (size < 1e16), value).try_cast("decimal(38,20)").cast("string"), "0+$", ""
    )
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    parts = F.split(value.cast("string"), "E")
    power = parts.getItem(1).try_cast("int")
    exponent = F.concat(
        F.regexp_replace(parts.getItem(0), r"\.0$", ""),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")),
    )
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(value == 0, F.regexp_replace(value.cast("string"), r"^(-?)0\.0$", "$10.0"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def browser_text(value: Column) -> Column:
    """Text a browser makes of a number: no ``.0``, plain from 1e-6 up to 1e21, else ``1e-7`` style."""
    size = F.abs(value)
    whole = value.try_cast("decimal(38,0)")
    plain = F.when((size < 1e21) & (whole.cast("double") == value), whole.cast("string")).otherwise(
        F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"\.?0+$", "")
    )
    parts = F.split(value.cast("string"), "E")
    power = parts.getItem(1).try_cast("int")
    exponent = F.concat(
        F.regexp_replace(parts.getItem(0), r"\.0$", ""),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.abs(power).cast("string"),
    )
    return (
        F.when(value == 0, F.lit("0"))
        .when(F.isnan(value), F.lit("NaN"))
        .when(size == float("inf"), F.when(value > 0, F.lit("Infinity")).otherwise(F.lit("-Infinity")))
        .when((size >= 1e-6) & (size < 1e21), plain)
        .otherwise(exponent)
    )


def grouped(value: Column, digits: int) -> Column:
    """Thousands separators and at most ``digits`` decimals, no trailing zeros."""
    text = F.format_number(F.round(value, digits), digits)
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def dollars(value: Column, digits: int) -> Column:
    return F.concat(F.lit("$"), grouped(value, digits))


def fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def signed_percent(value: Column) -> Column:
    text = F.concat(fixed(value, 2), F.lit("%"))
    return F.when(value >= 0, F.concat(F.lit("+"), text)).otherwise(text)
