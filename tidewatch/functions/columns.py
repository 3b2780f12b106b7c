"""Column expressions shared by batch and streaming jobs. All of them stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Amounts are below this, which the parse sees to; so they fit the type they are added in, and so does the sum of a
# million million of them.
LARGEST_AMOUNT = 1e20
_EXACT, _MONEY = "decimal(28,8)", "decimal(38,2)"


def exact(amount: Column | str) -> Column:
    """An amount as a decimal, with eight digits after the point: what totals are added in."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.cast(_EXACT)


def money(total: Column | str) -> Column:
    """A total rounded to cents, which is the last step."""
    column = F.col(total) if isinstance(total, str) else total
    return column.cast(_MONEY)


def exact_total(amount: Column | str) -> Column:
    """Sum of amounts, rounded to cents at the end. Decimals are added, so the order of the rows cannot change it."""
    return money(F.sum(exact(amount)))


def tumbling(seconds: int, time: str = "event_time") -> Column:
    """Epoch-aligned tumbling window ``[start, start + seconds)``."""
    return F.window(time, f"{seconds} seconds")


def iso_utc(time: Column | str) -> Column:
    """ISO-8601 with offset; the fraction is left out when it is zero. Needs a UTC session."""
    column = F.col(time) if isinstance(time, str) else time
    whole = F.date_trunc("second", column) == column
    return F.when(whole, F.date_format(column, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def plain_number(number: Column | str) -> Column:
    """A double as text without an exponent, with at least one digit after the point: 6000.0, 12345678.9."""
    column = F.col(number) if isinstance(number, str) else number
    digits = column.cast("decimal(38,6)").cast("string")
    trimmed = F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(column) < 1e7, column.cast("string")).otherwise(trimmed)


def to_millis(text: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Epoch milliseconds of a datetime string in the session time zone."""
    return F.unix_millis(F.to_timestamp(text, fmt))


def contains_pattern(keyword: str) -> str:
    r"""LIKE pattern for "contains". ``%`` and ``_`` in the keyword stay wildcards; a stray ``\`` is literal."""
    escaped = re.sub(r"\\([%_\\]?)", lambda m: "\\" + (m.group(1) or "\\"), keyword)
    return f"%{escaped}%"


def json_with(json: Column, *members: Column) -> Column:
    """A JSON object text with further members, each given as ``"name":value`` text."""
    opened = F.substring(json, F.lit(1), F.length(json) - 1)
    return F.concat(opened, F.lit(","), F.concat_ws(",", *members), F.lit("}"))
