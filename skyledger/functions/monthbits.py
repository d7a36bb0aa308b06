"""Sets of days as one number a month: bit ``d - 1`` is day ``d``. SQL texts over columns.

A station's presence, a request's range and what is missing of it are one row a month in place of one a day;
unions and intersections are ``bit_or`` and ``bit_and``, which are combined before a shuffle.
"""

from __future__ import annotations


def month_of(day: str) -> str:
    """The first day of a day's month."""
    return f"CAST(trunc({day}, 'MM') AS DATE)"


def bit_of(day: str) -> str:
    return f"shiftleft(1L, dayofmonth({day}) - 1)"


def range_bits(month: str, date_from: str, date_to: str) -> str:
    """The days of a month inside an inclusive range that touches it."""
    low, high = f"greatest({date_from}, {month})", f"least({date_to}, last_day({month}))"
    return f"(shiftleft(1L, dayofmonth({high})) - shiftleft(1L, dayofmonth({low}) - 1))"


def months_between(date_from: str, date_to: str) -> str:
    """The first days of the months that a range touches; none when the range is empty or open."""
    return (f"CASE WHEN {date_from} <= {date_to} THEN sequence({month_of(date_from)}, {month_of(date_to)}, INTERVAL 1 MONTH) "
            f"ELSE CAST(array() AS array<date>) END")


def days_of(month: str, bits: str) -> str:
    """The days of a month's bits, in order."""
    return f"transform(filter(sequence(0, 30), i -> (shiftright({bits}, i) & 1L) = 1L), i -> date_add({month}, i))"
