"""Typed values out of text.

``on_error`` says what happens to text that cannot be read: "null" keeps the row
and blanks the value (to be quarantined and counted), "raise" stops the job.
Missing text is missing in both modes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date spellings in use, and the marks around amounts.
DATE_LAYOUTS = ("y-M-d", "y/M/d", "y年M月d日")
ROSTER_DATE_LAYOUTS = ("y/M/d", "y年M月d日")
AMOUNT_MARKS = "¥,円"
TRUE_SPELLINGS = ("1", "Y", "true", "TRUE", "True", "有", "はい")
_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
FALSE_SPELLINGS = ("0", "N", "false", "FALSE", "False", "無", "いいえ")


def guarded(text: Column, value: Column, what: str, on_error: str) -> Column:
    """Attach the error policy to a parse that yields NULL for unreadable text."""
    if on_error == "null":
        return value
    if on_error != "raise":
        raise ValueError(f"on_error must be null or raise, not {on_error!r}")
    message = F.concat(F.lit(f"unreadable {what}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def parse_date(c: Column, layouts: Sequence[str] = DATE_LAYOUTS, on_error: str = "null") -> Column:
    """Date from any of several year-month-day layouts, padded or not.

    The layouts differ only in their separators, so one regex decides whether the
    text is a date at all and one cast reads it.  That avoids a chain of format
    attempts, each of which fails through an exception on most rows.
    """
    shapes, marks = [], set()
    for layout in layouts:
        if [x for x in layout if x in "yMd"] != ["y", "M", "d"]:
            raise ValueError(f"not a year-month-day layout: {layout}")
        shape = ""
        for char in layout:
            if char == "y":
                shape += "[0-9]{4}"
            elif char in "Md":
                shape += "[0-9]{1,2}"
            else:
                shape += re.escape(char)
                marks.add(char)
        shapes.append(shape)
    tail_marks = {x[-1] for x in layouts if x[-1] not in "yMd"}
    inner = "".join(sorted(marks - tail_marks))
    plain = F.translate(c, inner + "".join(sorted(tail_marks)), "-" * len(inner))
    value = F.when(c.rlike("^(?:" + "|".join(shapes) + ")$"), plain.try_cast("date"))
    return guarded(c, value, "date", on_error)


def parse_short_date(c: Column, layout: str = "MM/dd/yy", on_error: str = "null") -> Column:
    """Date in a layout with another field order, such as 01/05/24."""
    return guarded(c, F.try_to_date(c, layout), "date", on_error)


def excel_serial_date(c: Column) -> Column:
    """Day number of the 1900 spreadsheet calendar, e.g. 45296 for 2024-01-05."""
    return F.date_add(F.lit("1899-12-30").cast("date"), c.try_cast("int"))


def _decimal(bare: Column) -> Column:
    """Exact value of plain decimal text; NULL for anything else, such as 12d or 0x1p3, which a cast to double would read."""
    return F.when(bare.rlike(_NUMBER), bare.try_cast("decimal(38,12)"))


def _whole(bare: Column, other: Column) -> Column:
    """Up to 18 digits are a whole number as they are; ``other`` says what becomes of any other text."""
    return F.when(bare.rlike(r"^[+-]?[0-9]{1,18}\z"), bare.try_cast("bigint")).otherwise(other)


def parse_amount(c: Column, marks: str = AMOUNT_MARKS, on_error: str = "null") -> Column:
    """Whole currency units: marks dropped, decimals cut off ("1200.0" is 1200)."""
    bare = F.translate(c, marks, "") if marks else c
    return guarded(c, _whole(bare, _decimal(bare).try_cast("bigint")), "amount", on_error)


def parse_integer(c: Column, marks: str = "", on_error: str = "null") -> Column:
    """Whole number; text with a fractional part other than zero is unreadable."""
    bare = F.translate(c, marks, "") if marks else c
    number = _decimal(bare)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return guarded(c, _whole(bare, whole), "number", on_error)


def parse_number(c: Column, marks: str = "", on_error: str = "null") -> Column:
    """Double, after dropping marks."""
    bare = F.translate(c, marks, "") if marks else c
    value = F.when(bare.rlike(_NUMBER), bare.try_cast("double"))
    return guarded(c, value, "number", on_error)


def parse_accounting(c: Column, on_error: str = "null") -> Column:
    """Whole amount where brackets mean negative: (1,200) is -1200."""
    bare = F.translate(c, "(),¥円", "")
    value = _decimal(bare).try_cast("bigint")
    signed = F.when(c.rlike(r"^\(.*\)$"), -value).otherwise(value)
    return guarded(c, signed, "amount", on_error)


def parse_flag(c: Column, on_error: str = "null") -> Column:
    """Boolean from the usual spellings; anything else follows ``on_error``."""
    value = F.when(c.isin(*TRUE_SPELLINGS), F.lit(True)).when(c.isin(*FALSE_SPELLINGS), F.lit(False))
    return guarded(c, value, "flag", on_error)


def parse_instant(c: Column, on_error: str = "null") -> Column:
    """Instant from ISO text carrying its own offset (Z, +09:00, ...)."""
    return guarded(c, F.try_to_timestamp(c), "timestamp", on_error)


def wall_clock(instant: Column, zone: str) -> Column:
    """Local clock reading of an instant, without a zone attached."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def instant_of(local: Column, zone: str) -> Column:
    """Instant at which clocks in ``zone`` show the given reading."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as double, to the microsecond."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def tax_included(amount: Column, rate: float) -> Column:
    """Tax-inclusive whole amount: half-even on the binary product, as a bigint."""
    return F.rint(amount * F.lit(rate)).cast("bigint")


def minor_units(c: Column, digits: int = 2) -> Column:
    """A double money value as an exact integer, so that sums do not depend on order."""
    return F.rint(c * F.lit(float(10 ** digits))).cast("bigint")
