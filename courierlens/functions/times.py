"""Clock times and calendar dates as native column expressions.

Clock text arrives as ``H:M``, ``H:M:S``, hours of 24 or more after midnight,
or the fraction of a day a spreadsheet leaves behind. All functions take text
that is already trimmed and has null for missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.functions.text import is_one_byte, number
from courierlens.settings import MINUTES_PER_DAY, SECONDS_PER_DAY, WHITESPACE

MULTI_BYTE_SPACES = "".join(c for c in WHITESPACE if not c.isascii())


def plain_spaces(text: Column) -> Column:
    """Multi-byte white space as plain spaces, which a cast to a number trims.

    Needed before ``clock_parts`` for text like '9:\\xa05'.
    """
    spaces = " " * len(MULTI_BYTE_SPACES)
    plain = F.translate(text, MULTI_BYTE_SPACES, spaces)
    return F.when(is_one_byte(text), text).otherwise(plain)


def second_of_day(text: Column) -> Column:
    """Second of the day from a day fraction, rounded half to even.

    Staying within one day keeps a value of any size exact; text beyond the
    double range is null.
    """
    days = number(text)
    second = F.pmod(F.rint(days * 24 * 3600), F.lit(float(SECONDS_PER_DAY)))
    return F.when(F.abs(days) < 1e300, second)


def clock_parts(text: Column) -> Column:
    """Hour 0-23 and minute of a clock text, as a struct of ``h`` and ``m``.

    Hours past midnight wrap round; the minute stays as written, since a clock
    text may carry 60 or more.
    """
    hour, minute = _before_colon(text), _after_colon(text)
    second = second_of_day(text)
    return (
        F.when(text.contains(":"), _parts(F.pmod(hour, F.lit(24)), minute))
        .otherwise(
            _parts(F.floor(second / 3600), F.floor(F.pmod(second, F.lit(3600.0)) / 60))
        )
    )


def _before_colon(text: Column) -> Column:
    return F.substring_index(text, ":", 1).try_cast("bigint")


def _after_colon(text: Column) -> Column:
    """Number between the first colon and the next one or the end."""
    return _before_colon(F.substr(text, F.instr(text, ":") + 1))


def _parts(hour: Column, minute: Column) -> Column:
    return F.struct(hour.cast("int").alias("h"), minute.alias("m"))


def two_digits(n: Column) -> Column:
    """Zero-pad to two places; longer and negative numbers stay whole."""
    digits = n.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), F.lit("0"))


def clock(parts: Column) -> Column:
    """``HH:MM``, null when either part is null."""
    return F.concat(two_digits(parts["h"]), F.lit(":"), two_digits(parts["m"]))


def known_hour(parts: Column) -> Column:
    """The hour of a valid clock time: without a minute there is no time."""
    return F.when(parts["m"].isNotNull(), parts["h"])


def parse_clock(text: Column) -> Column:
    """Any accepted clock notation to ``HH:MM``; the rest becomes null."""
    return clock(clock_parts(plain_spaces(text)))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from one clock time to the next; a negative gap passes midnight."""
    gap = (end["h"] * 60 + end["m"]) - (start["h"] * 60 + start["m"])
    return F.when(gap < 0, gap + MINUTES_PER_DAY).otherwise(gap).cast("int")


def parse_date(text: Column, *, lenient: bool = False) -> Column:
    """``D-M-YYYY`` text to a date; bad text fails the run unless lenient.

    The same under any ANSI setting of the session.
    """
    date = F.try_to_date(text, "d-M-yyyy")
    if lenient:
        return date
    problem = F.raise_error(F.concat(F.lit("unreadable date: "), text)).cast("date")
    return F.when(date.isNull() & text.isNotNull(), problem).otherwise(date)


def weekend_flag(date: Column) -> Column:
    """1 on Saturday and Sunday, 0 otherwise and where the date is missing."""
    return F.when(F.weekday(date) >= 5, 1).otherwise(0)


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
