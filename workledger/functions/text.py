"""Text clean-up and timestamp parsing as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters Unicode counts as white space, plus the four
# ASCII separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What nearly all feeds send; parsed directly.
_PLAIN = r"^(?!0000)\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?([+-](0\d|1[0-7]):[0-5]\d)?$"

# The other ISO 8601 calendar forms: compact digits, any separator between date
# and time, missing minutes or seconds, comma or long fractions, short or long offsets.
_ISO = (
    r"(?s)^(?!0000)(\d{4})(-?)(\d\d)\2(\d\d)"
    r"(?:.(\d\d)(?:(:?)(\d\d)(?:\6(\d\d)(?:[.,](\d+))?)?)?"
    r"(?:([+-])(\d\d)(?:(:?)(\d\d)(?:\12(\d\d)(?:[.,](\d+))?)?)?)?)?$"
)

# A year, a week and perhaps its day, in front of whatever follows a date. Digits that
# follow a compact week begin with the day if they are one, or an even number.
_WEEK = r"(?s)^(?!0000)(\d{4})(?:-W(\d\d)(?:-(\d)(?!\d))?|W(\d\d)(?:(\d)(?=(?:\d(?:\d\d)*)?(?:\D|$)))?)(.*)$"

_DAY = 86_400


def stripped(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def any_padded(texts: list[Column]) -> Column:
    """Whether some text may begin or end with white space; false only if :func:`stripped` changes none.

    One search for all texts of a row: trimming looks every character up in the list
    above, and nearly all texts begin and end with a visible ASCII character.
    """
    joined = F.concat_ws("!", *texts)
    # Most rows hold no other character at all, which is the quicker search.
    return joined.rlike("[^!-~]") & joined.rlike("[^!-~](?:!|$)|(?:^|!)[^!-~]")


def is_blank(text: Column) -> Column:
    return F.length(stripped(text)) == 0


def iso_timestamp(text: Column) -> Column:
    """The instant an ISO 8601 text names, or NULL; no offset means UTC."""
    zoned = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    other = once(zoned, lambda t: F.when(t.rlike(_WEEK), _with_calendar_date(t)).otherwise(t))
    return F.when(zoned.rlike(_PLAIN), F.try_to_timestamp(zoned)).otherwise(once(other, _spelled_out))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, and kept out of the generated code, for what is rarely needed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _with_calendar_date(text: Column) -> Column:
    """A text that begins with a year, week and day, with the date they name; NULL if the year has no such week."""

    def part(*indexes: int) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(text, _WEEK, index), F.lit("")) for index in indexes])

    year, week, day = _number(part(1)), _number(part(2, 4)), F.coalesce(_number(part(3, 5)), F.lit(1))
    # The fourth of January is in the first week, the 28th of December in the last one.
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    weeks = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    date = F.date_add(fourth, 7 * (week - 1) + day - 1 - F.weekday(fourth))
    named = week.between(1, weeks) & day.between(1, 7)
    return F.when(named, F.concat(F.date_format(date, "yyyy-MM-dd"), F.regexp_extract(text, _WEEK, 6)))


def _spelled_out(text: Column) -> Column:
    """The instant of any accepted form, read as ``yyyy-MM-ddTHH:mm:ss.ffffff`` and moved by its offset.

    Missing parts are empty: padding with zeros fills in their default. Padding
    also cuts a longer fraction to microseconds. An offset is below a day.
    """

    def part(index: int, digits: int = 2) -> Column:
        return F.rpad(F.regexp_extract(text, _ISO, index), digits, "0")

    day = F.concat(part(1, 4), F.lit("-"), part(3), F.lit("-"), part(4))
    time = F.concat(part(5), F.lit(":"), part(7), F.lit(":"), part(8), F.lit("."), part(9, 6))
    local = F.try_to_timestamp(F.concat(day, F.lit("T"), time, F.lit("+00:00")))
    seconds = _number(part(11)) * 3600 + _number(part(13)) * 60 + _number(part(14))
    offset = seconds.cast("long") * 1_000_000 + _number(part(15, 6))
    moved = F.when(F.regexp_extract(text, _ISO, 10) == "-", offset).otherwise(-offset)
    return F.when(text.rlike(_ISO) & (seconds < _DAY), F.timestamp_micros(F.unix_micros(local) + moved))
