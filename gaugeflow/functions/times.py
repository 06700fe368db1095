"""Time expressions. All text forms are zone-less UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text shapes of a time and their lengths.
SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"
SECOND_LENGTH = 19
MINUTE_LENGTH = 16

MICROS = 1_000_000


def second_text(ts) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def minute_text(ts) -> Column:
    return F.date_format(ts, MINUTE_FORMAT)


def minute_key(text) -> Column:
    """Cut a time text to minutes; shorter texts pass unchanged."""
    return F.substring(text, 1, MINUTE_LENGTH)


def parse_time(text) -> Column:
    """The seconds form or the minutes form; NULL if neither fits.

    Each form has one length, so the one to try is known without a failed attempt.
    """
    length = F.length(text)
    return F.when(length == SECOND_LENGTH, F.try_to_timestamp(text, F.lit(SECOND_FORMAT))).when(
        length == MINUTE_LENGTH, F.try_to_timestamp(text, F.lit(MINUTE_FORMAT))
    )


def parse_time_smart(text: Column) -> Column:
    """Like `parse_time`, but a day past the month's end becomes its last day
    and 24:00:00 becomes the next midnight."""
    shape = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"

    def part(start, length):
        return F.substring(text, start, length).try_cast("int")

    year, month, day = part(1, 4), part(6, 2), part(9, 2)
    hour, minute = part(12, 2), part(15, 2)
    second = F.coalesce(part(18, 2), F.lit(0))
    first = F.try_to_timestamp(F.concat(F.substring(text, 1, 7), F.lit("-01")), F.lit("yyyy-MM-dd"))
    clamped = F.least(day, F.dayofmonth(F.last_day(first)))
    midnight = (hour == 24) & (minute == 0) & (second == 0)
    moment = F.try_make_timestamp(
        year, month, clamped, F.when(midnight, 0).otherwise(hour), minute, second
    )
    moment = F.when(midnight, moment + F.expr("INTERVAL 1 DAY")).otherwise(moment)
    # A leap second is accepted by make_timestamp but not by the two text patterns.
    legal = text.rlike(shape) & day.between(1, 31) & (second < 60) & (year > 0)
    return F.coalesce(parse_time(text), F.when(legal, moment))


_HALF = 1 << 20


def time_sums(ts) -> dict[str, Column]:
    """Aggregates of a timestamp from which `mean_of_sums` takes the mean.

    Epoch milliseconds are summed in two halves, because one sum of them would
    overflow a long after a few million rows.
    """
    millis = F.unix_millis(ts)
    return {
        "_high": F.sum(cell(millis, _HALF)),
        "_low": F.sum(F.pmod(millis, F.lit(_HALF))),
        "_times": F.count(ts),
    }


def mean_of_sums(high: Column, low: Column, rows: Column) -> Column:
    """Mean timestamp in whole milliseconds, rounded down."""
    rest = F.pmod(high, rows)
    part = rest * _HALF + low
    whole = _whole(high - rest, rows) * _HALF
    return F.timestamp_millis(whole + _whole(part - F.pmod(part, rows), rows))


def _whole(multiple: Column, size: Column) -> Column:
    """Quotient of an exact multiple."""
    return (multiple / size).cast("long")


def cell(micros: Column, width: int) -> Column:
    """Number of the `width`-microsecond cell that holds `micros` (exact for any long)."""
    size = F.lit(width).cast("long")
    return _whole(micros - F.pmod(micros, size), size)


def micros_of(duration) -> int:
    """Microseconds in an int/float number of seconds."""
    return round(duration * MICROS)
