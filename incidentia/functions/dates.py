"""Event time: parsing, parts, shift of the day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentia.schemas import OTHER_SHIFT, SHIFTS

# One- and two-digit day, month, hour and minute; any white space before the
# hour; a one-digit day may have a blank before it.
TIME_SHAPE = r"^(?:([0-9]{1,2})| ([0-9]))/([0-9]{1,2})/([0-9]{4})\s+([0-9]{1,2}):([0-9]{1,2})$"
# A text of that shape is written anew behind a mark, so no other text parses.
_MARK = "\u0001"
TIME_PATTERN = f"'{_MARK}'d/M/yyyy H:m"

# Day names, in the order of Spark's day numbers.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def parse_event_time(text: Column) -> Column:
    """Wall-clock time of the incident, null where the text does not parse."""
    plain = F.regexp_replace(text, TIME_SHAPE, f"{_MARK}$1$2/$3/$4 $5:$6")
    marked = F.when(~text.startswith(_MARK), plain)
    return F.try_to_timestamp(marked, F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def time_parts(time: Column) -> dict[str, Column]:
    return {
        "anio": F.year(time),
        "mes": F.month(time),
        "hora": F.hour(time),
        "dia_semana": F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.dayofweek(time)),
    }


def shift_of(hour: Column) -> Column:
    """Shift name; a null hour has no shift."""
    shift = F.when(hour.isNull(), F.lit(None).cast("string"))
    for name, start, end in SHIFTS:
        shift = shift.when((hour >= start) & (hour < end), name)
    return shift.otherwise(OTHER_SHIFT)


def hour_from_text(text: Column) -> Column:
    """Hour after the first ``T`` or blanks in a date-time text; null if there
    is none from 0 to 23."""
    halves = F.when(text.contains("T"), F.split(text, "T")).when(
        text.contains(" "), F.split(text, " +")
    )
    clock = F.try_element_at(halves, F.lit(2))
    hour = F.try_element_at(F.split(clock, ":"), F.lit(1)).try_cast("int")
    # A list of one, so that the text is taken apart once.
    return F.get(F.filter(F.array(hour), lambda h: h.between(0, 23)), F.lit(0))


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
