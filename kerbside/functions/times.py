"""Event time, floors, buckets, labels and horizons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"
INTERVAL_MINUTES = 3
BUCKETS_PER_DAY = 480
MINUTES_PER_DAY = 1440
CLOCK_PATTERN = r"(?:^|T|\s)(\d{1,2}):(\d{2})(?::\d{2})?"
DATED_CLOCK_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"
FILE_DATE_PATTERN = r"(\d{2}-\d{2}-\d{4})"
# --- end of fixed values ---


def _pad2(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def _held(value: Column, low: int, high: int) -> Column:
    """``value`` moved into low..high; null stays null, which least and greatest alone skip."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def _clock(minutes: Column) -> Column:
    return F.concat(_pad2(F.floor(minutes / 60)), F.lit(":"), _pad2(F.floor(minutes % 60)))


def interval_time(day: Column, clock: Column) -> Column:
    """Timestamp of ``day`` (yyyy-MM-dd) at ``clock`` (HH:mm); 24:00 is the next midnight.

    Unparseable input gives null, also under ANSI mode.
    """
    next_midnight = F.date_add(day.try_cast("date"), 1).cast("timestamp")
    return F.when(clock == "24:00", next_midnight).otherwise(
        F.try_to_timestamp(F.concat(day, F.lit("T"), clock))
    )


def minute_text(ts: Column) -> Column:
    """yyyy-MM-dd'T'HH:mm."""
    return F.date_format(ts, MINUTE_FORMAT)


def parse_minute_text(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(MINUTE_FORMAT))


def parse_local(text: Column) -> Column:
    """Wall-clock time of an ISO text; an offset, when present, is dropped, not applied."""
    return text.try_cast("timestamp_ntz")


def processed_at(clock: Column | None = None) -> Column:
    """Processing stamp to the minute; pass ``clock`` to fix it."""
    return minute_text(F.current_timestamp() if clock is None else clock)


def floor_minutes(ts: Column, minutes: int = INTERVAL_MINUTES) -> Column:
    """Floor on the epoch; right for every step that divides the zone's offset."""
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / step) * step)


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts)


def hour_of_day(ts: Column, day: Column) -> Column:
    """Hour of ``ts`` counted from the start of ``day``: 0..23, and 24 for the closing
    24:00 interval, which belongs to ``day`` but must not share hour 0 with its morning."""
    return F.when(F.to_date(ts) > day, F.lit(24)).otherwise(F.hour(ts)).cast("int")


def seconds_to_clock(seconds: Column) -> Column:
    return _clock(F.floor(seconds.try_cast("double") / 60))


def minutes_to_clock(minutes: Column) -> Column:
    """HH:mm of a minute count; 1440 and beyond read "24:00"."""
    return F.when(minutes >= MINUTES_PER_DAY, F.lit("24:00")).otherwise(
        _clock(_held(minutes, 0, MINUTES_PER_DAY - 1))
    )


def compact_clock(clock: Column) -> Column:
    return F.replace(clock, F.lit(":"), F.lit(""))


def bucket_of(ts: Column, hour: Column | None = None) -> Column:
    """3-minute bucket 0..479. A numeric hour, when there is one, wins over the timestamp
    and names the hour's first bucket."""
    by_time = F.floor((F.hour(ts) * 60 + F.minute(ts)) / INTERVAL_MINUTES)
    if hour is None:
        return by_time.cast("int")
    usable = F.when(hour.isNotNull() & ~F.isnan(hour.cast("double")), hour)
    by_hour = _held(F.floor(usable), 0, 23) * (60 // INTERVAL_MINUTES)
    return F.coalesce(by_hour, by_time).cast("int")


def bucket_to_clock(bucket: Column) -> Column:
    return _clock(bucket * INTERVAL_MINUTES)


def minute_from_number(value: Column) -> Column:
    """Nearest whole minute, halves upwards, held to 0..1439."""
    return _held(F.floor(value + 0.5), 0, MINUTES_PER_DAY - 1).cast("int")


def minute_from_text(value: Column) -> Column:
    """Minute of the first HH:mm in the text, else of a parseable timestamp, else null.

    After a date in its usual form the clock stands at a fixed place, which spares the pattern's groups.
    """
    text = F.trim(value)
    placed = F.substr(text, F.lit(12), F.lit(2)).cast("int") * 60 + F.substr(text, F.lit(15), F.lit(2)).cast("int")
    hours = F.regexp_extract(text, CLOCK_PATTERN, 1)
    minutes = F.regexp_extract(text, CLOCK_PATTERN, 2)
    clock = hours.try_cast("int") * 60 + minutes.try_cast("int")
    stamp = F.when(F.length(text) > 0, F.try_to_timestamp(text))
    found = F.when(F.length(hours) > 0, clock).otherwise(F.hour(stamp) * 60 + F.minute(stamp)).cast("int")
    return F.when(text.rlike(DATED_CLOCK_PATTERN), placed).otherwise(found)


def nearest_step(minute: Column, step: int = INTERVAL_MINUTES) -> Column:
    return (F.floor(minute / step + 0.5) * step).cast("int")


def snap_to_five(minute: Column) -> Column:
    return _held(nearest_step(minute, 5), 0, 1435).cast("int")


def horizon_minutes(anchor: Column, target: Column) -> Column:
    """Whole minutes from anchor to target; a half goes to the even minute."""
    return F.bround((F.unix_micros(target) - F.unix_micros(anchor)) / 60e6).cast("int")


def step_count(horizon: Column, step: Column) -> Column:
    return F.ceil(horizon / step).cast("int")


def step_time(anchor: Column, target: Column, step_index: Column, steps: Column, step: Column) -> Column:
    """Time of one step; the last one always lands on the target."""
    at = F.timestamp_seconds(F.unix_seconds(anchor) + step_index * step * 60)
    return F.when(step_index == steps, target).otherwise(at)


def day_schedule(first_end: Column, step: int = INTERVAL_MINUTES) -> Column:
    """Interval ends, in minutes of the day, from ``first_end`` to 1440; empty past it."""
    ends = F.sequence(F.least(first_end, F.lit(MINUTES_PER_DAY)), F.lit(MINUTES_PER_DAY), F.lit(step))
    return F.when(first_end <= MINUTES_PER_DAY, ends).otherwise(F.array().cast("array<int>"))


def next_interval_end(minute: Column, step: int = INTERVAL_MINUTES) -> Column:
    return ((F.floor(minute / step) + 1) * step).cast("int")


def calendar_features(ts: Column) -> dict[str, Column]:
    """Monday is day 0."""
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
    }


def date_from_file_name(path: Column) -> Column:
    """Date of a dd-MM-yyyy stretch in a file name; null when there is none."""
    return F.to_date(F.try_to_timestamp(F.regexp_extract(path, FILE_DATE_PATTERN, 1), F.lit("dd-MM-yyyy")))
