"""Times in file names and paths, epoch arithmetic and forecast times. All results are TIMESTAMP_NTZ; what can't be parsed is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where products keep the time in their names, and how it is written there.
NAME_LAYOUTS = {
    "radar": (r"(\d{8}-\d{6})", "yyyyMMdd-HHmmss"),
    "rain_rate": (r"\.S(\d{12})\.", "yyyyMMddHHmm"),
    "blended_rain": (r"blend_s(\d{12})", "yyyyMMddHHmm"),
    "dust": (r"_(\d{10})_\d+\.nc", "yyyyMMddHH"),
    "full_disk": (r"_(\d{12})\.nc", "yyyyMMddHHmm"),
}
UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def ntz(value: Column) -> Column:
    return value.cast("timestamp_ntz")


def time_from_name(name: Column, layout: str) -> Column:
    """The time that a product's file name holds, by one of NAME_LAYOUTS."""
    pattern, written = NAME_LAYOUTS[layout]
    return ntz(F.try_to_timestamp(F.regexp_extract(name, pattern, 1), F.lit(written)))


def time_from_day_of_year(name: Column, mark: str = "_s") -> Column:
    """Year, day of year and time of day after a mark, as in s20250011230456; a tenth of a second that follows is dropped."""
    part = lambda k: F.regexp_extract(name, rf"{mark}(\d{{4}})(\d{{3}})(\d{{2}})(\d{{2}})(\d{{2}})", k).try_cast("int")
    day = F.date_add(F.make_date(part(1), F.lit(1), F.lit(1)), part(2) - 1)
    return ntz(day) + F.make_dt_interval(F.lit(0), part(3), part(4), part(5))


def iso_time(text: Column) -> Column:
    """ISO 8601 with a fraction and an optional Z, taken as UTC."""
    return ntz(F.try_to_timestamp(F.rtrim(text, F.lit("Z"))))


def joined_time(date: Column, time: Column, written: str = "yyyyMMddHHmmss") -> Column:
    """Time from a date attribute and a time attribute."""
    return ntz(F.try_to_timestamp(F.concat(date, time), F.lit(written)))


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return F.unix_micros(F.to_utc_timestamp(time.cast("timestamp"), "UTC"))


def from_micros(value: Column) -> Column:
    return ntz(F.timestamp_micros(value))


def encode_time(time: Column, unit: str = "s", epoch: str = "1970-01-01 00:00:00") -> Column:
    """Whole units since an epoch, rounded down."""
    return F.floor((micros(time) - micros(F.lit(epoch).cast("timestamp_ntz"))) / UNITS[unit]).cast("long")


def decode_time(value: Column, unit: str = "s", epoch: str = "1970-01-01 00:00:00") -> Column:
    """The time that lies so many units after an epoch."""
    return from_micros(micros(F.lit(epoch).cast("timestamp_ntz")) + value.cast("long") * UNITS[unit])


def mid_time(start: Column, end: Column) -> Column:
    """Middle of a scan, to the microsecond below."""
    return from_micros(micros(start) + F.floor((micros(end) - micros(start)) / 2).cast("long"))


def step_seconds(time: Column, init: Column) -> Column:
    return F.floor((micros(time) - micros(init)) / 1_000_000).cast("long")


def valid_time(init: Column, hours: Column) -> Column:
    return init + F.make_dt_interval(F.lit(0), hours)


def compact(time: Column) -> Column:
    """ISO form without separators, to the minute."""
    return F.date_format(time, "yyyyMMdd'T'HHmm'Z'")


def day_path(time: Column, root: str = "") -> Column:
    """root/year/day of year/hour with fixed widths."""
    return F.concat(F.lit(f"{root}/" if root else ""), F.date_format(time, "yyyy"), F.lit("/"), F.lpad(F.dayofyear(time).cast("string"), 3, "0"), F.lit("/"), F.date_format(time, "HH"))


def templated(template: str, **parts: Column) -> Column:
    """A path or address from a template with {name} places."""
    out, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before), parts[name].cast("string")]
    return F.concat(*out, F.lit(rest))


def day_slots(day: Column, minutes: int) -> Column:
    """Array of the times of a day that lie a fixed number of minutes apart."""
    start = ntz(F.date_trunc("day", day))
    count = 24 * 60 // minutes
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: start + F.make_dt_interval(F.lit(0), F.lit(0), k * minutes))
