"""Sentinels, gains, narrow number types, axes, keys and attribute maps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Platform codes and names, and the keyword classes of ocean platforms.
PLATFORMS = {"M01": "Metop-B", "M02": "Metop-A", "M03": "Metop-C"}
PLATFORM_CLASSES = {
    "buoys": ("BUOY",),
    "ships": ("SHIP", "UNCREWED SURFACE VEHICLE", "VOSCLIM"),
    "stations": ("STATION",),
    "obs": ("OBS",),
    "gliders": ("GLIDER", "FLOAT"),
}


def fill_to_null(value: Column, *fills: float) -> Column:
    """Null where the value is one of the sentinels or NaN."""
    return F.when(~(value.isin(*fills) | F.isnan(value.cast("double"))), value)


def null_to_fill(value: Column, fill: float | str) -> Column:
    return F.coalesce(value, F.lit(fill))


def scaled(value: Column, gain: float, offset: float = 0.0) -> Column:
    return value * gain + offset


def _step(size: Column, bits: int, least: int) -> Column:
    """The power of two at or below a positive finite number over 2^bits, at least 2^least; the logarithm may be off by rounding at powers.

    Without branches, so that Spark evaluates the logarithm and the power once, however often they are used.
    """
    near = F.pow(F.lit(2.0), F.floor(F.log2(size)).cast("double"))
    exact = near * (F.lit(1.0) + (near * 2 <= size).cast("double") - (near > size).cast("double") / 2)
    return F.greatest(exact * 2.0**-bits, F.lit(2.0**least))


def _rounded(value: Column, bits: int, least: int) -> Column:
    """value to a multiple of its power of two over 2^bits, of 2^least at least, ties to even; zero, infinity and NaN as they are.

    Zero has no logarithm and so a null result, infinity gives NaN; both fall back to the value.
    """
    step = _step(F.abs(value), bits, least)
    return F.nanvl(F.coalesce(F.rint(value / step) * step, value), value)


def to_half(value: Column) -> Column:
    """Values rounded to half precision, ties to even, and held as FLOAT; from 65520 on they become infinite."""
    value = value.cast("double")
    return F.when((F.abs(value) >= 65520) & ~F.isnan(value), F.signum(value) * float("inf")).otherwise(_rounded(value, 10, -24)).cast("float")


def bit_rounded(value: Column, bits: int = 9) -> Column:
    """Value with so many mantissa bits kept, ties to even: the step is the power of two below it over 2^bits."""
    return _rounded(value.cast("double"), bits, -1074)


def regular_axis(least: float, most: float, step: float, falling: bool = False) -> Column:
    """Array of the axis from least to most, the end included, as index times step so that no error adds up."""
    count = int(np.ceil((most + step - least) / step - 1e-9))
    axis = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.lit(float(least)) + k * float(step))
    return F.reverse(axis) if falling else axis


def radians_to_degrees(value: Column) -> Column:
    return F.degrees(value)


def above_radius(distance: Column, radius: float = 6378137.0) -> Column:
    return distance - radius


def platform_name(name: Column) -> Column:
    """Platform by the code between underscores in a product name; null if it is unknown."""
    table = F.create_map(*(F.lit(x) for pair in PLATFORMS.items() for x in pair))
    return F.try_element_at(table, F.regexp_extract(name, r"_(M\d\d)_", 1))


def platform_classes(name: Column, classes: dict[str, tuple[str, ...]] | None = None) -> Column:
    """All classes one of whose keywords the name holds; they overlap and case counts."""
    found = []
    for label, keys in (classes or PLATFORM_CLASSES).items():
        hit = F.lit(False)
        for key in keys:
            hit = hit | F.contains(name, F.lit(key))
        found.append(F.when(hit, F.lit(label)))
    return F.array_compact(F.array(*found))


def level_key(name: Column, level: Column, wavelength: Column | None = None) -> Column:
    """name@level, and @wavelength if there is one."""
    return F.concat_ws("@", name, level.cast("string"), *([wavelength.cast("string")] if wavelength is not None else []))


def split_level_key(key: Column) -> Column:
    part = F.split(key, "@")
    return F.struct(F.get(part, F.lit(0)).alias("name"), F.get(part, F.lit(1)).try_cast("int").alias("level"), F.get(part, F.lit(2)).try_cast("int").alias("wavelength"))


def model_name(name: Column, lower: Column) -> Column:
    """Variable name in the case that the model's files use."""
    return F.when(lower, F.lower(name)).otherwise(F.upper(name))


def composite_id(*parts: Column) -> Column:
    return F.concat_ws("-", *parts)


def fixed_width(value: Column, width: int) -> Column:
    return F.substring(value, 1, width)


def text_attributes(attributes: Column) -> Column:
    """Attribute map with all values as text."""
    return F.transform_values(attributes, lambda _, v: v.cast("string"))


def matching_attributes(attributes: Column, part: str, but: str) -> Column:
    """The attributes whose key contains ``part`` but not ``but``."""
    return F.map_filter(attributes, lambda k, _: F.contains(k, F.lit(part)) & ~F.contains(k, F.lit(but)))


def tagged_number(text: Column, before: str) -> Column:
    """Number that follows a text in XML-like metadata."""
    return F.regexp_extract(text, rf"{before}([-+]?[0-9]*\.?[0-9]+)<", 1).try_cast("double")


def field_name_of_url(url: Column) -> Column:
    """Canonical file name from a field address /p/VAR/[wvl1/W/][lvt1/T/][lv1/L/]r/TIME/s/PThhhHmmM."""
    part = lambda p: F.regexp_extract(url, p, 1)
    piece = lambda p, label: F.when(part(p) != "", F.concat(F.lit(label), part(p)))
    return F.concat(F.concat_ws("_", part("/p/([^/]+)/"), piece("/wvl1/([^/]+)/", "wavelength-"), piece("/lv1/([^/]+)/", "level-"), piece(r"/s/PT(\d+)H", "step-")), F.lit(".grib2"))
