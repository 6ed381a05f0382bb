"""Weather labels and density classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: weather code labels, label translations, category words, thresholds ---
WMO_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Icy fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Heavy showers",
    95: "Thunderstorm",
    96: "Thunderstorm w/ hail",
    99: "Thunderstorm w/ heavy hail",
}
UNKNOWN_WEATHER = "Unknown"
WEATHER_VIETNAMESE = {
    "clear sky": "Trời quang",
    "few clouds": "Ít mây",
    "scattered clouds": "Mây rải rác",
    "broken clouds": "Nhiều mây",
    "overcast clouds": "Trời u ám",
    "light rain": "Mưa nhẹ",
    "moderate rain": "Mưa vừa",
    "heavy intensity rain": "Mưa to",
    "thunderstorm": "Dông",
    "mist": "Sương mù",
    "fog": "Sương dày",
}
# First category with a matching word wins, so the order matters.
WEATHER_CATEGORIES = [
    ("storm", ["thunder", "storm", "sấm"]),
    ("rain", ["rain", "mưa", "drizzle"]),
    ("snow", ["snow", "tuyết"]),
    ("fog", ["fog", "mist", "sương"]),
    ("cloud", ["cloud", "mây", "overcast", "u ám"]),
    ("partly", ["partly", "few", "ít mây"]),
    ("clear", ["clear", "sunny", "nắng", "quang"]),
]
OTHER_CATEGORY = "other"
# Vehicles per km at which a road turns yellow, orange, red, by road class.
DENSITY_THRESHOLDS = {
    "trunk": (1.5, 3.0, 5.0),
    "primary": (3.0, 7.0, 11.0),
    "secondary": (6.0, 12.0, 20.0),
    "tertiary": (6.0, 12.0, 20.0),
    "residential": (3.0, 6.0, 10.0),
    "service": (3.0, 6.0, 10.0),
}
DENSITY_THRESHOLDS_DEFAULT = (4.0, 8.0, 12.0)
DENSITY_CLASSES = ["free", "busy", "heavy", "jammed"]
NO_DENSITY = "no data"
# --- end of fixed values ---


def _lookup(table: dict, key: Column) -> Column:
    """Literal map lookup: no join, no shuffle, folded into the projection."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def weather_label(code: Column) -> Column:
    return F.coalesce(_lookup(WMO_LABELS, code.cast("int")), F.lit(UNKNOWN_WEATHER))


def weather_in_vietnamese(label: Column) -> Column:
    """Translated label; a label without a translation stays as it is, null reads ''."""
    return F.coalesce(_lookup(WEATHER_VIETNAMESE, F.lower(label)), label, F.lit(""))


def weather_category(label: Column) -> Column:
    text = F.lower(label)
    chosen = None
    for name, words in WEATHER_CATEGORIES:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
    return chosen.otherwise(OTHER_CATEGORY)


def is_rainy(label: Column) -> Column:
    return F.coalesce(F.lower(label).contains("rain"), F.lit(False))


def density_class(density: Column, highway: Column) -> Column:
    """Class by the road's thresholds; a density on a threshold takes the higher class."""
    table = {name: F.array(*map(F.lit, limits)) for name, limits in DENSITY_THRESHOLDS.items()}
    entries = [x for name, limits in table.items() for x in (F.lit(name), limits)]
    limits = F.coalesce(
        F.try_element_at(F.create_map(*entries), highway),
        F.array(*map(F.lit, DENSITY_THRESHOLDS_DEFAULT)),
    )
    free, busy, heavy, jammed = DENSITY_CLASSES
    return (
        F.when(density.isNull() | F.isnan(density), NO_DENSITY)
        .when(density < limits[0], free)
        .when(density < limits[1], busy)
        .when(density < limits[2], heavy)
        .otherwise(jammed)
    )
