"""Road names, edge ids and distances."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
INTERNAL_EDGE_MARK = ":"
HOUSE_NUMBER_PATTERN = r"(?i)^\s*\d+[a-z]?(?:[/-]\d+[a-z]?)?\s+"
STREET_TYPE_PATTERN = r"(?i)^(duong|pho|ngo|ngach|hem)\s+"
COMBINING_MARKS = r"[\u0300-\u036f]"
PLAIN_NAME_PATTERN = r"^(?!(?:duong|pho|ngo|ngach|hem) )[a-z_][-a-z0-9_.']*(?: [-a-z0-9_.']+)*\z"
METRES_PER_DEGREE = 111000.0
# --- end of fixed values ---


def _accent_table() -> tuple[str, str]:
    """Latin letters with their unaccented forms, read off Unicode's own decompositions."""
    accented, plain = ["đ", "Đ"], ["d", "D"]
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        bare = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if bare != letter and len(bare) == 1:
            accented.append(letter)
            plain.append(bare)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), COMBINING_MARKS, "")


def normal_road_name(name: Column) -> Column:
    """Accent-free lower-case name without house number and street type; null reads ''.

    A name whose lower case is plain ASCII words is its own normal form, which spares it the accents and patterns.
    """
    text = F.coalesce(name, F.lit(""))
    plain = F.lower(strip_accents(text))
    street = F.regexp_replace(plain, HOUSE_NUMBER_PATTERN, "")
    street = F.regexp_replace(street, STREET_TYPE_PATTERN, "")
    normal = F.trim(F.regexp_replace(street, r"\s+", " "))
    return F.when(F.lower(text).rlike(PLAIN_NAME_PATTERN), F.lower(text)).otherwise(normal)


def is_internal_edge(edge_id: Column) -> Column:
    return edge_id.startswith(INTERNAL_EDGE_MARK)


def way_of_edge(edge_id: Column) -> Column:
    """Way id behind an edge id such as -123#4; null for internal or blank ones."""
    base = F.substring_index(F.ltrim(edge_id, F.lit("-")), "#", 1)
    return F.when(~is_internal_edge(edge_id) & (base != ""), base)


def edge_keys(edge_id: Column) -> Column:
    """Lookup keys of an edge id, best first: as is, without direction, without part, as a name.

    An id of digits and marks alone is its own normal form, which spares the usual id the
    name's patterns.
    """
    raw = F.trim(edge_id)
    undirected = F.when(raw.startswith("-"), F.substr(raw, F.lit(2))).otherwise(raw)
    whole_way = F.substring_index(undirected, "#", 1)
    as_name = F.when(raw.rlike("^[-0-9#:_]*$"), raw).otherwise(normal_road_name(raw))
    keys = F.array_distinct(F.array_remove(F.array(raw, undirected, whole_way, as_name), ""))
    return F.when(edge_id.isNull(), F.array().cast("array<string>")).otherwise(keys)


def name_keys(name: Column) -> Column:
    """Lookup keys of a road name: lower case, then normalised. The two are often the same, and
    then count twice in row counts, as the published figures do."""
    keys = F.array_remove(F.array(F.lower(name), normal_road_name(name)), "")
    return F.when(name.isNull(), F.array().cast("array<string>")).otherwise(keys)


def metres_between(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Equirectangular distance, with the longitude scale of the first point."""
    dy = (to_lat - lat) * METRES_PER_DEGREE
    dx = (to_lon - lon) * METRES_PER_DEGREE * F.cos(F.radians(lat))
    return F.sqrt(dy * dy + dx * dx)
