"""Scalar expressions of the network domain: identifiers, codes, classes, vessel dimensions, edge costs.

All are Column expressions (no UDF), and none fails under ANSI mode: a text that can't be read as a number gives null.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
CEMT_ORDER = {"0": 0, "I": 1, "II": 2, "III": 3, "IV": 4, "VA": 5, "VB": 6, "VIA": 7, "VIB": 8, "VIC": 9}
CEMT_ALIASES = {"IVA": "IV", "IVB": "IV", "VIIA": "VIC"}
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
NAME_KEYWORDS = ("oost", "west", "midden", "zuid", "noord", "klein", "groot", "boven", "beneden", "hoofd", "jacht", "spui")
SPEED_COLUMNS = ("maxspeed_up", "maxspeed_down", "maxspeed", "calspeed_up", "calspeed_down")
VESSEL_DEFAULT = {"beam": 11.4, "length": 110.0, "height": 6.0, "draft": 2.5, "cemt": "VB"}
DRAFT_DEFAULT, EMPTY_SHARE, HARD_PENALTY, SEA_PENALTY, EXCESS_RATE, PASSAGE_MINUTES = 3.5, 0.4, 1000.0, 100000.0, 5.0, 30.0


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_valid(x: Column | str) -> Column:
    """Neither null, nor NaN, nor the text 'nan'."""
    text = _c(x).cast("string")
    return _c(x).isNotNull() & ~text.isin("nan", "NaN")


def stringify_id(x: Column | str) -> Column:
    """An identifier as text: whole numbers without decimals ('123.0' is '123'), 'nan' and what isn't finite null."""
    text = _c(x).cast("string")
    number = text.try_cast("double")
    whole = F.when(F.abs(number) < 1e15, (number == F.floor(number)))
    return (
        F.when(F.lower(text).isin("nan", "inf", "-inf", "infinity", "-infinity"), F.lit(None).cast("string"))
        .when(whole, number.cast("bigint").cast("string"))
        .when(number.isNotNull(), number.cast("string"))
        .otherwise(text)
    )


def snake_name(name: str) -> str:
    """A column name in snake case. Only a small letter or the digit 0 before a capital ends a word."""
    if name.lower() == "geometry":
        return "geometry"
    return re.sub(r"([a-z0])([A-Z])", r"\1_\2", re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)).lower()


def camel_to_snake(x: Column | str) -> Column:
    """snake_name of a column of texts."""
    once = F.regexp_replace(_c(x), r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.when(F.lower(_c(x)) == "geometry", "geometry").otherwise(F.lower(F.regexp_replace(once, r"([a-z0])([A-Z])", "$1_$2")))


def normalize_code(x: Column | str) -> Column:
    """A route code: leading digits without zeros before them ('001b' is '1'), else without leading zeros."""
    text = F.trim(_c(x).cast("string"))
    text = F.regexp_replace(text, r"\.0$", "")
    digits = F.regexp_extract(text, r"^0*(\d+)", 1)
    empty = _c(x).isNull() | F.lower(_c(x).cast("string")).isin("", "nan", "none", "<na>")
    return F.when(~empty, F.when(digits != "", digits).otherwise(F.regexp_replace(text, "^0+", "")))


def normalize_class_code(x: Column | str) -> Column:
    """A vessel class: upper case, trimmed, B0 (digit) read as BO; null is ''."""
    code = F.trim(F.upper(_c(x)))
    return F.coalesce(F.when(code.startswith("B0"), F.concat(F.lit("BO"), F.substring(code, 3, 1000))).otherwise(code), F.lit(""))


def normalize_cemt(x: Column | str) -> Column:
    code = F.translate(F.trim(F.upper(_c(x))), "_-", "")
    return F.coalesce(reduce(lambda c, kv: F.when(code == kv[0], kv[1]).otherwise(c), CEMT_ALIASES.items(), code), F.lit(""))


def cemt_scale(x: Column | str) -> Column:
    """Rank of a normalised waterway class, 0 if unknown."""
    scale = F.create_map(*[F.lit(v) for kv in CEMT_ORDER.items() for v in kv])
    return F.coalesce(F.try_element_at(scale, _c(x)), F.lit(0))


def number_in_text(x: Column | str) -> Column:
    """The first decimal or whole number of a text if it is above zero, else null; a number is taken as it is."""
    #: Fixed value: the pattern of a number.
    found = F.regexp_extract(_c(x).cast("string"), r"[-+]?\d*\.\d+|\d+", 0).try_cast("double")
    number = F.typeof(_c(x)).rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    found = F.when(number, _c(x).cast("string").try_cast("double")).otherwise(found)
    return F.when(found > 0, found)


def month_number(x: Column | str) -> Column:
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(_c(x))), F.lit(0)).cast("int")


def file_year_month(name: Column | str) -> Column:
    """struct(year, month) from the name of a weekly file: DDMMMYYYY, else YYYY_YYYYMMDD, else nulls."""
    a, b = r"weekmonitor_\d{2}([A-Z]{3})(\d{4})", r"weekmonitor_(\d{4})_(\d{4})(\d{2})"
    month = month_number(F.regexp_extract(_c(name), a, 1))
    one = F.struct(F.regexp_extract(_c(name), a, 2).try_cast("int").alias("year"), month.alias("month"))
    two = F.struct(F.regexp_extract(_c(name), b, 1).try_cast("int").alias("year"), F.regexp_extract(_c(name), b, 3).try_cast("int").alias("month"))
    return F.when(month.isNotNull(), one).otherwise(two)


def year_month_key(given: Column | str, year: Column | str, month: Column | str) -> Column:
    """yymm as given if above zero, else derived."""
    n = [F.coalesce(_c(x).try_cast("bigint"), F.lit(0)) for x in (given, year, month)]
    return F.when(n[0] > 0, n[0]).otherwise(F.pmod(n[1], F.lit(100)) * 100 + n[2])


def to_long(x: Column | str) -> Column:
    """A whole number, 0 for what isn't one."""
    return F.coalesce(_c(x).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def ranges_overlap(b1: Column | str, e1: Column | str, b2: Column | str, e2: Column | str, longest: Column | str | None = None) -> Column:
    """Whether two closed ranges touch, in any direction; with longest also where the second counts from the far end.
    A null end gives false."""
    lo1, hi1, lo2, hi2 = F.least(_c(b1), _c(e1)), F.greatest(_c(b1), _c(e1)), F.least(_c(b2), _c(e2)), F.greatest(_c(b2), _c(e2))
    hit = ~((hi1 < lo2) | (hi2 < lo1))
    if longest is not None:
        far = F.coalesce(~((hi1 < _c(longest) - hi2) | (_c(longest) - lo2 < lo1)), F.lit(False))
        hit = hit | far
    ends = [_c(x).isNotNull() for x in (b1, e1, b2, e2)]
    return F.coalesce(reduce(lambda a, b: a & b, ends) & hit, F.lit(False))


def name_score(one: Column | str, other: Column | str, distance: Column | str | None = None) -> Column:
    """Likeness of two names: 10 for each keyword in both, 5 if one holds the other, up to 5 for nearness (100 m each)."""
    a, b = _c(one), _c(other)
    shared = reduce(lambda s, w: s + F.when(a.contains(w) & b.contains(w), 10.0).otherwise(0.0), NAME_KEYWORDS, F.lit(0.0))
    score = F.when((F.length(a) > 0) & (F.length(b) > 0), shared + F.when(a.contains(b) | b.contains(a), 5.0).otherwise(0.0)).otherwise(0.0)
    return F.coalesce(score, F.lit(0.0)) + (0.0 if distance is None else F.greatest(F.lit(0.0), 5.0 - _c(distance) / 100.0))


def harbour_locode(unlocode: Column | str, code: Column | str) -> Column:
    """The port's location code if it has five characters or more, else the first five of its own code, else ''."""
    return F.coalesce(F.when(F.length(_c(unlocode)) >= 5, _c(unlocode)).when(F.length(_c(code)) >= 5, F.substring(_c(code), 1, 5)), F.lit(""))


def flag_text(x: Column | str) -> Column:
    """'1' and '0' for texts of truth values; other texts without decimals."""
    low = F.lower(F.trim(_c(x).cast("string")))
    return F.when(low.isin("true", "yes"), "1").when(low.isin("false", "no"), "0").otherwise(F.regexp_replace(low, r"\.\d*$", ""))


def edge_key(fis_id: Column | str, code: Column | str) -> Column:
    """An edge's name: the first of its two ids that isn't empty, as a text; null without any."""
    text = lambda x: F.nullif(F.trim(_c(x).cast("string")), F.lit(""))
    return F.coalesce(text(fis_id), text(code))


#: The water that inland routes avoid and its factor; classes of large waterways and the factor of others.
SEA, SEA_FACTOR, LARGE, SMALL_FACTOR = "Noordzee", 1e8, ("IV", "VII", "VIa", "VIb", "VIc", "Va", "Vb"), 10.0


def length_without_sea(length: Column | str, water_name: Column | str) -> Column:
    return F.coalesce(_c(length), F.lit(1.0)) * F.when(F.coalesce(_c(water_name) == SEA, F.lit(False)), SEA_FACTOR).otherwise(1.0)


def length_by_class(length: Column | str, cemt: Column | str) -> Column:
    return _c(length) * F.when(F.coalesce(_c(cemt).isin(*LARGE), F.lit(False)), 1.0).otherwise(SMALL_FACTOR)


def percent(part: Column | str, total: Column | str) -> Column:
    return F.coalesce(F.when(_c(total) > 0, 100.0 * _c(part) / _c(total)), F.lit(0.0))


def line_width(weight: Column | str, largest: Column | str) -> Column:
    return 1 + 12 * F.log1p(_c(weight)) / F.log1p(_c(largest))


def vessel_draft(cargo: Column | str, capacity: Column | str, loaded: Column | str, empty: Column | str, average: Column | str) -> Column:
    """Draught between empty and loaded by the share of the capacity that is used (0 to 1)."""
    full = F.coalesce(_c(loaded), _c(average), F.lit(DRAFT_DEFAULT))
    bare = F.coalesce(_c(empty), EMPTY_SHARE * full)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(_c(cargo), _c(capacity))))
    return F.when((_c(capacity) > 0) & (_c(cargo) > 0), bare + share * (full - bare)).otherwise(bare)


def is_home(structure_id: Column | str) -> Column:
    """All digits, or FIS_ before it, or NL in it; without an id too."""
    s = F.upper(_c(structure_id))
    return F.coalesce(s.rlike("^[0-9]+$") | s.startswith("FIS_") | s.contains("NL"), F.lit(True))


def narrowest(chambers: Column | str, openings: Column | str, edge: Column) -> Column:
    """struct(value, id, name, type) of the least width of chambers, openings (arrays of struct(id, name, width)) and the
    edge (such a struct); ties in this order. Null if none has a width."""
    def tagged(items: Column, kind: str, rank: int) -> Column:
        own = F.filter(items, lambda s: s["width"].isNotNull())
        return F.transform(own, lambda s: F.struct(s["width"].cast("double").alias("value"), F.lit(rank).alias("rank"), s["id"].alias("id"), s["name"].alias("name"), F.lit(kind).alias("type")))

    none = F.expr("cast(array() as array<struct<value:double,rank:int,id:string,name:string,type:string>>)")
    parts = [F.coalesce(tagged(_c(chambers), "lock", 0), none), F.coalesce(tagged(_c(openings), "bridge", 1), none), F.coalesce(tagged(F.array(edge), "fairway", 2), none)]
    return F.array_min(F.concat(*parts))


def soft_penalties(beam: Column, length: Column, cemt: Column, limit: Column, shortest: Column, water_name: Column, edge_cemt: Column) -> Column:
    """struct(lock, bridge, fairway, sea, cemt, total) of what a vessel exceeds on an edge. limit: narrowest(); shortest:
    least chamber length, null without chambers. Height and depth don't count: they vary with the water level."""
    over = F.coalesce(beam > limit["value"], F.lit(False))
    wide = F.when(over, F.when(is_home(limit["id"]), HARD_PENALTY).otherwise(EXCESS_RATE * (beam - limit["value"]))).otherwise(0.0)
    kind = F.coalesce(limit["type"], F.lit("fairway"))
    water = F.lower(F.trim(water_name))
    ship, edge = cemt_scale(normalize_cemt(cemt)), cemt_scale(normalize_cemt(edge_cemt))
    parts = {
        "lock": F.when(kind == "lock", wide).otherwise(0.0) + F.when(F.coalesce(length > shortest, F.lit(False)), HARD_PENALTY).otherwise(0.0),
        "bridge": F.when(kind == "bridge", wide).otherwise(0.0),
        "fairway": F.when(kind == "fairway", wide).otherwise(0.0),
        "sea": F.when(F.coalesce(water.contains("noordzee") | water.contains("sea"), F.lit(False)), SEA_PENALTY).otherwise(0.0),
        "cemt": F.when((edge > 0) & (ship > edge), HARD_PENALTY).otherwise(0.0),
    }
    return F.struct(*[v.alias(k) for k, v in parts.items()], reduce(lambda a, b: a + b, parts.values()).alias("total"))


def edge_speed(columns: list[Column]) -> Column:
    """km/h: the first above zero of the columns (numbers, or texts with one), 10 if none, at least 1."""
    return F.greatest(F.lit(1.0), F.coalesce(*[number_in_text(c) for c in columns], F.lit(10.0)))


def edge_weight(length_m: Column, speed: Column, passage_minutes: Column, penalty: Column) -> Column:
    """Hours: sailing, plus the passage of every chamber (an array of minutes; null is half an hour), plus penalties."""
    locks = F.aggregate(F.coalesce(passage_minutes, F.expr("cast(array() as array<double>)")), F.lit(0.0), lambda a, m: a + F.coalesce(m, F.lit(PASSAGE_MINUTES)) / 60.0)
    return length_m / 1000.0 / speed + locks + penalty
