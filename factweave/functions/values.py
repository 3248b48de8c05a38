"""Column functions that read numbers, units, dates and places from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.units import UNITS, dimension, to_standard  # noqa: F401

#: Languages that group digits by comma (fixed values); others swap comma and point.
COMMA_LANGS = ("en", "ja", "zh")
#: Scale words and their factors (fixed values).
SCALES = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12, "quadrillion": 1e15}
#: English month names (fixed values).
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
#: Months by language: names of each number (fixed values).
MONTH_NAMES = {
    "en": [[m] for m in MONTHS],
    "de": [["januar", "jänner"], ["februar", "feber"], ["märz"], ["april"], ["mai"], ["juni"], ["juli"], ["august"], ["september"], ["oktober"], ["november"], ["dezember"]],
}


def _plain(c: Column, lang: Column) -> Column:
    """A number with a point for decimals and no grouping."""
    return F.when(lang.isin(*COMMA_LANGS), F.replace(c, F.lit(","), F.lit(""))).otherwise(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def parse_integer(c: Column, lang: Column) -> Column:
    """The first run of digits and group marks."""
    return _plain(F.regexp_extract(c, r"(-?[0-9][0-9.,]*)", 1), lang).try_cast("decimal(38,6)").cast("bigint")


def parse_float(c: Column, lang: Column) -> Column:
    return _plain(F.regexp_extract(c, r"(-?[0-9]+(?:[.,][0-9]+)*)", 1), lang).try_cast("double")


def parse_scaled(c: Column, lang: Column) -> Column:
    """A number followed by a scale word is multiplied."""
    word = F.lower(F.regexp_extract(c, r"(?i)[0-9]\s*(?:\[\[)?(thousand|million|billion|trillion|quadrillion)", 1))
    factor = F.lit(1.0)
    for name, f in SCALES.items():
        factor = F.when(word == name, F.lit(f)).otherwise(factor)
    return parse_float(c, lang) * factor


def format_number(c: Column) -> Column:
    """From 1000 on without decimals, below with four."""
    return F.when(F.abs(c) >= 1000, F.round(c).cast("bigint").cast("string")).otherwise(F.format_string("%.4f", c))


def parse_percent(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]{1,3}(?:\.[0-9]+)?) ?%", 1).try_cast("double")


def parse_rank(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]+)(?:<sup>)?(?:st|nd|rd|th)\b", 1).try_cast("bigint")


def parse_money(c: Column) -> Column:
    """``$1,234.50`` or ``$1.2 million`` as a number."""
    body = F.regexp_extract(c, r"(?i)\$ ?([0-9][0-9,]*(?:\.[0-9]+)?(?: (?:thousand|million|billion|trillion))?)", 1)
    return F.when(body != "", parse_scaled(body, F.lit("en")))


def minutes_of(c: Column) -> Column:
    """``h:mm`` as minutes."""
    h, m = (F.regexp_extract(c, r"\b([0-9]{1,2}):([0-5][0-9])\b", k).try_cast("bigint") for k in (1, 2))
    return h * 60 + m


def within_permille(a: Column, b: Column) -> Column:
    """a lies within 0.1 % of b."""
    return F.abs(a - b) <= F.abs(b) * 0.001


def month_number(c: Column, lang: str = "en") -> Column:
    """1 to 12, or null."""
    k = F.coalesce(*(F.when(F.lower(c).isin(*names), F.lit(m)) for m, names in enumerate(MONTH_NAMES[lang], 1)))
    return k.cast("int")


def parse_date(c: Column, lang: str = "en") -> Column:
    """ISO, ``d Month y`` (German ``d. Month y``) or ``Month d, y`` as an ISO string, checked against the calendar; null if none."""
    names = "(?i)(" + "|".join(m for ms in MONTH_NAMES[lang] for m in ms) + ")"
    dot = r"\.?" if lang == "de" else ""
    iso = F.regexp_extract(c, r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1)
    dmy = F.regexp_extract(c, rf"(?iu)\b([0-9]{{1,2}}){dot} {names[4:]},? ([0-9]{{4}})\b", 0)
    mdy = F.regexp_extract(c, rf"(?iu)\b{names[4:]} ([0-9]{{1,2}}),? ([0-9]{{4}})\b", 0)

    def build(y, m, d):
        return F.concat_ws("-", y, F.lpad(month_number(m, lang).cast("string"), 2, "0"), F.lpad(d, 2, "0"))

    a = build(F.regexp_extract(dmy, r"([0-9]{4})$", 1), F.regexp_extract(dmy, r"(\p{L}+)", 1), F.regexp_extract(dmy, r"^([0-9]+)", 1))
    b = build(F.regexp_extract(mdy, r"([0-9]{4})$", 1), F.regexp_extract(mdy, r"(\p{L}+)", 1), F.regexp_extract(mdy, r" ([0-9]{1,2})", 1))
    found = F.when(iso != "", iso).when(dmy != "", a).when(mdy != "", b)
    return F.when(F.try_to_date(found, "yyyy-MM-dd").isNotNull(), found)


def century(two_digits: Column) -> Column:
    """Two-digit years over 10 are of the 1900s, others of the 2000s."""
    return F.when(two_digits > 10, two_digits + 1900).otherwise(two_digits + 2000)


def inverse_timestamp(ts: Column) -> Column:
    """Fourteen digits, each replaced by nine minus it, so that text order is newest first."""
    return F.translate(F.date_format(ts, "yyyyMMddHHmmss"), "0123456789", "9876543210")


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    a = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def azimuth(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def degrees_of(d: Column, m: Column, s: Column, hemisphere: Column) -> Column:
    """Degrees, minutes, seconds and a letter as signed degrees."""
    v = d + F.coalesce(m, F.lit(0.0)) / 60 + F.coalesce(s, F.lit(0.0)) / 3600
    return F.when(F.upper(hemisphere).isin("S", "W"), -v).otherwise(v)


def parse_number_old(c: Column, lang: Column) -> Column:
    """A number as the older rules read it: French groups like English, other languages but English and its like swap comma and point."""
    return parse_float(c, F.when(lang == "fr", "en").otherwise(lang))


def value_shape(c: Column) -> Column:
    """The first shape that a text has: integer, grouped integer, float, large number, picture, rank, percent, link, or text."""
    shapes = [
        ("integer", r"^-?[0-9]+$"), ("grouped", r"^-?[0-9]{1,3}(?:,[0-9]{3})+$"), ("float", r"^-?[0-9,]+\.[0-9]+$"), ("large", r"(?i)^[0-9][0-9.,]* (?:thousand|million|billion|trillion|quadrillion)$"),
        ("picture", r"(?i)^(?:\[\[(?:Image|File):)?[\w\- ]+\.(?:jpe?g|png|gif|svg)(?:\|[0-9]+px\]\])?$"), ("rank", r"^[0-9]+(?:<sup>)?(?:st|nd|rd|th)(?:</sup>)?$"), ("percent", r"^[0-9]{1,3}(?:\.[0-9]+)? ?%$"),
        ("link", r"^\[\[[^\]]+\]\]$"),
    ]
    out = F.lit("text")
    for name, pattern in reversed(shapes):
        out = F.when(c.rlike(pattern), name).otherwise(out)
    return out


def template_quantity(c: Column) -> Column:
    """struct(value, unit) of a unit template: convert, height (feet and inches as centimetres), and those named by their unit."""
    #: Templates whose name tells the unit (fixed values).
    named = {"auto in": "inch", "km to mi": "kilometre", "km2 to mi2": "squareKilometre", "pop density km2 to mi2": "inhabitantsPerSquareKilometre", "pop density mi2 to km2": "inhabitantsPerSquareMile"}
    parts = F.transform(F.split(F.regexp_extract(c, r"\{\{([^{}]*)\}\}", 1), r"\|"), lambda p: F.trim(p))
    name = F.lower(F.translate(F.get(parts, F.lit(0)), "_", " "))
    number = lambda p: F.replace(F.regexp_extract(p, r"(-?[0-9][0-9,.]*)", 1), F.lit(","), F.lit("")).try_cast("double")
    first = F.get(parts, F.lit(1))
    key, value = F.regexp_extract(first, r"^([A-Za-z]+) *=", 1), number(F.regexp_replace(first, "^[^=]*=", ""))
    inches = number(F.regexp_extract(F.get(parts, F.lit(2)), r"^in *=(.*)$", 1))
    tall = F.when((key == "ft") & inches.isNotNull(), F.struct((value * 30.48 + inches * 2.54).alias("value"), F.lit("centimetre").alias("unit"))).otherwise(F.struct(value.alias("value"), key.alias("unit")))
    unit = F.try_element_at(F.create_map(*(F.lit(x) for kv in named.items() for x in kv)), name)
    out = F.when(name.isin("convert", "converti"), F.struct(number(first).alias("value"), F.get(parts, F.lit(2)).alias("unit"))).when(name == "height", tall)
    out = out.when(unit.isNotNull(), F.struct(number(first).alias("value"), unit.alias("unit")))
    return F.when(out["value"].isNotNull(), out)


def first_quantity(c: Column, units: dict[str, str]) -> Column:
    """struct(value, unit URI) of a text that is one quantity, or a quantity with another in brackets: the first counts."""
    names = "|".join(sorted((u.replace(".", r"\.") for u in units), key=lambda u: (-len(u), u)))
    pattern = rf"^([0-9][0-9,]*(?:\.[0-9]+)?) ?({names})\s*(?:\(\s*[0-9][0-9,.]*\s*(?:{names})\s*\)\s*)?$"
    value = F.replace(F.regexp_extract(c, pattern, 1), F.lit(","), F.lit("")).try_cast("double")
    unit = F.try_element_at(F.create_map(*(F.lit(x) for kv in units.items() for x in kv)), F.regexp_extract(c, pattern, 2))
    return F.when(value.isNotNull(), F.struct(value.alias("value"), unit.alias("unit")))


def infobox_money(c: Column, names: dict[str, str]) -> Column:
    """struct(value, unit) of an amount with its currency before or after: ``$1.2 million``, ``1,234 EUR``."""
    signs = "|".join(sorted((n.replace("$", r"\$") for n in names), key=lambda n: (-len(n), n)))
    body = r"([0-9][0-9,]*(?:\.[0-9]+)?(?: (?:thousand|million|billion|trillion))?)"
    before, after = rf"(?i)^({signs}) ?{body}$", rf"(?i)^{body} ?({signs})$"
    unit = lambda k: F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), k)
    one = lambda p, v, u: F.when(c.rlike(p), F.struct(parse_scaled(F.regexp_extract(c, p, v), F.lit("en")).alias("value"), unit(F.regexp_extract(c, p, u)).alias("unit")))
    return F.coalesce(one(before, 2, 1), one(after, 1, 2))
