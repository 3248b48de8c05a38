"""Typed readings of property values: quantities with units, coordinates, and the ordered cascade over value shapes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions import units as U
from factweave.functions import values as V
from factweave.functions.text import strip_emphasis, wiki_encode

XSD = "http://www.w3.org/2001/XMLSchema#"
_NUM = r"(-?[0-9][0-9.,]*)"
_MONTH = "(" + "|".join(V.MONTHS) + ")"
#: Endings of picture files (fixed values).
PICTURES = "jpe?g|png|gif|svg"


def _alternation(names) -> str:
    """One of the names, the longest that fits first; sorted into branches by first character, and none is tried where no name begins."""
    branches: dict[str, list[str]] = {}
    for n in sorted(names, key=lambda n: (-len(n), n)):
        branches.setdefault(n[0], []).append(re.escape(n[1:]))
    return f"(?=[{''.join(map(re.escape, branches))}])(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(tails)})" for c, tails in branches.items()) + ")"


def quantity(c: Column, lang: Column, dimension: str | None = None) -> Column:
    """struct(value, unit, standard) of the first ``number unit``; feet and inches together give centimetres.

    Reads ``{{convert|n|unit}}`` and ``{{height|ft=|in=}}`` too. Null if there is none, or if the text is null.
    """
    names = U.labels(dimension)
    plain = rf"{_NUM}(?:\s*(?:\[\[)?|\|)({_alternation(names)})(?!/)(?!\\)(?![\w²³])"
    feet = r"(?i)([0-9]+)\s*(?:ft|feet|foot|′)\.?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:in|inch|inches|″)(?!\w)"
    height = r"(?i)\{\{height\|(?:[^{}]*\|)?ft=([0-9.]+)(?:\|in=([0-9.]+))?"
    unit_of = U.literal_map({k: f"'{v}'" for k, v in names.items()})

    def sized(value, unit):
        return U.let(value, lambda v: U.let(unit, lambda u: F.struct(v.alias("value"), u.alias("unit"), U.to_standard(v, u).alias("standard"))))

    def imperial(pattern):
        g = lambda m, k: F.coalesce(F.regexp_extract(m, pattern, k).try_cast("double"), F.lit(0.0))
        return U.let(F.regexp_extract(c, pattern, 0), lambda m: F.when(m != "", sized(g(m, 1) * 30.48 + g(m, 2) * 2.54, F.lit("centimetre"))))

    found = U.let(F.regexp_extract(c, plain, 0), lambda m: F.when(m != "", sized(V.parse_float(m, lang), F.try_element_at(unit_of, F.regexp_extract(m, plain, 2)))))
    return F.coalesce(*([imperial(feet), imperial(height)] if dimension in (None, "Length") else []), found)


def money(c: Column, lang: Column, more: dict[str, str] | None = None) -> Column:
    """struct(value, unit): a currency's sign or name before or after a number with an optional scale word."""
    names = {label: unit for unit, ls in (U.CURRENCIES | (more or {})).items() for label in ls.split("|")}
    sign, tail = _alternation(names), rf"{_NUM}(?:\s*(?:\[\[)?(?i:thousand|million|billion|trillion|quadrillion))?"
    before, after = rf"({sign})\s?{tail}", rf"{tail}(?:\]\])?\s*({sign})(?!\w)"
    unit_of = U.literal_map({k: f"'{v}'" for k, v in names.items()})
    read = lambda p, k: U.let(F.regexp_extract(c, p, 0), lambda m: F.when(m != "", F.struct(V.parse_scaled(m, lang).alias("value"), F.try_element_at(unit_of, F.regexp_extract(m, p, k)).alias("unit"))))
    return F.coalesce(read(before, 1), read(after, 2))


def coordinates(c: Column) -> Column:
    """struct(lat, lon) of the first coordinate template (degrees, minutes, seconds and letters, or signed decimals); null out of range."""
    part = r"\|\s*([0-9.]+)\s*(?:\|\s*([0-9.]+)\s*)?(?:\|\s*([0-9.]+)\s*)?\|\s*"
    dms = rf"(?i)\{{\{{coor[^|{{}}]*{part}([NS])\s*{part}([EW])"
    signed = r"(?i)\{\{coor[^|{}]*\|\s*(-?[0-9.]+)\s*\|\s*(-?[0-9.]+)\s*[|}]"
    g = lambda p, k: F.regexp_extract(c, p, k).try_cast("double")
    lat = F.when(c.rlike(dms), V.degrees_of(g(dms, 1), g(dms, 2), g(dms, 3), F.regexp_extract(c, dms, 4))).otherwise(g(signed, 1))
    lon = F.when(c.rlike(dms), V.degrees_of(g(dms, 5), g(dms, 6), g(dms, 7), F.regexp_extract(c, dms, 8))).otherwise(g(signed, 2))
    return F.when((F.abs(lat) <= 90) & (F.abs(lon) <= 180), F.struct(lat.alias("lat"), lon.alias("lon")))


def plain_text(c: Column) -> Column:
    """Links to their labels, emphasis, tags, list marks and outer blanks away."""
    c = F.regexp_replace(c, r"\[\[(?:[^\]|]*\|)?([^\]|]*)\]\]", "$1")
    c = F.regexp_replace(c, r"\[(?:https?|ftp)://\S+\s*([^\]]*)\]", "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(strip_emphasis(c), r"<[^>]*>", " "), r"(?m)^[*#:;]+\s*", ""))


def typed_values(c: Column, lang: Column, base: str) -> Column:
    """array of struct(o, o_kind, datatype): the first shape that fits decides; links and addresses may give several.

    Order: blank node, integer, grouped integer, decimal, picture, month of a year, date, year, rank, scaled number, money, percent,
    quantity, one link, link list, external addresses, number with a reference, text. Empty and null texts give none.
    """
    return U.let(F.trim(c, F.lit(" \t\r\n")), lambda t: _cascade(t, lang, base))


_VALUES = "array<struct<o:string,o_kind:string,datatype:string>>"


def _cascade(t: Column, lang: Column, base: str) -> Column:
    def one(o, kind="literal", datatype=None):
        d = datatype if isinstance(datatype, Column) else F.lit(datatype).cast("string")
        return F.array(F.struct(o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), d.alias("datatype")))

    none = F.array().cast(_VALUES)
    uri = lambda target: F.concat(F.lit(base), wiki_encode(target))
    link = r"\[\[([^\]|:]+)(?:\|[^\]]*)?\]\]"
    many = lambda found: F.transform(F.array_distinct(found), lambda x: F.struct(x.alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("datatype")))
    month_year = rf"(?i)^(?:\[\[)?{_MONTH}(?:\]\])?,?\s+(?:\[\[)?([0-9]{{4}})(?:\]\])?$"
    month = F.lpad(V.month_number(F.regexp_extract(t, month_year, 1)).cast("string"), 2, "0")
    scaled = r"(?i)^[0-9][0-9.,]*\s*(?:\[\[)?(?:thousand|million|billion|trillion|quadrillion)(?:\]\])?$"
    referenced = r"^(-?[0-9][0-9,]*(?:\.[0-9]+)?)\s*(?:\(|<ref|\[http)"
    number = lambda d: F.when(d == F.floor(d), F.floor(d).cast("string")).otherwise(d.cast("string"))
    shapes = (
        F.when(t.isNull() | (t == ""), none)
        .when(t.rlike(r"^;bn[0-9]+;$"), one(F.replace(t, F.lit(";"), F.lit("")), "bnode"))
        .when(t.rlike(r"^-?[0-9]+$"), one(t, datatype=XSD + "integer"))
        .when(t.rlike(r"^-?[0-9]{1,3}(?:,[0-9]{3})+$"), one(F.replace(t, F.lit(","), F.lit("")), datatype=XSD + "integer"))
        .when(t.rlike(r"^-?[0-9]*\.[0-9]+$"), one(t, datatype=XSD + "decimal"))
        .when(t.rlike(rf"(?i)^[^\[\]{{}}|<>\n]+\.(?:{PICTURES})$") & ~t.contains("://"), one(uri(F.concat(F.lit("File:"), t)), "uri"))
        .when(t.rlike(month_year), one(F.concat_ws("-", F.regexp_extract(t, month_year, 2), month), datatype=XSD + "gYearMonth"))
    )
    # cheap tests of what a reading needs come first: most values fail them, and a cast of no digits is an exception caught in Spark
    year = t.rlike(r"[0-9]{4}|[0-9](?:\[\[|\]\])+[0-9]")
    dates = F.when(year, U.let(V.parse_date(F.regexp_replace(t, r"\[\[|\]\]", "")), lambda d: F.when(d.isNotNull(), one(d, datatype=XSD + "date"))))
    ranks = (
        F.when(t.rlike(r"^\[\[[0-9]{4}\]\]$"), one(F.regexp_extract(t, "([0-9]{4})", 1), datatype=XSD + "gYear"))
        .when(t.rlike(r"^[0-9]+(?:<sup>)?(?:st|nd|rd|th)(?:</sup>)?$"), one(F.regexp_extract(t, "^([0-9]+)", 1), datatype="rank"))
        .when(t.rlike(scaled), U.let(V.parse_scaled(t, lang), lambda v: one(number(v), datatype=XSD + "integer")))
    )
    coins = U.let(money(t, lang), lambda m: F.when(m.isNotNull(), one(number(m["value"]), datatype=m["unit"])))
    percents = F.when(t.rlike("[0-9] ?%"), U.let(V.parse_percent(t), lambda v: F.when(v.isNotNull(), one(number(v), datatype="percent"))))
    sizes = F.when(t.rlike(r"^-?[0-9]"), U.let(quantity(t, lang), lambda q: F.when(q.isNotNull(), one(number(q["value"]), datatype=q["unit"]))))
    links = (
        F.when(t.rlike(rf"^{link}$"), one(uri(F.regexp_extract(t, link, 1)), "uri"))
        .when(t.rlike(link), many(F.transform(F.regexp_extract_all(t, F.lit(link), F.lit(1)), uri)))
        .when(t.rlike(r"(?:https?|ftp)://"), many(F.regexp_extract_all(t, F.lit(r"((?:https?|ftp)://[^\s\]|<>\"]+)"), F.lit(1))))
        .when(t.rlike(referenced), U.let(F.replace(F.regexp_extract(t, referenced, 1), F.lit(","), F.lit("")), lambda n: one(n, datatype=F.when(n.contains("."), XSD + "decimal").otherwise(XSD + "integer"))))
    )
    texts = U.let(plain_text(t), lambda x: F.when(x != "", one(x)).otherwise(none))
    numbers = F.when(t.rlike("[0-9]"), F.coalesce(dates, ranks, coins, percents, sizes))  # none of these reads a text without digits
    return F.coalesce(shapes, numbers, links, texts)
