"""Column functions that read dates from templates, phrases and parts, and tell what kind of date a text is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.values import MONTH_NAMES, month_number, parse_date

#: Date templates, lower-cased without blanks: order of their numbers, and which of two dates counts (fixed values).
DATE_TEMPLATES = {
    "deathdate": ("ymd", "first"), "deathdateandage": ("ymd", "first"), "dda": ("ymd", "first"), "birthdate": ("ymd", "first"), "startdate": ("ymd", "first"),
    "birthdateandage": ("ymd", "second"), "birthdateandage2": ("ymd", "second"), "bda": ("ymd", "second"),
    "birthdeathage": ("ymd", "flag"),
    "datededécès": ("dmy", "first"), "datededécèsetâge": ("dmy", "first"),
    "datedenaissance": ("dmy", "second"),
    "nda": ("dmy", "flag"), "naissancedécèsâge": ("dmy", "flag"),
}
#: Era marks of years before the first (fixed values).
BEFORE = ["BC", "BCE", "B.C.", "v. Chr.", "av. J.-C.", "a. C."]


def checked(y: Column, m: Column, d: Column) -> Column:
    """``yyyy-MM-dd`` if the calendar has that day, else null."""
    text = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text)


def template_date(c: Column) -> Column:
    """The date of a birth, death or start template: of two dates the one that its kind names.

    Where a flag decides, a leading ``B`` or ``N`` takes the first date, its absence the second.
    """
    plain = F.regexp_replace(F.translate(c, " ", ""), r"(?i)\|[dm]f=[a-z]+", "")
    parts = F.split(F.regexp_extract(plain, r"^\{\{([^{}]*)\}\}", 1), r"\|")
    name = F.lower(F.get(parts, F.lit(0)))
    given = F.filter(F.slice(parts, 2, 20), lambda p: p.rlike(r"^[0-9]{1,4}$"))
    flagged = F.upper(F.get(parts, F.lit(1))).isin("B", "N")
    kind = {k: [n for n, v in DATE_TEMPLATES.items() if v[1] == k] for k in ("first", "second", "flag")}
    at = F.when(name.isin(*kind["first"]), 0).when(name.isin(*kind["second"]), F.when(F.size(given) >= 6, 3).otherwise(0)).when(name.isin(*kind["flag"]), F.when(flagged, 0).otherwise(3))
    a, b, d = (F.get(given, at + k) for k in range(3))
    dmy = name.isin(*[n for n, v in DATE_TEMPLATES.items() if v[0] == "dmy"])
    return F.when(dmy, checked(d, b, a)).otherwise(checked(a, b, d))


def parse_month_year(c: Column, lang: str = "en") -> Column:
    """``Month yyyy`` (a comma or link marks may stand between) as ``yyyy-MM``."""
    names = "|".join(m for ms in MONTH_NAMES[lang] for m in ms)
    pattern = rf"(?iu)\b({names})[\],\[]* ?(?:de |of )?[\[]*([0-9]{{4}})\b"
    month = month_number(F.regexp_extract(c, pattern, 1), lang)
    return F.when(month.isNotNull(), F.concat(F.regexp_extract(c, pattern, 2), F.lit("-"), F.lpad(month.cast("string"), 2, "0")))


def parse_year(c: Column) -> Column:
    """A year of four digits, else three, two or one, as four digits; with a sign where an era mark before the first follows."""
    eras = "|".join(e.replace(".", r"\.") for e in BEFORE)
    digits = F.coalesce(*(F.nullif(F.regexp_extract(c, rf"(?<![0-9])([0-9]{{{n}}})(?![0-9])", 1), F.lit("")) for n in (4, 3, 2, 1)))
    before = c.rlike(rf"[0-9]\]{{0,2}} ?(?:{eras})(?![A-Za-z])")
    return F.when(digits.isNotNull(), F.concat(F.when(before, "-").otherwise(""), F.lpad(digits, 4, "0")))


def combine_date(day: Column, month: Column, year: Column, lang: str = "en") -> Column:
    """The parts of a date in three properties: a day, a month of a year, a day of any year (``--MM-dd``) or a year; null if none fits."""
    number = F.coalesce(month.try_cast("int"), month_number(F.trim(month), lang))
    m = F.lpad(F.when(number.between(1, 12), number).cast("string"), 2, "0")
    d = F.regexp_extract(day, "([0-9]{1,2})", 1)
    y = F.regexp_extract(year, "([0-9]{4})", 1)
    has = lambda x: F.coalesce(x != "", F.lit(False))
    any_year = F.when(checked(F.lit("2000"), m, d).isNotNull(), F.concat(F.lit("--"), m, F.lit("-"), F.lpad(d, 2, "0")))
    return F.when(has(y) & has(m) & has(d), checked(y, m, d)).when(has(y) & has(m), F.concat(y, F.lit("-"), m)).when(has(m) & has(d), any_year).when(has(y) & ~has(d), y)


def german_date(c: Column) -> Column:
    """``12. März 1950``, else ``März 1950``, else a year."""
    return F.coalesce(parse_date(c, "de"), parse_month_year(c, "de"), parse_year(c))


def korean_date(c: Column) -> Column:
    """Year, month and day marks; birth and death templates (the last numbers of a death template are the birth); years before the first."""
    text = F.regexp_replace(c, r"[\[\]]", "")
    get = lambda pattern, *at: [F.regexp_extract(text, pattern, k) for k in at]
    pad = lambda y, *rest: F.concat_ws("-", F.lpad(y, 4, "0"), *(F.lpad(x, 2, "0") for x in rest))
    day, month, year = r"^([0-9]{1,4})년 ([0-9]{1,2})월 ([0-9]{1,2})일$", r"^([0-9]{1,4})년 ([0-9]{1,2})월$", r"^([0-9]{1,4})년$"
    before, person = r"^기원전 ([0-9]{1,4})년기?$", r"^(?:출생|사망)[^|]*\|([0-9]{2,4})\|([0-9]{1,2})\|([0-9]{1,2})(?:\|[0-9]+\|[0-9]+\|[0-9]+)?\|?$"
    out = F.when(text.rlike(day), pad(*get(day, 1, 2, 3))).when(text.rlike(month), pad(*get(month, 1, 2))).when(text.rlike(year), pad(*get(year, 1)))
    return out.when(text.rlike(before), F.concat(F.lit("-"), pad(*get(before, 1)))).when(text.rlike(person), pad(*get(person, 1, 2, 3)))


def record_time(c: Column) -> Column:
    """The time stamp of an update record, to the second or to the day."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def date_type(c: Column, lang: str = "en") -> Column:
    """The datatype of a property's text: a month of a year, a day, a year, or null."""
    names = "|".join(m for ms in MONTH_NAMES[lang] for m in ms)
    whole = F.trim(F.regexp_replace(c, r"[\[\]]", ""))
    return F.when(whole.rlike(rf"(?iu)^(?:{names}),? [0-9]{{4}}$"), "gYearMonth").when(parse_date(whole, lang).isNotNull(), "date").when(whole.rlike(r"^[0-9]{4}$"), "gYear")
