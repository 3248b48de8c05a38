"""Column functions that turn marked-up pages into plain beginnings, places and images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.text import strip_comments, strip_emphasis, truncate_bytes
from factweave.functions.values import degrees_of

#: Bytes of a page in which its beginning is sought.
BEGINNING = 8192
#: What ends a sentence, in several scripts (fixed values).
ENDS = ".!?。．！？｡"


def without_templates(c: Column) -> Column:
    """Balanced double braces go, the innermost first."""
    inner = r"\{\{[^{}]*\}\}"
    rounds = F.size(F.split(c, r"\{\{")) - 1  # no template is nested deeper than there are openings
    return F.when(rounds > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(rounds, F.lit(1))), c, lambda t, _: F.regexp_replace(t, inner, ""))).otherwise(c)


def strip_markup(c: Column, image: str = "image|file", category: str = "category") -> Column:
    """Plain text of marked-up text: references, emphasis, comments, tags, addresses, templates, tables, images, categories, links, indented lines."""
    t = F.regexp_replace(c, r"(?s)<ref(?:\s[^>]*[^/])?>.+?</ref>", "")
    t = strip_comments(strip_emphasis(t))
    t = F.regexp_replace(t, r"(?s)</?[a-z0-9]+.*?>", "")
    t = F.regexp_replace(t, r"(?s)(?<!\[)\[[a-z]+:[^\s\]]* ([^\]]*)\]", "$1")
    t = F.regexp_replace(t, r"(?s)\{\{\{[^{}]*\}\}\}", "")
    t = without_templates(t)
    t = F.regexp_replace(t, r"(?s)\{\|.*?\|\}", "")
    t = F.regexp_replace(t, rf"(?i)\[\[:?(?:{image})\s*:(?:[^\[\]]*\[\[[^\[\]]*\]\])*[^\[\]]*\]\]", "")
    t = F.regexp_replace(t, rf"(?i)\[\[(?:{category}):[^\]]*\]\]", "")
    t = F.regexp_replace(t, r"(?s)\[\[(?:[^|\]]*\|)?(.*?)\]\]", "$1")
    t = F.regexp_replace(t, r"(?m)^:.*$", "")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def first_sentences(c: Column, many: int = 2) -> Column:
    """So many sentences of the first line, or the first line where it has fewer."""
    pattern = rf"^((?:.*?[{ENDS}]+){{{many}}})"
    found = F.regexp_extract(c, pattern, 1)
    return F.when(found != "", found).otherwise(F.trim(F.split_part(c, F.lit("\n"), F.lit(1))))


def page_abstracts(c: Column) -> tuple[Column, Column]:
    """(comment, abstract): the first two sentences, and the text up to the first heading, of a page's beginning."""
    plain = strip_markup(truncate_bytes(c, BEGINNING))
    return first_sentences(plain), F.regexp_replace(F.split_part(plain, F.lit("=="), F.lit(1)), r"\s+$", "")


#: Place templates: degrees, minutes and seconds before letters, or two signed numbers.
PLACE = r"(?i)\{\{\s*(?:coord|coor(?: title| at)?(?: dms| dm| d)?)\s*\|([^{}]*)\}\}"


def place(c: Column, title_only: bool = False) -> Column:
    """struct(lat, lon, type, region, population) of the first place template, null if there is none or it can't be on earth.

    With ``title_only`` the template must be shown in the title.
    """
    bodies = F.regexp_extract_all(c, F.lit(PLACE), F.lit(1))
    if title_only:
        bodies = F.filter(bodies, lambda b: b.rlike(r"(?i)display\s*=\s*(?:[a-z]+,)?(?:t\b|title)"))
    body = F.get(bodies, F.lit(0))
    parts = F.transform(F.split(body, r"\|"), lambda p: F.trim(p))
    ns = F.array_position(F.transform(parts, lambda p: p.rlike("^[NSns]$")), True).cast("int")
    ew = F.array_position(F.transform(parts, lambda p: p.rlike("^[EWew]$")), True).cast("int")
    num = lambda k: F.get(parts, k).try_cast("double")

    def side(start, end):
        n = end - start  # how many numbers stand before the letter
        return degrees_of(num(start), F.when(n > 1, num(start + 1)), F.when(n > 2, num(start + 2)), F.get(parts, end))

    lettered = (ns > 0) & (ew > ns)
    lat = F.when(lettered, side(F.lit(0), ns - 1)).otherwise(num(F.lit(0)))
    lon = F.when(lettered, side(ns, ew - 1)).otherwise(num(F.lit(1)))
    extra = lambda key: F.nullif(F.regexp_extract(body, rf"{key}:([^_|(]+)", 1), F.lit(""))
    people = F.regexp_replace(F.regexp_extract(body, r"type:[a-z]+\(([0-9,]+)\)", 1), ",", "").try_cast("bigint")
    ok = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return F.when(ok, F.struct(lat.alias("lat"), lon.alias("lon"), extra("type").alias("type"), extra("region").alias("region"), people.alias("population")))


#: Endings of image files (fixed values).
IMAGE = r"[^\s|\[\]{}=:][^|\[\]{}=:\n]*\.(?:jpe?g|png|gif|svg)"


def first_image(c: Column, within: int = 2000, width: int = 200) -> Column:
    """struct(file, width) of the image a page shows first: in a template's value, or a link that starts within so many characters."""
    value = F.regexp_extract(c, rf"(?i)=\s*(?:\[\[(?:image|file):)?({IMAGE})", 1)
    link = F.regexp_extract(c, rf"(?i)\[\[(?:image|file):\s*({IMAGE})", 1)
    px = F.regexp_extract(c, rf"(?i)\[\[(?:image|file):\s*{IMAGE}[^\]]*?\|\s*([0-9]+)px", 1).try_cast("int")
    at = lambda x: F.when(x != "", F.position(x, c))
    use_link = (link != "") & ((value == "") | (at(link) < at(value))) & (at(link) <= within)
    file = F.when(use_link, link).when(value != "", value)
    clean = F.translate(F.trim(file), " ", "_")
    return F.when(file.isNotNull(), F.struct(F.concat(F.upper(F.substring(clean, 1, 1)), F.substr(clean, F.lit(2))).alias("file"), F.when(use_link, F.coalesce(px, F.lit(width))).otherwise(F.lit(width)).alias("width")))
