"""Column functions on titles, URIs and marked-up text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def lower_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def clean_space(c: Column) -> Column:
    """Runs of spaces and underscores become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, "[ _]+", " "))


def wiki_encode(c: Column) -> Column:
    """Title to its URI form: clean, first letter upper, underscores, percent escapes but for ``/`` and ``:``."""
    t = F.url_encode(F.translate(upper_first(clean_space(c)), " ", "_"))
    return F.replace(F.replace(t, F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":"))


def wiki_decode(c: Column) -> Column:
    return upper_first(clean_space(F.try_url_decode(c)))


#: Namespace names of the wiki software and their numbers (fixed values).
NAMESPACES = {
    "media": -2, "special": -1, "talk": 1, "user": 2, "user talk": 3, "project": 4, "project talk": 5, "image": 6, "file": 6, "image talk": 7, "file talk": 7,
    "mediawiki": 8, "mediawiki talk": 9, "template": 10, "template talk": 11, "help": 12, "help talk": 13, "category": 14, "category talk": 15,
}


def namespace_of(title: Column) -> Column:
    """Number of the prefix before the first colon; 0 where there is none that is known."""
    prefix = F.lower(clean_space(F.regexp_extract(title, "^([^:]*):", 1)))
    out = F.lit(0)
    for name, number in NAMESPACES.items():
        out = F.when(prefix == name, F.lit(number)).otherwise(out)
    return out


def title_text(title: Column) -> Column:
    """The title without a known namespace prefix, cleaned; null if it has a ``#`` or nothing is left."""
    rest = F.when(namespace_of(title) != 0, F.regexp_replace(title, "^[^:]*:", "")).otherwise(title)
    text = upper_first(clean_space(F.coalesce(F.try_url_decode(rest), rest)))
    return F.when(~title.contains("#") & (text != ""), text)


def strip_emphasis(c: Column) -> Column:
    """Bold-italic, bold and italic marks go, the longest first."""
    for marks in ("'''''", "'''", "''"):
        c = F.replace(c, F.lit(marks), F.lit(""))
    return c


def strip_comments(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->", "")


def strip_tags(c: Column) -> Column:
    """Scripts and styles with their content, then all other tags."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), r"<[^>]*>", " ")


def unescape_basic(c: Column) -> Column:
    """The five named entities of XML and the hard space, ``&amp;`` last."""
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def link_target(c: Column) -> Column:
    """Of ``target|label`` the target."""
    return F.trim(F.split_part(c, F.lit("|"), F.lit(1)))


def link_label(c: Column) -> Column:
    return F.trim(F.element_at(F.split(c, r"\|"), -1))


def camel_case(c: Column) -> Column:
    """Words joined, each but the first with an upper first letter."""
    words = F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w, i: F.when(i == 0, w).otherwise(F.initcap(w))), "")


def fold_digit(c: Column) -> Column:
    """One closing digit after a letter goes; more digits, or digits alone, stay."""
    return F.regexp_replace(c, r"(?<=[^0-9_])[0-9]$", "")


def label_of_camel(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "([A-Z])", " $1"))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; two empty strings are equal."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(n == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / n)


def image_url(name: Column, base: str, width: int | None = None) -> Column:
    """Path of a file by the first digits of its name's MD5; a thumbnail of a width, SVG as PNG."""
    file = F.translate(name, " ", "_")
    h = F.md5(file.cast("binary"))
    path = F.concat(F.substring(h, 1, 1), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), file)
    if width is None:
        return F.concat(F.lit(base + "/"), path)
    end = F.when(F.lower(file).endswith(".svg"), ".png").otherwise("")
    return F.concat(F.lit(f"{base}/thumb/"), path, F.lit(f"/{width}px-"), file, end)


def truncate_bytes(c: Column, most: int) -> Column:
    """The longest prefix of whole characters within so many UTF-8 bytes."""
    cut = F.make_valid_utf8(F.substring(c.cast("binary"), 1, most).cast("string"))
    return F.when(F.octet_length(c) <= most, c).otherwise(F.regexp_replace(cut, "�+$", ""))


def short_abstract(c: Column, most: int = 500) -> Column:
    """Whole sentences while they fit into so many bytes."""
    sentences = F.split(c, r"(?<=[.!?]) +")
    step = lambda acc, s: F.when(
        acc["open"] & (F.octet_length(acc["text"]) + F.octet_length(s) + 1 <= most),
        F.struct(F.when(acc["text"] == "", s).otherwise(F.concat(acc["text"], F.lit(" "), s)).alias("text"), F.lit(True).alias("open")),
    ).otherwise(F.struct(acc["text"].alias("text"), F.lit(False).alias("open")))
    return F.aggregate(sentences, F.struct(F.lit("").alias("text"), F.lit(True).alias("open")), step, lambda a: a["text"])


_SHORT = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]


def ntriples_escape(c: Column) -> Column:
    """Backslash, quote and line ends as escapes; characters beyond ASCII as ``\\uXXXX`` or ``\\UXXXXXXXX``."""
    for char, escape in _SHORT:
        c = F.replace(c, F.lit(char), F.lit(escape))
    code = lambda x: F.conv(F.hex(F.encode(x, "UTF-32")), 16, 16)
    one = lambda x: F.when(x.rlike(r"^[\x20-\x7e]$"), x).when(F.length(code(x)) > 4, F.concat(F.lit("\\U"), F.lpad(code(x), 8, "0"))).otherwise(F.concat(F.lit("\\u"), F.lpad(code(x), 4, "0")))
    return F.when(c.rlike(r"^[\x20-\x7e]*$"), c).otherwise(F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), one), ""))


def valid_uri(c: Column, most: int = 255) -> Column:
    """Scheme, authority, no blanks, quotes or angle brackets, and a bounded length."""
    return F.coalesce(c.rlike(r"^(?:https?|ftp)://[^\s/?#<>\"{}|\\^`]+[^\s<>\"{}|\\^`]*$") & (F.octet_length(c) <= most), F.lit(False))


def label_of_title(c: Column, lang_template: str = "Template", lang_category: str = "Category") -> Column:
    """A page's label: no template or category prefix, blanks for underscores, brackets and ampersands readable."""
    out = F.regexp_replace(F.translate(c, "_", " "), f"^(?:{lang_template}|{lang_category}):", "")
    for code, char in (("%28", "("), ("%29", ")"), ("%26", "&")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def predicate_name(c: Column, derivates: dict[str, str], percent: bool = True) -> Column:
    """A predicate under its preferred name, fit for element names: percent signs spelt out, or a closing escape marked by ``_``."""
    name = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in derivates.items() for x in kv)), c), c) if derivates else c
    return F.replace(name, F.lit("%"), F.lit("_percent_")) if percent else F.when(name.rlike("%[A-F0-9]{2}$"), F.concat(name, F.lit("_"))).otherwise(name)


def isbn(c: Column) -> Column:
    """The ten or thirteen signs of a book number whose check digit is right, without hyphens; null otherwise."""
    x = F.upper(F.regexp_replace(F.regexp_extract(c, r"((?:97[89][- ]?)?(?:[0-9][- ]?){9}[0-9Xx])(?![0-9])", 1), "[- ]", ""))
    digits = F.transform(F.filter(F.split(x, ""), lambda v: v != ""), lambda v: F.when(v == "X", 10).otherwise(v.try_cast("int")))
    ten = F.aggregate(F.transform(digits, lambda v, i: v * (10 - i)), F.lit(0), lambda a, v: a + v) % 11 == 0
    thirteen = F.aggregate(F.transform(digits, lambda v, i: v * F.when(i % 2 == 0, 1).otherwise(3)), F.lit(0), lambda a, v: a + v) % 10 == 0
    return F.when(((F.length(x) == 10) & ten) | ((F.length(x) == 13) & thirteen), x)


def list_items(c: Column) -> Column:
    """The parts of a list of values: between semicolons or blank-node marks (``;bn1;``), of two signs or more."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, r";bn[0-9]+;", ";"), ";"), lambda x: F.trim(F.translate(x, "\n", ""))), lambda x: F.length(x) > 1)


#: Signs of short ids (fixed values).
ID_SIGNS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def short_id(n: Column, length: int = 15) -> Column:
    """A number as an id of so many base-62 signs, in the order of the numbers; ``F.monotonically_increasing_id()`` gives unique ones without a shuffle."""
    digit = lambda v: F.substring(F.lit(ID_SIGNS), (v + 1).cast("int"), F.lit(1))
    start = F.struct(n.cast("bigint").alias("n"), F.lit("").alias("s"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(length)), start, lambda a, i: F.struct(F.floor((a["n"] - F.pmod(a["n"], F.lit(62))) / F.lit(62)).cast("bigint").alias("n"), F.concat(digit(F.pmod(a["n"], F.lit(62))), a["s"]).alias("s")), lambda a: a["s"])


def clean_by(c: Column, patterns: list[tuple[str, str]]) -> Column:
    """Replacements of regular expressions, one after the other."""
    for pattern, by in patterns:
        c = F.regexp_replace(c, pattern, by)
    return c


def english_twin(source: Column) -> Column:
    """The title of a page's English twin, from its language link; null if it has none."""
    return F.nullif(F.trim(F.regexp_extract(source, r"\[\[en:(.*?)\]\]", 1)), F.lit(""))
