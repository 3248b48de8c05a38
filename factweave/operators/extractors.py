"""Page extractors over marked-up sources: pages (page_id, title, ns, source) -> page_id, s, p, o, o_kind, datatype.

All are column expressions; pages with null sources, and pages that lack what an extractor looks for, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions.text import clean_space, wiki_encode
from factweave.functions.values import parse_date

#: Keys under which templates name the official site (fixed values).
HOMEPAGE_KEYS = ("website", "homepage", "webpräsenz", "web", "site", "siteweb", "site web")
#: Words for official, and headings of sections of external links, by language (fixed values).
OFFICIAL = {"en": "official", "de": "offizielle", "fr": "officiel"}
LINK_SECTIONS = {"en": "External links?", "de": "Weblinks?", "fr": "(?:Lien externe|Liens externes|Liens et documents externes)"}
#: Template and key names of person records by language (fixed values).
PERSONDATA = {
    "en": ("Persondata", "NAME", "SHORT DESCRIPTION", "DATE OF BIRTH", "PLACE OF BIRTH", "DATE OF DEATH", "PLACE OF DEATH"),
    "de": ("Personendaten", "NAME", "KURZBESCHREIBUNG", "GEBURTSDATUM", "GEBURTSORT", "STERBEDATUM", "STERBEORT"),
}


def _page(base: str) -> Column:
    return F.concat(F.lit(base), wiki_encode(F.col("title")))


def _facts(pages: DataFrame, subject: Column, found: Column) -> DataFrame:
    """found: array of struct(p, o, o_kind, datatype); those without an object go."""
    return pages.select("page_id", subject.alias("s"), F.explode(found).alias("f")).select("page_id", "s", "f.*").where("o is not null and o != ''")


def _fact(p: str, o: Column, kind: str = "literal", datatype: str | None = None) -> Column:
    return F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"))


def _targets(pattern: str) -> Column:
    return F.regexp_extract_all("source", F.lit(pattern), F.lit(1))


def article_categories(pages: DataFrame, base: str, category: str = "Category") -> DataFrame:
    """Categories of pages that are none themselves."""
    found = F.transform(F.array_distinct(_targets(rf"\[\[{category}:([^\]|]+)")), lambda c: _fact("subject", F.concat(F.lit(f"{base}{category}:"), wiki_encode(c)), "uri"))
    return _facts(pages.where("ns != 14"), _page(base), found)


def skos_categories(pages: DataFrame, base: str, category: str = "Category") -> DataFrame:
    """Category pages: label, type and each broader category; a link ends at its first closing brackets."""
    broader = F.transform(F.array_distinct(_targets(rf"\[\[{category}:([^\]|]+)")), lambda c: _fact("broader", F.concat(F.lit(f"{base}{category}:"), wiki_encode(c)), "uri"))
    label = F.regexp_replace(clean_space(F.col("title")), f"^{category}:", "")
    return _facts(pages.where("ns = 14"), _page(base), F.concat(F.array(_fact("prefLabel", label), _fact("type", F.lit("Concept"), "uri")), F.coalesce(broader, F.array())))


def disambiguations(pages: DataFrame, base: str, marks: tuple[str, ...] = ("{{disambig", "{{dab}}")) -> DataFrame:
    """Links of disambiguation pages that hold the page's title without its addition in brackets."""
    is_one = F.lit(False)
    for m in marks:
        is_one = is_one | F.lower("source").contains(m.lower())
    name = F.lower(F.trim(F.regexp_replace(clean_space(F.col("title")), r"\([^)]*\)\s*$", "")))
    found = F.filter(F.array_distinct(F.transform(_targets(r"\[\[([^\]|:]+)"), lambda x: clean_space(x))), lambda x: F.lower(x).contains(name))
    return _facts(pages.where(is_one), _page(base), F.transform(found, lambda x: _fact("disambiguates", F.concat(F.lit(base), wiki_encode(x)), "uri")))


def homepage(pages: DataFrame, base: str, lang: str = "en") -> DataFrame:
    """The official site: of a template's known key, else the first link called official among the external links."""
    keys = "|".join(k.replace(" ", r"\s") for k in HOMEPAGE_KEYS)
    named = F.regexp_extract("source", rf"(?i)\|\s*(?:{keys})\s*=\s*\[?(https?://[^\s\]|}}<]+)", 1)
    section = F.regexp_extract("source", rf"(?is)==+\s*{LINK_SECTIONS[lang]}\s*==+(.*?)(?:\n==|\z)", 1)
    official = F.regexp_extract(section, rf"(?i)\[(https?://[^\s\]]+)\s[^\]]*{OFFICIAL[lang]}", 1)
    return _facts(pages, _page(base), F.array(_fact("homepage", F.coalesce(F.nullif(named, F.lit("")), F.nullif(official, F.lit(""))), "uri")))


def persondata(pages: DataFrame, base: str, lang: str = "en") -> DataFrame:
    """Name, its two parts if one comma divides it, description, dates and places of birth and death, and the type."""
    template, *keys = PERSONDATA[lang]
    value = lambda k: F.nullif(F.trim(F.regexp_extract("record", rf"(?i)\|\s*{k}\s*=((?:\[\[[^\]]*\]\]|[^|}}])*)", 1), F.lit(" \t\r\n")), F.lit(""))
    name, description, born, birthplace, died, deathplace = (value(k) for k in keys)
    parts = F.split(name, ",")
    half = lambda k: F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(k))))
    place = lambda c: F.nullif(F.regexp_extract(c, r"\[\[([^\]|]+)", 1), F.lit(""))
    uri = lambda c: F.when(place(c).isNotNull(), F.concat(F.lit(base), wiki_encode(place(c))))
    date = lambda c: parse_date(F.regexp_replace(c, r"\[\[|\]\]", ""), lang)
    facts = F.array(
        _fact("name", name), _fact("givenName", half(1)), _fact("surname", half(0)), _fact("description", description), _fact("birth", date(born), datatype="date"), _fact("birthPlace", uri(birthplace), "uri"),
        _fact("death", date(died), datatype="date"), _fact("deathPlace", uri(deathplace), "uri"), _fact("type", F.lit("Person"), "uri"),
    )
    record = F.regexp_extract("source", rf"(?is)\{{\{{\s*{template}\s*\|((?:\[\[[^\]]*\]\]|[^{{}}])*)\}}\}}", 0)
    return _facts(pages.withColumn("record", record).where("record != ''"), _page(base), facts)


def authority_ids(pages: DataFrame, base: str) -> DataFrame:
    """Numbers of the authority file: of ``Normdaten``, ``PND`` (its own, then the name's) and ``PNDfehlt`` templates.

    Positional numbers have nine characters at least.
    """
    normal = F.regexp_extract("source", r"(?i)\{\{Normdaten[^{}]*\|\s*PND\s*=\s*([0-9X]+)", 1)
    own = F.regexp_extract("source", r"\{\{\s*PND\s*\|\s*([0-9X]{9,})", 1)
    others = r"\{\{\s*PND\s*\|[^|{}]*\|\s*([0-9X]{9,})"
    missing = F.regexp_extract("source", r"\{\{\s*PNDfehlt\s*\|\s*([0-9X]{9,})", 1)
    return _facts(pages, _page(base), F.array(_fact("individualisedPnd", normal), _fact("individualisedPnd", own), _fact("nonIndividualisedPnd", F.regexp_extract("source", others, 1)), _fact("nonIndividualisedPnd", missing)))


def meta_information(records: DataFrame, base: str, host: str) -> DataFrame:
    """records (page_id, title, oai_id, revision, modified): when changed, source id, links to the revision and to its edit form."""
    index = F.concat(F.lit(f"{host}/w/index.php?title="), F.url_encode(F.translate("title", " ", "_")))
    facts = F.array(
        _fact("modified", F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss'Z'"), datatype="dateTime"), _fact("oaiIdentifier", F.col("oai_id").cast("string"), datatype="integer"),
        _fact("revision", F.concat(index, F.lit("&oldid="), F.col("revision").cast("string")), "uri"), _fact("editLink", F.concat(index, F.lit("&action=edit")), "uri"),
    )
    return _facts(records, _page(base), facts)


def marked_pages(pages: DataFrame, base: str, mark: str, p: str, o: str) -> DataFrame:
    """One stated fact for each page that holds a mark, such as the header template of a kind of infobox."""
    return _facts(pages.where(F.contains("source", F.lit(mark))), _page(base), F.array(_fact(p, F.lit(o))))


def semantic_links(pages: DataFrame, base: str) -> DataFrame:
    """``[[p::o]]`` as links and ``[[p:=v]]`` as literals."""
    pairs = lambda mark: F.arrays_zip(_targets(rf"\[\[([^\]|:]+){mark}[^\]]*\]\]").alias("p"), F.regexp_extract_all("source", F.lit(rf"\[\[[^\]|:]+{mark}([^\]|]*)"), F.lit(1)).alias("o"))
    row = lambda x, o, kind: F.struct(clean_space(x["p"]).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(None).cast("string").alias("datatype"))
    links = F.transform(pairs("::"), lambda x: row(x, F.concat(F.lit(base), wiki_encode(x["o"])), "uri"))
    return _facts(pages, _page(base), F.concat(links, F.transform(pairs(":="), lambda x: row(x, F.trim(x["o"]), "literal"))))


def _statement(s: Column, p: str, o: Column, kind: str = "uri", datatype: str | None = None) -> Column:
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"))


def _statements(rows: DataFrame, *facts: Column) -> DataFrame:
    """page_id and the facts whose object is there."""
    each = rows.select("page_id", F.explode(F.array(*facts)).alias("f"))
    return each.select("page_id", "f.*").where("o is not null")


def twins(langlinks: DataFrame, pages: DataFrame, base: str, domains: dict[str, str]) -> DataFrame:
    """Facts ``sameAs`` for the twins (page_id, lang, title) of pages, in the languages whose resource bases are stated."""
    other = F.try_element_at(F.create_map(*(F.lit(x) for kv in domains.items() for x in kv)), F.col("lang"))
    rows = pages.select("page_id", F.concat(F.lit(base), wiki_encode(F.col("title"))).alias("s")).join(langlinks.select("page_id", "lang", F.col("title").alias("twin")), "page_id")
    return _statements(rows, _statement(F.col("s"), "sameAs", F.concat(other, wiki_encode(F.col("twin")))))


def image_facts(pages: DataFrame, nonfree: DataFrame, base: str, files: str, wiki: str) -> DataFrame:
    """Five facts of a page's first image: depiction, its thumbnail (also of the page), and rights of both; images in ``nonfree`` (file) give none."""
    from factweave.functions.markup import first_image
    from factweave.functions.text import image_url

    rows = pages.select("page_id", F.concat(F.lit(base), wiki_encode(F.col("title"))).alias("s"), first_image(F.col("source")).alias("i")).where("i is not null")
    rows = rows.select("page_id", "s", F.col("i.file").alias("file"), F.col("i.width").alias("width")).join(nonfree.select("file").distinct(), "file", "left_anti")
    full = image_url(F.col("file"), files)
    small = F.concat(image_url(F.col("file"), files + "/thumb"), F.lit("/"), F.col("width").cast("string"), F.lit("px-"), F.col("file"), F.when(F.lower("file").endswith(".svg"), ".png").otherwise(""))
    rights = F.concat(F.lit(wiki + "/wiki/Image:"), F.url_encode("file"))
    return _statements(rows, _statement(F.col("s"), "depiction", full), _statement(full, "thumbnail", small), _statement(F.col("s"), "pageThumbnail", small), _statement(small, "rights", rights), _statement(full, "rights", rights))


def place_facts(pages: DataFrame, base: str, title_only: bool = False) -> DataFrame:
    """Facts of a page's first place template: lat, long, point, feature class, population."""
    from factweave.functions.markup import place

    rows = pages.select("page_id", F.concat(F.lit(base), wiki_encode(F.col("title"))).alias("s"), place(F.col("source"), title_only).alias("c")).where("c is not null")
    s, double = F.col("s"), "double"
    point = F.concat_ws(" ", F.col("c.lat").cast("string"), F.col("c.lon").cast("string"))
    return _statements(rows, _statement(s, "lat", F.col("c.lat"), "literal", double), _statement(s, "long", F.col("c.lon"), "literal", double), _statement(s, "point", point, "literal"), _statement(s, "featureClass", F.regexp_extract("c.type", "^([a-z]+)", 1), "literal"), _statement(s, "population", F.col("c.population"), "literal", "integer"))


def abstract_facts(pages: DataFrame, base: str) -> DataFrame:
    """Facts of a page's beginning: comment (two sentences) and abstract (up to the first heading); empty ones are none."""
    from factweave.functions.markup import page_abstracts

    comment, abstract = page_abstracts(F.col("source"))
    rows = pages.select("page_id", F.concat(F.lit(base), wiki_encode(F.col("title"))).alias("s"), F.nullif(comment, F.lit("")).alias("c"), F.nullif(abstract, F.lit("")).alias("a"))
    return _statements(rows, _statement(F.col("s"), "comment", F.col("c"), "literal"), _statement(F.col("s"), "abstract", F.col("a"), "literal"))


def template_redirects(pages: DataFrame, known: DataFrame, keywords: tuple[str, ...] = ("#REDIRECT",)) -> DataFrame:
    """(template_id, name): names of redirect pages (title, ns, source) in the template namespace, under the template (template_id, name) they lead to.

    Sources without a keyword are left out by a pattern before anything is parsed; names that are known already give nothing.
    """
    pattern = "(?i)^\\s*(?:" + "|".join(k.replace("#", "\\#") for k in keywords) + ")"
    plain = lambda c: F.lower(F.translate(clean_space(F.regexp_replace(c, "(?i)^template:", "")), " ", "_"))
    found = pages.where((F.col("ns") == 10) & F.col("source").rlike(pattern)).select(plain(F.col("title")).alias("name"), plain(F.split_part(F.regexp_extract("source", r"\[\[([^\]]*)\]\]", 1), F.lit("|"), F.lit(1))).alias("target"))
    goal = known.select("template_id", plain(F.col("name")).alias("target"))
    return found.join(goal, "target").select("template_id", "name").join(known.select(plain(F.col("name")).alias("name")), "name", "left_anti").distinct()


def property_statistics(properties: DataFrame) -> DataFrame:
    """(template, key, uses, pages, filled) of infobox properties (page_id, template, key, value)."""
    filled = F.count_if(F.trim(F.coalesce("value", F.lit(""))) != "")
    by_page = properties.groupBy("template", "key", "page_id").agg(F.count(F.lit(1)).alias("n"), filled.alias("f"))
    return by_page.groupBy("template", "key").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("pages"), F.sum("f").alias("filled"))


def parsed_boolean(c: Column) -> Column:
    """yes and true, no and false; else null."""
    low = F.lower(F.trim(c))
    return F.when(low.rlike(r"\b(?:yes|true)\b"), F.lit(True)).when(low.rlike(r"\b(?:no|false)\b"), F.lit(False))


def parsed_enumeration(c: Column, values: dict[str, str]) -> Column:
    """The value whose keyword occurs first in the text; of keywords at one place the longest."""
    at = F.array_compact(F.array(*(F.when(F.position(F.lit(k.lower()), F.lower(c)) > 0, F.struct(F.position(F.lit(k.lower()), F.lower(c)).alias("at"), F.lit(-len(k)).alias("n"), F.lit(v).alias("v"))) for k, v in values.items())))
    return F.array_min(at)["v"]


def ontology_axioms(definitions: DataFrame, base: str) -> DataFrame:
    """source_page, s, p, o, axiom of class and property pages (source_page, name, kind, label, parent, domain, range): the schema with the
    page that each statement comes from, so that a page's statements can be replaced as one."""
    uri = lambda c: F.concat(F.lit(base), c)
    kind = F.when(F.col("kind") == "class", "owl:Class").when(F.col("kind") == "object", "owl:ObjectProperty").otherwise("owl:DatatypeProperty")
    sup = F.when(F.col("kind") == "class", "rdfs:subClassOf").otherwise("rdfs:subPropertyOf")
    one = lambda p, o: F.struct(p.alias("p"), o.alias("o"))
    facts = F.array(one(F.lit("rdf:type"), kind), one(F.lit("rdfs:label"), F.col("label")), one(sup, uri(F.col("parent"))), one(F.lit("rdfs:domain"), uri(F.col("domain"))), one(F.lit("rdfs:range"), uri(F.col("range"))))
    t = definitions.select("source_page", uri(F.col("name")).alias("s"), F.explode(facts).alias("f")).select("source_page", "s", "f.*").where("o is not null")
    return t.withColumn("axiom", F.md5(F.concat_ws(" ", "s", "p", "o").cast("binary")))


def renamed_definitions(definitions: DataFrame, renames: DataFrame) -> DataFrame:
    """Definitions with names, parents, domains and ranges under their new names (old, new)."""
    out = definitions
    for c in ("name", "parent", "domain", "range"):
        r = renames.select(F.col("old").alias(c), F.col("new").alias("_new"))
        out = out.join(r, c, "left").withColumn(c, F.coalesce("_new", F.col(c))).drop("_new")
    return out.select(*definitions.columns)
