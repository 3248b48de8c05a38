"""Readers: page dumps, page directories, N-Triples, flagged TSV, record directories; and writers back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DUMP_SCHEMA = (
    "title string, ns int, id long, redirect struct<_title:string>, restrictions string, "
    "revision array<struct<id:long,timestamp:string,contributor:struct<username:string,id:long,ip:string>,minor:string,comment:string,text:string>>"
)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Pages with their revisions as an array; compressed files by their suffix."""
    return spark.read.format("xml").option("rowTag", "page").schema(DUMP_SCHEMA).load(path)


def revisions(pages: DataFrame) -> DataFrame:
    """One row a revision, numbered in stream order."""
    r = pages.select(F.col("id").alias("page_id"), "ns", "title", F.posexplode("revision").alias("ordinal", "r"))
    contributor = F.struct(F.coalesce("r.contributor.username", "r.contributor.ip").alias("username"), F.col("r.contributor.id").alias("id"), F.col("r.contributor.ip").isNotNull().alias("is_ip"))
    return r.select("page_id", "ns", "title", "ordinal", F.col("r.id").alias("rev_id"), F.to_timestamp("r.timestamp").alias("ts"), contributor.alias("contributor"), F.col("r.comment").alias("comment"), F.col("r.text").alias("text"), F.col("r.minor").isNotNull().alias("minor"))


def read_page_directory(spark: SparkSession, path: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """One page a file; the title is the file's name up to ``#`` or ``.``."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    name = F.try_url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return files.select(F.regexp_extract(name, r"^([^#.]*)", 1).alias("title"), F.col("value").alias("source"), name.alias("file")).where(~F.col("file").isin(*skip) if skip else F.lit(True)).drop("file")


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    from factweave.operators.triples import parse_ntriples

    return parse_ntriples(spark.read.text(path).where("trim(value) != '' and not startswith(trim(value), '#')"))


def read_flagged_tsv(spark: SparkSession, path: str, flags: str = "bcefinprsuz") -> DataFrame:
    """Tab-separated statistics: flag letters and blanks go, ``:`` and nothing become null, numbers where they parse."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    first, *rest = raw.columns
    clean = lambda c: F.regexp_replace(F.col(f"`{c}`"), rf"[\s{flags}]+", "")
    return raw.select(F.col(f"`{first}`"), *(F.when(~clean(c).isin("", ":"), clean(c)).try_cast("double").alias(c.strip()) for c in rest))


def read_records(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Record files: a header of ``key=value`` lines, a line of asterisks, a body."""
    files = (spark.readStream if streaming else spark.read).text(path, wholetext=True)
    head, body = F.split_part("value", F.lit("\n**********\n"), F.lit(1)), F.regexp_replace("value", r"(?s)\A.*?\n\*{10}\n", "")
    return files.select(F.str_to_map(head, F.lit("\n"), F.lit("=")).alias("meta"), body.alias("body"))


#: Sets of pages by name: namespace, whether redirects are left out, prefix of the titles (fixed values).
PAGE_SETS = {
    "all articles": (0, False, ""), "articles": (0, True, ""), "categories": (14, True, "Category:"),
    "all templates": (10, False, "Template:"), "templates": (10, True, "Template:"),
}


def titles(pages: DataFrame, which: str, langlinks: DataFrame | None = None, lang: str | None = None) -> DataFrame:
    """(page_id, title) of a set of pages (page_id, ns, title, is_redirect).

    With ``langlinks`` (page_id, lang, title), only pages that have a twin in ``lang``, under that title.
    """
    ns, no_redirects, prefix = PAGE_SETS[which]
    out = pages.where(F.col("ns") == ns)
    if no_redirects:
        out = out.where(~F.col("is_redirect"))
    if langlinks is not None:
        twin = langlinks.where(F.col("lang") == lang).select("page_id", F.col("title").alias("_twin"))
        out = out.join(twin, "page_id").withColumn("title", F.col("_twin"))
    return out.select("page_id", F.concat(F.lit(prefix), "title").alias("title"))


def page_source(pages: DataFrame, texts: DataFrame, page_id: int) -> DataFrame:
    """(page_id, title, text) of one page (page_id, title, latest) by its latest text (text_id, text)."""
    one = pages.where(F.col("page_id") == page_id)
    return one.join(texts, one["latest"] == texts["text_id"]).select("page_id", "title", "text")


def read_page_elements(spark: SparkSession, path: str) -> DataFrame:
    """``value``: each ``<page>`` element of a text dump, as it stands; no line is read twice and none is needed whole."""
    parts = spark.read.option("lineSep", "</page>").text(path)
    return parts.where("contains(value, '<page>')").select(F.concat(F.regexp_extract("value", r"(?s)(<page>.*)\z", 1), F.lit("</page>")).alias("value"))


def xpath_rows(docs: DataFrame, expression: str, column: str = "value") -> DataFrame:
    """One row for each text that an XPath finds in a column of XML, numbered in document order."""
    return docs.select("*", F.posexplode(F.xpath(column, F.lit(expression))).alias("n", "found"))


def sparql_json(answers: DataFrame, s: str = "s", p: str = "p", o: str = "o", lang: str | None = None, column: str = "value") -> DataFrame:
    """Triples of SPARQL answers in JSON; with ``lang``, literals of other languages go."""
    node = "struct<type: string, value: string, `xml:lang`: string, datatype: string>"
    rows = answers.select(F.explode(F.from_json(column, f"results struct<bindings: array<map<string, {node}>>>")["results"]["bindings"]).alias("b"))
    o_lang = F.col("b")[o]["xml:lang"]
    out = rows.select(F.col("b")[s]["value"].alias("s"), F.col("b")[p]["value"].alias("p"), F.col("b")[o]["value"].alias("o"), F.col("b")[o]["type"].alias("o_kind"), F.col("b")[o]["datatype"].alias("datatype"), o_lang.alias("lang"))
    return out if lang is None else out.where(F.col("lang").isNull() | (F.col("lang") == lang))


def sparql_xml(answers: DataFrame, names: list[str], column: str = "value") -> DataFrame:
    """One row a result of SPARQL answers in XML, a column a variable (unbound ones null)."""
    one = F.regexp_extract_all(F.col(column), F.lit(r"(?s)<result>(.*?)</result>"), F.lit(1))
    rows = answers.select(F.explode(one).alias("_r")).select(F.concat(F.lit("<r>"), "_r", F.lit("</r>")).alias("_r"))
    value = lambda n: F.when(F.xpath_boolean("_r", F.lit(f"/r/binding[@name='{n}']")), F.xpath_string("_r", F.lit(f"/r/binding[@name='{n}']/*")))
    return rows.select(*(value(n).alias(n) for n in names))


def xml_columns(docs: DataFrame, fields: dict[str, str], key: str, column: str = "value") -> DataFrame:
    """The key and one column for each named XPath; a number with group commas is a number where the whole text is one."""
    text = {n: F.xpath_string(column, F.lit(x)) for n, x in fields.items()}
    return docs.select(key, *(F.nullif(F.trim(c), F.lit("")).alias(n) for n, c in text.items()))


def number_or_null(name: str):
    return F.replace(F.col(name), F.lit(","), F.lit("")).try_cast("double")


def borders(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(key, neighbour, km) of lists like ``Austria 784 km, Belgium 167 km``."""
    each = docs.select(key, F.explode(F.regexp_extract_all(F.col(column), F.lit(r"([^,;]+? [0-9][0-9,.]* km)"), F.lit(1))).alias("_x"))
    return each.select(key, F.trim(F.regexp_extract("_x", r"^(.*) [0-9][0-9,.]* km$", 1)).alias("neighbour"), F.replace(F.regexp_extract("_x", r"([0-9][0-9,.]*) km$", 1), F.lit(","), F.lit("")).try_cast("double").alias("km"))


def read_sheet(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A CSV sheet: quotes may hold separators, line ends and doubled quotes."""
    return spark.read.csv(path, header=header, quote='"', escape='"', multiLine=True)


def read_settings(text: str) -> dict[str, str]:
    """``key = value`` lines; sections give prefixes, ``#`` and ``;`` begin remarks, quotes around a value go."""
    out, section = {}, ""
    for line in map(str.strip, text.splitlines()):
        if line.startswith("[") and line.endswith("]"):
            section = line[1:-1].strip() + "."
        elif line and line[0] not in "#;" and "=" in line:
            key, value = (x.strip() for x in line.split("=", 1))
            out[section + key] = value[1:-1] if len(value) > 1 and value[0] == value[-1] == '"' else value
    return out


def namespaces_of(siteinfo: DataFrame, column: str = "value") -> DataFrame:
    """(ns, name) of the namespaces that an export's site information lists."""
    each = siteinfo.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(r"(<namespace [^>]*?(?:/>|>[^<]*</namespace>))"), F.lit(1))).alias("_n"))
    return each.select(F.regexp_extract("_n", r'key="(-?[0-9]+)"', 1).cast("int").alias("ns"), F.regexp_extract("_n", r">([^<]*)<", 1).alias("name"))


def single_page(spark: SparkSession, title: str, source: str, page_id: int = 0, ns: int = 0) -> DataFrame:
    """One page from memory, as all extractors take it."""
    return spark.createDataFrame([(page_id, title, ns, source)], "page_id long, title string, ns int, source string")


def oldest_record(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of the record file that was changed first; of files of one time the first by name."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_modification_time").alias("_t"), "value")
    return files.orderBy("_t", "name").limit(1).drop("_t")


#: A string literal of an SQL dump: escapes by backslash, quotes also doubled.
_QUOTED = r"'(?:[^'\\]++|\\.|'')*+'"
#: Escapes in the literals of dumps but for the backslash itself (fixed values).
_ESCAPED = [("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\Z", "\x1a"), ("\\'", "'"), ('\\"', '"'), ("''", "'")]


def _literal(c: Column) -> Column:
    """The text of a literal; null for NULL."""
    inner = F.substring(c, 2, F.length(c) - 2)

    def unescaped(x):
        for escape, char in _ESCAPED:
            x = F.replace(x, F.lit(escape), F.lit(char))
        return x

    text = F.array_join(F.transform(F.split(inner, r"\\\\", -1), unescaped), "\\")
    return F.when(c.startswith("'"), text).when(F.upper(c) != "NULL", c)


def inserted_rows(lines: DataFrame, table: str, names: list[str], column: str = "value") -> DataFrame:
    """The rows that an SQL dump's INSERT statements, one a line, put into a table: texts under the names, null for NULL."""
    head = rf"(?is)^\s*INSERT\s+INTO\s+`?{re.escape(table)}`?\s*(?:\([^)]*\)\s*)?VALUES\s*"
    rows = F.regexp_extract_all(F.regexp_replace(column, head, ""), F.lit(rf"(?s)\((?:{_QUOTED}|[^'()]++)*+\)"), F.lit(0))
    each = lines.where(F.col(column).rlike(head)).select(F.explode(rows).alias("_r"))
    cells = each.select(F.regexp_extract_all("_r", F.lit(rf"(?s){_QUOTED}|[^'(),\s]++"), F.lit(0)).alias("_c"))
    return cells.select(*(_literal(F.get("_c", F.lit(k))).alias(n) for k, n in enumerate(names)))


def read_catalogue(spark: SparkSession, path: str, tag: str = "pgterms:etext") -> DataFrame:
    """``value``: each element of a kind of an RDF/XML catalogue, as it stands."""
    parts = spark.read.option("lineSep", f"</{tag}>").text(path).where(f"contains(value, '<{tag} ')")
    return parts.select(F.concat(F.regexp_extract("value", rf"(?s)(<{tag} .*)\z", 1), F.lit(f"</{tag}>")).alias("value"))


def without_prefixes(c: Column, prefixes: tuple[str, ...], entities: dict[str, str] | None = None) -> Column:
    """XML whose element and attribute names have lost the stated prefixes; stated entities are written out, other unknown ones go."""
    c = F.regexp_replace(c, rf"(</?|\s)(?:{'|'.join(prefixes)}):", "$1")
    for name, text in (entities or {}).items():
        c = F.replace(c, F.lit(f"&{name};"), F.lit(text))
    return F.regexp_replace(c, r"&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z]+;", "")


#: Prefixes of the book catalogue (fixed values).
CATALOGUE_PREFIXES = ("rdf", "pgterms", "dcterms", "dc")


def catalogue_tables(books: DataFrame, files: DataFrame, entities: dict[str, str] | None = None, column: str = "value") -> dict[str, DataFrame]:
    """Tables of a book catalogue from its book and file elements: texts, creators, contributors, subjects, files.

    Names stand alone or in a bag; a contributor's part stands in square brackets behind the name.
    """
    number = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).try_cast("int").alias("text_id")
    one = lambda x: F.nullif(F.trim(F.xpath_string("x", F.lit(x))), F.lit(""))
    many = lambda df, x, name: df.select("text_id", F.explode(F.xpath("x", F.lit(x))).alias("_v")).select("text_id", F.trim(F.col("_v"), F.lit(" \t\r\n")).alias(name)).where(F.col(name) != "").distinct()
    plain = lambda df: df.select(without_prefixes(F.col(column), CATALOGUE_PREFIXES, entities).alias("x"))
    b = plain(books).select(number(F.xpath_string("x", F.lit("/etext/@ID"))), "x")
    names = lambda kind: many(b, f"/etext/{kind}/text() | /etext/{kind}/Bag/li/text()", "name")
    part = F.regexp_extract("name", r"\[([^\]]*)\]$", 1)
    texts = b.select("text_id", *(one(f"/etext/{x}").alias(x) for x in ("publisher", "title", "friendlytitle", "language", "created", "rights", "description")))
    f = plain(files)
    formats = F.transform(F.xpath("x", F.lit("/file/format//text()")), lambda v: F.trim(v, F.lit(" \t\r\n")))
    formats = F.filter(formats, lambda v: v != "")
    stored = f.select(
        number(F.xpath_string("x", F.lit("/file/isFormatOf/@resource"))), one("/file/@about").alias("url"), F.get(formats, F.lit(0)).alias("format1"), F.get(formats, F.lit(1)).alias("format2"),
        one("/file/modified").try_cast("date").alias("modified"), one("/file/extent").try_cast("bigint").alias("extent"),
    )
    return {
        "texts": texts.withColumn("created", F.col("created").try_cast("date")), "creators": names("creator"),
        "contributors": names("contributor").select("text_id", F.trim(F.regexp_replace("name", r"\s*\[[^\]]*\]$", "")).alias("name"), F.nullif(part, F.lit("")).alias("type")),
        "subjects": many(b, "/etext/subject//text()", "subject"), "files": stored,
    }


def write_ntriples(triples: DataFrame, path: str, by: str | None = None) -> None:
    """One line a triple, in folders by a dataset column if named."""
    from factweave.operators.triples import ntriple

    lines = triples.select(*([by] if by else []), ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind")).alias("value"))
    (lines.write.partitionBy(by) if by else lines.write).text(path)
