"""External tables as facts and dimensions: regions, catalogues of books, lexical links, mapping sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions.text import isbn


def wide_regions(statistics: DataFrame, names: DataFrame, indicators: list[str]) -> DataFrame:
    """One row a region: statistics (geocode, indicator, value), names (geocode, name), one number column an indicator stated."""
    wide = statistics.groupBy("geocode").pivot("indicator", indicators).agg(F.max("value"))
    return names.join(wide, "geocode", "left").select("geocode", "name", *indicators)


def plain_name(c):
    """A person's name for joins: ``Surname, Given`` turned round, years and marks away, lower case."""
    name = F.regexp_replace(c, r",?\s*\(?(?:ca?\. )?[0-9]{3,4}\??\s*-\s*(?:[0-9]{3,4}\??)?\)?\s*$", "")
    turned = F.when(name.contains(","), F.concat(F.regexp_extract(name, r",\s*([^,]*)", 1), F.lit(" "), F.regexp_extract(name, r"^([^,]*)", 1))).otherwise(name)
    return F.trim(F.lower(F.regexp_replace(turned, r"[^\p{L} ]+", "")))


def linked_authors(books: DataFrame, people: DataFrame) -> DataFrame:
    """(book, person): books (book, creator) and people (person, name) whose plain names are equal and belong to one person only."""
    known = people.select("person", plain_name(F.col("name")).alias("_n")).where("_n != ''").groupBy("_n").agg(F.min("person").alias("person"), F.count_distinct("person").alias("_k")).where("_k = 1")
    return books.select("book", plain_name(F.col("creator")).alias("_n")).join(known, "_n").select("book", "person")


def book_links(pages: DataFrame, base: str) -> DataFrame:
    """(page_id, o): addresses of the books whose numbers a page (page_id, source) holds, each once."""
    found = F.regexp_extract_all("source", F.lit(r"(?i)isbn(?:-1[03])?\s*[:=]?\s*([0-9][0-9Xx -]{8,16}[0-9Xx])"), F.lit(1))
    each = pages.select("page_id", F.explode(F.array_distinct(found)).alias("x")).select("page_id", isbn(F.col("x")).alias("x"))
    return each.where("x is not null").select("page_id", F.concat(F.lit(base), "x").alias("o")).distinct()


def mapping_tables(sheet: DataFrame) -> dict[str, DataFrame]:
    """The mapping database's tables from a sheet (template, class, parent, template_property, property, range, unit): numbered by name.

    Ids follow the names' order, so a sheet gives the same ids each time; sheets are small.
    """
    from pyspark.sql import Window as W

    def numbered(df, name):
        return df.withColumn("id", F.row_number().over(W.orderBy(name)))

    names = sheet.select(F.col("class").alias("name")).unionByName(sheet.select(F.col("parent").alias("name"))).where("name is not null").distinct()
    ids = numbered(names, "name")
    parents = sheet.where("parent is not null").groupBy(F.col("class").alias("name")).agg(F.min("parent").alias("parent"))
    classes = ids.join(parents, "name", "left").join(ids.select(F.col("name").alias("parent"), F.col("id").alias("parent_id")), "parent", "left").select("id", "name", "parent_id")
    uris = numbered(sheet.select("template").distinct(), "template").select(F.col("id").alias("template_id"), F.col("template").alias("uri"))
    template_class = sheet.select("template", "class").distinct().join(uris, sheet["template"] == uris["uri"]).join(ids, F.col("class") == ids["name"]).select("template_id", F.col("id").alias("class_id"))
    keys = sheet.select("template", "template_property", "property", "range", "unit", "class").distinct()
    properties = numbered(keys.select(F.col("property").alias("name"), "range").groupBy("name").agg(F.min("range").alias("range")), "name").select("id", "name", "range")
    links = keys.join(uris, keys["template"] == uris["uri"]).join(properties.select(F.col("name").alias("property"), F.col("id").alias("class_property_id")), "property").select("template_id", F.col("template_property").alias("name"), "class_property_id", "unit")
    return {"class": classes, "template_uri": uris, "template_class": template_class, "class_property": properties, "template_property_class_property": links}
