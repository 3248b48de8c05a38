"""Mapping of template properties to an ontology: instances, typed values, sub-nodes, places and intervals.

Tables in:
  templates   template, class, corr_class, corr_property          which class a template makes
  rules       template, key, kind, property, key2, property2, node_class, unit   what a property becomes (see ``map_pages``)
  ontology    property, range, functional                         range: integer, double, string, date, gYear, boolean, object, or a unit or dimension
  ancestors   class, ancestor                                     reflexive and transitive
They are dimension tables: joins with them are left to the optimizer, which broadcasts them if their size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.functions import cascade as C
from factweave.functions import units as U
from factweave.functions import values as V
from factweave.functions.text import truncate_bytes, wiki_encode

XSD = C.XSD
BREAK = r"(?i)<br\s*/?>"


#: Rows up to which a rule table is sent to all tasks, and parts into which a hot key of the cells is dealt where it has more.
SMALL_ROWS, SALTS = 100_000, 32


def with_rules(cells: DataFrame, rules: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """cells joined with a rule table: broadcast if it is counted to be small, else dealt by key and page, so that a template of a third
    of all pages comes to many tasks."""
    if rules.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return cells.join(F.broadcast(rules), on, how)
    each = rules.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return cells.withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS).cast("long"))).join(each, [*on, "_salt"], how).drop("_salt")


def resolve_redirects(redirects: DataFrame, rounds: int = 20) -> DataFrame:
    """(source, target) with each target at the end of its chain, by doubling; sources on a cycle or leading into one are left out.

    Chains of up to 2**rounds links end; the loop stops when no more sources reach an end.
    """
    from factweave.operators.graph import written

    now, sources, left = redirects.groupBy("source").agg(F.min("target").alias("target")), redirects.select(F.col("source").alias("target")).distinct(), None
    for _ in range(rounds):
        step = now.select(F.col("source").alias("target"), F.col("target").alias("next"))
        moved = written(now.join(step, "target", "left").select("source", F.coalesce("next", "target").alias("target"), F.col("next").isNotNull().alias("open")), "redirects")
        now, before, left = moved.select("source", "target"), left, moved.where("open").count()
        if left in (0, before):
            break
    return now.join(sources, "target", "left_anti").select("source", "target")


def typed(value: Column, range_: Column, unit: Column, lang: Column, base: str) -> Column:
    """struct(o, o_kind, datatype) of a text by the range; null where it can't be read (then no triple comes)."""
    lit = lambda o, d: U.let(o, lambda x: F.when(x.isNotNull(), F.struct(x.cast("string").alias("o"), F.lit("literal").alias("o_kind"), d.alias("datatype"))))
    link = F.regexp_extract(value, r"\[\[([^\]|]+)", 1)
    address = F.regexp_extract(value, r"((?:https?|ftp)://[^\s\]|<>\"]+)", 1)
    node = F.when(link != "", F.concat(F.lit(base), wiki_encode(link))).when(address != "", address)
    low = F.lower(value)
    truth = F.when(low.rlike(r"\b(yes|true)\b"), "true").when(low.rlike(r"\b(no|false)\b"), "false")
    shown = range_
    for d, u in U.SHOWN_IN.items():
        shown = F.when(range_ == d, F.lit(u)).otherwise(shown)
    # a number without a unit is in the rule's unit; what is read goes to the ontology's unit
    same = lambda q: F.coalesce(U.dimension(q["unit"]) == F.coalesce(U.dimension(unit), unit), F.lit(False))
    standard = U.let(C.quantity(value, lang), lambda q: F.when(same(q), q["standard"]).otherwise(U.to_standard(V.parse_float(value, lang), unit)))
    amount = U.let(standard, lambda x: F.when(U.dimension(shown).isNotNull(), U.from_standard(x, shown)).otherwise(x))
    return (
        F.when(range_ == "integer", lit(V.parse_integer(value, lang), F.lit(XSD + "integer")))
        .when(range_.isin("double", "float"), lit(V.parse_scaled(value, lang), F.lit(XSD + "double")))
        .when(range_ == "string", lit(F.nullif(C.plain_text(value), F.lit("")), F.lit(XSD + "string")))
        .when(range_ == "date", lit(V.parse_date(F.regexp_replace(value, r"\[\[|\]\]", "")), F.lit(XSD + "date")))
        .when(range_ == "gYear", lit(F.nullif(F.regexp_extract(value, r"\b([0-9]{4})\b", 1), F.lit("")), F.lit(XSD + "gYear")))
        .when(range_ == "boolean", lit(truth, F.lit(XSD + "boolean")))
        .when(range_ == "object", U.let(node, lambda x: F.when(x.isNotNull(), F.struct(x.alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("datatype")))))
        .when(range_ == "Currency", U.let(C.money(value, lang), lambda m: F.when(m.isNotNull(), F.struct(m["value"].cast("string").alias("o"), F.lit("literal").alias("o_kind"), m["unit"].alias("datatype")))))
        .when(range_.isNotNull(), lit(amount, shown))
    )


def instances(properties: DataFrame, templates: DataFrame, base: str) -> DataFrame:
    """The cells of mapped templates with page, s, class, page_class, nth and first (the template's first cell).

    A page's first mapped template describes the page; later ones get ``page__name`` of their first property with ``name`` in
    its key (else of their first property), numbered ``__1``, ... where that repeats. All windows lie within a page, so one
    shuffle by page_id serves them.
    """
    cells = properties.where(F.col("error").isNull() & F.col("via").isNull()).select("page_id", "title", "ordinal", "position", "template", "key", "value", "raw")
    cells = with_rules(cells, templates, ["template"])
    by_page, template = W.partitionBy("page_id").orderBy("ordinal"), W.partitionBy("page_id", "ordinal")
    cells = cells.withColumn("nth", F.dense_rank().over(by_page)).withColumn("page_class", F.first("class").over(by_page)).withColumn("page", F.concat(F.lit(base), wiki_encode(F.col("title"))))
    named = F.min(F.struct((~F.lower("key").contains("name")).alias("rest"), "position", F.col("value").alias("v"))).over(template)["v"]
    cells = cells.withColumn("name", named).withColumn("first", F.col("position") == F.min("position").over(template)).withColumn("cells", F.collect_list(F.struct("key", "value")).over(template))
    cut = F.regexp_replace(F.trim(truncate_bytes(C.plain_text(F.col("name")), 50)), r"\s*\([^)]*\)$", "")
    cells = cells.withColumn("s0", F.when(F.col("nth") == 1, F.col("page")).otherwise(F.concat("page", F.lit("__"), wiki_encode(cut))))
    cells = cells.withColumn("again", F.dense_rank().over(W.partitionBy("page_id", "s0").orderBy("ordinal")) - 1)
    return cells.withColumn("s", F.when(F.col("again") > 0, F.concat("s0", F.lit("__"), F.col("again").cast("string"))).otherwise(F.col("s0"))).drop("again", "name", "title", "s0")


def map_pages(properties: DataFrame, templates: DataFrame, rules: DataFrame, ontology: DataFrame, ancestors: DataFrame, lang: str, base: str, ontology_base: str) -> DataFrame:
    """Triples page_id, s, p, o, o_kind, datatype of mapped templates, in one pass over the cells.

    rules.kind: ``simple`` (value by the property's range; several at ``<br>`` unless functional), ``node`` (a sub-node of
    ``node_class`` a ``<br>`` part, linked by ``property``, holding the part under ``property2``), ``geo`` (a coordinate
    template in the value, or decimal degrees in ``key`` and ``key2``), ``interval`` (start under ``property``, end under
    ``property2``). Several rules may name a key. Unmapped templates and keys, null or unreadable values give nothing.
    """
    uri = lambda c: F.concat(F.lit(ontology_base), c)
    null = F.lit(None).cast("string")
    fact = lambda s, p, o, kind="uri", datatype=null: F.struct(s.alias("s"), p.alias("p"), o.alias("o"), (F.lit(kind) if isinstance(kind, str) else kind).alias("o_kind"), datatype.alias("datatype"))
    none = F.array().cast("array<struct<s:string,p:string,o:string,o_kind:string,datatype:string>>")

    ups = ancestors.groupBy("class").agg(F.sort_array(F.collect_set("ancestor")).alias("ups"))
    known = rules.join(ontology.select("property", "range", "functional"), "property", "left").join(ontology.select(F.col("property").alias("property2"), F.col("range").alias("range2")), "property2", "left")
    known = known.groupBy("template", "key").agg(F.collect_list(F.struct("kind", "property", "property2", "key2", "node_class", "unit", "range", "range2", "functional")).alias("rules"))
    cells = with_rules(instances(properties, templates, base), ups, ["class"], "left")
    cells = with_rules(with_rules(cells, ups.toDF("page_class", "page_ups"), ["page_class"], "left"), known, ["template", "key"], "left")

    r = "page_id s first nth page ups page_ups corr_class corr_property key value raw cells".split()
    rows = cells.select(*r, F.posexplode_outer("rules").alias("rule_no", "rule")).select(*r, "rule_no", "rule.*")
    split = F.filter(F.transform(F.split(F.when(F.coalesce("functional", F.lit(False)), F.regexp_replace("value", BREAK, " ")).otherwise(F.col("value")), BREAK), lambda x: F.trim(x, F.lit(" \t\r\n"))), lambda x: x != "")
    ends = F.slice(F.split("value", r"\s+(?:-|–|—|to)\s+|–|—"), 1, 2)
    rows = rows.withColumn("parts", F.when(F.col("kind").isin("simple", "node"), split).when(F.col("kind") == "interval", ends))
    rows = rows.select("*", F.posexplode_outer("parts").alias("k", "part"))
    in_second = (F.col("kind") == "node") | ((F.col("kind") == "interval") & (F.col("k") == 1))
    value2 = F.get(F.filter("cells", lambda x: x["key"] == F.col("key2")), F.lit(0))["value"]
    place = F.when(F.col("kind") == "geo", F.coalesce(C.coordinates(F.col("raw")), F.struct(F.col("value").try_cast("double").alias("lat"), value2.try_cast("double").alias("lon"))))
    rows = rows.withColumn("g", place).withColumn("v", typed(F.col("part"), F.when(in_second, F.col("range2")).otherwise(F.col("range")), F.col("unit"), F.lit(lang), base))

    s, v = F.col("s"), F.col("v")
    read = lambda subject, p: fact(subject, uri(p), v["o"], v["o_kind"], v["datatype"])
    sub = F.concat("s", F.lit("__"), wiki_encode(F.col("key")), F.lit("__"), (F.col("k") + 1).cast("string"))
    node = U.let(sub, lambda x: F.array(fact(s, uri(F.col("property")), x), fact(x, F.lit("rdf:type"), uri(F.col("node_class"))), read(x, F.col("property2"))))
    lat, lon = F.format_string("%.8f", "g.lat"), F.format_string("%.8f", "g.lon")
    number = lambda p, o: fact(s, F.lit(p), o, "literal", F.lit(XSD + "double"))
    spot = F.array(number("geo:lat", lat), number("geo:long", lon), fact(s, F.lit("georss:point"), F.concat_ws(" ", lat, lon), "literal"))
    found = (
        F.when((F.col("kind") == "node") & v.isNotNull(), node)
        .when(v.isNotNull(), F.array(read(s, F.when(in_second, F.col("property2")).otherwise(F.col("property")))))
        .when(F.expr("g.lat between -90 and 90 and g.lon between -180 and 180"), spot).otherwise(none)
    )
    # what the template itself says comes once, with the first row of its first cell
    types = F.transform("ups", lambda c: fact(s, F.lit("rdf:type"), uri(c)))
    link = F.when((F.col("nth") > 1) & F.array_contains("page_ups", F.col("corr_class")) & F.col("corr_property").isNotNull(), F.array(fact(s, uri(F.col("corr_property")), F.col("page")))).otherwise(none)
    once = F.col("first") & (F.coalesce("rule_no", F.lit(0)) == 0) & (F.coalesce("k", F.lit(0)) == 0)
    own = F.when(once, F.concat(F.coalesce(types, none), link)).otherwise(none)
    return rows.select("page_id", F.explode(F.concat(found, own)).alias("f")).select("page_id", "f.*")


def unmapped(properties: DataFrame, templates: DataFrame, rules: DataFrame) -> DataFrame:
    """template, key, n: keys of mapped templates that no rule names, for the fallback to infobox triples and for statistics."""
    tops = properties.where(F.col("error").isNull() & F.col("via").isNull())
    return tops.join(templates.select("template"), "template", "left_semi").join(rules.select("template", "key").distinct(), ["template", "key"], "left_anti").groupBy("template", "key").agg(F.count(F.lit(1)).alias("n"))
