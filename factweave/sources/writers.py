"""Sinks as lines of text: INSERT statements, documents for a full-text index, page exports, ontologies and class trees."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512 * 1024
#: Escapes of string literals in the two dialects (fixed values).
ESCAPES = {"mysql": [("\\", "\\\\"), ("'", "\\'"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\x1a", "\\Z")], "postgres": [("'", "''")]}


def sql_value(c: Column, dtype: str, dialect: str = "mysql") -> Column:
    """A literal: NULL, digits, 0 or 1 for truth, else a quoted and escaped string."""
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        out = c.cast("string")
    elif dtype == "boolean":
        out = c.cast("int").cast("string")
    else:
        text = c.cast("string")
        for char, escape in ESCAPES[dialect]:
            text = F.replace(text, F.lit(char), F.lit(escape))
        out = F.concat(F.lit("'"), text, F.lit("'"))
    return F.coalesce(out, F.lit("NULL"))


def insert_statements(df: DataFrame, table: str, dialect: str = "mysql", block: int = BLOCK) -> DataFrame:
    """``value``: multi-row INSERTs of about ``block`` bytes, made partition by partition without a shuffle."""
    row = F.concat(F.lit("("), F.concat_ws(",", *(sql_value(F.col(f"`{c}`"), t, dialect) for c, t in df.dtypes)), F.lit(")"))
    head = f"INSERT INTO {table} ({','.join(df.columns)}) VALUES "

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for v in pdf["v"]:
                if held and size >= block:
                    yield pd.DataFrame({"value": [head + ",".join(held) + ";"]})
                    held, size = [], 0
                held.append(v)
                size += len(v.encode()) + 1
        if held:
            yield pd.DataFrame({"value": [head + ",".join(held) + ";"]})

    return df.select(row.alias("v")).mapInPandas(run, "value string")


def xml_text(c: Column) -> Column:
    for char, escape in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(escape))
    return F.coalesce(c, F.lit(""))


def index_documents(revisions: DataFrame) -> DataFrame:
    """``value``: one document element a page, of its last revision in stream order."""
    last = revisions.groupBy("page_id").agg(F.max_by(F.struct("title", "ts", "text"), "ordinal").alias("r"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    body = F.concat(tag("id", F.col("page_id").cast("string")), F.lit("<group>0</group>"), tag("timestamp", F.coalesce(F.unix_seconds(F.col("r.ts").cast("timestamp")).cast("string"), F.lit(""))), tag("title", xml_text(F.col("r.title"))), tag("body", xml_text(F.col("r.text"))))
    return last.select(tag("document", body).alias("value"))


def page_export(revisions: DataFrame) -> DataFrame:
    """``value``: one page element a page with its revisions in stream order; histories of a page are grouped, as its element needs."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    one = tag("revision", F.concat(tag("id", F.col("rev_id").cast("string")), tag("timestamp", F.coalesce(when, F.lit(""))), tag("text", xml_text(F.col("text")))))
    rows = revisions.select("page_id", "title", F.struct("ordinal", one.alias("x")).alias("r")).groupBy("page_id").agg(F.first("title").alias("title"), F.sort_array(F.collect_list("r")).alias("r"))
    return rows.select(tag("page", F.concat(tag("title", xml_text(F.col("title"))), tag("id", F.col("page_id").cast("string")), F.array_join("r.x", ""))).alias("value"))


def page_export_lines(revisions: DataFrame) -> DataFrame:
    """page_id, ordinal, ``value``: one line a revision, the first with its page's opening, the last with its closing.

    Rows are dealt and sorted by page, so written as text they are whole elements; no page's history is held at once.
    """
    from pyspark.sql import Window as W

    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    of_page = W.partitionBy("page_id").orderBy("ordinal")
    one = tag("revision", F.concat(tag("id", F.col("rev_id").cast("string")), tag("timestamp", F.coalesce(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))), tag("text", xml_text(F.col("text")))))
    opening = F.when(F.lag("ordinal").over(of_page).isNull(), F.concat(F.lit("<page>"), tag("title", xml_text(F.col("title"))), tag("id", F.col("page_id").cast("string")))).otherwise("")
    closing = F.when(F.lead("ordinal").over(of_page).isNull(), "</page>").otherwise("")
    return revisions.select("page_id", "ordinal", F.concat(opening, one, closing).alias("value"))


def class_tree(classes: DataFrame) -> DataFrame:
    """``value``: an edge of a Graphviz digraph from each class (id, parent_id, label) to its parent."""
    up = classes.select(F.col("id").alias("parent_id"), F.col("label").alias("parent"))
    return classes.join(up, "parent_id").select(F.concat(F.lit(' "'), "label", F.lit('" -> "'), "parent", F.lit('";')).alias("value"))


def owl_elements(classes: DataFrame, properties: DataFrame, base: str, doubles: tuple[str, ...] = ()) -> DataFrame:
    """``value``: an OWL element a class (name, label, parent, equivalent) and property (name, label, kind, domain, range, functional).

    Names with a prefix belong to other vocabularies and are left out; units and dimensions in ``doubles`` become xsd:double.
    """
    def res(name, c):
        return F.when(c.isNotNull(), F.concat(F.lit(f'<{name} rdf:resource="'), c, F.lit('"/>')))

    uri = lambda c: F.when(c.contains(":"), c).otherwise(F.concat(F.lit(base), c))
    label = F.when(F.col("label").isNotNull(), F.concat(F.lit('<rdfs:label xml:lang="en">'), xml_text(F.col("label")), F.lit("</rdfs:label>")))
    element = lambda kind, *parts: F.concat(F.lit("<"), kind, F.lit(' rdf:about="'), uri(F.col("name")), F.lit('">'), F.concat_ws("", *parts), F.lit("</"), kind, F.lit(">"))
    own = lambda df: df.where(~F.col("name").contains(":"))
    kind = F.when(F.col("kind") == "object", "owl:ObjectProperty").otherwise("owl:DatatypeProperty")
    range_ = F.when(F.col("range").isin(*doubles) if doubles else F.lit(False), "http://www.w3.org/2001/XMLSchema#double").otherwise(uri(F.col("range")))
    functional = F.when(F.col("functional"), '<rdf:type rdf:resource="http://www.w3.org/2002/07/owl#FunctionalProperty"/>')
    c = own(classes).select(element(F.lit("owl:Class"), label, res("rdfs:subClassOf", uri(F.col("parent"))), res("owl:equivalentClass", uri(F.col("equivalent")))).alias("value"))
    return c.unionByName(own(properties).select(element(kind, functional, label, res("rdfs:domain", uri(F.col("domain"))), res("rdfs:range", range_)).alias("value")))


def decoded(triples: DataFrame) -> DataFrame:
    """Triples with readable URIs: percent escapes decoded where they are sound."""
    return triples.withColumns({c: F.coalesce(F.try_url_decode(c), F.col(c)) for c in ("s", "p")}).withColumn("o", F.when(F.col("o_kind") == "uri", F.coalesce(F.try_url_decode("o"), F.col("o"))).otherwise(F.col("o")))


def routed(triples: DataFrame, routes: dict[str, str], default: str, by: str = "extractor_id") -> DataFrame:
    """Triples with the dataset that their extractor is sent to; ``write_ntriples(..., by="dataset")`` writes a folder a dataset."""
    out = F.lit(default)
    for extractor, dataset in routes.items():
        out = F.when(F.col(by) == extractor, F.lit(dataset)).otherwise(out)
    return triples.withColumn("dataset", out)


def _newest(revisions: DataFrame) -> DataFrame:
    return revisions.groupBy("page_id").agg(F.max("ordinal").alias("_last"))


def current_and_old_rows(revisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the tables ``cur`` and ``old`` of the first dump layout, with time stamps that sort newest first."""
    from factweave.functions.values import inverse_timestamp

    r = revisions.join(_newest(revisions), "page_id")
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    row = lambda p, kind: r.where(kind).select(F.col("page_id" if p == "cur" else "rev_id").alias(f"{p}_id"), F.col("ns").alias(f"{p}_namespace"), F.translate("title", " ", "_").alias(f"{p}_title"), F.col("text").alias(f"{p}_text"), stamp.alias(f"{p}_timestamp"), inverse_timestamp(F.col("ts")).alias("inverse_timestamp"))
    return row("cur", F.col("ordinal") == F.col("_last")), row("old", F.col("ordinal") < F.col("_last"))


def page_revision_text_rows(revisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the tables ``page``, ``revision`` and ``text`` of the later dump layout; a page's length is in UTF-8 bytes."""
    last = revisions.groupBy("page_id").agg(F.max_by(F.struct("ns", "title", "rev_id", F.octet_length("text").alias("n")), "ordinal").alias("r"))
    page = last.select("page_id", F.col("r.ns").alias("page_namespace"), F.translate("r.title", " ", "_").alias("page_title"), F.col("r.rev_id").alias("page_latest"), F.col("r.n").alias("page_len"))
    revision = revisions.select("rev_id", F.col("page_id").alias("rev_page"), F.col("rev_id").alias("rev_text_id"), F.date_format("ts", "yyyyMMddHHmmss").alias("rev_timestamp"))
    text = revisions.select(F.col("rev_id").alias("old_id"), F.col("text").alias("old_text"), F.lit("utf-8").alias("old_flags"))
    return page, revision, text


def write_lines(lines: DataFrame, path: str, compression: str = "none") -> None:
    """Lines to files, plain or as gzip or bzip2."""
    lines.write.option("compression", compression).text(path)


def tee(df: DataFrame, sinks) -> None:
    """The same rows to several sinks, computed once."""
    held = df.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def mapping_templates(mappings: DataFrame) -> DataFrame:
    """``value``: the text of a mapping page for each template: mappings (template, class, template_property, property)."""
    one = F.concat(F.lit("{{PropertyMapping | templateProperty = "), "template_property", F.lit(" | ontologyProperty = "), "property", F.lit(" }}"))
    rows = mappings.groupBy("template", "class").agg(F.sort_array(F.collect_list(F.struct("template_property", one.alias("x")))).alias("r"))
    return rows.select(F.concat(F.lit("{{TemplateMapping\n| mapToClass = "), "class", F.lit("\n| mappings =\n"), F.array_join("r.x", "\n"), F.lit("\n}}")).alias("value"))


def schema_templates(classes: DataFrame) -> DataFrame:
    """``value``: the text of an ontology page for each class (name, label, parent)."""
    sup = F.coalesce(F.concat(F.lit("| rdfs:subClassOf = "), "parent", F.lit("\n")), F.lit(""))
    return classes.select("name", F.concat(F.lit("{{Class\n| rdfs:label@en = "), "label", F.lit("\n"), sup, F.lit("}}")).alias("value"))


def count_sheet(counts: DataFrame, rows: str, columns: str, values: list[str], number: str) -> DataFrame:
    """A sheet of counts: a row a value of ``rows``, a column for each of the stated values, a total."""
    wide = counts.groupBy(rows).pivot(columns, values).agg(F.sum(number)).fillna(0)
    total = F.lit(0)
    for v in values:
        total = total + F.col(f"`{v}`")
    return wide.withColumn("total", total)


def record_files(records: DataFrame) -> DataFrame:
    """``name`` and ``value`` of record files: metadata lines, a line of asterisks, the body; deleted records have no body."""
    meta = F.concat_ws("\n", F.concat(F.lit("identifier="), "identifier"), F.concat(F.lit("title="), "title"), F.concat(F.lit("ts="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.concat(F.lit("op="), "op"))
    body = F.when(F.col("op") == "delete", "").otherwise(F.coalesce("source", F.lit("")))
    return records.select(F.concat("identifier", F.lit(".txt")).alias("name"), F.concat(meta, F.lit("\n**********\n"), body).alias("value"))


def update_statements(triples: DataFrame, graph: str, insert: bool = True, one_by_one: bool = False) -> DataFrame:
    """s, ``value``: statements that put the triples of a subject into a graph or take them out: one a subject, or one a triple."""
    from factweave.operators.triples import ntriple

    head = F.lit(f"INSERT INTO GRAPH <{graph}> {{ " if insert else f"DELETE FROM GRAPH <{graph}> {{ ")
    rows = triples.select("s", ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind")).alias("value"))
    if not one_by_one:
        rows = rows.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("value")), " ").alias("value"))
    return rows.select("s", F.concat(head, "value", F.lit(" }")).alias("value"))


def delete_by_filter(subjects: DataFrame, graph: str, kept: list[tuple[str, str]] = ()) -> DataFrame:
    """s, ``value``: a statement that takes all of a subject's triples out of a graph, but for kept ones.

    ``kept``: (``p`` or ``o``, the address that the predicate or object begins with).
    """
    quoted = lambda x: x.replace("\\", "\\\\").replace("'", "\\'")
    rest = "".join(f" FILTER (!(str(?{v}) LIKE '{quoted(start)}%'))" for v, start in kept)
    s = F.concat(F.lit("<"), "s", F.lit("> ?p ?o"))
    return subjects.select("s", F.concat(F.lit(f"DELETE FROM GRAPH <{graph}> {{ "), s, F.lit(f" }} FROM <{graph}> WHERE {{ "), s, F.lit(f" .{rest} }}")).alias("value"))


def write_by_subject(statements: DataFrame, paths: list[str], most: int = 200) -> None:
    """The lines of each subject (s, value) in a folder of its own under each of the paths, named by the escaped address.

    Addresses that agree in their first ``most`` escaped signs share a folder; no line is lost.
    """
    named = statements.select(F.substring(F.url_encode("s"), 1, most).alias("subject"), "value")
    tee(named.repartition("subject"), [lambda df, path=path: df.write.partitionBy("subject").text(path) for path in paths])
