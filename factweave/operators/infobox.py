"""Infoboxes: the templates of pages as property rows, then as triples of typed values."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.functions.cascade import typed_values
from factweave.functions.text import camel_case, fold_digit, lower_first, wiki_encode
from factweave.operators.wikitext import MarkupError, blank_skipped, closing, split_top

PROPERTY_SCHEMA = "page_id long, title string, subject string, parent string, via string, template string, ordinal int, position int, key string, named boolean, value string, raw string, error string"
_NAMES = [c.split()[0] for c in PROPERTY_SCHEMA.split(", ")]
_TYPES = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}[c.split()[1]] for c in PROPERTY_SCHEMA.split(", ")]


def without_templates(value: str) -> tuple[str, list[str]]:
    """The text outside of nested templates, and the bodies of those."""
    kept, bodies, i, last = [], [], 0, 0
    while (i := value.find("{{", i)) >= 0:
        end = closing(value, i, "{{", "}}")
        kept.append(value[last:i])
        bodies.append(value[i + 2 : end - 2])
        i = last = end
    return "".join([*kept, value[last:]]).strip(), bodies


def _rows(page_id, title: str, source: str) -> Iterator[tuple]:
    name_of = lambda parts: " ".join(parts[0].replace("_", " ").split())
    top, seen, known = [split_top(b, "|") for b in without_templates(blank_skipped(source))[1]], {}, {}
    counts = Counter(map(name_of, top))

    def template(parts, subject, parent, via, ordinal):
        name, position, subs = name_of(parts), 0, []
        for k, part in enumerate(parts[1:]):
            key, equals, value = part.partition("=")
            named = bool(equals) and "[[" not in key and "{{" not in key
            if not named:
                position += 1
                key, value = str(position), part
            text, bodies = without_templates(value)
            key = key.strip()
            subs += [(key, b) for b in bodies]
            yield page_id, title, subject, parent, via, name, ordinal, k, key, named, text, value.strip(), None
        for key, b in subs:
            parts = split_top(b, "|")
            path = f"{subject}/{key}/{name_of(parts)}"
            known[path] = known.get(path, -1) + 1
            yield from template(parts, path + (str(known[path]) if known[path] else ""), subject, key, ordinal)

    for n, parts in enumerate(top):
        name = name_of(parts)
        seen[name] = seen.get(name, 0) + 1
        repeated = counts[name] > 1
        yield from template(parts, f"/{name}{seen[name]}" if repeated else "", "" if repeated else None, None, n)


def template_properties(pages: DataFrame) -> DataFrame:
    """pages (page_id, title, source) -> one row a template property, those of nested templates too.

    ``subject`` is a path below the page ('' is the page itself): templates that occur once describe the page, repeated ones
    get ``/nameN``, nested ones ``subject/key/name``. ``value`` lacks nested templates, ``raw`` has them. A page that doesn't
    parse gives one row with ``error``; null sources and pages without templates give none.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for b in batches:
            for page_id, title, source in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    out += _rows(page_id, title, source or "")
                except MarkupError as e:
                    out.append((page_id, title, *[None] * (len(_NAMES) - 3), str(e)))
                if len(out) > 10_000:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return pages.select("page_id", "title", "source").mapInArrow(run, PROPERTY_SCHEMA)


def infobox_triples(properties: DataFrame, lang: str, base: str, property_base: str, ignored_templates: tuple[str, ...] = (), ignored_properties: tuple[str, ...] = (), min_properties: int = 1) -> DataFrame:
    """page_id, s, p, o, o_kind, datatype: typed values, links to nested subjects, and which template a subject uses.

    ``ignored_templates`` may end in ``*``. Templates with fewer named or positional values than ``min_properties`` give nothing.
    """
    t = F.lower("template")
    skip = F.lit(False)
    for name in ignored_templates:
        skip = skip | (t.startswith(name[:-1].lower()) if name.endswith("*") else t == name.lower())
    rows = properties.where(F.col("error").isNull() & ~skip & ~F.col("template").startswith("#") & ~F.lower("key").isin(*[p.lower() for p in ignored_properties] or [""]))
    page = F.concat(F.lit(base), wiki_encode(F.col("title")))
    path = lambda c: F.concat(page, F.translate(c, " ", "_"))
    name = lambda key: F.regexp_replace(camel_case(key), "^([0-9])", "_$1")
    predicate = F.when(F.col("named"), name(fold_digit(F.col("key")))).otherwise(F.concat(lower_first(camel_case(F.col("template"))), F.lit("_"), F.col("key")))
    rows = rows.withColumn("s", path(F.col("subject"))).withColumn("p", F.concat(F.lit(property_base), predicate)).withColumn("v", typed_values(F.col("value"), F.lit(lang), base))
    # one pass a subject: how many values it has, what it hangs on; its first row gives what is said once
    subject = W.partitionBy("page_id", "s")
    filled, first = F.count_if(F.size("v") > 0).over(subject), subject.orderBy("ordinal", "position")
    rows = rows.select(
        "page_id", "s", "p", "v", "template", filled.alias("filled"), F.row_number().over(first).alias("at"), path(F.first("parent").over(first)).alias("parent"),
        F.coalesce(F.concat(F.lit(property_base), name(F.first("via").over(first))), F.lit(property_base + "relatedInstance")).alias("via"),
    ).where(F.col("filled") >= min_properties)
    null = F.lit(None).cast("string")
    fact = lambda s, p, o: F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit("uri").alias("o_kind"), null.alias("datatype"))
    values = F.transform("v", lambda v: F.struct(F.col("s"), F.col("p"), v["o"].alias("o"), v["o_kind"].alias("o_kind"), v["datatype"].alias("datatype")))
    uses = fact(F.col("s"), F.lit(property_base + "usesTemplate"), F.concat(F.lit(base + "Template:"), wiki_encode(F.col("template"))))
    hangs = fact(F.col("parent"), F.col("via"), F.col("s"))
    once = F.when(F.col("parent").isNotNull(), F.array(uses, hangs)).otherwise(F.array(uses))
    return rows.select("page_id", F.explode(F.when(F.col("at") == 1, F.concat(values, once)).otherwise(values)).alias("f")).select("page_id", "f.*")
