"""Comparison of gold triples with actual ones: exact, without predicate, and by similar objects."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions.text import similarity
from factweave.functions.values import within_permille


def exact(gold: DataFrame, actual: DataFrame) -> DataFrame:
    """gold with ``present``: the same s, p, o occurs."""
    hit = actual.select("s", "p", "o").distinct().withColumn("present", F.lit(True))
    return gold.join(hit, ["s", "p", "o"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


def predicate_neutral(gold: DataFrame, actual: DataFrame) -> DataFrame:
    """Of gold triples without an exact match, those whose s and o occur under another predicate."""
    rest = gold.join(actual.select("s", "p", "o").distinct(), ["s", "p", "o"], "left_anti")
    hit = actual.select("s", "o").distinct().withColumn("present", F.lit(True))
    return rest.join(hit, ["s", "o"], "left").select("s", "p", "o", F.coalesce("present", F.lit(False)).alias("present"))


def similar_objects(a: Column, b: Column, least: float = 0.8) -> Column:
    """Numbers within 0.1 %, other texts of an edit similarity over ``least``."""
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), within_permille(x, y)).otherwise(similarity(a, b) > least)


def object_similar(gold: DataFrame, actual: DataFrame, least: float = 0.8) -> DataFrame:
    """gold with ``present``: an actual object of the same subject (or its sub-nodes) and predicate is similar.

    Equal objects are found by their hash.  What is left meets only objects that can be similar: numbers of a size within a
    thousandth (blocks of their logarithm), texts of a length within ``least`` (blocks of its logarithm), so a predicate of many objects is many keys.
    """
    g = gold.select("s", "p", "o").distinct()
    a = actual.select(F.split_part("s", F.lit("__"), F.lit(1)).alias("s"), "p", F.col("o").alias("o2")).distinct()
    equal = g.join(a, F.expr("o = o2") & (g["s"] == a["s"]) & (g["p"] == a["p"]), "left_semi")
    rest = g.join(equal, ["s", "p", "o"], "left_anti").withColumn("x", F.col("o").try_cast("double"))
    a = a.withColumn("y", F.col("o2").try_cast("double"))
    size = lambda c: F.concat_ws("/", F.signum(c).cast("int").cast("string"), F.coalesce(F.floor(F.ln(F.abs(c)) / 0.002), F.lit(0)).cast("string"))
    near = F.explode(F.array(*(F.lit(k) for k in (-1, 0, 1)))).alias("k")
    block = F.coalesce(F.floor(F.ln(F.abs("x")) / 0.002), F.lit(0))
    numbers = rest.where("x is not null").select("s", "p", "o", "x", near).withColumn("b", F.concat_ws("/", F.signum("x").cast("int").cast("string"), (block + F.col("k")).cast("string")))
    numbers = numbers.join(a.where("y is not null").withColumn("b", size(F.col("y"))), ["s", "p", "b"]).where(within_permille(F.col("y"), F.col("x")))
    width = -math.log(least)
    length = lambda c: F.floor(F.ln(F.length(c) + F.lit(1.0)) / width)
    texts = rest.select("s", "p", "o", "x", near).withColumn("b", length("o") + F.col("k"))
    close = F.abs(F.length("o") - F.length("o2")) <= (1 - least) * F.greatest(F.length("o"), F.length("o2"))
    texts = texts.join(a.withColumn("b", length("o2")), ["s", "p", "b"]).where((F.col("x").isNull() | F.col("y").isNull()) & close & (similarity(F.col("o2"), F.col("o")) > least))
    hits = equal.unionByName(numbers.select("s", "p", "o")).unionByName(texts.select("s", "p", "o")).distinct().withColumn("present", F.lit(True))
    return gold.join(hits, ["s", "p", "o"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


def completeness(judged: DataFrame, snippet: str) -> DataFrame:
    """A snippet is complete if each of its triples is present."""
    return judged.groupBy(snippet).agg(F.count(F.lit(1)).alias("triples"), F.count_if("present").alias("found"), F.every("present").alias("complete"))


def literal_bucket(o: Column, kind: Column) -> Column:
    """Resource or the literal's shape."""
    return (
        F.when(kind == "uri", F.when(o.contains("__"), "intermediate").otherwise("entity"))
        .when(o.rlike(r"^-?[0-9]+$"), "integer").when(o.rlike(r"^-?[0-9]*\.[0-9]+$"), "double").when(o.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), "date")
        .when(F.lower(o).isin("true", "false"), "boolean").when(o.rlike("^https?://"), "url").otherwise("string")
    )


#: Base categories of a rendered object, tried in order (fixed values).
BASE_CATEGORIES = [
    ("Integer", "XMLSchema#integer"), ("Double", "XMLSchema#double|/datatype/[^>]+>"), ("Float", "XMLSchema#float"), ("Date", "XMLSchema#date(?!T)"), ("GYear", "XMLSchema#gYear(?!M)"),
    ("GYearMonth", "XMLSchema#gYearMonth"), ("Time", "XMLSchema#time"), ("GMonthDay", "XMLSchema#gMonthDay"), ("String", '".*"@[a-z]{2}'),
]


def base_category(rendered: Column, resource_base: str) -> Column:
    """What a rendered N-Triples object is: a typed literal, a text of a language, a resource, another address; else null."""
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in BASE_CATEGORIES:
        out = out.when(rendered.rlike(pattern), name)
    return out.when(rendered.startswith("<" + resource_base), "Resource").when(rendered.rlike("^<[^>]+>"), "Url")


def pattern_counts(objects: DataFrame, snippet: str, resource_base: str) -> DataFrame:
    """snippet, pattern, triples: how many objects of a snippet are of which base categories, as ``Date*1 Integer*2``."""
    n = objects.select(snippet, F.coalesce(base_category(F.col("o"), resource_base), F.lit("Other")).alias("c")).groupBy(snippet, "c").agg(F.count(F.lit(1)).alias("n"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("c", "n"))), lambda x: F.concat(x["c"], F.lit("*"), x["n"].cast("string")))
    return n.groupBy(snippet).agg(F.array_join(parts, " ").alias("pattern"), F.sum("n").alias("triples"))


def relevant(triples: DataFrame, gold: DataFrame) -> DataFrame:
    """Triples about gold subjects or their sub-nodes (``subject__...``): what a comparison has to read."""
    subjects = gold.select(F.col("s").alias("root")).distinct()
    return triples.withColumn("root", F.split_part("s", F.lit("__"), F.lit(1))).join(subjects, "root", "left_semi").drop("root")
