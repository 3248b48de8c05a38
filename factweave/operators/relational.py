"""Joins and set operations of the extraction and its stores, over any tables of the named columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions.text import camel_case, similarity, upper_first


def sub_resources(rows: DataFrame, subjects: DataFrame, uri: str = "uri", subject: str = "subject", keep: bool = True) -> DataFrame:
    """Rows whose URI lies under a subject (``subject/...``), or with ``keep`` false the others.

    Every proper prefix of a URI that ends before a slash is a key, so the range join is an equi-join.
    """
    parts = F.split(F.col(uri), "/")
    keys = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    under = rows.select(uri).distinct().select(uri, F.explode(keys).alias("_key")).where(F.col("_key") != F.col(uri))
    hit = under.join(subjects.select(F.col(subject).alias("_key")).distinct(), "_key", "left_semi").select(uri).distinct()
    return rows.join(hit, uri, "left_semi" if keep else "left_anti")


def chain(edges: DataFrame, length: int, start: Column, end: Column) -> DataFrame:
    from factweave.operators.graph import paths

    return paths(edges, start, end, length)


def same_cluster(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with the cluster both are in: members (node, cluster, depth); depth_gap is a lower bound of their distance."""
    x = members.select(F.col("node").alias("a"), "cluster", F.col("depth").alias("da"))
    y = members.select(F.col("node").alias("b"), "cluster", F.col("depth").alias("db"))
    return pairs.join(x, "a").join(y, ["b", "cluster"]).select("a", "b", "cluster", F.abs(F.col("da") - F.col("db")).alias("depth_gap"))


def membership(axioms: DataFrame, annotations: DataFrame) -> DataFrame:
    """(extractor, s, p, o) of reified triples: axioms (axiom, role, value) and annotations (axiom, extractor)."""
    roles = axioms.groupBy("axiom").agg(*(F.max(F.when(F.col("role") == r, F.col("value"))).alias(r) for r in ("s", "p", "o")))
    return annotations.join(roles, "axiom").select("extractor", "s", "p", "o")


def renamed_annotations(annotations: DataFrame, renames: DataFrame) -> DataFrame:
    """annotations (property, ...) under their properties' new names; only of properties renamed (old, new)."""
    return annotations.join(renames, annotations["property"] == renames["old"]).drop("old", "property").withColumnRenamed("new", "property")


def superclass_links(pages: DataFrame, facts: DataFrame) -> DataFrame:
    """(page, class): pages (page, category) whose categories have a superclass (category, superclass), as a camel-case class name."""
    name = upper_first(camel_case(F.col("superclass")))
    return pages.join(facts, "category").select("page", name.alias("class")).distinct()


def having_members(items: DataFrame, members: DataFrame, key: str, member_key: str) -> DataFrame:
    """The items that a member refers to."""
    return items.join(members.select(F.col(member_key).alias(key)).distinct(), key, "left_semi")


def pages_with_revisions(pages: DataFrame, revisions: DataFrame, ids: DataFrame, page: str, revision: str) -> tuple[DataFrame, DataFrame]:
    """The listed revisions, and the pages of which one is left."""
    kept = revisions.join(ids.select(revision).distinct(), revision, "left_semi")
    return kept, pages.join(kept.select(page).distinct(), page, "left_semi")


def contains_all(wanted: DataFrame, present: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, complete): does ``present`` hold every wanted row of the group?"""
    hit = present.select(group, *columns).distinct().withColumn("_hit", F.lit(1))
    return wanted.join(hit, [group, *columns], "left").groupBy(group).agg(F.every(F.col("_hit").isNotNull()).alias("complete"))


def pattern_types(rows: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """(key, p, o): a type for each LIKE pattern that the text fits."""
    types = F.array_compact(F.array(*(F.when(F.col(text).like(p), F.lit(o)) for p, o in patterns.items())))
    return rows.select(key, F.lit("rdf:type").alias("p"), F.explode(types).alias("o"))


def totals(facts: DataFrame, pages: DataFrame) -> DataFrame:
    """One row: numbers of triples, articles, categories and redirects of facts (p, ...) and pages (ns, is_redirect)."""
    n = pages.agg(F.count_if((F.col("ns") == 0) & ~F.col("is_redirect")).alias("articles"), F.count_if(F.col("ns") == 14).alias("categories"), F.count_if("is_redirect").alias("redirects"))
    return facts.agg(F.count(F.lit(1)).alias("triples")).join(n)


def guarded(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows before and after an update, added and deleted, and whether the counts agree."""
    b, a = before.select(*key).distinct().withColumn("b", F.lit(1)), after.select(*key).distinct().withColumn("a", F.lit(1))
    both = b.join(a, key, "full").agg(F.count("b").alias("n_before"), F.count("a").alias("n_after"), F.count_if(F.expr("b is null")).alias("added"), F.count_if(F.expr("a is null")).alias("deleted"))
    return both.withColumn("ok", F.expr("n_before + added - deleted = n_after"))


def neighbours(edges: DataFrame) -> DataFrame:
    """(node, neighbour): the union of both directions of (a, p, b), each once."""
    return edges.select(F.col("a").alias("node"), F.col("b").alias("neighbour")).union(edges.select("b", "a")).distinct()


def similar_pairs(rows: DataFrame, group: list[str], key: str, text: str, least: float) -> DataFrame:
    """(a, b) of one group whose texts are more similar than ``least`` (1 - edit distance / longer length), each text compared once.

    Equal texts are one before they meet; a text meets those whose lengths can be similar enough, by blocks of lengths: a pair
    with similarity s has lengths at least s : 1, so the ratio's power tells the blocks apart that can't meet.
    """
    width = -F.log(F.lit(least)) if least > 0 else F.lit(64.0)
    texts = rows.groupBy(*group, text).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.floor(F.log(F.length(text) + F.lit(1.0)) / width))
    x = texts.select(*group, F.col(text).alias("_x"), F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b"), F.col("_b").alias("_bx"))
    y = texts.select(*group, F.col(text).alias("_y"), F.col("_b").alias("_b"))
    close = F.greatest(F.length("_x"), F.length("_y")) * (1 - least) >= F.abs(F.length("_x") - F.length("_y"))
    once = (F.col("_b") != F.col("_bx")) | (F.col("_x") <= F.col("_y"))
    met = x.join(y, [*group, "_b"]).where(once & close & (similarity(F.col("_x"), F.col("_y")) > least)).select(*group, "_x", "_y")
    a = rows.select(*group, F.col(key).alias("a"), F.col(text).alias("_x"))
    b = rows.select(*group, F.col(key).alias("b"), F.col(text).alias("_y"))
    pairs = met.join(a, [*group, "_x"]).join(b, [*group, "_y"]).where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.distinct()
