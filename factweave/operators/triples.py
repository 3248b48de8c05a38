"""The fact table: building, rendering, validating, comparing and merging triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.functions.text import ntriples_escape

NT_LINE = r'^<([^<>"{}|^`\\\s]+)> <([^<>"{}|^`\\\s]+)> (?:<([^<>"{}|^`\\\s]+)>|"((?:[^"\\]|\\.)*)"(?:\^\^<([^<>"{}|^`\\\s]+)>|@([a-zA-Z]+(?:-[a-zA-Z0-9]+)*))?) \.$'


def unpivot(df: DataFrame, subject: Column, predicates: dict[str, Column], kinds: dict[str, str] | None = None) -> DataFrame:
    """One triple a row and column: s, p, o, o_kind (uri or literal); null objects are left out."""
    kinds = kinds or {}
    facts = F.array(*(F.struct(F.lit(p).alias("p"), c.cast("string").alias("o"), F.lit(kinds.get(p, "literal")).alias("o_kind")) for p, c in predicates.items()))
    return df.select(subject.alias("s"), F.explode(facts).alias("f")).select("s", "f.*").where("o is not null")


def ntriple(s: Column, p: Column, o: Column, kind: Column) -> Column:
    term = F.when(kind == "uri", F.concat(F.lit("<"), o, F.lit(">"))).otherwise(F.concat(F.lit('"'), ntriples_escape(o), F.lit('"')))
    return F.concat(F.lit("<"), s, F.lit("> <"), p, F.lit("> "), term, F.lit(" ."))


def nquad(s: Column, p: Column, o: Column, kind: Column, graph: Column) -> Column:
    """The triple's line with the provenance URI before the closing point."""
    return F.concat(F.regexp_replace(ntriple(s, p, o, kind), r"\.$", ""), F.lit("<"), graph, F.lit("> ."))


def parse_ntriples(lines: DataFrame, column: str = "value") -> DataFrame:
    """line, valid and the parts s, p, o, o_kind of each line."""
    c = F.col(column)
    part = lambda k: F.regexp_extract(c, NT_LINE, k)
    return lines.select(c.alias("line"), c.rlike(NT_LINE).alias("valid"), part(1).alias("s"), part(2).alias("p"), F.when(part(3) != "", part(3)).otherwise(part(4)).alias("o"), F.when(part(3) != "", "uri").otherwise("literal").alias("o_kind"))


def triple_hash(line: Column) -> Column:
    return F.md5(F.trim(line).cast("binary"))


def reify(triples: DataFrame, base: str, annotations: dict[str, Column]) -> DataFrame:
    """Each triple as an axiom: source, property, target and annotations, keyed by the hash of its line."""
    axiom = F.concat(F.lit(base), triple_hash(ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind"))))
    return unpivot(triples.withColumn("axiom", axiom), F.col("axiom"), {"annotatedSource": F.col("s"), "annotatedProperty": F.col("p"), "annotatedTarget": F.col("o"), **annotations})


def diff(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """keys and status: added, removed or retained, by one full outer join of distinct keys."""
    a, b = new.select(*keys).distinct().withColumn("a", F.lit(1)), old.select(*keys).distinct().withColumn("b", F.lit(1))
    return a.join(b, keys, "full_outer").select(*keys, F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").otherwise("retained").alias("status"))


def predicate_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Triples with an action: insert all of predicates in ``new``; delete all of shared predicates in ``old``."""
    preds = new.select("p").distinct()
    return new.withColumn("action", F.lit("insert")).unionByName(old.join(preds, "p", "left_semi").withColumn("action", F.lit("delete")))


def matches_rules(triples: DataFrame, rules: list[tuple[str, str, str]]) -> Column:
    """Some rule (mode EXACT or STARTSWITH, column, pattern) holds; the rules are a fixed short list."""
    checks = [F.col(c) == v if mode == "EXACT" else F.col(c).startswith(v) for mode, c, v in rules]
    return reduce(lambda x, y: x | y, checks, F.lit(False))


def number_occurrences(df: DataFrame, keys: list[str], order: list, out: str = "uri") -> DataFrame:
    """Repeated names get ``__1``, ``__2``, ... from the second on, in the stated order."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_n", n).withColumn(out, F.when(F.col("_n") == 0, F.col(keys[-1])).otherwise(F.concat(F.col(keys[-1]), F.lit("__"), F.col("_n").cast("string")))).drop("_n")


def describe(triples: DataFrame, resource: str) -> DataFrame:
    """All triples from and to a resource, with the direction."""
    out = triples.where(F.col("s") == resource).select(F.lit("out").alias("direction"), "p", F.col("o").alias("value"))
    return out.unionByName(triples.where(F.col("o") == resource).select(F.lit("in").alias("direction"), "p", F.col("s").alias("value")))


def membership_merge(members: DataFrame, target: str, extractor: str, new: DataFrame) -> DataFrame:
    """Shared triples: (hash, action) when an extractor's result for a target is replaced.

    insert: no member had the triple before; add: others have it; remove: others keep it; delete: the last member left.
    """
    own = members.where((F.col("target") == target) & (F.col("extractor") == extractor)).select("hash").distinct()
    others = members.where(~((F.col("target") == target) & (F.col("extractor") == extractor))).select("hash").distinct().withColumn("other", F.lit(True))
    change = diff(new, own, ["hash"]).where("status != 'retained'").join(others, "hash", "left")
    return change.select("hash", F.when(F.col("status") == "added", F.when(F.col("other"), "add").otherwise("insert")).otherwise(F.when(F.col("other"), "remove").otherwise("delete")).alias("action"))


def valid_triples(triples: DataFrame) -> DataFrame:
    """Triples whose subject, predicate and URI object are valid; labels of blank nodes keep letters and digits only."""
    repair = lambda c: F.when(c.startswith("_:"), F.concat(F.lit("_:"), F.regexp_replace(F.substr(c, F.lit(3)), "[^A-Za-z0-9]", ""))).otherwise(c)
    t = triples.withColumn("s", repair(F.col("s"))).withColumn("o", F.when(F.col("o_kind") == "bnode", repair(F.col("o"))).otherwise(F.col("o")))
    from factweave.functions.text import valid_uri

    node = lambda c: valid_uri(c) | c.rlike("^_:[A-Za-z0-9]+$")
    return t.where(node(F.col("s")) & valid_uri(F.col("p")) & ((F.col("o_kind") == "literal") | node(F.col("o"))))


def statement_filter(predicates: list[str], objects: list[str], ends: tuple = (), kinds: dict[str, str] | None = None, ignored_predicates=(), ignored_objects=(), avoid_cycles: int = 0):
    """A condition on the columns of a path: no ignored predicate or object, no literal object (``kinds`` names the columns that tell).

    ``avoid_cycles`` 1: no object is an end; 2: nor another object.
    """
    out = F.lit(True)
    for p in predicates:
        out = out & ~F.col(p).isin(*ignored_predicates) if ignored_predicates else out
    for i, o in enumerate(objects):
        out = out & ~F.col(o).isin(*ignored_objects) if ignored_objects else out
        if kinds and o in kinds:
            out = out & (F.col(kinds[o]) != "literal")
        for end in ends if avoid_cycles > 0 else ():
            out = out & (F.col(o) != F.lit(end))
        for other in objects[:i] if avoid_cycles > 1 else ():
            out = out & (F.col(o) != F.col(other))
    return out
