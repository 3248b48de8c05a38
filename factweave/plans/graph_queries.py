"""Paths and components over the star schema as a graph of resources."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.operators import graph as G
from factweave.plans.registry import query, table

_EDGES = """edges AS (SELECT 'o' || o_orderkey AS a, 'customer' AS p, 'c' || o_custkey AS b FROM orders
    UNION ALL SELECT 'c' || c_custkey, 'nation', 'n' || c_nationkey FROM customer
    UNION ALL SELECT 'n' || n_nationkey, 'region', 'r' || n_regionkey FROM nation
    UNION ALL SELECT 's' || s_suppkey, 'nation', 'n' || s_nationkey FROM supplier)"""


def edges(spark, d):
    def of(name, a, p, b):
        (ka, ca), (kb, cb) = a, b
        return table(spark, d, name).select(F.concat(F.lit(ka), ca).alias("a"), F.lit(p).alias("p"), F.concat(F.lit(kb), cb).alias("b"))

    parts = [of("orders", ("o", "o_orderkey"), "customer", ("c", "o_custkey")), of("customer", ("c", "c_custkey"), "nation", ("n", "c_nationkey")), of("nation", ("n", "n_nationkey"), "region", ("r", "n_regionkey")), of("supplier", ("s", "s_suppkey"), "nation", ("n", "s_nationkey"))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("p1_direct_paths", f"WITH {_EDGES} SELECT x.a AS n0, x.p AS p1, x.b AS n1, y.p AS p2, y.b AS n2, z.p AS p3, z.b AS n3 FROM edges x JOIN edges y ON x.b = y.a JOIN edges z ON y.b = z.a WHERE x.a LIKE 'o%' AND z.b LIKE 'r%'")
def p1(spark, d):
    return G.paths(edges(spark, d), F.col("node").startswith("o"), F.col("node").startswith("r"), 3)


@query("p4_symmetric_hops", f"WITH {_EDGES}, s AS (SELECT a, p, b FROM edges UNION ALL SELECT b, p, a FROM edges) SELECT x.a AS n0, x.p AS p1, x.b AS n1, y.p AS p2, y.b AS n2 FROM s x JOIN s y ON x.b = y.a WHERE x.a = 's1' AND y.b <> x.a AND x.b <> x.a AND y.b <> x.b AND y.b NOT LIKE 'c%'")
def p4(spark, d):
    return G.paths(G.symmetric(edges(spark, d)), F.col("node") == "s1", ~F.col("node").startswith("c"), 2)


@query("p8_symmetric_closure", f"WITH {_EDGES} SELECT dir, count(*) AS n FROM (SELECT 'forward' AS dir FROM edges WHERE p <> 'region' UNION ALL SELECT 'back' FROM edges WHERE p <> 'region') GROUP BY dir")
def p8(spark, d):
    return G.symmetric(edges(spark, d).where("p != 'region'")).groupBy("dir").agg(F.count(F.lit(1)).alias("n"))


@query("p6_components", "SELECT 'n' || n_nationkey AS node, min('n' || n_nationkey) OVER (PARTITION BY n_regionkey) AS component FROM nation")
def p6(spark, d):
    """Nations chained within their region."""
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node"), "n_regionkey", "n_nationkey")
    nxt = n.select(F.col("node").alias("b"), "n_regionkey", F.col("n_nationkey").alias("k"))
    e = n.join(nxt, "n_regionkey").where("k > n_nationkey").groupBy(F.col("node").alias("a")).agg(F.min_by("b", "k").alias("b"))
    return G.components(n, e)


@query("p9_e21_ancestors", """WITH RECURSIVE c AS (SELECT n_name AS name, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'Thing' FROM region UNION ALL SELECT 'Thing', NULL),
    up(name, ancestor, depth) AS (SELECT name, name, 0 FROM c UNION ALL SELECT up.name, c.parent, up.depth + 1 FROM up JOIN c ON c.name = up.ancestor WHERE c.parent IS NOT NULL) SELECT * FROM up""")
def p9(spark, d):
    r = table(spark, d, "region")
    c = table(spark, d, "nation").join(r, F.expr("n_regionkey = r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("parent"))
    c = c.unionByName(r.select(F.col("r_name").alias("name"), F.lit("Thing").alias("parent"))).unionByName(spark.createDataFrame([("Thing", None)], "name string, parent string"))
    return G.ancestors(c)


@query("p13_breadth_first", f"WITH RECURSIVE {_EDGES}, e AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), r(node, distance) AS (SELECT 's1', 0 UNION SELECT e.b, r.distance + 1 FROM r JOIN e ON e.a = r.node WHERE r.distance < 3) SELECT node, min(distance) AS distance FROM r GROUP BY node")
def p13(spark, d):
    """What lies within three edges of a supplier, either way."""
    return G.breadth_first(G.symmetric(edges(spark, d)), spark.createDataFrame([("s1",)], "node string"), 3)


@query("p13_paths_of_classes", f"WITH {_EDGES} SELECT x.a AS n0, x.p AS p1, x.b AS n1, y.p AS p2, y.b AS n2 FROM edges x JOIN edges y ON x.b = y.a JOIN customer ON x.b = 'c' || c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND x.a LIKE 'o%'")
def p13_classes(spark, d):
    """Orders to nations over customers of two segments."""
    types = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.col("c_mktsegment").alias("class"))
    found = G.paths(edges(spark, d), F.col("node").startswith("o"), F.lit(True), 2)
    return G.paths_of(found, types, ["BUILDING", "MACHINERY"], ["customer", "nation"])


@query("g1_wikitext_nodes")
def g1(spark, d):
    """Documents as pages of markup: a section, a template with links, and the text."""
    from factweave.operators.wikitext import parse_pages

    source = F.concat(F.lit("== Head ==\n{{Infobox doc\n| lang = "), "lang", F.lit("\n| source = [["), "source", F.lit("|the source]]\n}}\n"), F.col("text"))
    pages = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.col("source").alias("title"), F.regexp_replace(source, r"[{\[|]{2,}(?=[^Is])", " ").alias("source"))
    return parse_pages(pages)
