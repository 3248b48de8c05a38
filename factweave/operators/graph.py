"""Paths, neighbourhoods, components and hierarchies over an edge table (a, p, b)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, with the direction walked."""
    return edges.select("a", "p", "b", F.lit("forward").alias("dir")).unionByName(edges.select(F.col("b").alias("a"), "p", F.col("a").alias("b"), F.lit("back").alias("dir")))


def paths(edges: DataFrame, start: Column, end: Column, length: int, ignored_predicates=(), ignored_nodes=(), avoid_cycles: bool = True) -> DataFrame:
    """Chains n0 p1 n1 ... of exactly ``length`` edges between nodes for which ``start`` and ``end`` hold.

    ``start`` and ``end`` are conditions on a column named ``node``; both ends are filtered before the joins.
    """
    e = edges.select("a", "p", "b")
    if ignored_predicates:
        e = e.where(~F.col("p").isin(*ignored_predicates))
    if ignored_nodes:
        e = e.where(~F.col("a").isin(*ignored_nodes) & ~F.col("b").isin(*ignored_nodes))
    out = e.withColumnRenamed("a", "node").where(start).withColumnRenamed("node", "n0").withColumnRenamed("p", "p1").withColumnRenamed("b", "n1")
    for k in range(2, length + 1):
        step = e.select(F.col("a").alias(f"n{k - 1}"), F.col("p").alias(f"p{k}"), F.col("b").alias(f"n{k}"))
        out = out.join(step, f"n{k - 1}")
        if avoid_cycles:
            for j in range(k):
                out = out.where(F.col(f"n{j}") != F.col(f"n{k}"))
    out = out.withColumnRenamed(f"n{length}", "node").where(end).withColumnRenamed("node", f"n{length}")
    names = ["n0"] + [x for k in range(1, length + 1) for x in (f"p{k}", f"n{k}")]
    return out.select(*names)


def middle_paths(edges: DataFrame, start: Column, end: Column, length: int, toward: bool = True, **options) -> DataFrame:
    """Pairs of chains from a start and from an end node that meet in a middle node, for all splits of ``length`` edges.

    Rows: n0 (start), m (middle), z (end), left and right (predicates of the two chains), split.  ``toward`` the middle both chains
    follow their edges' direction; away from it, both go against it.  Both ends are bound before anything is joined.
    """
    e = edges if toward else edges.select(F.col("b").alias("a"), "p", F.col("a").alias("b"))
    out = None
    for k in range(1, length):
        x, y = paths(e, start, F.lit(True), k, **options), paths(e, end, F.lit(True), length - k, **options)
        x = x.select("n0", F.col(f"n{k}").alias("m"), F.array(*(f"p{i}" for i in range(1, k + 1))).alias("left"))
        y = y.select(F.col("n0").alias("z"), F.col(f"n{length - k}").alias("m"), F.array(*(f"p{i}" for i in range(1, length - k + 1))).alias("right"))
        part = x.join(y, "m").where("n0 != z").select("n0", "m", "z", "left", "right", F.lit(k).alias("split"))
        out = part if out is None else out.unionByName(part)
    return out


def path_families(edges: DataFrame, start: Column, end: Column, length: int, **options) -> DataFrame:
    """(family, n0, z, trail): direct chains there and back, and chains that meet in the middle, toward it and away from it."""
    names = [x for k in range(1, length + 1) for x in (f"p{k}", f"n{k}")][:-1]
    out = None
    for family, a, b in (("forward", start, end), ("back", end, start)):
        p = paths(edges, a, b, length, **options).select(F.lit(family).alias("family"), "n0", F.col(f"n{length}").alias("z"), F.concat_ws(" ", *names).alias("trail"))
        out = p if out is None else out.unionByName(p)
    for family, toward in (("toward", True), ("away", False)) if length > 1 else ():
        m = middle_paths(edges, start, end, length, toward, **options)
        out = out.unionByName(m.select(F.lit(family).alias("family"), "n0", "z", F.concat_ws(" ", F.concat_ws(" ", "left"), "m", F.concat_ws(" ", "right")).alias("trail")))
    return out


def paths_of(found: DataFrame, types: DataFrame, classes: list[str] = (), predicates: list[str] = ()) -> DataFrame:
    """Paths (n0 p1 n1 ...) whose predicates are all stated ones, and whose inner nodes all have a stated class by types (node, class)."""
    for c in [x for x in found.columns if x[0] == "p"] if predicates else ():
        found = found.where(F.col(c).isin(*predicates))
    inner = sorted((x for x in found.columns if x[0] == "n"), key=lambda x: int(x[1:]))[1:-1]
    for c in inner if classes else ():
        found = found.join(types.where(F.col("class").isin(*classes)).select(F.col("node").alias(c)).distinct(), c, "left_semi")
    return found


def breadth_first(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(node, distance) of all nodes within ``depth`` edges of the starts (node), walking edges (a, b) in their direction.

    A round joins only the nodes reached last, and nodes seen are left out, so an edge is walked once; rounds are checkpointed.
    """
    step = edges.select(F.col("a").alias("node"), F.col("b").alias("_to")).distinct()
    seen = last = written(starts.select("node").distinct().withColumn("distance", F.lit(0)), "starts")
    for k in range(1, depth + 1):
        reached = last.join(step, "node").select(F.col("_to").alias("node")).distinct()
        last = written(reached.join(seen.select("node"), "node", "left_anti").withColumn("distance", F.lit(k)), "reached")
        if last.isEmpty():
            break
        seen = seen.unionByName(last)
    return seen


def deepening(edges: DataFrame, start: Column, end: Column, max_length: int, saved: dict[int, DataFrame] | None = None) -> tuple[int, DataFrame | None]:
    """The least length up to ``max_length`` with a chain, and those chains; lengths found in ``saved`` are not searched again."""
    saved = {} if saved is None else saved
    for length in range(1, max_length + 1):
        if length not in saved:
            saved[length] = written(paths(edges, start, end, length), "paths")
        if not saved[length].isEmpty():
            return length, saved[length]
    return 0, None


def distance_bounds(parents: DataFrame, pairs: DataFrame, max_depth: int = 50) -> DataFrame:
    """(a, b, least, most) of pairs in one tree of parents (name, parent): the difference of depths, and the way over the nearest common ancestor.

    ``most`` counts the nodes of both chains under the common ancestor, less one; a chain that is empty counts one.
    """
    up = written(ancestors(parents, max_depth), "ancestors")
    depth = up.groupBy("name").agg(F.max("depth").alias("d"))
    x, y = up.select(F.col("name").alias("a"), "ancestor", F.col("depth").alias("da")), up.select(F.col("name").alias("b"), "ancestor", F.col("depth").alias("db"))
    near = pairs.join(x, "a").join(y, ["b", "ancestor"]).groupBy("a", "b").agg(F.min(F.struct((F.col("da") + F.col("db")).alias("s"), "da", "db")).alias("m"))
    most = F.greatest(F.col("m.da"), F.lit(1)) + F.greatest(F.col("m.db"), F.lit(1)) - 1
    near = near.join(depth.toDF("a", "ya"), "a").join(depth.toDF("b", "yb"), "b")
    return near.select("a", "b", F.abs(F.col("ya") - F.col("yb")).alias("least"), most.alias("most"))


def best_labels(labels: DataFrame, languages: list[str]) -> DataFrame:
    """labels (s, label, lang): each subject's label in the first preferred language that it has, else in the language that sorts first."""
    rank = F.coalesce(*(F.when(F.col("lang") == x, F.lit(k)) for k, x in enumerate(languages)), F.lit(len(languages)))
    return labels.groupBy("s").agg(F.min_by(F.struct("label", "lang"), F.struct(rank, "lang", "label")).alias("r")).select("s", "r.label", "r.lang")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: by checkpoint, in the folder that the session shares."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            import tempfile

            where = "file://" + tempfile.mkdtemp(prefix=f"factweave-{name}-{uuid.uuid4().hex[:8]}-")
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint()


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, by spreading minima and jumping to the minimum's minimum."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct()
    both = written(both, "edges")
    labels = written(nodes.select("node").distinct().withColumn("component", F.col("node")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["u"], "left").select("node", F.least("component", F.coalesce("near", "component")).alias("c"), F.col("component").alias("old"))
        root = step.select(F.col("node").alias("c"), F.col("c").alias("cc"))
        new = written(step.join(root, "c", "left").select("node", F.least("c", F.coalesce("cc", "c")).alias("component"), "old"), "labels")
        if new.where("component != old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
    raise RuntimeError("components did not settle")


def ancestors(classes: DataFrame, max_depth: int = 50) -> DataFrame:
    """(name, ancestor, depth) from (name, parent), each class its own ancestor at depth 0."""
    view = f"classes_{uuid.uuid4().hex}"
    classes.select("name", "parent").createOrReplaceTempView(view)
    return classes.sparkSession.sql(
        f"""WITH RECURSIVE up(name, ancestor, depth) AS (
            SELECT name, name, 0 FROM {view}
            UNION ALL SELECT up.name, c.parent, up.depth + 1 FROM up JOIN {view} c ON c.name = up.ancestor WHERE c.parent IS NOT NULL AND up.depth < {int(max_depth)})
        SELECT name, ancestor, depth FROM up"""
    )
