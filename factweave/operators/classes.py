"""Categories as classes: which categories name classes, their superclasses, and the classes of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.operators.graph import written

EXCLUDED, CLASS, PLAIN = 2, 1, 0


def category_classes(categories: DataFrame, memberships: DataFrame, patterns: list[str], whitelist: tuple[str, ...] = ()) -> DataFrame:
    """(category, kind): 2 if the title fits an excluded LIKE pattern, 1 if it has articles or is listed, else 0; the list wins."""
    out = F.lit(False)
    for p in patterns:
        out = out | F.col("category").like(p)
    held = memberships.select("category").distinct().withColumn("_has", F.lit(True))
    listed = F.col("category").isin(*whitelist) if whitelist else F.lit(False)
    kind = F.when(listed, CLASS).when(out, EXCLUDED).when(F.col("_has"), CLASS).otherwise(PLAIN)
    return categories.select("category").distinct().join(held, "category", "left").select("category", kind.alias("kind"))


def nearest_classes(starts: DataFrame, links: DataFrame, kinds: DataFrame, depth: int) -> DataFrame:
    """(item, class, steps): the nearest class categories above each of ``starts`` (item, category), after at most ``depth`` links (child, parent).

    The search of an item goes on above categories that are no class, and stops above one that is.
    """
    up = links.select(F.col("child").alias("category"), "parent").distinct()
    front = written(starts.select("item", "category").distinct(), "front")
    found = None
    for step in range(depth + 1):
        known = front.join(kinds, "category", "left")
        hit = known.where(F.col("kind") == CLASS).select("item", F.col("category").alias("class"), F.lit(step).alias("steps"))
        found = hit if found is None else found.unionByName(hit)
        if step == depth:
            break
        rest = known.where("kind is null or kind != 1").select("item", "category")
        front = written(rest.join(up, "category").select("item", F.col("parent").alias("category")).distinct(), "front")
        if front.isEmpty():
            break
    return found.groupBy("item", "class").agg(F.min("steps").alias("steps"))


def superclasses(kinds: DataFrame, links: DataFrame, depth: int = 10, root: str = "Thing") -> DataFrame:
    """(class, superclass): the nearest classes above each class within ``depth`` links, else the root."""
    classes = kinds.where(F.col("kind") == CLASS).select("category")
    starts = classes.join(links, classes["category"] == links["child"]).select(F.col("child").alias("item"), F.col("parent").alias("category"))
    near = nearest_classes(starts, links, kinds, depth - 1).where("item != class").select(F.col("item").alias("category"), "class")
    return classes.join(near, "category", "left").select(F.col("category").alias("class"), F.coalesce("class", F.lit(root)).alias("superclass"))


def article_classes(memberships: DataFrame, links: DataFrame, kinds: DataFrame, depth: int = 3) -> DataFrame:
    """(article, class): the nearest classes of the categories of each article within ``depth`` links."""
    return nearest_classes(memberships.select(F.col("article").alias("item"), "category"), links, kinds, depth).select(F.col("item").alias("article"), "class")
