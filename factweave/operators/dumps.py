"""Filters of page and revision dumps, as conditions and semi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions.text import NAMESPACES


def namespace_filter(ns: Column, config: str) -> Column:
    """Comma-separated names or numbers; a leading ``!`` inverts."""
    invert, names = config.startswith("!"), config.lstrip("!").split(",")
    keys = [int(n) if n.strip().lstrip("-").isdigit() else 0 if n.strip().lower() in ("", "main") else NAMESPACES[n.strip().lower().replace("_", " ").removeprefix("ns ")] for n in names]
    return ~ns.isin(*keys) if invert else ns.isin(*keys)


def not_talk(ns: Column) -> Column:
    return (ns < 0) | (ns % 2 == 0)


def latest(revisions: DataFrame, page: str, ordinal: str) -> DataFrame:
    """Each page's last revision in stream order, whatever its time stamp."""
    rest = [c for c in revisions.columns if c not in (page, ordinal)]
    best = revisions.groupBy(page).agg(F.max_by(F.struct(ordinal, *rest), ordinal).alias("r"))
    return best.select(page, f"r.{ordinal}", *(f"r.{c}" for c in rest))


def title_matches(title: Column, regex: str) -> Column:
    return title.rlike(f"^(?:{regex})$")


def in_list(pages: DataFrame, titles: DataFrame, subject: Column, key: str = "title") -> DataFrame:
    """Pages whose subject title is listed: a page and its talk twin pass together."""
    return pages.withColumn("_k", subject).join(titles.select(F.col(key).alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def listed_revisions(revisions: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return revisions.join(ids.select(key).distinct(), key, "left_semi")


def page_type(ns: Column, title: Column, deleted: Column) -> Column:
    return F.when(deleted, "deleted").when((ns == 10) & title.endswith("/doc"), "10/doc").otherwise(ns.cast("string"))


def stream_filter(ns: Column, title: Column, project: str) -> Column:
    """Articles, templates, categories, and the project's own user pages."""
    return ns.isin(0, 10, 14) | ((ns == 2) & title.startswith(project))


def counted(rows: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, object]:
    """The rows, unchanged, and an observation with their number and that of each condition, filled when an action has run.

    Counting rides on the action: no job of its own, no row passes the driver.
    """
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in conditions.items())), seen


#: Namespaces of schema pages (fixed values).
SCHEMA_NAMESPACES = (200, 202)


def schema_filter(ns: Column, namespaces=SCHEMA_NAMESPACES) -> Column:
    """Pages of the ontology's own namespaces."""
    return ns.isin(*namespaces)


def accept_all() -> Column:
    return F.lit(True)


def template_filter(name: Column, accepted: list[str] = (), ignored: list[str] = (), also: list[Column] = ()) -> Column:
    """Names (or patterns with ``*``) that pass: accepted if any are stated, not ignored, and under all further conditions."""
    def fits(patterns):
        return F.lower(name).rlike("^(?:" + "|".join(".*".join(_quoted(x) for x in p.lower().split("*")) for p in patterns) + ")$")

    out = fits(accepted) if accepted else F.lit(True)
    out = out & ~fits(ignored) if ignored else out
    for c in also:
        out = out & c
    return out


def _quoted(text: str) -> str:
    return "".join("\\" + ch if ch in "\\^$.|?*+()[]{}" else ch for ch in text)
