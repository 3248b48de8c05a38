"""Tables of pages as pseudo templates: headers are matched with keywords, rows become property values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def headers(cells: DataFrame) -> DataFrame:
    """(page_id, table_id, row, col, header) of cells (page_id, table_id, row, col, text): the first of a table's first two rows with several cells."""
    early = cells.where("row < 2")
    width = early.groupBy("page_id", "table_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("page_id", "table_id").agg(F.min("row").alias("row"))
    return early.join(width, ["page_id", "table_id", "row"]).where("trim(text) != ''").select("page_id", "table_id", "row", "col", F.trim("text").alias("header"))


def pseudo_templates(cells: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """(page_id, table_id, row, key, value): the data rows of tables whose header has every key of ``mapping``.

    A key stands for keywords that are joined by ``&`` where all must be in one header cell.  A cell fits a key by the keyword that begins
    earliest in it, of those the one with most parts, of those the one that ends first.
    """
    head = headers(cells)
    fits = []
    for key, words in mapping.items():
        for word in words:
            parts = [w.strip().lower() for w in word.split("&")]
            at = [F.position(F.lit(w), F.lower("header")) for w in parts]
            every = at[0] > 0
            for a in at[1:]:
                every = every & (a > 0)
            end = F.greatest(*(a + len(w) for a, w in zip(at, parts))) if len(at) > 1 else at[0] + len(parts[0])
            begin = F.least(*at) if len(at) > 1 else at[0]
            fits.append(F.when(every, F.struct(F.lit(key).alias("key"), begin.alias("begin"), F.lit(-len(parts)).alias("less"), end.alias("end"))))
    each = head.select("page_id", "table_id", F.col("row").alias("head"), "col", F.explode(F.array_compact(F.array(*fits))).alias("f")).select("page_id", "table_id", "head", "col", "f.*")
    # one column a key, one key a column
    order = F.struct("begin", "less", "end", "col")
    best = each.groupBy("page_id", "table_id", "head", "key").agg(F.min_by("col", order).alias("col"))
    whole = best.groupBy("page_id", "table_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(mapping)).drop("n")
    columns = best.join(whole, ["page_id", "table_id"])
    rows = cells.join(columns, ["page_id", "table_id", "col"]).where("row > head and trim(text) != ''")
    return rows.select("page_id", "table_id", "row", "key", F.trim("text").alias("value"))
