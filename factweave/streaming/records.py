"""Update records as a stream: deduplication, delay window, merge into a triple table, throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def deduplicate(records: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Repeats of an identifier at the same time stamp go; a later one passes.  State is dropped behind the watermark."""
    return records.withWatermark("ts", late).dropDuplicatesWithinWatermark(["identifier", "ts"])


def deduplicate_batch(records: DataFrame) -> DataFrame:
    return records.dropDuplicates(["identifier", "ts"])


def throughput(records: DataFrame, width: str = "10 minutes") -> DataFrame:
    return records.groupBy(F.window("ts", width)).agg(F.count(F.lit(1)).alias("n"))


def delayed(records: DataFrame, delay_seconds: int, late: str = "0 seconds", renew: bool = True) -> DataFrame:
    """records (key, ts, payload): each key's latest payload, released when the watermark is ``delay_seconds`` past it.

    With ``renew`` a re-arrival starts the wait anew, else the first arrival's time counts.  What is held when the
    input ends is not released.
    """
    state = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("payload", T.StringType())])

    def hold(key, batches, group):
        import pandas as pd

        if group.hasTimedOut:
            ts, payload = group.get
            group.remove()
            yield pd.DataFrame({"key": [key[0]], "ts": [ts], "payload": [payload]})
            return
        best = group.get if group.exists else None
        for pdf in batches:
            pdf = pdf.sort_values("ts", kind="stable")
            if len(pdf):
                first, last = pdf.iloc[0], pdf.iloc[-1]
                held = best[0] if best else first["ts"]
                best = ((max(last["ts"], pd.Timestamp(best[0])) if best else last["ts"]) if renew else held, last["payload"])
        ts = pd.Timestamp(best[0])
        group.update((ts.to_pydatetime(), best[1]))
        due = int(ts.timestamp() * 1000) + delay_seconds * 1000
        group.setTimeoutTimestamp(max(due, group.getCurrentWatermarkMs() + 1))
        return
        yield

    marked = records.withWatermark("ts", late).select("key", "ts", "payload")
    return marked.groupBy("key").applyInPandasWithState(hold, "key string, ts timestamp, payload string", state, "append", "EventTimeTimeout")


def hash_merge(state: DataFrame, new: DataFrame, active: list[str], kept: list[str] = ()) -> DataFrame:
    """(page, extractor, hash, action) when the triples of pages that changed replace the stored ones.

    ``state`` and ``new`` have page, extractor, hash.  Pages not in ``new`` are untouched; extractors in ``kept`` keep their old rows.
    """
    pages = new.select("page").distinct()
    old = state.join(pages, "page", "left_semi").where(~F.col("extractor").isin(*kept)) if kept else state.join(pages, "page", "left_semi")
    fresh = new.where(F.col("extractor").isin(*active)) if active else new
    a, b = fresh.select("page", "extractor", "hash").distinct().withColumn("a", F.lit(1)), old.select("page", "extractor", "hash").distinct().withColumn("b", F.lit(1))
    joined = a.join(b, ["page", "extractor", "hash"], "full_outer")
    return joined.select("page", "extractor", "hash", F.when(F.col("b").isNull(), "add").when(F.col("a").isNull(), "delete").otherwise("keep").alias("action"))


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after a merge."""
    gone = changes.where("action = 'delete'").select("page", "extractor", "hash")
    added = changes.where("action = 'add'").select("page", "extractor", "hash")
    return state.select("page", "extractor", "hash").join(gone, ["page", "extractor", "hash"], "left_anti").unionByName(added)


def read_record_stream(spark, path: str, files_a_trigger: int = 1000, delete: bool = False, archive: str | None = None) -> DataFrame:
    """Record files as a stream, oldest first, so many a trigger; files that are done can be deleted or moved."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_a_trigger).option("latestFirst", False).option("wholetext", True)
    if delete or archive:
        reader = reader.option("cleanSource", "archive" if archive else "delete")
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.text(path, wholetext=True)


def fan_out(records: DataFrame, handlers: dict, by: str, default=None):
    """A function for ``foreachBatch``: each category's rows to its handler, others to ``default``; the batch is computed once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for category, handler in handlers.items():
                handler(held.where(F.col(by) == category), batch_id)
            if default is not None:
                default(held.where(~F.col(by).isin(*handlers) | F.col(by).isNull()), batch_id)
        finally:
            held.unpersist()

    return records.writeStream.foreachBatch(handle)


def chained(*streams: DataFrame) -> DataFrame:
    """Several sources of one shape as one."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def replace_pages(state: DataFrame, new: DataFrame, page: str = "page") -> DataFrame:
    """The simple update: all rows of the pages that are new go, theirs are put in; other pages stay as they are."""
    return state.join(new.select(page).distinct(), page, "left_anti").unionByName(new.select(*state.columns))


def edit_statistics(records: DataFrame, width: str = "10 minutes", slide: str = "5 minutes", renew: bool = False) -> DataFrame:
    """(start, edits, pages) of sliding windows of records (key, ts): all edits, and each page once a window.

    Without ``renew`` a page's edits within ``width`` of its first edit in a tumbling window of that width count as one.
    """
    if not renew:
        records = records.groupBy("key", F.window("ts", width)).agg(F.min("ts").alias("ts")).select("key", "ts")
    return records.groupBy(F.window("ts", width, slide)).agg(F.count(F.lit(1)).alias("edits"), F.count_distinct("key").alias("pages")).select(F.col("window.start").alias("start"), "edits", "pages")
