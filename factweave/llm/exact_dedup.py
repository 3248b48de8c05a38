"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

New rows are reduced to one row per digest, sort-merge anti-joined with the index (whose bucketing
saves that side the shuffle and the sort), and the digests not seen before are appended.  Only DataFrame operations
run.  A document's row never travels with its text: 32-byte digests do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RE, fresh, scratch, stash, text_or_empty

#: A group of copies may hold a third of all rows: its rows are dealt over so many sub-keys.
SALTS = 64
#: Buckets of an index that is made without a number.
BUCKETS = 64


def normalised(text="text"):
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_RE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the SHA-256 of the normalised text, and the sub-key of the row."""
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )


def groups_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group of the keys: ``first_id`` (smallest doc_id), ``n_rows`` and the ``salts`` that occur.

    Rows are counted by (keys, salt) first, so a group of any size reaches no task as a whole: the second step sees at
    most SALTS rows a group.
    """
    by_salt = rows.groupBy(*keys, "salt").agg(F.min("doc_id").alias("m"), F.count(F.lit(1)).alias("n"))
    return by_salt.groupBy(*keys).agg(F.min("m").alias("first_id"), F.sum("n").alias("n_rows"), F.collect_list("salt").alias("salts"))


class DigestIndex:
    """The digests kept so far: a table of (digest, keep_id), bucketed and sorted by digest.

    It lives at ``path`` in the shared folder, so another session opens it again.  The number of buckets is part of the
    data and kept beside it: an index that exists is opened with its own number, and ``buckets`` must be left out or equal.
    ``add`` may be repeated after a failure: digests already appended are found by the anti-join.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        held = self._stored()
        if held is None:
            held = int(buckets or BUCKETS)
            spark.createDataFrame([(held,)], "buckets int").coalesce(1).write.parquet(f"{path}/_buckets")  # files of such names are no part of the table
        elif buckets is not None and buckets != held:
            raise ValueError(f"the index at {path} has {held} buckets, not {buckets}")
        self.buckets = held
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {held} BUCKETS LOCATION '{path}'"
        )

    def _stored(self) -> int | None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_buckets/_SUCCESS")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return None
        return self.spark.read.parquet(f"{self.path}/_buckets").first()[0]

    def close(self) -> None:
        """Forget the table's name in this session's catalog; the data stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` that the index lacks, each with its smallest doc_id."""
        new = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        known = self.table().select(F.col("digest").alias("known")).hint("merge")
        # the count in the condition keeps the join above the aggregate, where each digest is one row
        (
            new.join(known, (F.col("digest") == F.col("known")) & (F.col("n") > 0), "left_anti")
            .drop("n")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def judge(self, rows: DataFrame) -> DataFrame:
        """rows (doc_id, digest, salt) with keep_id, group_size and kept.

        keep_id is the index's id of the digest, or else the smallest of the rows; call it after ``add``.
        """
        # one row a digest meets the index; only then its salts are dealt out again
        groups = groups_of(rows, ["digest"]).join(self.table().hint("merge"), "digest").withColumn("salt", F.explode("salts")).drop("salts")
        return (
            rows.join(groups, ["digest", "salt"])
            .select(
                "doc_id",
                F.coalesce("keep_id", "first_id").alias("keep_id"),
                F.col("n_rows").alias("group_size"),
                F.lower(F.hex("digest")).alias("text_sha256"),
            )
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)))
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Judge every row: doc_id, keep_id, group_size, text_sha256, kept.

    Null texts count as empty and are equal to texts that are empty; a text of white space only is one space.  Rows that
    repeat a doc_id with an equal text are all marked kept if that id is the smallest: ``survivors`` leaves
    one of them.  Null doc_ids are never the smallest; a group of null ids only has keep_id null and none
    kept.  An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    own = index is None
    if own:
        index = DigestIndex(spark, scratch(spark, "digests"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stash(digests(docs), "digests")  # some 50 bytes a row, so that texts are read and hashed once
    index.add(rows)
    judged = index.judge(rows)
    if own:
        index.close()
    return judged


def survivors(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; of rows repeating id and text one stays.

    Of equal texts without any doc_id one row stays, too.
    """
    count, text = fresh(docs, "count"), fresh(docs, "normal")
    judged = exact_dedup(docs, index)
    ids = judged.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias(count))
    kept = docs.join(ids.hint("merge"), "doc_id")
    once = kept.where(F.col(count) == 1).drop(count)
    again = kept.where(F.col(count) > 1).drop(count).withColumn(text, normalised()).dropDuplicates(["doc_id", text]).drop(text)
    # groups in which no row has an id
    nameless = judged.where("keep_id is null").select(F.col("text_sha256").alias(text)).distinct()
    hashed = docs.where("doc_id is null").withColumn(text, F.sha2(normalised().cast("binary"), 256))
    nameless = hashed.join(nameless.hint("merge"), text, "left_semi").dropDuplicates([text]).drop(text)
    return once.unionByName(again).unionByName(nameless).select(*docs.columns)
