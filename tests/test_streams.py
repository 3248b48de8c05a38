import uuid

from pyspark.sql import functions as F

from factweave.sources import readers
from factweave.streaming import records as R


def run(spark, stream, tmp_path):
    name = "q" + uuid.uuid4().hex
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def write(spark, rows, schema, path, k):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{k}")


def test_dedup_stream_equals_batch(spark, tmp_path, small):
    e = spark.read.parquet(f"{small}/events.parquet").select(F.col("user_id").cast("string").alias("identifier"), F.date_trunc("hour", "ts").alias("ts"))
    e.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    got = run(spark, R.deduplicate(stream, "10 days"), tmp_path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, R.deduplicate_batch(e).collect()))


def test_delay_window_releases_the_latest(spark, tmp_path):
    import datetime as dt

    t = lambda s: dt.datetime(2020, 1, 1) + dt.timedelta(seconds=s)
    schema, path = "key string, ts timestamp, payload string", str(tmp_path / "in")
    for k, rows in enumerate([[("a", t(0), "a1"), ("b", t(1), "b1")], [("a", t(5), "a2")], [("c", t(60), "c1")], [("d", t(120), "d1")]]):
        write(spark, rows, schema, path, k)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    got = {r["key"]: r["payload"] for r in run(spark, R.delayed(stream, 30), tmp_path).collect()}
    assert got["a"] == "a2" and got["b"] == "b1" and "d" not in got


def test_hash_merge_applies(spark):
    schema = "page int, extractor string, hash string"
    old = spark.createDataFrame([(1, "x", "h1"), (1, "x", "h2"), (1, "k", "h9"), (2, "x", "h3")], schema)
    new = spark.createDataFrame([(1, "x", "h2"), (1, "x", "h4")], schema)
    changes = R.hash_merge(old, new, ["x"], ["k"])
    after = {tuple(r) for r in R.apply_changes(old, changes).collect()}
    assert after == {(1, "x", "h2"), (1, "x", "h4"), (1, "k", "h9"), (2, "x", "h3")}


def test_dump_reader(spark, tmp_path):
    (tmp_path / "d.xml").write_text(
        """<mediawiki><page><title>A</title><ns>0</ns><id>1</id>
        <revision><id>10</id><timestamp>2009-01-01T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><text>old</text></revision>
        <revision><id>11</id><timestamp>2008-01-01T00:00:00Z</timestamp><contributor><username>U</username><id>5</id></contributor><minor/><comment>c</comment><text>new</text></revision>
        </page></mediawiki>"""
    )
    rows = readers.revisions(readers.read_dump(spark, str(tmp_path / "d.xml"))).orderBy("ordinal").collect()
    assert [(r["rev_id"], r["text"], r["contributor"]["is_ip"]) for r in rows] == [(10, "old", True), (11, "new", False)]


def test_flagged_tsv_and_records(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("geo\t2001\t2002\nDE\t1.5 b\t:\nFR\t\t7\n")
    got = {r[0]: (r[1], r[2]) for r in readers.read_flagged_tsv(spark, str(tmp_path / "t.tsv")).collect()}
    assert got == {"DE": (1.5, None), "FR": (None, 7.0)}
    (tmp_path / "rec").mkdir()
    (tmp_path / "rec/1").write_text("title=A\nid=3\n**********\nbody\ntext")
    r = readers.read_records(spark, str(tmp_path / "rec")).first()
    assert r["meta"] == {"title": "A", "id": "3"} and r["body"] == "body\ntext"


def test_ntriples_files(spark, tmp_path):
    t = spark.createDataFrame([("http://a/s", "http://a/p", "v", "literal", "one")], "s string, p string, o string, o_kind string, dataset string")
    readers.write_ntriples(t, str(tmp_path / "nt"), "dataset")
    assert readers.read_ntriples(spark, str(tmp_path / "nt/dataset=one")).first()["o"] == "v"
