"""Sources and sinks on files, streams of record files, and operators that tables of the driver don't reach."""

import bz2
import gzip
import os

from pyspark.sql import functions as F

from factweave.functions import media
from factweave.operators import graph as G
from factweave.sources import readers as S
from factweave.sources import writers as K
from factweave.streaming import records as R

DUMP = """<mediawiki><siteinfo><namespaces><namespace key="0" case="first-letter" /><namespace key="14" case="first-letter">Category</namespace></namespaces></siteinfo>
<page><title>A</title><ns>0</ns><id>1</id><revision><id>10</id><timestamp>2001-01-01T00:00:00Z</timestamp><contributor><username>u</username><id>5</id></contributor><comment>c</comment><text>one</text></revision>
<revision><id>11</id><timestamp>2002-01-01T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><text>two é</text></revision></page>
<page><title>Category:B</title><ns>14</ns><id>2</id><revision><id>12</id><timestamp>2003-01-01T00:00:00Z</timestamp><text>three</text></revision></page></mediawiki>
"""


def test_dumps_plain_and_compressed(spark, tmp_path):
    for name, pack in (("a.xml", lambda b: b), ("a.xml.gz", gzip.compress), ("a.xml.bz2", bz2.compress)):
        (tmp_path / name).write_bytes(pack(DUMP.encode()))
        r = S.revisions(S.read_dump(spark, str(tmp_path / name))).orderBy("rev_id").collect()
        assert [(x["page_id"], x["ns"], x["rev_id"], x["ordinal"]) for x in r] == [(1, 0, 10, 0), (1, 0, 11, 1), (2, 14, 12, 0)]
        assert [x["contributor"]["is_ip"] for x in r] == [False, True, False]


def test_page_elements_and_namespaces(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP)
    pages = [r["value"] for r in S.read_page_elements(spark, str(tmp_path / "d.xml")).collect()]
    assert len(pages) == 2 and all(p.startswith("<page>") and p.endswith("</page>") for p in pages)
    site = spark.read.text(str(tmp_path / "d.xml"), wholetext=True)
    assert {(r["ns"], r["name"]) for r in S.namespaces_of(site).collect()} == {(0, ""), (14, "Category")}


def test_page_directory(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("Berlin.txt", "Ulm#2.txt", "skip.txt"):
        (tmp_path / "in" / name).write_text("text of " + name)
    got = {(r["title"], r["source"]) for r in S.read_page_directory(spark, str(tmp_path / "in"), ("skip.txt",)).collect()}
    assert got == {("Berlin", "text of Berlin.txt"), ("Ulm", "text of Ulm#2.txt")}


def test_sheets_and_settings(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b\n"x, ""y""","two\nlines"\n1,\n')
    assert [tuple(r) for r in S.read_sheet(spark, str(tmp_path / "s.csv")).collect()] == [('x, "y"', "two\nlines"), ("1", None)]
    assert S.read_settings('; remark\nuser = "me "\n[db]\nhost=localhost\n# x\nurl = a=b\n') == {"user": "me ", "db.host": "localhost", "db.url": "a=b"}


def test_compressed_lines_and_tee(spark, tmp_path):
    lines = spark.createDataFrame([("a",), ("é",)], "value string")
    K.tee(lines, [lambda df: K.write_lines(df, str(tmp_path / "gz"), "gzip"), lambda df: K.write_lines(df, str(tmp_path / "bz"), "bzip2"), lambda df: K.write_lines(df, str(tmp_path / "no"))])
    for name, end in (("gz", ".gz"), ("bz", ".bz2"), ("no", ".txt")):
        assert {r["value"] for r in spark.read.text(str(tmp_path / name)).collect()} == {"a", "é"}
        assert any(f.endswith(end) for f in os.listdir(tmp_path / name))


def test_routed_triples_are_written_by_dataset(spark, tmp_path):
    t = spark.createDataFrame([("http://x/a", "http://x/p", "1", "literal", "labels"), ("http://x/b", "http://x/p", "2", "literal", "other")], "s string, p string, o string, o_kind string, extractor_id string")
    S.write_ntriples(K.routed(t, {"labels": "label_set"}, "rest"), str(tmp_path / "out"), by="dataset")
    assert {d for d in os.listdir(tmp_path / "out") if d.startswith("dataset=")} == {"dataset=label_set", "dataset=rest"}
    back = S.read_ntriples(spark, str(tmp_path / "out")).collect()
    assert {r["s"] for r in back} == {"http://x/a", "http://x/b"}


def test_record_files_as_a_stream_to_handlers(spark, tmp_path):
    records = spark.createDataFrame([("r1", "A", "update", "body\nof r1"), ("r2", "B", "delete", None), ("r3", "C", "other", "x")], "identifier string, title string, op string, source string").withColumn("ts", F.lit("2020-01-02 03:04:05").cast("timestamp"))
    (tmp_path / "in").mkdir()
    for r in K.record_files(records).collect():
        (tmp_path / "in" / r["name"]).write_text(r["value"])
    got = {(r["meta"]["identifier"], r["meta"]["op"], r["body"]) for r in S.read_records(spark, str(tmp_path / "in")).collect()}
    assert got == {("r1", "update", "body\nof r1"), ("r2", "delete", ""), ("r3", "other", "x")}
    stream = R.read_record_stream(spark, str(tmp_path / "in"), 1).select(F.regexp_extract("value", "op=(\\w+)", 1).alias("op"))
    seen = {"update": 0, "delete": 0, "rest": 0}

    def count(name):
        def handle(batch, _):
            seen[name] += batch.count()

        return handle

    q = R.fan_out(stream, {"update": count("update"), "delete": count("delete")}, "op", count("rest")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert seen == {"update": 1, "delete": 1, "rest": 1}


def test_catalogues_and_dumps_on_files(spark, tmp_path):
    book = '<pgterms:etext rdf:ID="etext7"><dc:title>A</dc:title></pgterms:etext>'
    (tmp_path / "c.rdf").write_text(f"<rdf:RDF>\n{book}\n{book.replace('7', '8')}\n</rdf:RDF>")
    books = S.read_catalogue(spark, str(tmp_path / "c.rdf"))
    t = S.catalogue_tables(books, S.read_catalogue(spark, str(tmp_path / "c.rdf"), "pgterms:file"))
    assert {(r["text_id"], r["title"], r["created"]) for r in t["texts"].collect()} == {(7, "A", None), (8, "A", None)} and t["files"].isEmpty() and t["creators"].isEmpty()
    (tmp_path / "d.sql").write_text("-- INSERT INTO x\nINSERT INTO `x` VALUES ('a''b', 12, NULL, 'c,\\\\');\ninsert into x (p, q) values ('(',-1.5,'',''),('NULL',0,null,'z');\nINSERT INTO y VALUES (1);\n")
    rows = S.inserted_rows(spark.read.text(str(tmp_path / "d.sql")), "x", ["p", "q", "r", "s"]).collect()
    assert {tuple(r) for r in rows} == {("a'b", "12", None, "c,\\"), ("(", "-1.5", "", ""), ("NULL", "0", None, "z")}


def test_oldest_record_and_single_page(spark, tmp_path):
    for k, name in enumerate(("b", "a", "c")):
        (tmp_path / name).write_text(name * 3)
        os.utime(tmp_path / name, (1000 + k, 1000 + k))
    assert tuple(S.oldest_record(spark, str(tmp_path)).first()) == ("b", "bbb")
    assert tuple(S.single_page(spark, "T", "{{x}}").first()) == (0, "T", 0, "{{x}}")


def test_statements_by_subject_in_several_folders(spark, tmp_path):
    rows = spark.createDataFrame([("http://x/a", "one"), ("http://x/a", "two"), ("http://x/b/c", "three")], "s string, value string")
    paths = [str(tmp_path / "1"), str(tmp_path / "2")]
    K.write_by_subject(rows, paths)
    for p in paths:
        got = spark.read.option("recursiveFileLookup", True).text(p).select("value", "_metadata.file_path").collect()
        assert len(got) == 3 and len({r["file_path"] for r in got}) == 2


def test_breadth_first_ends_where_nothing_new_is_reached(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("x", "y"), ("c", None)], "a string, b string")
    got = {tuple(r) for r in G.breadth_first(e.where("b is not null"), spark.createDataFrame([("a",)], "node string"), 9).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2)}


def test_chained_sources(spark):
    a = spark.range(2).toDF("x")
    assert R.chained(a, a).count() == 4


def test_edit_statistics_count_renewals(spark):
    rows = spark.createDataFrame([("p", "2020-01-01 00:01:00"), ("p", "2020-01-01 00:02:00"), ("q", "2020-01-01 00:03:00")], "key string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    start = lambda renew: {(r["edits"], r["pages"]) for r in R.edit_statistics(rows, renew=renew).collect()}
    assert start(False) == {(2, 2)} and start(True) == {(3, 2)}


def test_page_lines_are_whole_elements(spark, tmp_path):
    r = spark.createDataFrame([(k % 3, f"t{k % 3}", k, k, f"text {k}") for k in range(12)], "page_id long, title string, ordinal long, rev_id long, text string").withColumn("ts", F.lit(None).cast("timestamp"))
    K.page_export_lines(r).select("value").write.text(str(tmp_path / "x"))
    for f in (tmp_path / "x").glob("part-*"):
        text = f.read_text()
        assert text.count("<page>") == text.count("</page>") and (not text or text.startswith("<page>"))


def test_media_types():
    assert media.best_variant("a/b,c/d", ["a/b;q=0.6", "c/d;q=0.8"]) == "c/d"
    assert media.best_variant("a/b;q=0.6,c/d;q=0.8", ["a/b", "c/d"]) == "c/d"
    assert media.best_variant("text/*;q=0.5,text/html;level=1", ["text/html", "text/html;level=1;q=0.9"]) == "text/html"
    assert media.best_variant("nonsense", ["a/b"]) is None and media.parse_range("*/b") is None


def test_deepening_reads_saved_lengths(spark):
    e = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c")], "a string, p string, b string")
    saved = {}
    assert G.deepening(e, F.col("node") == "a", F.col("node") == "c", 3, saved)[0] == 2 and sorted(saved) == [1, 2]
    saved[1] = spark.createDataFrame([("a", "q", "c")], "n0 string, p1 string, n1 string")
    assert G.deepening(e, F.col("node") == "a", F.col("node") == "c", 3, saved)[0] == 1
    assert G.deepening(e, F.col("node") == "c", F.col("node") == "a", 2) == (0, None)


def test_rows_are_counted_on_the_way(spark):
    from factweave.operators import dumps as D

    rows, seen = D.counted(spark.range(100), "pages", even=F.col("id") % 2 == 0)
    assert rows.where("id < 10").count() == 10
    assert seen.get == {"rows": 100, "even": 50}


def test_currencies_are_one_a_code():
    from factweave.functions import units as U

    assert len(U.WORLD_CURRENCIES) + len(U.CURRENCIES) > 150 and U.WORLD_CURRENCIES["polishZloty"] == "PLN|Polish zloty"


def test_rule_tables_too_large_to_broadcast(spark, monkeypatch):
    from factweave.operators import mapping

    cells = spark.createDataFrame([(k, "t" if k % 3 else "u") for k in range(60)], "page_id long, template string")
    rules = spark.createDataFrame([("t", 1), ("t", 2)], "template string, rule int")
    small = sorted(map(tuple, mapping.with_rules(cells, rules, ["template"], "left").collect()), key=str)
    monkeypatch.setattr(mapping, "SMALL_ROWS", 1)
    assert sorted(map(tuple, mapping.with_rules(cells, rules, ["template"], "left").collect()), key=str) == small
