"""Infobox, mapping, extractor, sink and expression operators on their edge cases."""

import pytest
from pyspark.sql import functions as F

from factweave.functions import cascade as C
from factweave.functions import units as U
from factweave.operators import expressions as X
from factweave.operators import extractors as E
from factweave.operators import infobox as I
from factweave.operators import mapping as M
from factweave.plans import mapping_queries as Q
from factweave.sources import writers as K

PAGES = "page_id long, title string, ns int, source string"


def values(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    rows = df.select("k", C.typed_values(F.col("t"), F.lit("en"), "x:").alias("v")).orderBy("k").collect()
    return [[(v.o, v.o_kind, (v.datatype or "").rpartition("#")[2]) for v in r.v] for r in rows]


def test_cascade(spark):
    got = values(spark, None, "  \n", "42", "1,270,000", "134.34", "May 2004", "[[1999]]", "3rd", "3 million", "$1.2 million", "12.5 %", "10 km (4000 in)", "6 ft 2 in", "[[a b|c]]", "[[a]], [[b]], [[a]]", "12,000 (2004)", "''x'' y")
    assert got == [
        [], [], [("42", "literal", "integer")], [("1270000", "literal", "integer")], [("134.34", "literal", "decimal")], [("2004-05", "literal", "gYearMonth")], [("1999", "literal", "gYear")], [("3", "literal", "rank")],
        [("3000000", "literal", "integer")], [("1200000", "literal", "usDollar")], [("12.5", "literal", "percent")], [("10", "literal", "kilometre")], [("187.96", "literal", "centimetre")], [("x:A_b", "uri", "")],
        [("x:A", "uri", ""), ("x:B", "uri", "")], [("12000", "literal", "integer")], [("x y", "literal", "")],
    ]


def test_units_by_rule_and_listed():
    assert U.UNITS["squareKilometre"][1] == 1e6 and U.UNITS["kilowattHour"][1] == pytest.approx(3.6e6) and U.UNITS["cubicCentimetre"][1] == pytest.approx(1e-6)
    assert U.labels("Time")["m"] == "minute" and U.labels("Length")["m"] == "metre" and len({d for d, _, _ in U.UNITS.values()}) == 19


def test_coordinates(spark):
    df = spark.createDataFrame([("{{coor title dm|47|25|N|8|10|E|region:CH-AG}}",), ("{{coord|-47.5|8.5}}",), ("{{coord|99|N|8|E}}",), ("none",), (None,)], "t string")
    got = [r.c and (round(r.c.lat, 10), round(r.c.lon, 10)) for r in df.select(C.coordinates(F.col("t")).alias("c")).collect()]
    assert got == [(47.4166666667, 8.1666666667), (-47.5, 8.5), None, None, None]


def test_nested_and_repeated_templates(spark):
    pages = spark.createDataFrame([(1, "p", 0, "{{a|x=1|y={{b|z=2}} {{b|z=3}}}} {{q|1}} {{q|2}} <!-- {{c|d=1}} -->"), (2, "broken", 0, "{{x"), (3, "none", 0, None), (4, "", 0, "")], PAGES)
    rows = I.template_properties(pages)
    assert sorted((r.page_id, r.subject, r.template, r.key, r.value) for r in rows.where("error is null").collect()) == [
        (1, "", "a", "x", "1"), (1, "", "a", "y", ""), (1, "/q1", "q", "1", "1"), (1, "/q2", "q", "1", "2"), (1, "/y/b", "b", "z", "2"), (1, "/y/b1", "b", "z", "3"),
    ]
    assert [r.page_id for r in rows.where("error is not null").collect()] == [2]
    facts = {(r.s, r.p, r.o) for r in I.infobox_triples(rows, "en", "r:", "p:", ignored_templates=("q*",)).collect()}
    assert ("r:P", "p:y", "r:P/y/b1") in facts and ("r:P/y/b", "p:z", "2") in facts and not any("q" in s for s, _, _ in facts)


def test_infobox_of_nothing(spark):
    assert I.infobox_triples(I.template_properties(spark.createDataFrame([], PAGES)), "en", "r:", "p:").count() == 0


def test_mapping_numbers_repeated_names(spark):
    source = "{{Infobox customer|customer_name=A|height=0.50 m}} {{Address|name=S|city=[[X]]}} {{Address|name=S|city=not a link}}"
    props = I.template_properties(spark.createDataFrame([(1, "a", 0, source)], PAGES))
    got = {(r.s, r.p, r.o) for r in M.map_pages(props, *Q._tables(spark), "en", "r:", "o:").where("p != 'rdf:type'").collect()}
    assert got == {("r:A", "o:name", "A"), ("r:A", "o:height", "0.5"), ("r:A__S", "o:city", "r:X"), ("r:A__S", "o:addressOf", "r:A"), ("r:A__S__1", "o:addressOf", "r:A")}


def test_redirects_end_and_cycles_go(spark):
    r = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("z", "x"), ("s", "s")], "source string, target string")
    assert sorted(map(tuple, M.resolve_redirects(r).collect())) == [("a", "d"), ("b", "d"), ("c", "d")]


def test_statements_are_blocks(spark):
    df = spark.range(100).select("id", F.lit("a'b\\c\n").alias("t"), F.lit(None).cast("string").alias("n")).coalesce(1)
    got = [r.value for r in K.insert_statements(df, "x", block=200).collect()]
    assert len(got) > 5 and got[0].startswith("INSERT INTO x (id,t,n) VALUES (0,'a\\'b\\\\c\\n',NULL),(1,") and all(len(v) < 300 for v in got)
    assert K.insert_statements(df, "x", "postgres").first().value.startswith("INSERT INTO x (id,t,n) VALUES (0,'a''b\\c\n',NULL)")


def test_expression_errors_and_shapes():
    e = X.Expression('not (A or p only {b, c}) and q min 2 C and r value "x y"', "n")
    e.parse()
    assert {"owl:complementOf", "owl:unionOf", "owl:allValuesFrom", "owl:oneOf", "owl:minCardinality", "owl:onClass", "owl:hasValue"} <= {p for _, p, _, _ in e.rows}
    for bad in ("A and", "(A", "A B", "p some", "p min x"):
        with pytest.raises(X.ExpressionError):
            X.Expression(bad, "n").parse()


def test_extractors_of_nothing(spark):
    pages = spark.createDataFrame([(1, "a", 0, None), (2, "b", 0, ""), (3, "c", 0, "no marks")], PAGES)
    for f in (E.article_categories, E.disambiguations, E.homepage, E.persondata, E.authority_ids, E.semantic_links):
        assert f(pages, "r:").count() == 0


def test_german_persondata(spark):
    source = "{{Personendaten\n|NAME=Müller, Jörg\n|KURZBESCHREIBUNG=Maler\n|GEBURTSDATUM=[[12. März]] [[1950]]\n|GEBURTSORT=[[Köln]]\n|STERBEDATUM=1. Jänner 2001\n|STERBEORT=[[Wien]]\n}}"
    pages = spark.createDataFrame([(1, "Jörg Müller", source)], "page_id long, title string, source string")
    got = {r["p"]: r["o"] for r in E.persondata(pages, "http://x/", "de").collect()}
    assert got["birth"] == "1950-03-12" and got["death"] == "2001-01-01"
    assert (got["givenName"], got["surname"], got["description"]) == ("Jörg", "Müller", "Maler")


def test_pages_of_a_small_file_come_to_many_tasks(spark, small):
    """A file of some bytes a row is read in one task; the pages written from it are parsed in as many as there are cores."""
    from factweave.plans.mapping_queries import customer_pages

    pages = customer_pages(spark, small)
    assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    filled = I.template_properties(pages).select(F.spark_partition_id().alias("k")).distinct().count()
    assert filled >= spark.sparkContext.defaultParallelism
