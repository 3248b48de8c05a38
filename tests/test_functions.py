import pytest
from pyspark.sql import functions as F

from factweave.functions import text as X
from factweave.functions import values as V
from factweave.operators import graph, triples
from factweave.operators.wikitext import MarkupError, Parser


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name,folded", [("leaderName1", "leaderName"), ("leaderName13", "leaderName13"), ("1", "1"), ("12", "12")]
)
def test_fold_digit(spark, name, folded):
    assert one(spark, X.fold_digit(F.lit(name))) == folded


def test_titles(spark):
    assert one(spark, X.wiki_encode(F.lit(" _ émile _ Zola _ "))) == "%C3%89mile_Zola"
    assert one(spark, X.wiki_encode(F.lit("AC/DC"))) == "AC/DC"
    assert one(spark, X.wiki_decode(F.lit("%C3%89mile_Zola"))) == "Émile Zola"


@pytest.mark.parametrize("s,escaped", [('a"b\\c\n', 'a\\"b\\\\c\\n'), ("é", "\\u00E9"), ("😀", "\\U0001F600"), ("", "")])
def test_ntriples_escape(spark, s, escaped):
    assert one(spark, X.ntriples_escape(F.lit(s))) == escaped


def test_truncate_bytes(spark):
    assert one(spark, X.truncate_bytes(F.lit("ééé"), 5)) == "éé"
    assert one(spark, X.truncate_bytes(F.lit("abc"), 5)) == "abc"


@pytest.mark.parametrize(
    "s,lang,v", [("23,000", "en", 23000), ("1270000", "en", 1270000), ("1.270.000", "de", 1270000), ("none", "en", None)]
)
def test_integers(spark, s, lang, v):
    assert one(spark, V.parse_integer(F.lit(s), F.lit(lang))) == v


def test_floats_and_scales(spark):
    assert one(spark, V.parse_float(F.lit("134,34"), F.lit("de"))) == 134.34
    assert one(spark, V.parse_scaled(F.lit("1.2 [[million]] people"), F.lit("en"))) == 1.2e6
    assert one(spark, V.parse_money(F.lit("$1.2 million"))) == 1.2e6


@pytest.mark.parametrize(
    "s,d", [("born 3 May 1912", "1912-05-03"), ("May 3, 1912", "1912-05-03"), ("1912-02-30", None), ("nothing", None), ("on 1912-05-03", "1912-05-03")]
)
def test_dates(spark, s, d):
    assert one(spark, V.parse_date(F.lit(s))) == d


def test_units_agree_with_their_definition(spark):
    assert one(spark, V.to_standard(F.lit(32.0), F.lit("degreeFahrenheit"))) == pytest.approx(273.15)
    assert one(spark, V.to_standard(F.lit(1.0), F.lit("squareDecametre"))) == 100.0


def test_coordinates(spark):
    lat = V.degrees_of(F.lit(47.0), F.lit(25.0), F.lit(0.0), F.lit("N"))
    assert one(spark, lat) == pytest.approx(47.4166666667)


def test_wikitext():
    rows = Parser().page("P", "Intro [[A|b]] text\n== Head ==\n{{Box|x|k=[[L|m]]{{in|1}}}}\n{|\n! h1 !! h2\n|-\n| rowspan=2 | c1 || c2\n|}\n[http://e.org label]<!-- no -->")
    kinds = [r["kind"] for r in rows]
    assert kinds.count("template") == 2 and kinds.count("section") == 1 and kinds.count("header") == 2
    assert [(r["target"], r["text"], r["is_external"]) for r in rows if r["kind"] == "link"] == [("A", "b", False), ("L", "m", False), ("http://e.org", "label", True)]
    cell = next(r for r in rows if r["kind"] == "cell")
    assert (cell["text"], cell["rowspan"]) == ("c1", 2)
    with pytest.raises(MarkupError):
        Parser().page("P", "{{open")


def test_ntriples_round_trip(spark):
    t = spark.createDataFrame([("http://a/s", "http://a/p", 'x "q" \\ é\n', "literal"), ("http://a/s", "http://a/p", "http://a/o", "uri")], "s string, p string, o string, o_kind string")
    lines = t.select(triples.ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind")).alias("value"))
    got = triples.parse_ntriples(lines)
    assert got.where("valid").count() == 2
    assert got.where("o_kind = 'uri'").first()["o"] == "http://a/o"


def test_components_of_a_chain(spark):
    n = spark.range(60).select(F.col("id").alias("node"))
    e = spark.range(39).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["component"] for r in graph.components(n, e).collect()}
    assert got == {i: 0 if i < 40 else i for i in range(60)}
