"""Dates of templates, phrases and parts; beginnings, places and images of pages written from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.functions import dates as T
from factweave.functions import markup as M
from factweave.plans.registry import query, table

_Y, _M, _D = "year(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)"
_ISO = "strftime(o_orderdate, '%Y-%m-%d')"


def _orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("dd"), (F.col("o_orderkey") % 7).alias("k"))


@query("t1_template_dates", f"SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE {_ISO} END AS date FROM orders")
def t1(spark, d):
    """Seven kinds of templates; the last has a day that no calendar has."""
    forms = [
        ("{{Birth date|%d|%d|%d|df=yes}}", "y m dd"), ("{{death date and age|%d|%d|%d|1900|1|2}}", "y m dd"), ("{{Birth date and age|1900|1|2|%d|%d|%d|mf=y}}", "y m dd"), ("{{BirthDeathAge|B|%d|%d|%d|1999|9|9}}", "y m dd"),
        ("{{Date de décès|%d|%d|%d}}", "dd m y"), ("{{Naissance décès âge|1|2|1900|%d|%d|%d}}", "dd m y"), ("{{Start date|%d|%d|32|%d}}", "y m dd"),
    ]
    o = _orders(spark, d)
    text = F.coalesce(*(F.when(F.col("k") == i, F.format_string(f, *c.split())) for i, (f, c) in enumerate(forms)))
    return o.select("o_orderkey", T.template_date(text).alias("date"))


@query("t3_month_years", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def t3(spark, d):
    o = _orders(spark, d).withColumn("text", F.concat(F.lit("it was in [["), F.date_format("o_orderdate", "MMMM"), F.lit("]] [["), "y", F.lit("]] or so")))
    return o.select("o_orderkey", T.parse_month_year(F.col("text")).alias("month"))


@query("t5_years", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '' END || lpad((p_size * CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 30 END)::VARCHAR, 4, '0') AS year FROM part")
def t5(spark, d):
    n = F.col("p_size") * F.when(F.col("p_partkey") % 4 == 0, 1).when(F.col("p_partkey") % 4 == 1, 10).otherwise(30)
    text = F.concat(F.lit("about "), n, F.when(F.col("p_partkey") % 3 == 0, " BC").otherwise(" AD"))
    return table(spark, d, "part").select("p_partkey", T.parse_year(text).alias("year"))


@query("t7_combined_dates", f"SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN {_ISO} WHEN 1 THEN {_ISO} WHEN 2 THEN strftime(o_orderdate, '%Y-%m') WHEN 3 THEN strftime(o_orderdate, '--%m-%d') WHEN 4 THEN strftime(o_orderdate, '%Y') END AS date FROM orders")
def t7(spark, d):
    """Month by name or number; without a year, without a day, the year alone; a day alone, and a month that none has, give nothing."""
    k, name = F.col("k"), F.date_format("o_orderdate", "MMMM")
    day = F.when(k.isin(0, 1, 3, 5), F.concat(F.lit("the "), "dd", F.lit(".")))
    month = F.when(k.isin(0, 3), name).when(k.isin(1, 2), F.col("m").cast("string")).when(k == 6, "Nonember")
    year = F.when(k.isin(0, 1, 2, 4), F.concat("y", F.lit(" or so")))
    return _orders(spark, d).select("o_orderkey", T.combine_date(day, month, year).alias("date"))


@query("t9_german_dates", f"SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN {_ISO} WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS date FROM orders")
def t9(spark, d):
    names = F.array(*(F.lit(x) for x in ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]))
    month, k = F.get(names, F.col("m") - 1), F.col("o_orderkey") % 3
    text = F.when(k == 0, F.format_string("%d. %s %d", "dd", month, "y")).when(k == 1, F.format_string("%s %d", month, "y")).otherwise(F.format_string("um %d", "y"))
    return _orders(spark, d).select("o_orderkey", T.german_date(text).alias("date"))


@query("t10_korean_dates", f"SELECT o_orderkey, CASE o_orderkey % 7 WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '-%Y') WHEN 6 THEN NULL ELSE {_ISO} END AS date FROM orders")
def t10(spark, d):
    forms = [("[[%d년]] [[%d월 %d일]]", 3), ("%d년 %d월", 2), ("[[%d년]]", 1), ("기원전 %d년", 1), ("출생일|%d|%d|%d", 3), ("사망일과 나이|%d|%d|%d|1900|1|2|", 3), ("%d", 1)]
    text = F.coalesce(*(F.when(F.col("k") == i, F.format_string(f, *["y", "m", "dd"][:n])) for i, (f, n) in enumerate(forms)))
    return _orders(spark, d).select("o_orderkey", T.korean_date(text).alias("date"))


@query("t11_record_times", "SELECT event_id, date_trunc('second', ts) AS t FROM events")
def t11(spark, d):
    return table(spark, d, "events").select("event_id", T.record_time(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("t"))


@query("t13_date_types", "SELECT ['date', 'gYearMonth', 'gYear', NULL][1 + o_orderkey % 4] AS type, count(*) AS n FROM orders GROUP BY ALL")
def t13(spark, d):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format("o_orderdate", "MMMM d, yyyy")).when(k == 1, F.date_format("o_orderdate", "'[['MMMM yyyy']]'")).when(k == 2, F.date_format("o_orderdate", "yyyy")).otherwise("soon")
    return _orders(spark, d).select(T.date_type(text).alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query("x19_e20_abstracts", """SELECT p_partkey, p_name || ' is a type ' || p_size || '. It is ' || p_brand || '! Third one。' AS abstract, p_name || ' is a type ' || p_size || '. It is ' || p_brand || '!' AS comment FROM part""")
def x19(spark, d):
    """Nested templates, references, files with links in their captions, categories, comments, tables, indented lines, a heading."""
    page = F.concat(
        F.lit("{{Infobox|a={{b|{{c}}}}|d=e}}\n[[File:x.png|thumb|a [[link]] in a caption]]{| class=t\n|a\n|}\n:see also\n'''"), "p_name", F.lit("''' is a [[Kind of thing|type]] "), "p_size",
        F.lit("<ref name=\"a\">Some. Where.</ref>. It is [http://x.org/a "), "p_brand", F.lit("]! <!-- no. -->Third one。[[Category:Parts]]\n== Heading ==\nMore. Text."),
    )
    comment, abstract = M.page_abstracts(page)
    return table(spark, d, "part").select("p_partkey", comment.alias("comment"), abstract.alias("abstract"))


@query("e16_place_templates", """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE CASE s_suppkey % 5 WHEN 3 THEN 10.5 + s_nationkey ELSE -(10 + s_nationkey + CASE WHEN s_suppkey % 5 > 0 THEN 30 / 60.0 ELSE 0 END + CASE WHEN s_suppkey % 5 = 2 THEN 36 / 3600.0 ELSE 0 END) END END AS lat,
    CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE CASE s_suppkey % 5 WHEN 3 THEN -20.25 ELSE 100 + CASE WHEN s_suppkey % 5 > 0 THEN 15 / 60.0 ELSE 0 END + CASE WHEN s_suppkey % 5 = 2 THEN 18 / 3600.0 ELSE 0 END END END AS lon,
    CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE 'city' END AS type, CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE 1200 + s_suppkey END AS population FROM supplier""")
def e16(spark, d):
    """Degrees; degrees and minutes; with seconds; two numbers; a latitude that earth has not."""
    k, n = F.col("s_suppkey") % 5, F.format_string("type:city(%d)_region:XX", F.col("s_suppkey") + 1200)
    lat = F.col("s_nationkey") + 10
    text = F.when(k == 0, F.format_string("text {{coor title d|%d|S|100|E|%s}} {{coord|1|2}}", lat, n)).when(k == 1, F.format_string("{{coor dm|%d|30|S|100|15|E|%s}}", lat, n))
    text = text.when(k == 2, F.format_string("{{Coord|%d|30|36|S|100|15|18|E|%s|display=title}}", lat, n)).when(k == 3, F.format_string("{{coord|%s|-20.25|%s}}", lat + 0.5, n)).otherwise("{{coord|91|0|N|1|2|E}}")
    return table(spark, d, "supplier").select("s_suppkey", M.place(text).alias("c")).select("s_suppkey", "c.lat", "c.lon", "c.type", "c.population")


@query("e17_title_places", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey::DOUBLE END AS lat FROM supplier")
def e17(spark, d):
    shown = F.when(F.col("s_suppkey") % 2 == 0, "inline,title").otherwise("inline")
    text = F.format_string("{{coord|80|N|5|E|display=inline}} {{coord|%d|N|7|E|display=%s}}", "s_nationkey", shown)
    return table(spark, d, "supplier").select("s_suppkey", M.place(text, True)["lat"].alias("lat"))


@query("e11_first_images", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'My_map_' || s_suppkey || '.svg' WHEN 1 THEN 'Photo_' || s_suppkey || '.JPG' WHEN 2 THEN 'Photo_' || s_suppkey || '.JPG' END AS file, CASE s_suppkey % 4 WHEN 0 THEN 200 WHEN 1 THEN 80 WHEN 2 THEN 200 END AS width FROM supplier""")
def e11(spark, d):
    """A template's value, a link before it, a link alone, no image."""
    k, n = F.col("s_suppkey") % 4, F.col("s_suppkey")
    text = F.when(k == 0, F.format_string("{{Infobox|map = my map %d.svg |x=1}} [[File:photo %d.JPG|80px]]", n, n)).when(k == 1, F.format_string("[[Image:photo %d.JPG|thumb|80px|a]] {{Infobox|map=my map.svg}}", n))
    text = text.when(k == 2, F.format_string("some text [[File:photo %d.JPG|thumb]]", n)).otherwise("name = value.txt")
    return table(spark, d, "supplier").select("s_suppkey", M.first_image(text).alias("i")).select("s_suppkey", "i.file", "i.width")
