"""Numbers, units, dates and places, on driver tables rendered as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.functions import values as V
from factweave.plans.registry import query, table


@query("n1_n2_numbers", "SELECT o_orderkey, floor(o_totalprice)::BIGINT AS whole, round(o_totalprice, 2) AS number FROM orders")
def n1(spark, d):
    """Both groupings: 1,234.50 in English, 1.234,50 in German."""
    t = table(spark, d, "orders").withColumn("en", F.format_number(F.round("o_totalprice", 2), 2))
    de = F.translate("en", ",.", ".,")
    return t.select("o_orderkey", F.floor(V.parse_float(de, F.lit("de"))).alias("whole"), V.parse_float(F.concat(F.lit("about "), "en"), F.lit("en")).alias("number"))


@query("n3_scale_words", "SELECT p_partkey, p_size * 1e6 AS value FROM part")
def n3(spark, d):
    return table(spark, d, "part").select("p_partkey", V.parse_scaled(F.concat("p_size", F.lit(" Million people")), F.lit("en")).alias("value"))


@query("n4_format", "SELECT o_orderkey, CASE WHEN abs(o_totalprice) >= 1000 THEN round(o_totalprice)::BIGINT::VARCHAR ELSE format('{:.4f}', o_totalprice) END AS s FROM orders")
def n4(spark, d):
    return table(spark, d, "orders").select("o_orderkey", V.format_number(F.col("o_totalprice")).alias("s"))


_UNITS = ", ".join(f"('{u}', '{dim}', {f!r}::DOUBLE, {o!r}::DOUBLE)" for u, (dim, f, o) in V.UNITS.items())
_NAMES = ", ".join(f"'{u}'" for u in V.UNITS)


@query("n9_units", f"WITH u(unit, dimension, f, o) AS (VALUES {_UNITS}) SELECT p_partkey, u.unit, dimension, p_size * f + o AS standard FROM (SELECT p_partkey, p_size, ([{_NAMES}])[1 + p_partkey % {len(V.UNITS)}] AS unit FROM part) p JOIN u USING (unit)")
def n9(spark, d):
    unit = F.get(F.array(*map(F.lit, V.UNITS)), (F.col("p_partkey") % len(V.UNITS)).cast("int"))
    t = table(spark, d, "part").withColumn("unit", unit)
    return t.select("p_partkey", "unit", V.dimension(F.col("unit")).alias("dimension"), V.to_standard(F.col("p_size").cast("double"), F.col("unit")).alias("standard"))


@query("n10_money", "SELECT o_orderkey, round(o_totalprice, 2) AS amount FROM orders")
def n10(spark, d):
    return table(spark, d, "orders").select("o_orderkey", V.parse_money(F.concat(F.lit("cost $"), F.format_number(F.round("o_totalprice", 2), 2))).alias("amount"))


@query("n12_percent", "SELECT l_orderkey, l_linenumber, round(l_discount * 100, 1) AS pct FROM lineitem")
def n12(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", V.parse_percent(F.concat(F.round(F.col("l_discount") * 100, 1).cast("string"), F.lit(" % off"))).alias("pct"))


@query("n13_rank", "SELECT p_partkey, p_size::BIGINT AS rank FROM part")
def n13(spark, d):
    return table(spark, d, "part").select("p_partkey", V.parse_rank(F.concat(F.lit("ranked "), "p_size", F.lit("<sup>th"))).alias("rank"))


@query("n16_clock", "SELECT event_id, hour(ts) * 60 + minute(ts) AS minutes FROM events")
def n16(spark, d):
    return table(spark, d, "events").select("event_id", V.minutes_of(F.date_format("ts", "'at' HH:mm")).alias("minutes"))


@query("n17_sum_of_units", "SELECT p_partkey, p_size * 0.3048 + (p_size % 12) * 0.0254 AS metres FROM part")
def n17(spark, d):
    s = F.col("p_size").cast("double")
    return table(spark, d, "part").select("p_partkey", (V.to_standard(s, F.lit("foot")) + V.to_standard(s % 12, F.lit("inch"))).alias("metres"))


@query("n19_within_permille", "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND abs(a.o_totalprice - b.o_totalprice) <= abs(b.o_totalprice) * 0.001")
def n19(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    a, b = o.toDF("c", "a", "x"), o.toDF("c", "b", "y")
    return a.join(b, "c").where((F.col("a") < F.col("b")) & V.within_permille(F.col("x"), F.col("y"))).select("a", "b")


@query("n20_great_circle", """WITH p AS (SELECT c_custkey, (c_custkey % 170 - 85)::DOUBLE AS lat, (c_custkey * 7 % 360 - 180)::DOUBLE AS lon FROM customer)
    SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(48.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.0)) * pow(sin(radians(11.5 - lon) / 2), 2)))), 3) AS km FROM p""")
def n20(spark, d):
    lat, lon = (F.col("c_custkey") % 170 - 85).cast("double"), (F.col("c_custkey") * 7 % 360 - 180).cast("double")
    return table(spark, d, "customer").select("c_custkey", F.round(V.great_circle_km(lat, lon, F.lit(48.0), F.lit(11.5)), 3).alias("km"))


@query("n20_azimuth", """WITH p AS (SELECT c_custkey, radians((c_custkey % 170 - 85)::DOUBLE) AS lat, radians(11.5 - (c_custkey * 7 % 360 - 180)) AS dl FROM customer)
    SELECT c_custkey, round((degrees(atan2(sin(dl) * cos(radians(48.0)), cos(lat) * sin(radians(48.0)) - sin(lat) * cos(radians(48.0)) * cos(dl))) + 360) % 360, 4) AS azimuth FROM p""")
def n20b(spark, d):
    lat, lon = (F.col("c_custkey") % 170 - 85).cast("double"), (F.col("c_custkey") * 7 % 360 - 180).cast("double")
    return table(spark, d, "customer").select("c_custkey", F.round(V.azimuth(lat, lon, F.lit(48.0), F.lit(11.5)), 4).alias("azimuth"))


@query("e18_degrees", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END * (c_custkey % 90 + (c_custkey % 60) / 60.0::DOUBLE + 30 / 3600.0::DOUBLE) AS lat FROM customer")
def e18(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", V.degrees_of((k % 90).cast("double"), (k % 60).cast("double"), F.lit(30.0), F.when(k % 2 == 0, "S").otherwise("N")).alias("lat"))


@query("t2_text_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS a, strftime(o_orderdate, '%Y-%m-%d') AS b, strftime(o_orderdate, '%Y-%m-%d') AS c FROM orders")
def t2(spark, d):
    forms = {"a": "'on' yyyy-MM-dd 'at'", "b": "'born' d MMMM yyyy", "c": "'since' MMMM d, yyyy"}
    return table(spark, d, "orders").select("o_orderkey", *(V.parse_date(F.date_format("o_orderdate", f)).alias(n) for n, f in forms.items()))


@query("t2_century_pivot", "SELECT p_partkey, CASE WHEN p_partkey % 100 > 10 THEN p_partkey % 100 + 1900 ELSE p_partkey % 100 + 2000 END AS year FROM part")
def t2b(spark, d):
    return table(spark, d, "part").select("p_partkey", V.century(F.col("p_partkey") % 100).alias("year"))


@query("t4_partial_dates", "SELECT o_orderkey, '--' || strftime(o_orderdate, '%m-%d') AS month_day, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def t4(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "'--'MM-dd").alias("month_day"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))


@query("t6_valid_dates", "SELECT p_partkey, try_cast('2009-' || lpad((1 + p_partkey % 13)::VARCHAR, 2, '0') || '-' || lpad((1 + p_partkey % 31)::VARCHAR, 2, '0') AS DATE) IS NOT NULL AS valid FROM part")
def t6(spark, d):
    k = F.col("p_partkey")
    s = F.concat(F.lit("2009-"), F.lpad((1 + k % 13).cast("string"), 2, "0"), F.lit("-"), F.lpad((1 + k % 31).cast("string"), 2, "0"))
    return table(spark, d, "part").select("p_partkey", F.try_to_date(s, "yyyy-MM-dd").isNotNull().alias("valid"))


@query("t8_intervals", "SELECT o_orderkey, year(o_orderdate) AS y1, year(o_orderdate) + 5 AS y2 FROM orders")
def t8(spark, d):
    sep = F.when(F.col("o_orderkey") % 2 == 0, "-").otherwise("–")
    parts = F.split(F.concat(F.year("o_orderdate"), sep, F.year("o_orderdate") + 5), "[-–—]|&ndash;")
    y1, y2 = F.get(parts, F.lit(0)).try_cast("bigint"), F.get(parts, F.lit(1)).try_cast("bigint")
    return table(spark, d, "orders").select("o_orderkey", F.when(y1 > 1880, y1).alias("y1"), F.when((y2 >= 1800) & (y2 >= y1), y2).alias("y2"))


@query("t12_inverse_timestamps", "SELECT event_id, translate(strftime(ts, '%Y%m%d%H%M%S'), '0123456789', '9876543210') AS inverse FROM events")
def t12(spark, d):
    return table(spark, d, "events").select("event_id", V.inverse_timestamp(F.col("ts")).alias("inverse"))


@query("s22_flagged_numbers", "SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE round(s_acctbal, 2) END AS v FROM supplier")
def s22(spark, d):
    raw = F.when(F.col("s_suppkey") % 7 == 0, ":").otherwise(F.concat(F.round("s_acctbal", 2).cast("decimal(12,2)").cast("string"), F.lit(" bp")))
    v = F.translate(raw, " bcep", "")
    return table(spark, d, "supplier").select("s_suppkey", F.when(~v.isin("", ":"), v).try_cast("double").alias("v"))
