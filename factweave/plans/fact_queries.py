"""The fact table of the star schema: rendering, hashing, comparing, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.operators import quality as Z
from factweave.operators import triples as T
from factweave.plans.registry import query, table

R = "http://example.org/"
_NATION = f"""nat AS (SELECT '{R}nation/' || n_nationkey AS s, '{R}name' AS p, n_name AS o, 'literal' AS o_kind FROM nation
    UNION ALL SELECT '{R}nation/' || n_nationkey, '{R}region', '{R}region/' || n_regionkey, 'uri' FROM nation)"""
_LINE = "'<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'uri' THEN '<' || o || '>' ELSE '\"' || o || '\"' END || ' .'"
_CUST = f"""cust AS (SELECT '{R}customer/' || c_custkey AS s, '{R}name' AS p, c_name AS o, 'literal' AS o_kind FROM customer
    UNION ALL SELECT '{R}customer/' || c_custkey, '{R}segment', c_mktsegment, 'literal' FROM customer
    UNION ALL SELECT '{R}customer/' || c_custkey, '{R}nation', '{R}nation/' || c_nationkey, 'uri' FROM customer)"""


def nation_facts(spark, d):
    n = table(spark, d, "nation")
    return T.unpivot(n, F.concat(F.lit(R + "nation/"), "n_nationkey"), {R + "name": F.col("n_name"), R + "region": F.concat(F.lit(R + "region/"), "n_regionkey")}, {R + "region": "uri"})


def customer_facts(spark, d):
    facts = {R + "name": F.col("c_name"), R + "segment": F.col("c_mktsegment"), R + "nation": F.concat(F.lit(R + "nation/"), "c_nationkey")}
    return T.unpivot(table(spark, d, "customer"), F.concat(F.lit(R + "customer/"), "c_custkey"), facts, {R + "nation": "uri"})


@query("d5_facts", f"WITH {_CUST} SELECT * FROM cust")
def d5(spark, d):
    return customer_facts(spark, d)


@query("k1_ntriples", f"WITH {_NATION} SELECT {_LINE} AS line FROM nat")
def k1(spark, d):
    return nation_facts(spark, d).select(T.ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind")).alias("line"))


@query("x16_nquads", f"WITH {_NATION} SELECT rtrim({_LINE}, '.') || '<{R}src> .' AS line FROM nat")
def x16(spark, d):
    return nation_facts(spark, d).select(T.nquad(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind"), F.lit(R + "src")).alias("line"))


@query("x17_hashes", f"WITH {_CUST} SELECT s, p, md5(trim({_LINE})) AS h FROM cust")
def x17(spark, d):
    return customer_facts(spark, d).select("s", "p", T.triple_hash(T.ntriple(F.col("s"), F.col("p"), F.col("o"), F.col("o_kind"))).alias("h"))


@query("x18_reification", f"""WITH {_NATION}, a AS (SELECT '{R}axiom/' || md5({_LINE}) AS axiom, s, p, o FROM nat)
    SELECT axiom AS s, 'annotatedSource' AS p, s AS o, 'literal' AS o_kind FROM a UNION ALL SELECT axiom, 'annotatedProperty', p, 'literal' FROM a
    UNION ALL SELECT axiom, 'annotatedTarget', o, 'literal' FROM a UNION ALL SELECT axiom, 'extractor', 'nation', 'literal' FROM a""")
def x18(spark, d):
    return T.reify(nation_facts(spark, d), R + "axiom/", {"extractor": F.lit("nation")})


@query("s21_f28_parse_ntriples", f"WITH {_NATION} SELECT s, p, o, o_kind, true AS valid FROM nat UNION ALL SELECT '', '', '', 'literal', false FROM region")
def s21(spark, d):
    lines = k1(spark, d).toDF("value").unionByName(table(spark, d, "region").select(F.concat(F.lit("<broken "), "r_name").alias("value")))
    return T.parse_ntriples(lines).select("s", "p", "o", "o_kind", "valid")


@query("f18_rules", f"WITH {_CUST} SELECT s, p, o FROM cust WHERE p = '{R}name' OR starts_with(o, '{R}nation/1')")
def f18(spark, d):
    return customer_facts(spark, d).where(T.matches_rules(None, [("EXACT", "p", R + "name"), ("STARTSWITH", "o", R + "nation/1")])).select("s", "p", "o")


@query("f19_not_produced", f"WITH {_CUST} SELECT s, p, o FROM cust WHERE NOT (p = '{R}name' OR starts_with(o, '{R}nation/1'))")
def f19(spark, d):
    return customer_facts(spark, d).where(~T.matches_rules(None, [("EXACT", "p", R + "name"), ("STARTSWITH", "o", R + "nation/1")])).select("s", "p", "o")


@query("a7_predicates", f"WITH {_CUST} SELECT DISTINCT p, lower(list_extract(string_split(p, '/'), -1)) AS label FROM cust")
def a7(spark, d):
    return customer_facts(spark, d).select("p").distinct().withColumn("label", F.lower(F.element_at(F.split("p", "/"), -1)))


_NEW = "(SELECT o_custkey AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 <> 0)"
_OLD = "(SELECT o_custkey AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 <> 1)"


def _versions(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("s"), F.col("o_orderpriority").alias("p"), "o_orderkey")
    return o.where("o_orderkey % 3 != 0").select("s", "p"), o.where("o_orderkey % 3 != 1").select("s", "p")


@query("u1_insert_set", f"SELECT s, p FROM {_NEW} EXCEPT SELECT s, p FROM {_OLD}")
def u1(spark, d):
    new, old = _versions(spark, d)
    return new.distinct().join(old, ["s", "p"], "left_anti")


@query("u2_delete_set", f"SELECT s, p FROM {_OLD} EXCEPT SELECT s, p FROM {_NEW}")
def u2(spark, d):
    new, old = _versions(spark, d)
    return old.distinct().join(new, ["s", "p"], "left_anti")


@query("u3_j15_diff", f"WITH a AS (SELECT DISTINCT s, p, 1 AS x FROM {_NEW}), b AS (SELECT DISTINCT s, p, 1 AS y FROM {_OLD}) SELECT s, p, CASE WHEN y IS NULL THEN 'added' WHEN x IS NULL THEN 'removed' ELSE 'retained' END AS status FROM a FULL JOIN b USING (s, p)")
def u3(spark, d):
    new, old = _versions(spark, d)
    return T.diff(new, old, ["s", "p"])


@query("u4_predicate_diff", f"SELECT s, p, 'insert' AS action FROM {_NEW} WHERE p <> '1-URGENT' UNION ALL SELECT s, p, 'delete' FROM {_OLD} WHERE p IN (SELECT p FROM {_NEW} WHERE p <> '1-URGENT')")
def u4(spark, d):
    new, old = _versions(spark, d)
    return T.predicate_diff(new.where("p != '1-URGENT'"), old)


@query("u0_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u0(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("w1_occurrences", "SELECT conv_id, turn, role, CASE WHEN n = 1 THEN role ELSE role || '__' || (n - 1) END AS uri FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)")
def w1(spark, d):
    return T.number_occurrences(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "turn", "role", "uri")


@query("r12_membership", "WITH m AS (SELECT l_orderkey AS target, l_linenumber AS extractor, l_partkey AS hash FROM lineitem), own AS (SELECT DISTINCT hash FROM m WHERE target = 1 AND extractor = 1), oth AS (SELECT DISTINCT hash FROM m WHERE NOT (target = 1 AND extractor = 1)), new AS (SELECT DISTINCT hash FROM m WHERE target = 2 UNION SELECT 999999999) SELECT hash, CASE WHEN own.hash IS NULL THEN CASE WHEN hash IN (SELECT hash FROM oth) THEN 'add' ELSE 'insert' END ELSE CASE WHEN hash IN (SELECT hash FROM oth) THEN 'remove' ELSE 'delete' END END AS action FROM new FULL JOIN own USING (hash) WHERE own.hash IS NULL OR new.hash IS NULL".replace("own.hash IS NULL THEN", "own_h IS NULL THEN").replace("WHERE own.hash IS NULL OR new.hash IS NULL", "WHERE own_h IS NULL OR new_h IS NULL").replace("own AS (SELECT DISTINCT hash FROM m WHERE target = 1 AND extractor = 1)", "own AS (SELECT DISTINCT hash, hash AS own_h FROM m WHERE target = 1 AND extractor = 1)").replace("new AS (SELECT DISTINCT hash FROM m WHERE target = 2 UNION SELECT 999999999)", "new AS (SELECT hash, hash AS new_h FROM (SELECT DISTINCT hash FROM m WHERE target = 2 UNION SELECT 999999999))"))
def r12(spark, d):
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("target"), F.col("l_linenumber").cast("string").alias("extractor"), F.col("l_partkey").alias("hash"))
    new = m.where("target = '2'").select("hash").union(spark.range(999999999, 1000000000))
    return T.membership_merge(m, "1", "1", new)


_GOLD = f"gold AS (SELECT o_orderkey % 50 AS snippet, '{R}c/' || o_custkey AS s, CASE WHEN o_orderkey % 5 = 0 THEN 'status2' ELSE 'status' END AS p, o_orderpriority AS o FROM orders)"
_ACT = f"act AS (SELECT DISTINCT '{R}c/' || o_custkey AS s, 'status' AS p, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority || 'X' ELSE o_orderpriority END AS o FROM orders WHERE o_orderkey % 2 = 0)"


def _gold(spark, d):
    o, s = table(spark, d, "orders"), F.concat(F.lit(R + "c/"), "o_custkey")
    gold = o.select((F.col("o_orderkey") % 50).alias("snippet"), s.alias("s"), F.when(F.col("o_orderkey") % 5 == 0, "status2").otherwise("status").alias("p"), F.col("o_orderpriority").alias("o"))
    actual = o.where("o_orderkey % 2 = 0").select(s.alias("s"), F.lit("status").alias("p"), F.when(F.col("o_orderkey") % 4 == 0, F.concat("o_orderpriority", F.lit("X"))).otherwise(F.col("o_orderpriority")).alias("o")).distinct()
    return gold, actual


@query("z1_exact", f"WITH {_GOLD}, {_ACT} SELECT snippet, s, p, o, EXISTS (SELECT 1 FROM act WHERE act.s = gold.s AND act.p = gold.p AND act.o = gold.o) AS present FROM gold")
def z1(spark, d):
    return Z.exact(*_gold(spark, d)).select("snippet", "s", "p", "o", "present")


@query("z2_predicate_neutral", f"WITH {_GOLD}, {_ACT} SELECT s, p, o, EXISTS (SELECT 1 FROM act WHERE act.s = gold.s AND act.o = gold.o) AS present FROM gold WHERE NOT EXISTS (SELECT 1 FROM act WHERE act.s = gold.s AND act.p = gold.p AND act.o = gold.o)")
def z2(spark, d):
    return Z.predicate_neutral(*_gold(spark, d))


@query("z3_j14_similar", f"WITH {_GOLD}, {_ACT} SELECT snippet, s, p, o, EXISTS (SELECT 1 FROM act WHERE act.s = gold.s AND act.p = gold.p AND 1 - levenshtein(act.o, gold.o) / greatest(length(act.o), length(gold.o))::DOUBLE > 0.8) AS present FROM gold")
def z3(spark, d):
    return Z.object_similar(*_gold(spark, d)).select("snippet", "s", "p", "o", "present")


@query("z4_completeness", f"WITH {_GOLD}, {_ACT}, j AS (SELECT snippet, EXISTS (SELECT 1 FROM act WHERE act.s = gold.s AND act.p = gold.p AND act.o = gold.o) AS present FROM gold) SELECT snippet, count(*) AS triples, count(*) FILTER (WHERE present) AS found, bool_and(present) AS complete FROM j GROUP BY snippet")
def z4(spark, d):
    return Z.completeness(Z.exact(*_gold(spark, d)), "snippet")


@query("a6_z7_cube", f"WITH {_CUST}, b AS (SELECT p, CASE WHEN o_kind = 'uri' THEN 'entity' WHEN regexp_matches(o, '^-?[0-9]+$') THEN 'integer' ELSE 'string' END AS bucket FROM cust) SELECT p, bucket, count(*) AS n FROM b GROUP BY CUBE (p, bucket)")
def a6(spark, d):
    f = customer_facts(spark, d).select("p", Z.literal_bucket(F.col("o"), F.col("o_kind")).alias("bucket"))
    return f.cube("p", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("p10_describe", f"WITH {_CUST} SELECT 'in' AS direction, p, s AS value FROM cust WHERE o = '{R}nation/3' UNION ALL SELECT 'out', p, o FROM cust WHERE s = '{R}nation/3'")
def p10(spark, d):
    return T.describe(customer_facts(spark, d), R + "nation/3")


@query("p11_rewrite", f"WITH {_NATION} SELECT replace(s, '{R}', 'http://pub/') AS s, p, CASE WHEN o_kind = 'uri' THEN replace(o, '{R}', 'http://pub/') ELSE o END AS o FROM nat")
def p11(spark, d):
    move = lambda c: F.replace(c, F.lit(R), F.lit("http://pub/"))
    return nation_facts(spark, d).select(move(F.col("s")).alias("s"), "p", F.when(F.col("o_kind") == "uri", move(F.col("o"))).otherwise(F.col("o")).alias("o"))


@query("x25_prefixes", f"WITH {_CUST} SELECT s, 'ex:' || substr(p, {len(R) + 1}) AS p FROM cust")
def x25(spark, d):
    return customer_facts(spark, d).select("s", F.when(F.col("p").startswith(R), F.concat(F.lit("ex:"), F.substr("p", F.lit(len(R) + 1)))).otherwise(F.col("p")).alias("p"))
