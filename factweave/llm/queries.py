"""The queries of the training-data operators, under their production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, jaccard_join, language, licenses, packing, quality, sentencepiece_scan, suffix_dedup, topk, url_filter
from .common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def bucket(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def is_bucket(n: int, k: int):
    return F.coalesce(bucket(n) == k, F.lit(False))


def quality_voter(docs: DataFrame, labels: DataFrame) -> quality.Voter:
    """The classifier of op1 and of the pipeline: no label of a held-out row is read."""
    return quality.train(docs, labels.where(~is_bucket(4, 2)))


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_voter(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_bucket(4, 2).alias("held_out"), "score", "predicted")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_scan.summary(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), url_filter.default_list(spark)).select("page_id", "host", "path", "rule", "verdict")


def op9_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_bucket(5, 0)
    found = language.identify(docs, docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    f.__name__: f
    for f in (op1_quality_knn, op2_exact_dedup, op3_license_scan, op4_sentencepiece, op5_ngram_jaccard, op6_suffix_dedup, op7_exact_topk, op8_url_filter, op9_bestfit_packing, op10_language_id)
}

_listed = ", ".join(f"('{k}')" for k in url_filter.LISTED)
_rules = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in url_filter.RULES)

SQL = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op5_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT d.doc_id, count(s.g) AS n FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
        edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edge.b, reach.r FROM reach JOIN edge ON edge.a = reach.doc_id)
        SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY ALL""",
    "op7_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
        QUALIFY rank <= 20""",
    "op8_url_filter": rf"""
        WITH p AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
        rules(verdict, site, start, rule) AS (VALUES {_rules}),
        listed(key) AS (VALUES {_listed}),
        fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN rules
                ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start) GROUP BY page_id),
        bad AS (SELECT DISTINCT page_id FROM p JOIN listed
                ON host <> '' AND (key = host || '/' OR ends_with('.' || host || '/', '.' || key)
                   OR key = regexp_replace(host, '^(www|m)\.', '') || '/' || regexp_replace(ltrim(path, '/'), '(\.html)?/*$', '')))
        SELECT p.page_id, host, path, fit.rule, coalesce(fit.verdict, CASE WHEN bad.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM p LEFT JOIN fit USING (page_id) LEFT JOIN bad USING (page_id)""",
}
