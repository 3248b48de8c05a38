"""Each stage against a brute-force version on its own input."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline as P
from factweave.llm import queries
from factweave.llm.common import stash
from tests.llm.test_operators import brute_removed, sets_of


@pytest.fixture(scope="module")
def kept(spark, small):
    docs = [spark.read.parquet(f"{small}/documents.parquet")]
    for _, stage in P.STAGES[:-1]:
        docs.append(stash(stage(spark, docs[-1], small), "stage"))
    return docs


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_stay(kept):
    assert all(d.columns == kept[0].columns for d in kept)


def test_quality_stage(kept, spark, small):
    predicted = {r["doc_id"]: r["predicted"] for r in queries.op1_quality_knn(spark, small).collect()}
    assert {i for i, _ in rows_of(kept[1])} == {i for i, p in predicted.items() if p == 1}


def test_exact_stage(kept):
    best = {}
    for i, t in rows_of(kept[1]):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        best[key] = min(i, best.get(key, i))
    assert sorted(i for i, _ in rows_of(kept[2])) == sorted(best.values())


def test_near_stage(kept):
    rows = rows_of(kept[2])
    sets = dict(sets_of(rows, 5))
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {k: lo if v == hi else v for k, v in group.items()}
    assert {i for i, _ in rows_of(kept[3])} == set(group.values())


def test_passage_stage(kept):
    want = {int(i): n - gone for i, n, gone, _, _ in brute_removed(rows_of(kept[3]), P.PASSAGE)}
    assert {i: len(t.encode()) for i, t in rows_of(kept[4])} == want


def test_run(spark, small, kept):
    got = P.run(spark, small)
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in rows_of(kept[4])}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, uid long, spans int, count int, id int, hash int, normal int, __uid int, __n int"


def rows_with(spark, rows):
    """Documents with extra columns of names that stages use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 2, 3, 4, 5, 6, 7, 8) for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_rows_without_an_id_and_clashing_names(spark, small):
    rng = random.Random(3)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    rows = [(None, a), (None, a), (None, b), (7, b), (None, c + " end"), (None, c), (3, d), (3, b), (9, d + " end"), (None, None), (8, "")]
    docs = rows_with(spark, rows)
    one = P.exact_duplicates(spark, docs, small)
    got = Counter((r["doc_id"], r["text"]) for r in one.collect())
    want = Counter({(None, a): 1, (3, b): 1, (None, c + " end"): 1, (None, c): 1, (3, d): 1, (9, d + " end"): 1, (8, ""): 1})
    assert got == want and one.columns == docs.columns
    two = P.near_duplicates(spark, one, small).collect()
    texts = Counter(r["text"] for r in two)
    assert len([t for t in texts if t.startswith(c)]) == 1 and sum(texts.values()) == 5
    assert {(r["doc_id"], r["text"]) for r in two} >= {(None, a), (3, b), (3, d), (8, "")}
    three = P.repeated_passages(spark, docs, small)
    assert three.columns == docs.columns and {r["__uid"] for r in three.collect()} == {7} and three.count() == len(rows)


def test_no_rows(spark, small):
    docs = rows_with(spark, [(1, "x")]).limit(0)
    assert [stage(spark, docs, small).count() for _, stage in P.STAGES] == [0] * len(P.STAGES)


def test_planted_passages_go_and_clean_texts_stay(spark, small):
    rng = random.Random(5)
    passages = [prose(rng, 51) for _ in range(25)]
    clean = [(k, prose(rng, 150)) for k in range(60)]
    planted = [(100 + k, prose(rng, 60) + " " + passages[k % 25] + " " + prose(rng, 60)) for k in range(75)]
    got = {r["doc_id"]: r["text"] for r in P.repeated_passages(spark, rows_with(spark, clean + planted), small).collect()}
    assert all(got[i] == t for i, t in clean)
    assert sum(p not in got[i] and len(got[i]) < len(t) - 0.9 * len(p) for (i, t), p in zip(planted, passages * 3)) >= 0.9 * len(planted)
