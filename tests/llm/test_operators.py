"""Training-data operators against brute force on small fixtures, and their defined results for odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from factweave.llm import common, exact_dedup, jaccard_join, language, licenses, packing, quality, queries, sentencepiece_scan, suffix_dedup, topk, url_filter
from factweave.llm.bloom import BlockedBloom
from factweave.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, rep long, salt int, uid long, n long"


def frame(spark, rows):
    """Documents with extra columns of names that the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1.0, "x", 1, 2, 3, 4) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, base = prose(30_000), prose(120)
    rows = [(1, None), (2, ""), (3, "   \t\n"), (4, "one"), (5, "One"), (6, "two words"), (7, long), (8, long + " end"), (9, base), (10, base), (11, base.replace(" ", "\n")), (12, base + " tail"), (12, base + " tail"), (None, base), (None, None), (13, "x" * 1200), (14, "é" * 700)]
    rows += [(20 + k, prose(60) + " " + base[: 300 + 10 * k] + " " + prose(40)) for k in range(12)]
    rows += [(50 + k, " ".join(w if rng.random() > 0.01 else "zz" + str(k) for w in base.split())) for k in range(40)]
    return rows


def sets_of(rows, words):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()))
    return out


def test_hashes_tell_spans_apart():
    buf = np.frombuffer(b"ab ab abc ", np.uint8)
    h = common.spans_hash(buf, np.array([0, 3, 6, 0]), np.array([2, 5, 9, 1]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_exact_dedup(spark, odd):
    got = exact_dedup.exact_dedup(frame(spark, odd)).collect()
    norm = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    ids, sizes = {}, Counter(norm(t) for _, t in odd)
    for i, t in odd:
        if i is not None:
            ids[norm(t)] = min(i, ids.get(norm(t), i))
    want = sorted((str(i), str(ids.get(norm(t))), sizes[norm(t)], norm(t), i is not None and i == ids.get(norm(t))) for i, t in odd)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"], r["kept"]) for r in got) == want
    left = exact_dedup.survivors(frame(spark, odd))
    assert left.count() == len(ids) and left.columns == frame(spark, odd).columns


def test_index_keeps_what_came_before(spark):
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "test-index"), 4)
    first = exact_dedup.exact_dedup(frame(spark, [(5, "a"), (6, "b")]), index)
    assert first.where("kept").count() == 2
    again = exact_dedup.DigestIndex(spark, index.path, 4)
    second = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.exact_dedup(frame(spark, [(1, "b"), (2, "c"), (3, "c")]), again).collect()}
    assert second == {1: (6, False), 2: (2, True), 3: (2, False)}
    assert again.table().count() == 3


def test_index_keeps_its_number_of_buckets(spark):
    path = common.scratch(spark, "test-index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    rows = [(k, f"text {k}") for k in range(50)]
    assert exact_dedup.exact_dedup(frame(spark, rows), index).where("kept").count() == 50
    index.close()  # another session knows no table of that name
    with pytest.raises(ValueError, match="4 buckets"):
        exact_dedup.DigestIndex(spark, path, 16)
    again = exact_dedup.DigestIndex(spark, path)
    assert exact_dedup.exact_dedup(frame(spark, [(100 + k, t) for k, t in rows]), again).where("kept").count() == 0
    assert again.table().count() == 50


def test_large_groups_of_passages_stay_linear(spark, monkeypatch):
    """A passage between texts of their own: the parts that split its groups are a few a document, not one a byte."""
    monkeypatch.setattr(suffix_dedup, "WIDE", 20)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, made = noise(900), []
    stash = suffix_dedup.stash
    monkeypatch.setattr(suffix_dedup, "stash", lambda df, name: made.append((name, stash(df, name))) or made[-1][1])
    rows = [(k, noise(300) + shared + noise(300)) for k in range(200)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in got) == brute_removed(rows, 400)
    halves = sum(df.count() for name, df in made if name == "halves")
    assert 0 < halves <= 60 * len(rows)


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_join(spark, odd, words, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    rows = [r for r in odd if r != (12, odd[12][1])] + [odd[12]]
    sets = sets_of(rows, words)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if rows[a][0] is not None and rows[b][0] is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = sorted((str(i), len(sets[k][1]), str(least.get(find(k)) if i is not None else None)) for k, (i, _) in enumerate(rows))
    got = jaccard_join.jaccard_components(frame(spark, rows), words, percent).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want
    if words == 5:
        assert jaccard_join.keep_one(frame(spark, rows)).select("doc_id").distinct().count() == len({x[2] for x in want} - {"None"})


def test_jaccard_null_id_first(spark):
    """The row that a task sees first carries its set's shingles, and has no id."""
    text = " ".join(f"w{k}" for k in range(100))
    docs = frame(spark, [(None, text), (9, text), (10, text + " end")]).coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {None: None, 9: 9, 10: 9}
    assert [r["doc_id"] for r in jaccard_join.keep_one(docs).collect()] == [9]


def test_jaccard_two_texts_under_one_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(100)) for c in "ab")
    docs = frame(spark, [(5, a), (5, b), (3, a + " end"), (7, b + " end")])
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (7, 5)]
    assert sorted((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs).collect()) == [(3, a + " end"), (5, b)]


def brute_removed(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, raw):
        hit = np.zeros(len(t) + 1, np.int64)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                hit[k] += 1
                hit[k + length] -= 1
        gone = np.cumsum(hit)[:-1] > 0
        left = bytes(np.frombuffer(t, np.uint8)[~gone]) if len(t) else b""
        out.append((str(i), len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("wide", [1024, 2])
def test_suffix_dedup(spark, odd, wide, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    rows = [r for r in odd if r[0] not in (7, 8)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in got) == brute_removed(rows, 400)
    clean = suffix_dedup.clean(frame(spark, rows))
    assert clean.count() == len(rows) and clean.columns == frame(spark, rows).columns


def test_passages_go_from_the_length_on(spark):
    """A shared passage of over 50 words that is shorter than 400 bytes: op6's length leaves it, a shorter length removes it."""
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage = prose(55)
    assert 200 <= len(passage) < 390
    rows = [(k, prose(60) + " " + passage + " " + prose(60)) for k in range(3)]
    at = {n: suffix_dedup.suffix_dedup(frame(spark, rows), n, s).collect() for n, s in ((400, 100), (200, 50))}
    assert [sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in at[n]) for n in at] == [brute_removed(rows, n) for n in at]
    assert all(r["n_removed"] == 0 and passage in r["text"] for r in at[400])
    assert all(r["n_removed"] >= len(passage) and passage not in r["text"] for r in at[200])


@pytest.mark.parametrize("shard", [300, 1000, 1 << 18])
def test_merged_transforms_find_all_repeats(shard):
    rng = random.Random(8)
    base = [bytes(rng.choice(b"ab") for _ in range(1500)) for _ in range(3)]
    texts = [base[0][:700], base[1], base[0][250:600] + base[2][:500], b"x" * 400, b"", b"y" * 99, base[1][90:800]]
    flags = suffix_dedup.repeated_windows(texts, 100, 25, shard)
    seen = Counter(t[i : i + 100] for t in texts for i in range(len(t) - 99))
    assert flags.tolist() == [i + 100 <= len(t) and seen[t[i : i + 100]] > 1 for t in texts for i in range(len(t))]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(0, 0.3, 6)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, []), (420, [1.0, 2.0]), (421, [1.0, 2.0]), (40, rows[7][1]), (7, rows[7][1])]
    q = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(q, q.where("vec_id % 20 = 0"), 5, 64, 8).collect()
    x = [(i, [int(np.floor(64 * v)) for v in e]) for i, e in rows if e and all(v is not None and np.isfinite(v) for v in e)]
    want = []
    for i, a in x:
        if i % 20 == 0:
            s = sorted((-sum(p * r for p, r in zip(a, b)), j) for j, b in x if j != i and len(b) == len(a))[:5]
            want += [(i, j, -v) for v, j in s]
    # the vec_id 40 queries twice, and both rows rank together
    twice = [w for w in want if w[0] == 40]
    want = [w for w in want if w[0] != 40]
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got if r["query_id"] != 40) == sorted(want)
    assert {(r["vec_id"], r["score"]) for r in got if r["query_id"] == 40} <= {(v, s) for _, v, s in twice}


def test_top_k_meets_in_every_partition(spark):
    """Cells of both sides must come to the same task, also where partitions aren't joined into one."""
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = np.random.default_rng(4)
        rows = [(i, [float(v) for v in rng.normal(0, 0.3, 4)]) for i in range(400)]
        q = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        got = topk.top_k(q, q.where("vec_id % 20 = 0"), 5, 50, 7).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    x = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows}
    want = {i: sorted((-int(x[i] @ v), j) for j, v in x.items() if j != i)[:5] for i in range(0, 400, 20)}
    assert sorted((r["query_id"], -r["score"], r["vec_id"]) for r in got) == sorted((i, s, j) for i, w in want.items() for s, j in w)


def test_lists_are_read_until_no_outsider_can_qualify():
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (200, 6))
    x[5] = x[9] = 60  # far ahead of all: the first round shows it
    q = np.array([[1, 2, 1, 3, 1, 1], [-1, -1, 1, 1, -2, 2]])
    ids = np.arange(200)
    got = topk.Shard(ids, x).best(np.array([900, 901]), q, 2)
    assert got[3][0] == 1 and {(5, int(q[0] @ x[5])), (9, int(q[0] @ x[9]))} == {(int(v), int(s)) for i, v, s in zip(*got[:3]) if i == 900}
    assert got[3][1] > 1
    same = topk.Shard(ids, np.ones((200, 6), np.int64)).best(np.array([900]), q[:1], 3)  # bounds never part equals
    assert same[3].tolist() == [topk.ROUNDS] and same[1].tolist() == [0, 1, 2] and same[2].tolist() == [9, 9, 9]


def test_shards_before_set_the_bar():
    """The k-th best score of other shards ends reading early; a lane of shards gives what all pairs give, over all integer types."""
    rng = np.random.default_rng(5)
    x = np.floor(8 * rng.normal(0, 1, (3000, 32))).astype(np.int64)
    ids, k = np.arange(3000) * 3, 5
    s = x[:300] @ x.T
    s[np.arange(300), np.arange(300)] = -(10**9)
    bar = np.sort(s[:, :2000], axis=1)[:, -k]
    held = topk.Shard(ids[2000:], x[2000:])
    assert len(held.left(ids[:300], x[:300], k)[0]) >= 300 * k and held.compared >= topk.ROUNDS - 2
    free, held.compared = held.compared, None
    r, v, score, _ = held.left(ids[:300], x[:300], k, bar)
    assert held.compared < free and {(a, b) for a, b in zip(r, v)} >= {(a, 3 * b) for a, b in zip(*np.nonzero(s >= bar[:, None])) if b >= 2000}
    for scale in (1, 1000, 10**7):
        got = topk._lane([(ids[i : i + 700], scale * x[i : i + 700]) for i in range(0, 3000, 700)], ids[:300], scale * x[:300], k)
        order = np.lexsort((got[1], -got[2], got[0]))
        want = [(3 * a, 3 * b, int(scale * scale * s[a, b])) for a in range(300) for b in np.lexsort((ids, -s[a]))[:k]]
        assert list(zip(*(g[order].tolist() for g in got))) == want


def test_url_filter(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://WWW.Cheap-Pills.example.com/en/1"), (4, "https://a.example.org/es/1"), (5, "https://a.example.org/en/12"), (6, "https://b.org"), (7, "http://x.com/fr/1"), (8, "http://x.com/de/?q"), (9, "http://notexample.org/es/"), (10, "http://y.net/page.html#x"), (11, "http://y.net/other"), (11, "http://y.net/other"), (12, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit("k")).withColumn("rule", F.lit("r"))
    listed = spark.createDataFrame([("cheap-pills.example.com/",), ("y.net/page",), (None,), ("y.net/page",)], "key string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(pages, listed).collect()}
    assert got[1] == ("", "", None, "allow") and got[2] == ("", "", None, "allow")
    assert got[3] == ("www.cheap-pills.example.com", "/en/1", None, "block")
    assert got[4][2:] == ("example.org/es/", "block") and got[5][2:] == ("example.org/en/1", "block")
    assert got[6] == ("b.org", "", None, "allow") and got[7][2:] == ("com/fr/", "allow") and got[8][2:] == ("com/de/", "block")
    assert got[9][2:] == ("org/", "allow") and got[10][3] == "block" and got[11][3] == "allow"
    assert url_filter.url_filter(pages, listed).count() == len(rows)


def test_bloom_has_no_false_negatives():
    h = np.random.default_rng(1).integers(-(2**62), 2**62, 2000)
    b = BlockedBloom(1 << 16)
    b.add(h)
    assert b.has(h).all() and b.has(h + 1).mean() < 0.2


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 50)] + [(100, 99), (100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(e).collect()}
    assert got == {i: 0 for i in range(51)} | {99: 99, 100: 99, 101: 99}


def test_packing(spark, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    got = packing.pack(frame(spark, odd), path, 256).collect()
    want = Counter()
    for i, text in odd:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        at, k = 0, 0
        while at < len(ids):
            end = (len(ids) % 256 or 256) if at == 0 else at + 256
            want[str(i), k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())] += 1
            at, k = end, k + 1
    assert Counter((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 256
    assert len(bins) <= 1.02 * packing.least_bins([r["length"] for r in got], 256) + 1


def test_fast_ids_equal_the_library(spark, small):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()] + ["", " ", "\n\n  a", "<|endoftext|>", "a  b　c d", "don't 12 ３４ — 😀"]
    assert all(packing.encoder(path)(x).tolist() == t.encode(x, add_special_tokens=False).ids for x in texts)


def test_packing_reads_special_tokens_as_the_library(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "a  <|endoftext|>  b\n<|endoftext|><|endoftext|> c", "<|endoftext", "x " * packing.LONG_TEXT + "<|endoftext|>", "plain"]
    got = Counter((r["doc_id"], r["ids_crc32"], r["length"]) for r in packing.pack(frame(spark, list(enumerate(texts))), path, 1 << 20).collect())
    want = [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert want[0] == [64, 50256, 65, 0]
    assert got == Counter((k, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)) for k, ids in enumerate(want))


def test_crossover_keeps_every_piece():
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    people = []
    for k in range(2):
        bins, free = [], []
        packing.best_fit(bins, free, sorted(range(400), key=lambda x: -sizes[x] * (1 + k * rng.random())), sizes, 100)
        people.append((bins, free))
    bins, free = packing.crossover(*people, sizes, 100, rng)
    assert sorted(x for g in bins for x in g) == list(range(400))
    assert all(sum(sizes[x] for x in g) + f == 100 for g, f in zip(bins, free))


def test_crossover_improves_on_the_seed():
    """Triples that fill bins exactly: best fit by falling size misses them, generations find bins that it lacks."""
    better = 0
    for seed in range(6):
        rng = random.Random(seed)
        sizes = []
        for _ in range(60):
            a, b = rng.randint(260, 420), rng.randint(260, 420)
            sizes += [a, b, 1000 - a - b]
        first, free = [], []
        packing.best_fit(first, free, sorted(range(len(sizes)), key=lambda x: -sizes[x]), sizes, 1000)
        bins, room = packing.evolve(sizes, 1000, seed, generations=400)
        assert sorted(x for g in bins for x in g) == list(range(len(sizes))) and len(bins) >= packing.least_bins(sizes, 1000)
        assert len(bins) <= len(first) and all(sum(sizes[x] for x in g) + f == 1000 for g, f in zip(bins, room))
        better += len(bins) < len(first)
    assert better >= 4


def test_islands_and_migration_improve_a_cell(spark, monkeypatch):
    monkeypatch.setattr(packing, "GENERATIONS", 60)
    rng, sizes = random.Random(1), []
    for _ in range(60):
        a, b = rng.randint(260, 420), rng.randint(260, 420)
        sizes += [a, b, 1000 - a - b]
    first, free = [], []
    packing.best_fit(first, free, sorted(range(len(sizes)), key=lambda x: -sizes[x]), sizes, 1000)
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    got = packing.pack_level(items, 1000, 1).collect()
    assert sorted(r["uid"] for r in got) == list(range(len(sizes)))
    assert len({(r["cell"], r["bin"]) for r in got}) < len(first)


@pytest.mark.parametrize("chunk", [200, 5000])
def test_sentencepiece_scan(spark, odd, chunk):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    whole = sentencepiece_scan.codec(path).whole
    rng = random.Random(6)
    rows = [r for r in odd if r[0] not in (7, 8)] + [(90, " " * 900), (91, "日本語" * 400), (92, "".join(rng.choice("ab \n\tçé😀") for _ in range(1500))), (93, odd[6][1][:20_000])]
    got = Counter((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"], r["decoded_sha256"]) for r in sentencepiece_scan.summary(frame(spark, rows), path, chunk).collect())
    want = Counter()
    for i, t in rows:
        ids = whole.encode(t or "")
        want[str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want


def test_sentencepiece_levels(spark, odd, monkeypatch):
    """Chunks are combined over several levels."""
    monkeypatch.setattr(sentencepiece_scan, "FAN", 3)
    path = queries.tokenizer_file("piece_bpe_32k.model")
    whole = sentencepiece_scan.codec(path).whole
    rows = [(1, odd[6][1][:9000]), (2, "  a b " * 700), (2, odd[6][1][:700]), (3, "日本語 x" * 500)]
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"], r["n_chunks"]) for r in sentencepiece_scan.summary(frame(spark, rows), path, 200).collect())
    want = Counter()
    for i, t in rows:
        ids = whole.encode(t)
        n = len(sentencepiece_scan.codec(path).normal(t))
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(range(0, max(n - 100, 1), 200))] += 1
    assert got == want and max(k[3] for k in got) > 27


def test_max_plus_product_is_associative():
    rng = random.Random(1)
    m = lambda: {a: {b: float(rng.randint(-9, 9)) for b in "xyz" if rng.random() > 0.3} for a in "xyz"}
    a, b, c = m(), m(), m()
    f = sentencepiece_scan.combine
    assert f(f(a, b), c) == f(a, f(b, c))


def test_licenses(spark):
    rows = [(1, "Released under the MIT License."), (2, "foo\nThis is under the GNU Lesser General Public License.\nhis license"), (3, "my driver's license"), (4, None), (5, ""), (6, "plain text " * 50), (7, "GPLv2 and\r\nApache-2.0"), (7, "ISC License"), (None, "MIT License")]
    got = [(r["doc_id"], r["families"], r["n_licensed"], r["n_unknown"]) for r in licenses.scan(frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, "MIT", 1, 0), (2, "LGPL", 1, 1), (3, "", 0, 1), (4, "", 0, 0), (5, "", 0, 0), (6, "", 0, 0), (7, "Apache-2.0,GPL-2.0,ISC", 3, 0), (7, "Apache-2.0,GPL-2.0,ISC", 3, 0), (None, "MIT", 1, 0)]))


def test_license_texts_and_wrapped_lines(spark):
    bsd, isc, mit = (licenses.BODIES[k][0] for k in ("BSD", "ISC", "MIT"))
    wrap = lambda t, mark="": ("\n" + mark).join(re.findall(r".{1,40}(?: |$)", t))
    texts = [
        (bsd, "BSD"), (wrap(bsd), "BSD"), ("some text\n\n" + wrap(isc, " * ") + "\n\nmore text", "ISC"), (mit, "MIT"), (wrap(mit), "MIT"), ("Licensed under the Apache\nLicense, Version 2.0", "Apache-2.0"),
        ("Released under GPL version 2.", "GPL-2.0"), ("Released under the GNU GPL v3.", "GPL-3.0"), ("Released under the MIT licence.", "MIT"),
    ]
    for family in ("GPL-2.0", "GPL-3.0"):
        texts.append((wrap("This program is free software; you can redistribute it and/or modify it under the terms of the " + licenses.BODIES[family][0] + " of the License, or (at your option) any later version."), family))
    got = {r["doc_id"]: (r["families"], r["n_licensed"], r["n_unknown"]) for r in licenses.scan(frame(spark, [(k, t) for k, (t, _) in enumerate(texts)])).collect()}
    assert got == {k: (family, 1, 0) for k, (_, family) in enumerate(texts)}


def test_license_families_equal_brute_force(spark, small):
    """Every line and paragraph of documents and of license texts, scored and compared one by one."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-k, "intro\n\n" + b.replace(". ", ".\n") + "\n\nmore") for k, b in enumerate((b for bs in licenses.BODIES.values() for b in bs), 1)]
    model, classes = licenses.train(), [licenses.UNKNOWN, *licenses.NAMES]

    def family(unit):
        grams = set(licenses.grams(licenses.tokens(unit)))
        fits = {f for f, needed, least in licenses.templates() if len(grams & set(needed)) >= least}
        z = (np.array(model["bias"]) + sum((np.array(model["weights"][g]) for g in grams if g in model["weights"]), np.zeros(len(classes)))) / model["temperature"]
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p[1:].argmax()) + 1
        return classes[k] if classes[k] in fits and p[k] >= model["least"] else None

    want = {}
    for i, text in docs:
        found, n = set(), 0
        for block in re.split(r"(?:\r\n?|\n)(?:[^\w\r\n]*(?:\r\n?|\n))+", text or ""):
            lines = [x for x in re.split(r"[\r\n]+", block)]
            single = [f for f in map(family, lines) if f]
            whole = family(block) if len(lines) > 1 else None
            found.update(single)
            n += len(single)
            if whole and whole not in single:
                found.add(whole)
                n += 1
        want[i] = (",".join(sorted(found)), n)
    got = {r["doc_id"]: (r["families"], r["n_licensed"]) for r in licenses.scan(frame(spark, docs), model).collect()}
    assert got == want and sum(bool(f) for f, _ in want.values()) > 10


def test_no_template_is_confirmed_without_a_candidate_word():
    for family, needed, least in licenses.templates():
        assert sum(not re.search(licenses.CANDIDATE, g) for g in needed) < least, (family, needed)


def test_license_gate_is_exact():
    assert all(re.search(licenses.GATE, name) for names in licenses.NAMES.values() for name in names)


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op1_quality_knn(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_equals_brute_force(spark):
    """Votes of whole texts against cosines with every labelled vector, one by one."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    v = queries.quality_voter(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, v).collect()}
    share = v.labels.mean()
    for r in docs.limit(50).collect():
        x = quality.weighted(quality.frame_of([r["text"]]).to_numpy(), v.idf)[0] @ v.axes
        x = x / max(np.linalg.norm(x), 1e-9)
        near = sorted(((float(sum(a * b for a, b in zip(x, p))), k) for k, p in enumerate(v.points)), reverse=True)[: quality.NEIGHBOURS]
        w = [np.exp(quality.SHARP * (c - near[0][0])) * (v.prior / share if v.labels[k] else (1 - v.prior) / (1 - share)) for c, k in near]
        p = min(max(sum(a * v.labels[k] for a, (_, k) in zip(w, near)) / sum(w), 1e-3), 1 - 1e-3)
        want = 1 / (1 + np.exp(-(v.slope * np.log(p / (1 - p)) + v.shift)))
        assert abs(got[r["doc_id"]] - want) < 0.02


def test_texts_without_features_get_the_prior(spark):
    d = "/root/testdata/sf0.01"
    v = queries.quality_voter(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    got = [r["score"] for r in quality.score(frame(spark, [(1, None), (2, "")]), v).collect()]
    assert np.allclose(got, v.prior)


def test_quality_of_odd_rows(spark, odd):
    docs = frame(spark, odd)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    voter = quality.train(docs, labels)
    got = quality.score(docs, voter).collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.keep(docs, voter).columns == docs.columns
    none = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}


def test_language(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op10_language_id(spark, d).where("held_out").join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("x", None), (None, "en")] * 5)], "doc_id long, text string, lang string")
    docs = frame(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "the mat"), (4, "la table"), (None, "le chat"), (5, "日本"), (6, "€ ±")])
    got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(docs, train).collect()]
    assert got[:3] == [(1, "und"), (2, "und"), (3, "und")] and (4, "en") in got and (4, "fr") in got and (None, "fr") in got and (6, "und") in got
    assert all(r["lang_pred"] == "und" for r in language.identify(docs, train.limit(0)).collect())
    assert all(r["lang_pred"] == "und" for r in language.identify(docs, train, reject_below=1.1).collect())


def test_cross_entropies_equal_brute_force():
    """The arrays' sums against the recursion of the model, character by character."""
    counts = {"en": Counter("the cat sat on the mat and the dog ran".split()), "fr": Counter("le chat est sur la table et le chien".split())}
    m = language.fit(counts)

    def log_p(part, ctx, c):
        prob, back, floor = part
        if ctx + c in prob:
            return prob[ctx + c]
        return floor if not ctx else back.get(ctx, 0.0) + log_p(part, ctx[1:], c)

    words = ["cat", "chien", "zebra", "théâtre", "a"]
    got, n = language.word_scores(m, words)
    for k, lang in enumerate(m.langs):
        part = language.fit_one(counts[lang])
        for w, s, chars in zip(words, got[:, k], n):
            t = "^" + w + "$"
            assert chars == len(w) + 1
            assert abs(s - sum(log_p(part, t[max(0, i - language.ORDER + 1) : i], t[i]) for i in range(1, len(t)))) < 1e-3


def test_language_texts_equal_brute_force(spark, odd):
    """Predictions of whole texts against word sums in Python."""
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null")
    m = language.fit(language.training_counts(train))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(train, train).collect()}
    import regex

    for r in train.limit(60).collect():
        words = [w for w in regex.split(r"[^\p{L}\p{M}]+", (r["text"] or "").lower()) if w]
        if not regex.search(r"\p{L}", r["text"] or ""):
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        s, n = language.word_scores(m, words)
        ce = s.sum(axis=0) / n.sum()
        two = np.sort(ce)[-2:]
        assert got[r["doc_id"]][0] == m.langs[int(ce.argmax())]
        assert abs(got[r["doc_id"]][1] - 1 / (1 + np.exp(-min(50, m.slope * (two[1] - two[0]) * np.sqrt(len(words)) + m.shift)))) < 1e-3


def test_foreign_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    gibberish = spark.createDataFrame([(-k, "zxqvkj wqxzh jjqkz vvxqw kzzxj qwvkx " * 3) for k in range(1, 6)], "doc_id long, text string")
    got = language.identify(docs.select("doc_id", "text").unionByName(gibberish), docs, reject_foreign=True).collect()
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] < 0)
    assert np.mean([r["lang_pred"] != "und" for r in got if r["doc_id"] >= 0]) > 0.9


def test_kneser_ney_sums_to_one():
    prob, back, floor = language.fit_one({"aba": 3, "abc": 1, "ba": 2}, 3)
    seen = {g[-1] for g in prob if len(g) == 1}

    def p(ctx, c):
        if ctx + c in prob:
            return np.exp(prob[ctx + c])
        return np.exp(floor) if not ctx else np.exp(back.get(ctx, 0.0)) * p(ctx[1:], c)

    for ctx in ("", "a", "^a", "ab"):
        # mass is kept for 200 characters never seen
        assert abs(sum(p(ctx, c) for c in seen) + 200 * p(ctx, "?") - 1) < 1e-9


def test_empty_tables(spark):
    docs = frame(spark, []).limit(0)
    path = queries.tokenizer_file("byte_bpe_50k.json")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [exact_dedup.exact_dedup(docs), exact_dedup.survivors(docs), jaccard_join.jaccard_components(docs), jaccard_join.keep_one(docs), suffix_dedup.suffix_dedup(docs), suffix_dedup.clean(docs), packing.pack(docs, path), sentencepiece_scan.summary(docs, queries.tokenizer_file("piece_bpe_32k.model")), licenses.scan(docs), quality.score(docs, quality.train(docs, labels)), language.identify(docs, docs)]
    vectors = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    results += [topk.top_k(vectors, vectors), url_filter.url_filter(spark.createDataFrame([], "page_id long, url string"), url_filter.default_list(spark))]
    assert [r.count() for r in results] == [0] * len(results)
