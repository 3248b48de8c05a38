"""N-gram Jaccard join by grouped prefixes.

Equal shingle sets are one class.  A class is indexed by its prefix: the first few shingles in a global order
that puts frequent ones last, of which two sets of enough similarity must share some.  Classes with the same
prefix and size are one group; pairs of groups are filtered by size and by what the shared prefix leaves
possible, and only then expanded to their members, whose whole sets are compared.

Links inside a group, or inside the list of a frequent shingle, are first sought with one leader each.  What
that leaves in different components is compared exhaustively, so the components are exact without all pairs of a large group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, drop_stash, fresh, give_back, mix, runs, small_batches, spans_hash, stash, text_blocks
from .components import components
from .exact_dedup import SALTS
from .bloom import shared_bloom

WORDS, PERCENT = 5, 80
#: A shingle in more groups than this is frequent; as many of them are put last as the broadcast holds.
FREQUENT, FREQUENT_MOST = 32, 1 << 18

_odd = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> list[np.ndarray]:
    """For each document of a block its sorted distinct 64-bit shingle hashes."""
    buf = LOWER[buf]
    starts, ends, first = runs(~IS_SPACE[buf], offs)
    h = spans_hash(buf, starts, ends)
    n = len(h)
    grams = np.zeros(0, np.uint64)
    if n >= words:
        grams = h[: n - words + 1] * _odd[0]
        for j in range(1, words):
            grams = grams + h[j : n - words + 1 + j] * _odd[j]
        grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:  # the whole sequence as one shingle
            out.append(mix(np.array([(h[a:b] * _odd[40 : 40 + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest_of(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return bytes(memoryview(np.array([np.bitwise_xor.reduce(mix(s)), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64)))


def prefix_length(n: int, percent: int) -> int:
    """Of n ordered elements so many that a similar set must share one of them."""
    return n - -(-percent * n // 100) + 1


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offs = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.view(np.int64)))


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, h (a hash of the text), n, digest and tokens (the shingles of the counted zone) of the rows.

    Rows without an id, and sets that a task has sent already, go without their shingles.
    """
    zone = np.uint64(int(2**64 * min(0.9, 2 * (100 - percent) / 100)))

    def sign(batches):
        seen: set[bytes] = set()
        for b in batches:
            named, at = b.column(0).is_valid().to_pylist(), 0
            for _, buf, offs in text_blocks(b.column(2), 1 << 19):
                sets = shingle_sets(buf, offs, words)
                own = slice(at, at + len(sets))
                at += len(sets)
                digests, some = [digest_of(s) for s in sets], []
                for d, s, ok in zip(digests, sets, named[own]):
                    k = 0 if d in seen or not ok else max(int(np.searchsorted(s, zone)), prefix_length(len(s), percent) if len(s) else 0)
                    some.append(s[:k])
                    if ok:
                        seen.add(d)
                if len(seen) > 100_000:
                    seen = set()
                yield pa.RecordBatch.from_arrays([b.column(0)[own], b.column(1)[own], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), _lists(some)], ["doc_id", "h", "n", "digest", "tokens"])
        give_back()

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(sign, "doc_id long, h long, n long, digest binary, tokens array<long>")


def _frequent(classes: DataFrame) -> np.ndarray:
    """The most frequent shingles of the counted zone, sorted; their number is bounded."""
    counts = stash(classes.select(F.explode("tokens").alias("t")).groupBy("t").count().where(F.col("count") > FREQUENT), "counts")
    least, held = FREQUENT, 0
    for r in counts.groupBy("count").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("count")).limit(100_000).toLocalIterator():
        if held + r["k"] > FREQUENT_MOST:
            least = r["count"]
            break
        held += r["k"]
    got = counts.where(F.col("count") > least).select("t").toPandas()["t"].to_numpy(np.int64)
    drop_stash(counts)
    return np.sort(got.view(np.uint64))


def _indexed(classes: DataFrame, frequent, percent: int) -> DataFrame:
    """rep, n, gid (of prefix and size), share of frequent shingles, rare and hot prefix shingles."""

    def order(batches):
        hot = frequent.value
        for b in batches:
            n = b.column(1).to_pylist()
            values, offs = b.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(b.column(2).value_lengths().to_numpy(zero_copy_only=False))])
            is_hot = np.isin(values, hot)
            gid, share, rare, hots, size = [], [], [], [], []
            for k, m in enumerate(n):
                t, f = values[offs[k] : offs[k + 1]], is_hot[offs[k] : offs[k + 1]]
                p = prefix_length(m, percent)
                calm = t[~f][:p]
                warm = t[f][: p - len(calm)]
                rare.append(calm)
                hots.append(warm)
                size.append(p)
                share.append(float(f.mean()) if len(f) else 0.0)
                gid.append(int(mix(np.array([np.bitwise_xor.reduce(mix(np.concatenate([calm, warm]))) + np.uint64(m)], np.uint64))[0].view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gid, pa.int64()), pa.array(share), _lists(rare), _lists(hots)], ["rep", "n", "gid", "share", "rare", "hot"])
        give_back()

    return classes.select("rep", "n", "tokens").mapInArrow(order, "rep long, n long, gid long, share double, rare array<long>, hot array<long>")


LONG_LIST = 512
PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("t", pa.int64())])


def _meet(percent: int):
    """Sorted (t, gid, n) rows -> pairs of groups with counts of shared shingles (t null).

    Lists longer than LONG_LIST aren't held: their rows go out as they come, with their shingle t and b null.
    """

    def emit(pairs):
        a, b, na, nb = (np.concatenate(x) for x in zip(*pairs))
        order = np.lexsort((b, a))
        a, b, na, nb = a[order], b[order], na[order], nb[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        c = np.diff(np.append(first, len(a)))
        n = len(first)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[first], b[first], c, na[first], nb[first])] + [pa.nulls(n, pa.int64())], schema=PAIR)

    def of_list(g, n):
        g, first = np.unique(g, return_index=True)
        n = n[first]
        i, j = np.triu_indices(len(g), 1)
        ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        return g[i[ok]], g[j[ok]], n[i[ok]], n[j[ok]]

    def long_rows(t, g, n):
        return pa.RecordBatch.from_arrays([pa.array(g), pa.nulls(len(g), pa.int64()), pa.nulls(len(g), pa.int64()), pa.array(n), pa.nulls(len(g), pa.int64()), pa.array(np.full(len(g), t, np.int64))], schema=PAIR)

    def run(batches):
        pairs, held = [], 0
        last, open_g, open_n, long = None, [], [], False
        for batch in batches:
            t, g, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if not len(t):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
            size = np.diff(cuts)
            two = np.flatnonzero(size == 2)  # most lists that matter have two entries: all at once
            two = two[(two > 0) & (two < len(size) - 1)]
            i, j = cuts[two], cuts[two] + 1
            ok = (g[i] != g[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            swap = g[i] > g[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            if len(i):
                pairs.append((g[i], g[j], n[i], n[j]))
                held += len(i)
            for k in np.flatnonzero((size > 2) | (np.arange(len(size)) == 0) | (np.arange(len(size)) == len(size) - 1)).tolist():
                lo, hi = cuts[k], cuts[k + 1]
                if t[lo] != last:
                    if open_g and not long:
                        pairs.append(of_list(np.concatenate(open_g), np.concatenate(open_n)))
                        held += len(pairs[-1][0])
                    last, open_g, open_n, long = t[lo], [], [], False
                if long:
                    yield long_rows(last, g[lo:hi], n[lo:hi])
                    continue
                open_g.append(g[lo:hi])
                open_n.append(n[lo:hi])
                if sum(map(len, open_g)) > LONG_LIST:
                    all_g, first = np.unique(np.concatenate(open_g), return_index=True)
                    open_g, open_n = [all_g], [np.concatenate(open_n)[first]]
                    if len(all_g) > LONG_LIST:
                        long = True
                        yield long_rows(last, all_g, open_n[0])
                        open_g, open_n = [], []
            if held > 300_000:
                yield emit(pairs)
                pairs, held = [], 0
        if open_g and not long:
            pairs.append(of_list(np.concatenate(open_g), np.concatenate(open_n)))
        if pairs:
            yield emit(pairs)
        give_back()

    return run


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """rep and its whole sorted set, of the wanted classes: found again in the texts, not kept for all."""
    ids = wanted.join(classes.select("rep", "least_id", "digest"), "rep")

    ids = stash(ids, "wanted")
    held = shared_bloom(ids.select(F.xxhash64("least_id").alias("h")))

    def sets(batches):
        for b in batches:
            b = b.filter(pa.array(held.value.has(b.column(2).to_numpy(zero_copy_only=False))))
            at = 0
            for _, buf, offs in text_blocks(b.column(1), 1 << 19):
                got = shingle_sets(buf, offs, words)
                own = b.column(0).slice(at, len(got))
                at += len(got)
                yield pa.RecordBatch.from_arrays([own, pa.array([digest_of(s) for s in got], pa.binary()), _lists(got)], ["doc_id", "digest", "items"])
        give_back()

    found = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(sets, "doc_id long, digest binary, items array<long>")
    found = found.withColumnRenamed("doc_id", "least_id").join(ids, ["least_id", "digest"]).select("rep", "items")
    return stash(found.dropDuplicates(["rep"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def check(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = pairs.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("y")), "b")
    two = one.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("x")), "a")
    return two.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _pair_bound(n1: str, m1: str, n2: str, m2: str, percent: int) -> str:
    """Sizes n and most elements m that any other set can share: can the two be similar enough?"""
    return f"(100 + {percent}) * least({m1}, {m2}) >= {percent} * ({n1} + {n2}) and 100 * least({n1}, {n2}) >= {percent} * greatest({n1}, {n2})"


def _dense_lists(sets: DataFrame, percent: int) -> DataFrame:
    """t, rep, n, m, pos of the prefixes of dense classes in the exact order of frequency among them.

    m is the number of elements that another dense class has too; classes that can't be similar to any are left out.
    """
    items = sets.select("rep", F.explode("items").alias("t"))
    counts = items.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    shared = items.join(counts, "t").groupBy("rep").agg(F.count(F.lit(1)).alias("m"), F.array_sort(F.collect_list(F.struct("k", "t"))).alias("o"))
    sized = shared.join(sets.select("rep", F.size("items").cast("long").alias("n")), "rep").where(f"100 * m >= {percent} * n")
    # the elements that no other class has come first in the order and take part of the prefix
    own = f"n - cast(ceil({percent} * n / 100) as long) + 1 - (n - m)"
    return sized.select("rep", "n", "m", F.posexplode(F.expr(f"slice(o, 1, cast(greatest({own}, 0) as int))")).alias("k", "e")).select(F.col("e.t").alias("t"), "rep", "n", "m", (F.col("n") - F.col("m") + F.col("k") + 1).alias("pos"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row.

    Two rows link when 100 * |A & B| >= percent * |A | B|.  Null, empty and wordless texts have no shingles
    and link with nothing, not even with each other; texts of fewer words are one shingle.  A row with a null doc_id is in no
    component (null).  Repeated rows stay repeated; rows of one doc_id with different texts are judged each by its text, and
    share a component only if linked.  Other columns are ignored; an empty table gives no rows.
    Words are compared by 64-bit and sets by 128-bit hashes.
    """
    return _components_of_rows(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def _components_of_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``jaccard_components`` with h, a hash that tells apart the texts of one doc_id."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # texts are read once; of all rows the digests stay, the shingles go into the classes
    signed = stash(_classes(docs, words, percent), "signed")
    rows = stash(signed.drop("tokens"), "rows")
    named = signed.where("n > 0 and doc_id is not null")
    # copies: one row a class, of any number of rows (a class's shingles come from whichever row carried them); rep is a
    # number of the class, as one doc_id can be the least of several
    classes = named.groupBy("n", "digest").agg(F.min("doc_id").alias("least_id"), F.max("tokens").alias("tokens"))
    classes = stash(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    drop_stash(signed)
    frequent = spark.sparkContext.broadcast(_frequent(classes))
    able = classes.where(f"{percent} * n <= 100 * (n - 1) or {percent} * (n + 1) <= 100 * n")  # a smaller set is similar to its equals only
    index = stash(_indexed(able, frequent, percent).select("rep", "n", "gid", "share", "rare", "hot"), "index")
    members = index.select("rep", "n", "gid", "share")
    entries = index.select(F.explode("rare").alias("t"), "gid", "n").repartition(width, "t").sortWithinPartitions("t", "gid")
    met = stash(entries.mapInArrow(_meet(percent), "a long, b long, c long, na long, nb long, t long"), "met")
    # dense groups have frequent shingles (or lists too long to hold) in their prefix: pairs of two such are sought below
    dense = index.where("size(hot) > 0").select("gid").unionByName(met.where("t is not null").select(F.col("a").alias("gid"))).distinct()
    dense = stash(dense.withColumn("dense", F.lit(True)), "dense")
    # of a pair with another group every shared prefix element has been counted, so what remains bounds the overlap
    pairs = met.where("t is null").groupBy("a", "b").agg(F.sum("c").alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    left = lambda n: f"({n} - ({n} - cast(ceil({percent} * {n} / 100) as long) + 1))"  # noqa: E731  elements after the prefix
    may_link = f"(100 + {percent}) * (c + greatest({left('na')}, {left('nb')})) >= {percent} * (na + nb)"
    pairs = pairs.where(may_link)
    pairs = (
        pairs.join(dense.select(F.col("gid").alias("a"), F.col("dense").alias("la")), "a", "left")
        .join(dense.select(F.col("gid").alias("b"), F.col("dense").alias("lb")), "b", "left")
        .where("la is null or lb is null")
        .select("a", "b")
    )
    pairs = stash(pairs, "pairs")
    drop_stash(met)
    leader = members.groupBy("gid").agg(F.max_by("rep", F.struct("share", -F.col("rep"))).alias("leader"), F.count(F.lit(1)).alias("k"))
    leader = stash(leader, "leaders")

    # the classes whose whole sets are needed
    groups = pairs.select(F.col("a").alias("gid")).unionByName(pairs.select(F.col("b").alias("gid"))).unionByName(dense.select("gid")).unionByName(leader.where("k > 1").select("gid")).distinct()
    sets = _sets(docs, classes, members.join(groups, "gid").select("rep"), words)
    lists = stash(_dense_lists(sets.join(members.join(dense, "gid").select("rep"), "rep"), percent), "lists")

    # leaders first: one partner a group and a dense class here, the exhaustive step has the others
    lead = lambda df, g, out: df.join(leader.select(F.col("gid").alias(g), F.col("leader").alias(out)), g)
    stars = members.join(leader.where("k > 1"), "gid").where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    chosen = pairs.groupBy("b").agg(F.min("a").alias("a")).unionByName(pairs.groupBy("a").agg(F.min("b").alias("b")).select("b", "a"))
    chosen = lead(lead(chosen.distinct(), "a", "x"), "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    lists = lists.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)))
    best = F.struct((F.col("m") / F.col("n")).alias("share"), (-F.col("rep")).alias("r"), "n", "m")
    hub = lists.groupBy("t", "salt").agg(F.max(best).alias("h")).groupBy("t").agg(F.max("h").alias("h"), F.collect_list("salt").alias("salts"))
    spokes = lists.join(hub.withColumn("salt", F.explode("salts")), ["t", "salt"]).where("rep != -h.r").where(_pair_bound("n", "m", "h.n", "h.m", percent))
    spokes = spokes.groupBy("rep").agg(F.max("h").alias("h")).select((-F.col("h.r")).alias("a"), F.col("rep").alias("b"))
    first = stars.unionByName(chosen).unionByName(spokes).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = stash(first, "first")
    links = stash(_verified(first, sets, percent), "links")
    found = stash(components(links), "found")

    # then everything that may still join two components
    label = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("gid", "rep", F.coalesce("component", "rep").alias("comp"))
    label = stash(label.join(groups, "gid"), "labels")
    x = label.select(F.col("gid").alias("a"), F.col("rep").alias("ra"), F.col("comp").alias("ca"))
    y = label.select(F.col("gid").alias("b"), F.col("rep").alias("rb"), F.col("comp").alias("cb"))
    of_pairs = pairs.join(x, "a").join(y, "b").where("ca != cb").select("ra", "rb")
    mixed = label.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("gid")
    x = label.join(mixed, "gid")
    inside = x.select("gid", F.col("rep").alias("ra"), F.col("comp").alias("ca")).join(x.select("gid", F.col("rep").alias("rb"), F.col("comp").alias("cb")), "gid").where("ca != cb and ra < rb").select("ra", "rb")
    lists = lists.join(label.select("rep", "comp"), "rep")
    several = lists.groupBy("t", "salt").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("k"))
    several = several.groupBy("t").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("k").alias("k"), F.collect_list("salt").alias("salts")).where("lo != hi")
    several = several.select("t", F.ceil(F.col("k") / LONG_LIST).alias("blocks"), F.explode("salts").alias("salt"))
    # a long list is cut into blocks: each row of one side meets those of the other block by block
    mixed_lists = lists.join(several, ["t", "salt"]).drop("salt")
    other = mixed_lists.select("t", *(F.col(c).alias(f"{c}2") for c in ("rep", "n", "m", "pos", "comp")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    mixed_lists = mixed_lists.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "rep"), F.col("blocks")))
    # a similar pair's first shared element stands early enough in both for the overlap that the two sizes need
    need = f"(cast(ceil({percent} * (n + n2) / (100 + {percent})) as long))"
    early = f"pos <= n - {need} + 1 and pos2 <= n2 - {need} + 1"
    across = mixed_lists.join(other, ["t", "block"]).where("comp != comp2 and rep < rep2").where(_pair_bound("n", "m", "n2", "m2", percent)).where(early)
    across = across.select("rep", "rep2", "n", "n2").distinct()
    prefix = lists.groupBy("rep").agg(F.collect_set("t").alias("p"))
    across = across.join(prefix, "rep").join(prefix.select(F.col("rep").alias("rep2"), F.col("p").alias("p2")), "rep2")
    across = across.select(F.col("rep").alias("ra"), F.col("rep2").alias("rb"), F.col("n").alias("na"), F.col("n2").alias("nb"), F.size(F.array_intersect("p", "p2")).alias("c")).where(may_link).select("ra", "rb")
    rest = of_pairs.unionByName(inside).unionByName(across).select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    rest = stash(rest.join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = _verified(rest, sets, percent)
        found = stash(components(stash(more.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))), "links")), "found")

    # back to the rows, copies dealt by salt
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    by_salt = rows.where("n > 0 and doc_id is not null").groupBy("n", "digest", "salt").agg(F.count(F.lit(1)).alias("k"))
    whole = by_salt.groupBy("n", "digest").agg(F.collect_list("salt").alias("salts"))
    ids = classes.select("n", "digest", "rep", "least_id")
    linked = found.withColumnRenamed("node", "rep").join(ids, "rep")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, "component").select("n", "digest", "component_id")
    # a class without links is its own component
    named = ids.select("n", "digest", F.col("least_id").alias("component_id")).unionByName(linked).groupBy("n", "digest").agg(F.min("component_id").alias("component_id"))
    whole = whole.join(named, ["n", "digest"]).select("n", "digest", "component_id", F.explode("salts").alias("salt"))
    return rows.join(whole, ["n", "digest", "salt"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "h")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows whose doc_id is their component's, with the columns of ``docs``.

    Rows of one doc_id are told apart by their texts.  Rows without a doc_id are in no component and not returned: a caller who
    has such rows numbers them first.
    """
    number, text = fresh(docs, "id"), fresh(docs, "hash")
    kept = _components_of_rows(docs, words, percent).where("doc_id = component_id").select(F.col("doc_id").alias(number), F.col("h").alias(text)).distinct()
    return docs.join(kept, (F.col("doc_id") == F.col(number)) & (F.xxhash64("text") == F.col(text)), "left_semi")
