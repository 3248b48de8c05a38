"""Exact top-k by inner product, without random access.

Each component is a list sorted by value.  A shard's lists are read one after the other in rounds, each from the end
that is best for a query: what has been read and the values last read give a lower and an upper bound of every
candidate's score.  Candidates whose upper bound is under the k-th best lower bound are out; reading stops
when no outsider can qualify, and the winners get their final scores.  A task reads several shards one after the other:
the k-th best score of those before is a lower bound too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

K, SCALE = 20, 64
#: Vectors in a shard and queries in a block: what one task holds, whatever the table's size.
SHARD, BLOCK = 8192, 2048
#: Rounds in which a list is read to its end; bounds are compared after each.
ROUNDS = 8
#: Shards that a task reads one after the other, and the most tasks.
LANE, MOST_TASKS = 8, 4096
#: Queries whose bounds are compared at once (the first time fewer), pairs whose scores are ended at once.
GROUP, PILOT, PAIRS = 256, 32, 1 << 16
#: One pair in so many is left: pairs are read to the end one by one from here.
FEW = 32


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, q (floor(scale * x) as longs, x as double) and n of the vectors that take part."""
    fine = "vec_id is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(double(x)) = double('Infinity'))"
    return vectors.where(fine).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("q"), F.size("embedding").alias("n")
    )


def _kind(a: np.ndarray, b: np.ndarray):
    """The float type in which every inner product of a and b is exact, or int64."""
    big = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) * 2
    return np.float32 if big < 2**24 else np.float64 if big < 2**53 else np.int64


class Shard:
    """The sorted lists of a shard: one a component, read from its upper end where a query's weight is positive, else from its lower end."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rounds: int = ROUNDS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        n = len(self.x)
        self.lists = np.argsort(self.x, axis=0, kind="stable")
        ranked = np.take_along_axis(self.x, self.lists, axis=0)
        #: how many entries of each list have been read after each round
        self.depth = [-(-n * r // rounds) for r in range(1, rounds + 1)]
        # lists from the upper ends, then the same from the lower ends: the worst value, the frontiers
        self.worst = np.concatenate([ranked[0], ranked[-1]])
        self.front = [np.concatenate([ranked[n - t], ranked[t - 1]]) for t in self.depth]
        self._round, self._bounds = None, {}

    def _read_in(self) -> np.ndarray:
        """The round in which each entry is read, of the lists from the upper ends, then from the lower ends."""
        if self._round is None:
            n, d = self.x.shape
            by_place = np.searchsorted(np.array(self.depth), np.arange(1, n + 1)).astype(np.int8)
            self._round = np.empty((n, 2 * d), np.int8)
            np.put_along_axis(self._round[:, :d], self.lists, by_place[::-1, None], axis=0)
            np.put_along_axis(self._round[:, d:], self.lists, by_place[:, None], axis=0)
        return self._round

    def bound(self, r: int, kind, upper: bool) -> np.ndarray:
        """What each entry gives to a candidate's bound after round r: its value where it has been read, else the value last read or the worst."""
        if (r, kind, upper) not in self._bounds:
            d = self.x.shape[1]
            if upper:  # no unread entry is better than the frontier, no read one is worse
                out = np.hstack([np.maximum(self.x, self.front[r][:d]), np.minimum(self.x, self.front[r][d:])])
            else:
                out = np.where(self._read_in() <= r, np.hstack([self.x, self.x]), self.worst)
            self._bounds[r, kind, upper] = out.astype(kind)
        return self._bounds[r, kind, upper]

    def best(self, qid: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows (query, vec, score) of the k best of each query in this shard, and each query's number of rounds."""
        r, ids, s, rounds = self.left(qid, q, k)
        r, ids, s = _ranked(r, ids, s, k)
        return qid[r], ids, s, rounds

    def left(self, qid: np.ndarray, q: np.ndarray, k: int, known: np.ndarray | None = None, start: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows (place of the query, vec, score), the k best of each query among them, and each query's number of rounds.

        A round reads the next entries of all lists.  What is read counts as it is; for the rest, the lists' worst
        values give a candidate's lower bound, and the values last read (no unread entry is better) its upper bound.  A query
        is done when k candidates are left that can be among its best; candidates that no query can use are read no more.

        ``known`` is a score that a query has reached k times in other shards (the least long: none): candidates under it are out.
        Bounds are first compared after round ``start``.
        When few pairs of a query and a candidate are left, their lists are read to the end one pair at a time.
        """
        kind = _kind(q, self.x)
        least = np.finfo(kind).min if kind != np.int64 else np.iinfo(kind).min
        weight = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]).astype(kind)
        known = np.full(len(qid), np.iinfo(np.int64).min) if known is None else known
        known = np.where(known == np.iinfo(np.int64).min, least, known.astype(kind)).astype(kind)
        todo, cand = np.arange(len(qid)), None  # None: all
        rounds, out, last = np.zeros(len(qid), np.int64), [], len(self.front) - 1
        for r in range(min(start, last), last + 1):
            of = (lambda m: m) if cand is None else (lambda m: m[cand])
            own = self._own(qid[todo], cand)
            w, need = weight[todo], known[todo]
            cold = need == least
            if cold.any():  # the k-th best lower bound of those who know no better one
                low = w[cold] @ of(self.bound(r, kind, False)).T
                at = np.cumsum(cold) - 1
                mine = cold[own[0]]
                low[at[own[0][mine]], own[1][mine]] = least
                have = min(k, low.shape[1])
                need[cold] = np.partition(low, low.shape[1] - have, axis=1)[:, low.shape[1] - have]
            high = w @ of(self.bound(r, kind, True)).T
            alive = high >= need[:, None]
            alive[own] = False
            left = np.count_nonzero(alive, axis=1)
            few = left.sum() * FEW <= alive.size
            done = (left <= k) | (r == last) | few
            rounds[todo] = np.where(left <= k, r + 1, last + 1 if few else r + 1)
            row, col = np.nonzero(alive) if done.all() else np.nonzero(alive & done[:, None])
            out.append((todo[row], col if cand is None else cand[col]))
            self.compared = r
            if done.all():
                break
            stay = np.flatnonzero(alive[~done].any(axis=0))
            todo = todo[~done]
            if len(stay) < alive.shape[1]:
                cand = stay if cand is None else cand[stay]
        r, v = (np.concatenate(x) for x in zip(*out))
        # the final scores of those left (after the last round: of all whose bounds, now equal, reach the k-th)
        qk, xk = q.astype(kind), self.x.astype(kind)
        s = np.concatenate([np.einsum("ij,ij->i", qk[r[i : i + PAIRS]], xk[v[i : i + PAIRS]]) for i in range(0, max(len(r), 1), PAIRS)]).astype(np.int64)
        return r, self.ids[v], s, rounds

    def _own(self, qid: np.ndarray, cand: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Places (query, candidate) where both are one vec_id; ids are sorted."""
        ids = self.ids if cand is None else self.ids[cand]
        lo, hi = np.searchsorted(ids, qid, "left"), np.searchsorted(ids, qid, "right")
        row = np.repeat(np.arange(len(qid)), hi - lo)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[row]


def _ranked(r: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query place r, by place and rank; ties go to the smaller id."""
    order = np.lexsort((ids, -s, r))
    r, ids, s = r[order], ids[order], s[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], ids[keep], s[keep]


def _lane(shards, qid: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (query, vec, score) of the k best of each query in shards (ids, vectors) that are read one after the other.

    A query's k-th best score so far is to beat in the next shard.  Bounds are first compared after the round that the queries
    before had to reach, by some groups of queries a round earlier, so the start follows the data; results don't depend on it.
    """
    cuts = [0, *range(min(PILOT, len(qid)), len(qid), GROUP), len(qid)]  # a small group looks for the first start
    groups = [slice(i, j) for i, j in zip(cuts, cuts[1:]) if i < j]
    none = np.zeros(0, np.int64)
    best = [(none, none, none)] * len(groups)
    start = 0
    for ids, x in shards:
        held = Shard(ids, x)
        for n, g in enumerate(groups):
            r, v, s = best[n]
            count = np.bincount(r, minlength=g.stop - g.start)
            known = np.full(len(count), np.iinfo(np.int64).min)
            known[count == k] = s[np.cumsum(count)[count == k] - 1]
            found = held.left(qid[g], q[g], k, known, max(0, start - (n % 4 == 3)))
            start = held.compared
            best[n] = _ranked(*(np.concatenate(p) for p in zip(best[n], found[:3])), k)
    return tuple(np.concatenate(p) for p in zip(*((qid[g][r], v, s) for g, (r, v, s) in zip(groups, best))))


def _packed(vectors: DataFrame) -> DataFrame:
    """vec_id, n and q as bytes of the smallest integers that hold a batch: they are copied to many cells."""

    def run(batches):
        for b in batches:
            q = b.column(2)
            x = q.flatten().to_numpy(zero_copy_only=False)
            big = float(np.abs(x.astype(float)).max(initial=0))
            kind = next((t for t in (np.int8, np.int16, np.int32) if big <= np.iinfo(t).max), np.int64)
            size = np.concatenate([[0], np.cumsum(b.column(1).to_numpy(), dtype=np.int64)]) * np.dtype(kind).itemsize
            data = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(size), pa.py_buffer(x.astype(kind))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), data.cast(pa.binary())], ["vec_id", "n", "q"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("n").cast("int"), "q").mapInArrow(run, "vec_id long, n int, q binary")


def _matrix(t: pa.Table) -> np.ndarray:
    """The vectors of a table whose rows have one n; rows come from batches of several integer types."""
    n, q = t["n"][0].as_py(), t["q"].cast(pa.large_binary()).combine_chunks()
    q = pa.concat_arrays(q.chunks) if isinstance(q, pa.ChunkedArray) else q
    _, offs, data = q.buffers()
    offs, data = np.frombuffer(offs, np.int64, len(q) + 1, q.offset * 8), np.frombuffer(data, np.uint8)
    sizes = np.diff(offs) // n
    kinds = {w: np.dtype(f"i{w}") for w in np.unique(sizes)}
    out = np.empty((len(q), n), max(kinds.values(), key=lambda t: t.itemsize))
    for w, kind in kinds.items():
        rows = np.flatnonzero(sizes == w)
        out[rows] = data[offs[rows][:, None] + np.arange(n * w)].view(kind)
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest inner products.

    ``vectors`` and ``queries`` come from ``quantised``.  A query is compared with vectors of its own length
    and another vec_id; ties go to the smaller vec_id; repeated rows of a vec_id stay repeated.  A query
    without candidates has no rows.  Inner products must fit in 64 bits.
    """
    shards = max(1, -(-vectors.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    # A grid of lanes of shards and blocks of bounded size: each meets each other once, both dealt by an equal key.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    lanes = max(-(-shards // LANE), min(shards, -(-2 * cores // blocks)))

    def every(n: int):  # of one type with what pmod gives, as both sides are dealt by their hashes
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    cells_v = _packed(vectors).withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(shards).cast("long"))).withColumn("l", F.pmod("s", F.lit(lanes).cast("long"))).withColumn("b", every(blocks))
    cells_q = _packed(queries).withColumn("b", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks).cast("long"))).withColumn("l", every(lanes))

    def meet(v: pa.Table, q: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if v.num_rows and q.num_rows:
            s, ids, x = v["s"].to_numpy(), v["vec_id"].to_numpy(), _matrix(v)
            out = _lane(((ids[s == one], x[s == one]) for one in np.unique(s)), q["vec_id"].to_numpy(), _matrix(q), k)
        return pa.table({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    # cells are few bytes and much work: as many tasks as cells, never joined into few
    tasks = min(lanes * blocks, MOST_TASKS)
    found = (
        cells_v.select("l", "b", "n", "s", "vec_id", "q").repartition(tasks, "l", "b", "n")
        .groupBy("l", "b", "n")
        .cogroup(cells_q.select("l", "b", "n", "vec_id", "q").repartition(tasks, "l", "b", "n").groupBy("l", "b", "n"))
        .applyInArrow(meet, "query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
