"""Best-fit packing of tokenised documents into fixed-length sequences by a grouping genetic algorithm.

Pieces are dealt at random into cells of bounded size.  Each cell is packed on several islands: populations
of whole packings whose crossover injects well-filled bins of one parent into the other, removes the bins
that hold the same pieces, and puts the displaced pieces back: in the place of smaller ones that they fill better, else by best fit.  Between epochs an island's
best packing migrates to its neighbour.  Bins that stay badly filled are packed again together, across cells.
"""

from __future__ import annotations

import heapq
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, stash

CAPACITY, END_ID = 2048, 0
#: Pieces in a cell (about), islands a cell, packings an island, generations an epoch, epochs, levels.
CELL, ISLANDS, POPULATION, GENERATIONS, EPOCHS, LEVELS = 8192, 2, 6, 20, 2, 3
#: A bin filled to this share is final; others go to the next level.
FILLED = 0.985
#: Characters from which the slower library takes over, whose regular expressions need no stack.
LONG_TEXT = 400_000

_encoders: dict[tuple[str, bool], object] = {}


def encoder(path: str, special: bool = False):
    """text -> uint32 ids of the byte-level BPE in a ``tokenizers`` file, through its rank table where that is faster.

    Beside ``name.json`` the same vocabulary may lie as ``name.tiktoken``; both libraries then give the same ids
    (a test compares them), and only very long texts use the first.  With ``special``, special tokens in a text have
    ids of their own, as by the library's defaults; without, they are read as any text.
    """
    if (path, special) in _encoders:
        return _encoders[path, special]
    import base64
    import os

    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = not special
    ranks_path = path[: -len(".json")] + ".tiktoken"
    fast = None
    if os.path.exists(ranks_path):
        import tiktoken

        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={t.content: i for i, t in slow.get_added_tokens_decoder().items() if t.special} if special else {})

    def encode(text: str) -> np.ndarray:
        if fast is None or len(text) > LONG_TEXT:
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    _encoders[path, special] = encode
    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's tokens (its ids, then END_ID).

    A document of more than ``capacity`` tokens is cut into pieces of that length; the first takes the remainder.
    """

    def cut(batches):
        encode = encoder(tokenizer, special=True)
        for b in batches:
            rows = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                at, k = 0, 0
                while at < len(ids):
                    end = at + (len(ids) % capacity or capacity) if at == 0 else at + capacity
                    for column, x in zip(rows, (doc, k, at, end - at, zlib.crc32(ids[at:end].tobytes()))):
                        column.append(x)
                    at, k = end, k + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------ the genetic algorithm


def least_bins(sizes: list[int], capacity: int) -> int:
    """The bound of Martello and Toth: large pieces share no bin, the rest needs what they leave."""
    count = np.bincount(sizes, minlength=capacity + 1)
    total = count * np.arange(capacity + 1)
    n, t = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(total)])
    half, best = capacity // 2, -(-int(t[-1]) // capacity)
    for k in range(half + 1):
        large = n[capacity + 1] - n[capacity - k + 1]
        mid, mid_sum = n[capacity - k + 1] - n[half + 1], t[capacity - k + 1] - t[half + 1]
        low = t[half + 1] - t[k]
        best = max(best, int(large + mid + max(0, -(-int(low - (mid * capacity - mid_sum)) // capacity))))
    return best


def best_fit(bins: list[list[int]], free: list[int], items, sizes: list[int], capacity: int) -> None:
    """Put each item into the fullest bin that holds it, or a new one; a bit set of free room finds it."""
    room: dict[int, list[int]] = {}
    mask = 0
    for i, f in enumerate(free):
        if f:
            room.setdefault(f, []).append(i)
            mask |= 1 << f
    for x in items:
        s = sizes[x]
        above = mask >> s
        if above:
            f = s + ((above & -above).bit_length() - 1)
            at = room[f].pop()
            if not room[f]:
                mask &= ~(1 << f)
            bins[at].append(x)
        else:
            at, f = len(bins), capacity
            bins.append([x])
            free.append(0)
        free[at] = f - s
        if f - s:
            held = room.setdefault(f - s, [])
            held.append(at)
            mask |= 1 << (f - s)


def fitness(free: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins; among equals, room gathered in few bins."""
    return len(free), -float(np.square(np.array(free, float) / capacity).sum())


def exchange(bins: list[list[int]], free: list[int], displaced: list[int], sizes: list[int]) -> list[int]:
    """Displaced pieces, the largest first, take the place of a smaller one where that fills a bin best; what is left over goes on.

    Each exchange lessens the free room, so it ends.
    """
    slots = [(i, k) for i, f in enumerate(free) if f for k in range(len(bins[i]))]
    if not slots or not displaced:
        return list(displaced)
    where = np.array([i for i, _ in slots])
    size = np.array([sizes[bins[i][k]] for i, k in slots])
    room = np.array(free)
    heap, out = [(-sizes[x], x) for x in displaced], []
    heapq.heapify(heap)
    while heap:
        s, x = heapq.heappop(heap)
        left = room[where] - (-s - size)
        left[(size >= -s) | (left < 0)] = 1 << 40
        at = int(left.argmin())
        if left[at] == 1 << 40:
            out.append(x)
            continue
        i, k = slots[at]
        y, bins[i][k] = bins[i][k], x
        size[at], room[i], free[i] = -s, left[at], int(left[at])
        heapq.heappush(heap, (-sizes[y], y))
    return out


def crossover(a, b, sizes, capacity, rng):
    """Inject some of b's best-filled bins into a; pieces that this displaces are exchanged for smaller ones, the rest goes back by best fit."""
    (bins_a, _), (bins_b, free_b) = a, b
    order = sorted(range(len(free_b)), key=lambda i: free_b[i] + rng.random())
    many = max(1, int(len(order) * rng.uniform(0.1, 0.5)))
    picked = order[:many] if rng.random() < 0.5 else rng.sample(order[: max(many, len(order) * 2 // 3)], many)
    held = {x for i in picked for x in bins_b[i]}
    bins, free, displaced = [list(bins_b[i]) for i in picked], [free_b[i] for i in picked], []
    bins_left, free_left = [], []
    for group, f in zip(*a):
        if held.isdisjoint(group):
            bins_left.append(list(group))
            free_left.append(f)
        else:
            displaced += [x for x in group if x not in held]
    # mutation: the emptiest bins are dissolved too
    worst = sorted(range(len(free_left)), key=free_left.__getitem__, reverse=True)[: max(1, len(free_left) // 20)]
    for i in sorted(worst, reverse=True):
        displaced += bins_left.pop(i)
        free_left.pop(i)
    bins, free = bins + bins_left, free + free_left
    displaced = exchange(bins, free, displaced, sizes)
    displaced.sort(key=sizes.__getitem__, reverse=True)
    best_fit(bins, free, displaced, sizes, capacity)
    return bins, free


def evolve(sizes: list[int], capacity: int, seed: int, guests=(), generations: int | None = None):
    """The best packing (bins, free room) that one island finds in an epoch; it ends early at the lower bound."""
    rng, least = random.Random(seed), least_bins(sizes, capacity)
    people = [list(map(list, g)) for g in guests]
    for k in range(len(people), max(POPULATION, len(people) + 1)):
        noise = 0.0 if k == 0 else 0.1 * k
        order = sorted(range(len(sizes)), key=lambda x: -sizes[x] * (1 + noise * rng.random()))
        bins, free = [], []
        best_fit(bins, free, order, sizes, capacity)
        people.append([bins, free])
        if len(bins) == least:
            return bins, free
    for _ in range(GENERATIONS if generations is None else generations):
        people.sort(key=lambda p: fitness(p[1], capacity))
        if len(people[0][0]) == least:
            break
        i, j = rng.sample(range(len(people)), 2) if len(people) > 1 else (0, 0)
        people[-1] = list(crossover(people[i], people[j], sizes, capacity, rng))
    people.sort(key=lambda p: fitness(p[1], capacity))
    return people[0]


def _packed(uid: np.ndarray, sizes: list[int], bins, free, capacity: int, cell: int, island: int) -> pa.Table:
    order = np.array([x for g in bins for x in g], np.int64)
    which = np.repeat(np.arange(len(bins)), [len(g) for g in bins])
    length = np.array(sizes, np.int64)[order]
    before = np.concatenate([[0], np.cumsum(length)[:-1]])
    first = np.concatenate([[True], which[1:] != which[:-1]])
    offset = before - np.maximum.accumulate(np.where(first, before, 0))
    n, least = len(order), least_bins(sizes, capacity)
    return pa.table(
        {"cell": np.full(n, cell), "island": np.full(n, island, np.int32), "uid": uid[order], "length": length, "bin": which, "offset": offset, "free": np.array(free, np.int64)[which], "bins": np.full(n, len(bins)), "least": np.full(n, least)}
    )


SOLUTION = "cell long, island int, uid long, length long, bin long, offset long, free long, bins long, least long"


def pack_level(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """items (uid, length) -> uid, length, cell, bin, offset, free: one level of cells, islands and epochs."""
    cells = max(1, math.ceil(items.count() / CELL))
    dealt = items.withColumn("cell", F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(cells))).withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))

    def first(t: pa.Table) -> pa.Table:
        t = t.sort_by("uid")
        cell, island = t["cell"][0].as_py(), t["island"][0].as_py()
        sizes = t["length"].to_pylist()
        bins, free = evolve(sizes, capacity, 1000 * cell + island)
        return _packed(t["uid"].to_numpy(), sizes, bins, free, capacity, cell, island)

    def next_epoch(t: pa.Table) -> pa.Table:
        """Own packing and the neighbour's elite, told apart by ``origin``."""
        t = t.sort_by([("origin", "ascending"), ("uid", "ascending")])
        cell, island = t["cell"][0].as_py(), t["island"][0].as_py()
        guests = []
        for o in sorted(set(t["origin"].to_pylist())):
            own = t.filter(pa.compute.equal(t["origin"], o))
            uid, sizes, bins = own["uid"].to_numpy(), own["length"].to_pylist(), {}
            for x, b in enumerate(own["bin"].to_pylist()):
                bins.setdefault(b, []).append(x)
            groups = list(bins.values())
            guests.append([groups, [capacity - sum(sizes[x] for x in g) for g in groups]])
        bins, free = evolve(sizes, capacity, 77_777 + 1000 * cell + island, guests)
        return _packed(uid, sizes, bins, free, capacity, cell, island)

    columns = [x.split()[0] for x in SOLUTION.split(", ")]
    found = stash(dealt.select("cell", "island", "uid", "length").groupBy("cell", "island").applyInArrow(first, SOLUTION), f"pack{level}")
    for _ in range(EPOCHS - 1):
        poor = found.where("bins > least")
        if poor.isEmpty():
            break
        arrive = poor.withColumn("origin", F.col("island")).withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))
        both = poor.withColumn("origin", F.col("island")).unionByName(arrive)
        again = both.groupBy("cell", "island").applyInArrow(next_epoch, SOLUTION)
        found = stash(found.where("bins <= least").unionByName(again.select(*columns)), f"pack{level}")
    best = found.groupBy("cell").agg(F.min(F.struct("bins", "island")).alias("best")).select("cell", "best.island")
    return found.join(best, ["cell", "island"]).select("uid", "length", "cell", "bin", "offset", "free")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece.

    Null and empty texts are documents of the closing id alone; repeated rows are packed as often as they
    come; an empty table gives no rows; other columns are ignored.  Tokens are counted over whole texts.
    """
    small_batches(docs.sparkSession)
    held = stash(pieces(docs, tokenizer, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = held.where(F.col("length") >= capacity).select("uid", F.lit(-1).cast("long").alias("cell"), F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("level"))
    rest, level = held.where(F.col("length") < capacity).select("uid", "length"), 1
    while True:
        got = stash(pack_level(rest, capacity, level), f"level{level}")
        final = F.lit(True) if level == LEVELS else F.col("free") <= int(capacity * (1 - FILLED))
        placed = placed.unionByName(got.where(final).select("uid", "cell", "bin", "offset", F.lit(level).alias("level")))
        poor = got.where(~final)
        if level == LEVELS or poor.isEmpty():
            break
        rest, level = poor.select("uid", "length"), level + 1
    # a sequence is a bin of a cell of a level; full pieces have sequences of their own
    sequence = F.when(F.col("level") == 0, F.col("bin") * 4).otherwise((F.col("cell") * (1 << 20) + F.col("bin")) * 4 + F.col("level"))
    return held.join(placed.select("uid", sequence.alias("sequence_id"), "offset"), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
