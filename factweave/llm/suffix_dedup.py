"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that also starts elsewhere are removed.

1. Every window of LENGTH bytes has an anchor, the least-hashed gram inside, so equal windows have equal anchors.
   The windows of an anchor form a context; contexts are counted by anchor and content.  An anchor seen once has
   no repeated window; a context seen twice has only repeated ones.
2. Anchors with different contexts remain: their contexts are a group, one text of each is fetched.  The texts of a
   group are aligned at the anchor.  A group of more than WIDE texts is split in two by the place of the window: all windows of a
   half share a longer core, so texts whose cores differ part, and texts that are equal there become one.
   It goes on until a task can hold each group; at the latest a group of one window has one text.
3. The texts of groups are indexed in shards, each by its own Burrows-Wheeler transform over symbols of STRIDE bytes
   (one sequence for each residue, so every byte starts a suffix).
4. The shards' transforms are merged by interleave refinement: the interleave of suffixes ordered by h symbols
   gives that of h + 1 by one stable pass over the transforms' symbols; no suffix is compared or sorted again.
   Where a block splits gives the common prefix; blocks whole after LENGTH bytes are the repeated intervals.
5. Runs of repeated windows go back to the rows by (anchor, context), and the rows' bytes are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import passes, shared_bloom
from .common import drop_stash, fresh, give_back, mix, small_batches, spans_hash, stash, text_blocks, text_or_empty
from .exact_dedup import SALTS

LENGTH, GRAM, STRIDE = 400, 32, 100
#: Bytes of context texts merged at once in a task, and bytes of a shard.
MERGE_BYTES, SHARD_BYTES = 1 << 19, 1 << 17
#: Texts of one group that a task may hold; larger groups are split by longer cores until none is left.
WIDE = 1024
#: Bytes of a document that one pass looks at (windows across a cut belong to one side, none is lost).
PART = 1 << 19

_position = np.uint64((1 << 24) - 1)


def anchors(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(document, first window, last window, anchor, anchor hash, context hash) of a block; positions are in the block."""
    wide, n = length - gram + 1, len(buf)
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if n < length:
        return none
    start = np.arange(n - gram + 1)
    h = spans_hash(buf, start, start + gram)
    key = (h & ~_position) | start.astype(np.uint64)
    fill = -len(key) % wide
    key = np.concatenate([key, np.full(fill, 2**64 - 1, np.uint64)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    pick = (np.minimum(behind[:count], ahead[wide - 1 : wide - 1 + count]) & _position).astype(np.int64)
    doc = np.searchsorted(offs, np.arange(count), "right") - 1
    inside = np.arange(count) + length <= offs[doc + 1]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    pick, doc = pick[at], doc[at]
    new = np.concatenate([[True], (pick[1:] != pick[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1]
    p = pick[first]
    context = mix(spans_hash(buf, lo, hi + length) + (p - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return doc[first], lo, hi, p, h[p], context


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """uid, a, c, lo, hi, d: anchors and contexts of every row, in bytes of the row's text; the anchor stands d after lo."""

    def find(batches):
        for b in batches:
            uid, at = b.column(0).to_numpy(zero_copy_only=False), 0
            for _, buf, offs in text_blocks(b.column(1), PART):
                own = uid[at : at + len(offs) - 1]
                at += len(offs) - 1
                parts = [(0, buf, offs)] if len(buf) <= PART else [(i, buf[i : i + PART + length - 1], None) for i in range(0, len(buf), PART)]
                for base, piece, o in parts:
                    o = np.array([0, len(piece)]) if o is None else o
                    doc, lo, hi, p, a, c = anchors(piece, o, length)
                    if len(doc):
                        d = (p - lo).astype(np.int16)
                        lo, hi = lo + base - (o[doc] if base == 0 else 0), hi + base - (o[doc] if base == 0 else 0)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own[doc], a.view(np.int64), c.view(np.int64), lo.astype(np.int32), hi.astype(np.int32), d)], ["uid", "a", "c", "lo", "hi", "d"])
        give_back()

    return docs.mapInArrow(find, "uid long, a long, c long, lo int, hi int, d short")


# ------------------------------------------------------------ transforms and their merge


def stable_order(x: np.ndarray) -> np.ndarray:
    """A stable order of small numbers from 0 on: numpy sorts 16-bit keys by radix, so 16 bits at a time."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    high = (x >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def transform(sym: np.ndarray, nxt: np.ndarray, prev: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler symbols of one shard, by the first ``depth`` symbols.

    Entry e has the symbol ``sym[e]`` (0 for the empty suffix that ends a sequence), its following entry ``nxt`` and
    the symbol ``prev`` before it (0 if none).  Empty suffixes come first, in the order of their sequences.
    """
    ranks, at = [sym], nxt
    for _ in range(depth - 1):
        ranks.append(sym[at])
        at = nxt[at]
    order = stable_order(ranks[-1])
    for rank in ranks[-2::-1]:
        order = order[stable_order(rank[order])]
    return order, prev[order]


def refine(transforms: list[np.ndarray], ends: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge shards' transforms: (shard of each merged position, block of equal ``depth``-symbol prefixes).

    ``ends`` counts each shard's empty suffixes.  Every pass reads the transforms once, in the order of the last
    interleave, and deals the shard numbers stably by symbol.
    """
    sizes = [len(t) for t in transforms]
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    every = np.concatenate(transforms)
    shard = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    tops = np.repeat(np.arange(len(ends), dtype=np.uint16), ends)
    heads = np.concatenate([b + np.arange(s) for b, s in zip(base, sizes)])
    block = np.zeros(len(shard), np.int64)
    for _ in range(depth):
        by = np.argsort(shard, kind="stable")
        read = np.empty(len(shard), np.int64)  # the n-th entry of a shard reads its n-th symbol
        read[by] = heads
        symbol = every[read]
        inner = np.flatnonzero(symbol)
        order = inner[stable_order(symbol[inner])]
        s, old = symbol[order], block[order]
        split = np.concatenate([[1], (s[1:] != s[:-1]) | (old[1:] != old[:-1])]) if len(order) else np.zeros(0, np.int64)
        block = np.concatenate([np.arange(len(tops)), len(tops) + np.cumsum(split)])
        shard = np.concatenate([tops, shard[order]])
    return shard, block


def repeated_windows(texts: list[bytes], length: int = LENGTH, stride: int = STRIDE, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """For all texts in a row, a flag at each byte: the string of ``length`` bytes from here also starts elsewhere."""
    depth = length // stride
    if depth * stride != length:
        raise ValueError("the length must be a multiple of the stride")
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    flags = np.zeros(len(buf), bool)
    sizes = np.diff(offs)
    whole = np.maximum(sizes - stride + 1, 0)  # positions where a full symbol starts
    pos = np.concatenate([np.arange(o, o + w) for o, w in zip(offs, whole)]) if len(texts) else np.zeros(0, np.int64)
    if not len(pos):
        return flags
    _, rank = np.unique(spans_hash(buf, pos, pos + stride), return_inverse=True)
    at = np.full(len(buf) + 1, -1, np.int64)
    at[pos] = rank.astype(np.int32) + 1
    # shards of whole texts
    cut, shards = 0, []
    while cut < len(texts):
        end = max(cut + 1, int(np.searchsorted(offs, offs[cut] + shard_bytes, "right")) - 1)
        shards.append((cut, end))
        cut = end
    transforms, ends, places = [], [], []
    for i, j in shards:
        p = np.arange(offs[i], offs[j])
        stop = np.repeat(offs[i + 1 : j + 1], sizes[i:j])
        begin = np.repeat(offs[i:j], sizes[i:j])
        full = p + stride <= stop
        seq_start = p < begin + stride  # each residue of each text that has a symbol starts a sequence
        q = p[full]
        tails = np.flatnonzero(seq_start & full)
        # entries: the empty suffixes (one a sequence), then the suffixes with symbols
        n_end = len(tails)
        entry = np.full(len(p), -1, np.int64)
        entry[np.flatnonzero(full)] = n_end + np.arange(len(q))
        nxt = np.zeros(n_end + len(q), np.int64)
        sym = np.concatenate([np.zeros(n_end, np.int64), at[q]])
        prev = np.zeros(n_end + len(q), np.int64)
        off, lim, beg = q - offs[i], stop[full], begin[full]
        following = np.where(q + 2 * stride <= lim, entry[np.minimum(off + stride, len(p) - 1)], -1)
        last = np.flatnonzero(following < 0)
        # the last suffix of each sequence is followed by that sequence's empty one: sequences by (text, residue)
        key = (np.searchsorted(offs, q[last], "right") - 1) * stride + (q[last] - beg[last]) % stride
        order = np.argsort(key, kind="stable")
        ending = np.empty(len(last), np.int64)
        ending[order] = np.arange(len(last))
        following[last] = ending
        nxt[n_end:] = following
        nxt[:n_end] = np.arange(n_end)
        before = q - stride >= beg
        prev[n_end:] = np.where(before, at[np.maximum(q - stride, 0)], 0)
        prev[ending] = at[q[last]]
        order, bwt = transform(sym, nxt, prev, depth)
        transforms.append(bwt)
        ends.append(n_end)
        places.append(np.where(order < n_end, -1, np.concatenate([np.full(n_end, -1), q])[order]))
    shard, block = refine(transforms, ends, depth)
    by = np.argsort(shard, kind="stable")
    place = np.empty(len(shard), np.int64)
    place[by] = np.concatenate(places)
    many = np.bincount(block, minlength=block.max() + 1)[block] > 1
    flags[place[many & (place >= 0)]] = True
    return flags


def _ranges(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def _merge(length: int, stride: int):
    """Sorted (g, k, x) rows -> (g, k, m): runs [lo, hi) of the windows of each text that other texts of its group have."""

    def flush(rows):
        flags = repeated_windows([r[2] for r in rows], length, stride)
        g, k, m, at = [], [], [], 0
        for r in rows:
            lo, hi = _ranges(flags[at : at + len(r[2]) - length + 1])
            at += len(r[2])
            if lo:
                g.append(r[0])
                k.append(r[1])
                m.append([{"lo": x, "hi": y} for x, y in zip(lo, hi)])
        return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(k, pa.int64()), pa.array(m, RUNS_ARROW)], ["g", "k", "m"])

    def run(batches):
        rows, size, seen = [], 0, set()
        for b in batches:
            for g, k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if rows and g != rows[-1][0]:
                    seen = set()
                    if size > MERGE_BYTES:
                        yield flush(rows)
                        rows, size = [], 0
                if k in seen:  # fetched from two rows with one uid
                    continue
                seen.add(k)
                rows.append((g, k, x.as_py()))
                size += len(rows[-1][2])
        if rows:
            yield flush(rows)
        give_back()

    return run


RUNS = "array<struct<lo: int, hi: int>>"
RUNS_ARROW = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
HALF = pa.schema([("g", pa.int64()), ("k", pa.int64()), ("g2", pa.int64()), ("k2", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("w", pa.int32()), ("n", pa.int64()), ("x", pa.binary())])


def _merged(texts: DataFrame, length: int, stride: int) -> DataFrame:
    """(g, k, m) of texts (g, k, x, ...) of groups that a task can hold."""
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select("g", "k", "x").repartition(width, "g").sortWithinPartitions("g", "k").mapInArrow(_merge(length, stride), f"g long, k long, m {RUNS}")


def _halves(length: int):
    """Texts of a group with windows [i, j) -> their parts in the two halves of that range.

    Places are relative to the anchor; ``w`` is a text's first window.  Windows [u, v) all hold the bytes [v - 1, u + length):
    with them the group's key goes on.
    """

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                out = []
                for r in b.slice(at, 4096).to_pylist():
                    x, w, end = r["x"], r["w"], r["w"] + len(r["x"]) - length + 1
                    middle = (r["i"] + r["j"]) // 2
                    for u, v in ((r["i"], middle), (middle, r["j"])):
                        p, q = max(w, u), min(end, v)
                        if p < q:
                            part = x[p - w : q - 1 + length - w]
                            core = x[v - 1 - w : u + length - w]
                            out.append((r["g"], r["k"], _key(core, r["g"], u), _key(part, r["g"], u, p), u, v, p, r["n"], part))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(HALF)], schema=HALF)

    return run


def _key(x: bytes, *more: int) -> int:
    h = hashlib.blake2b(x, digest_size=8, key=b",".join(str(m).encode() for m in more))
    return int.from_bytes(h.digest(), "little", signed=True)


def _wide(texts: DataFrame, length: int, stride: int, gram: int) -> DataFrame:
    """(a, c, m) of the texts (g, k, w, n, x) of groups too large for one task.

    ``links`` tells which parts (g, k) of which window on stand for a context (a, c); equal parts are one, counted by ``n``.
    """
    hot = texts.select("g", "k", F.lit(gram - length).cast("int").alias("i"), F.lit(1).alias("j"), "w", "n", "x")
    links = hot.select(F.col("g").alias("a"), F.col("k").alias("c"), "g", "k", "w", F.col("w").alias("w0"))
    done = None
    while not hot.isEmpty():
        split = stash(hot.mapInArrow(_halves(length), "g long, k long, g2 long, k2 long, i int, j int, w int, n long, x binary"), "halves")
        parts = split.groupBy("g2", "k2").agg(*(F.first(c).alias(c) for c in ("i", "j", "w", "x")), F.sum("n").alias("n")).withColumnsRenamed({"g2": "g", "k2": "k"})
        # counted by (group, part of the group) first, and joined by it, so a group of any size comes to many tasks
        parts = parts.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(SALTS)))
        kinds = parts.groupBy("g", "salt").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
        kinds = kinds.groupBy("g").agg(F.sum("c").alias("kinds"), F.sum("s").alias("total"), F.collect_list("salt").alias("salts")).where("total > 1")
        parts = stash(parts.join(kinds.select("g", "kinds", F.explode("salts").alias("salt")).hint("merge"), ["g", "salt"]).drop("salt"), "parts")
        moved = split.select("g", "k", "g2", "k2", F.col("w").alias("w2")).join(parts.select(F.col("g").alias("g2"), F.col("k").alias("k2"), "n"), ["g2", "k2"])
        links = stash(links.join(moved.hint("merge"), ["g", "k"]).select("a", "c", F.col("g2").alias("g"), F.col("k2").alias("k"), F.col("w2").alias("w"), "w0", "n"), "links")
        whole = F.array(F.struct(F.lit(0).alias("lo"), (F.length("x") - length + 1).alias("hi")))
        runs = parts.where("n > 1").select("g", "k", whole.alias("m"))
        runs = runs.unionByName(_merged(parts.where((F.col("kinds") > 1) & (F.col("kinds") <= WIDE)), length, stride).join(parts.where("n = 1").select("g", "k"), ["g", "k"]))
        got = links.join(runs.hint("merge"), ["g", "k"])
        got = got.select("a", "c", F.transform("m", lambda r: F.struct((r["lo"] + F.col("w") - F.col("w0")).alias("lo"), (r["hi"] + F.col("w") - F.col("w0")).alias("hi"))).alias("m"))
        got = stash(got, "runs")
        done = got if done is None else done.unionByName(got)
        # what occurs twice is marked as a whole, but other texts of its group may still share some of it
        hot, links = parts.where(F.col("kinds") > WIDE).drop("kinds"), links.where("n = 1").drop("n")
    return None if done is None else done.groupBy("a", "c").agg(F.flatten(F.collect_list("m")).alias("m"))


def repeats(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """docs (uid, text) -> uid, spans: array of (lo, hi), byte ranges covered by repeated strings."""
    seen = stash(occurrences(docs, length), "anchors")
    rep = F.struct("uid", F.col("lo").alias("l"), F.col("hi").alias("h"), "d")
    contexts = seen.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(rep).alias("rep"))
    contexts = stash(contexts, "contexts")
    totals = contexts.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    live = stash(contexts.join(totals, "a").select("a", "c", "n", "rep.*", "kinds"), "live")
    drop_stash(contexts)

    # texts of the contexts of anchors that have several
    several = live.where("kinds > 1").groupBy("uid").agg(F.collect_list(F.struct("a", "c", "l", "h", "d", "n", "kinds")).alias("cuts"))
    several = stash(several, "cuts")
    maybe = passes(shared_bloom(several.select("uid")))

    def slices(batches):
        for b in batches:
            out = []
            for text, cuts in zip(b.column(0), b.column(1).to_pylist()):
                raw = text.as_py().encode()
                out += [(x["a"], x["c"], -x["d"], x["n"], x["kinds"], raw[x["l"] : x["h"] + length]) for x in cuts]
                if len(out) > 5000:
                    yield _rows(out)
                    out = []
            yield _rows(out)
        give_back()

    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["g", "k", "w", "n", "kinds", "x"])

    found = docs.where(maybe("uid")).join(several, "uid").select("text", "cuts").mapInArrow(slices, "g long, k long, w int, n long, kinds long, x binary")
    texts = stash(found, "texts")
    small, large = texts.where(F.col("kinds") <= WIDE), texts.where(F.col("kinds") > WIDE).dropDuplicates(["g", "k"])
    marks = _merged(small, length, stride).select(F.col("g").alias("a"), F.col("k").alias("c"), "m")
    wide = _wide(stash(large, "wide"), length, stride, GRAM)
    marks = marks if wide is None else marks.unionByName(wide)

    # contexts seen twice are repeated as a whole; every context has one row of marks
    marks = marks.join(live.where("n = 1").select("a", "c"), ["a", "c"])
    whole = F.array(F.struct(F.lit(0).alias("lo"), (F.col("h") - F.col("l") + 1).alias("hi")))
    marks = marks.unionByName(live.where("n > 1").select("a", "c", whole.alias("m")))
    # both sides are plain exchanges, so the adaptive join splits a context that a third of all rows hold
    rows = seen.select("uid", "a", "c", F.col("lo").alias("at"))
    spans = F.transform("m", lambda r: F.struct((F.col("at") + r["lo"]).alias("lo"), (F.col("at") + r["hi"] - 1 + length).alias("hi")))
    hits = rows.join(marks.hint("merge"), ["a", "c"]).select("uid", spans.alias("m"))
    return hits.groupBy("uid").agg(F.flatten(F.collect_list("m")).alias("spans"))


def _union(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _cut(raw: bytes, spans) -> tuple[bytes, int]:
    """What is left of raw, and the number of removed runs."""
    at, kept, runs = 0, [], _union((x["lo"], x["hi"]) for x in spans or ())
    for lo, hi in runs:
        kept.append(raw[at:lo])
        at = hi
    return b"".join([*kept, raw[at:]]), len(runs)


def _apply(docs: DataFrame, length: int, stride: int, finish, schema) -> DataFrame:
    """``finish(batch, spans of its rows)`` over all rows; only rows that lose something are joined with their spans."""
    uid, held = fresh(docs, "uid"), fresh(docs, "spans")
    small_batches(docs.sparkSession)
    rows = docs.withColumn(uid, F.xxhash64("doc_id", text_or_empty()))
    spans = stash(repeats(rows.select(F.col(uid).alias("uid"), text_or_empty().alias("text")), length, stride), "spans")
    held_bloom = shared_bloom(spans.select("uid"))

    def cut(batches):
        for b in batches:
            yield finish(pa.RecordBatch.from_arrays(b.columns[:-1], b.schema.names[:-1]), b.column(b.num_columns - 1).to_pylist())
        give_back()

    def same(batches):
        for b in batches:
            b = b.filter(pa.array(~held_bloom.value.has(b.column(b.num_columns - 1).to_numpy(zero_copy_only=False))))
            yield finish(pa.RecordBatch.from_arrays(b.columns[:-1], b.schema.names[:-1]), [None] * b.num_rows)
        give_back()

    spans = spans.select(F.col("uid").alias(uid), F.col("spans").alias(held))
    hit = rows.where(passes(held_bloom)(uid)).join(spans.hint("merge"), uid, "left").select(*docs.columns, held).mapInArrow(cut, schema)
    return hit.unionByName(rows.select(*docs.columns, uid).mapInArrow(same, schema))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is kept) of every row.

    Null texts are empty; texts shorter than ``length`` bytes lose nothing.  Repeated rows repeat each other's text and
    lose all of it from ``length`` bytes on.  A character of which a byte is removed is missing in ``text``, its other bytes
    count in the digest.  Other columns are ignored; an empty table gives no rows.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def finish(b, spans):
        out = []
        for text, s in zip(b.column(1), spans):
            raw = (text.as_py() or "").encode()
            left, n = _cut(raw, s)
            out.append((len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate(kinds))], names)

    return _apply(docs.select("doc_id", "text"), length, stride, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def clean(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """The rows of ``docs`` with their kept text (and ``n_chars`` of it, if there is such a column).

    A character of which a byte is removed goes as a whole.  Null texts stay null.
    """
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def finish(b, spans):
        out = []
        for text, s in zip(b.column(at), spans):
            t = text.as_py()
            out.append(t if t is None or not s else _cut(t.encode(), s)[0].decode("utf-8", "ignore"))
        columns = list(b.columns)
        columns[at] = pa.array(out, b.schema.field(at).type)
        if chars is not None:
            columns[chars] = pa.array([n if t is None or not s else len(t) for n, t, s in zip(b.column(chars).to_pylist(), out, spans)], b.schema.field(chars).type)
        return pa.RecordBatch.from_arrays(columns, b.schema.names)

    return _apply(docs, length, stride, finish, docs.schema)
