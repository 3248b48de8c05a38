"""SentencePiece encoding and decoding with a max-plus parallel scan over the chunks of giant documents.

The file's model is a BPE, so a segmentation is right exactly when every two neighbouring pieces are what
the library makes of their joined text (a merge across a boundary would be the first such merge in the pair
alone as well).  Path weights are therefore 0 (every pair stands) or minus infinity, and the one path of weight 0 is the
encoding.  A chunk's transfer matrix holds the weights between the pieces that may cover its first character and
those that may cover the first character after it; matrices combine associatively in max-plus algebra, the boundary
states are read back, and each chunk is then backtraced on its own between two known pieces.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, stash

#: Characters in a chunk; documents up to this size are one chunk.
CHUNK = 16_384
#: Characters beyond a cut in which two segmentations are expected to meet; doubled until they do.
WINDOW = 64

#: Matrices of neighbouring chunks that are combined at once.
FAN = 64

_codecs: dict[str, "Codec"] = {}


def codec(path: str) -> "Codec":
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


class Codec:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2:
            raise ValueError("the boundary states here are those of a BPE model")
        spec = model.normalizer_spec
        self.identity = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        self.prefix = spec.add_dummy_prefix
        spec.ClearField("precompiled_charsmap")
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.size = np.array([self._chars(p) for p in model.pieces], np.int64)
        self.longest = int(max(self.size.max(), 1))
        self.bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b"" if p.type == 3 else " ⁇ ".encode() if p.type == 2 else p.piece.replace("▁", " ").encode() for p in model.pieces]

    @staticmethod
    def _chars(piece) -> int:
        if piece.type == 6:  # a byte: the first of a character stands for all of it
            b = int(piece.piece[3:5], 16)
            return int(b < 0x80 or b >= 0xC0)
        return 1 if piece.type == 2 else 0 if piece.type == 3 else len(piece.piece)

    def normal(self, text: str) -> str:
        """What is segmented: the library's normal form with marks for spaces and the leading mark."""
        if not text:
            return ""
        if self.identity:
            return ("▁" if self.prefix else "") + text.replace(" ", "▁")
        return self.whole.normalize(text)

    def ids(self, s: str) -> list[int]:
        return self.part.encode(s, num_threads=1) if s else []

    def spans(self, s: str, at: int) -> list[tuple[int, int]]:
        """(start, end) of the pieces of s, which begins at ``at``; a character's bytes are one piece."""
        n = self.size[self.ids(s)]
        ends = np.cumsum(n)[n > 0] + at
        starts = np.concatenate([[at], ends[:-1]])
        return list(zip(starts.tolist(), ends.tolist()))


# ------------------------------------------------------------ transfer matrices


def transfer(c: Codec, s: str, base: int, lo: int, hi: int, first: bool, last: bool) -> dict:
    """{state at lo: {state at hi: 0.0}} of one chunk; absent pairs weigh minus infinity.

    ``s`` is the text from ``base`` on, with a margin around [lo, hi).  A state is the (start, end) of the piece
    that covers the character at a cut; at the document's end it is (hi, hi).
    """
    text = lambda a, b: s[a - base : b - base]
    starts = [lo] if first else [p for p in range(lo - c.longest + 1, lo + 1) if p >= base]
    ends = [hi] if last else [e for e in range(hi + 1, hi + c.longest + 1) if e <= base + len(s)]
    whole = c.spans(text(starts[0], ends[-1]), starts[0])
    known = {x: i for i, x in enumerate(whole)}
    left, right = {}, {}
    for p in starts:
        width = WINDOW
        while True:
            end = min(lo + width, ends[-1])
            run = c.spans(text(p, end), p)
            meet = next((known[x] for x in run if x in known), None)
            if meet is not None or end == ends[-1]:
                left[p] = (run[0] if run else (p, p), meet)
                break
            width *= 2
    for e in ends:
        width = WINDOW
        while True:
            begin = max(hi - width, starts[0])
            run = c.spans(text(begin, e), begin)
            meet = next((known[x] for x in reversed(run) if x in known), None)
            if meet is not None or begin == starts[0]:
                right[e] = (run[-1] if run else (e, e), meet)
                break
            width *= 2
    out: dict = {}
    for p, (a, i) in left.items():
        if not first and not a[0] <= lo < a[1]:
            continue
        for e, (b, j) in right.items():
            x, y = a, b
            if i is None or j is None or i > j:  # no common piece in between: segment the pair's own text
                run = c.spans(text(p, e), p)
                x, y = run[0], run[-1]
                if not first and not x[0] <= lo < x[1]:
                    continue
            y = (hi, hi) if last else y
            if last or y[0] <= hi < y[1]:
                out.setdefault(x, {})[y] = 0.0
    return out


def combine(a: dict, b: dict) -> dict:
    """The max-plus product of two transfer matrices; it is associative."""
    out: dict = {}
    for x, row in a.items():
        best: dict = {}
        for m, w in row.items():
            for y, v in b.get(m, {}).items():
                if w + v > best.get(y, -np.inf):
                    best[y] = w + v
        if best:
            out[x] = best
    return out


def boundary_states(matrices: list[dict], ends: tuple | None = None) -> list[tuple[int, int]]:
    """The state at each cut (one more than there are chunks): products over halves, then read back from the middle outwards.

    ``ends`` gives the first and the last state where they are known.
    """
    tree: dict[tuple[int, int], dict] = {}

    def build(i: int, j: int) -> dict:
        if (i, j) not in tree:
            tree[i, j] = matrices[i] if j - i == 1 else combine(build(i, (i + j) // 2), build((i + j) // 2, j))
        return tree[i, j]

    states: list = [None] * (len(matrices) + 1)
    whole = build(0, len(matrices))
    states[0], states[-1] = ends or max(((x, y) for x, row in whole.items() for y in row), key=lambda p: whole[p[0]][p[1]])
    stack = [(0, len(matrices))]
    while stack:
        i, j = stack.pop()
        if j - i > 1:
            m = (i + j) // 2
            a, b = build(i, m)[states[i]], build(m, j)
            states[m] = max((x for x in a if states[j] in b.get(x, {})), key=lambda x: a[x] + b[x][states[j]])
            stack += [(i, m), (m, j)]
    return states


def _held(t: pa.Table) -> tuple[list[int], list[dict]]:
    """The numbers and matrices of a group's chunks, in order."""
    held: dict[int, dict] = {}
    for x in t.select(["chunk", "a", "b", "w"]).to_pylist():
        held.setdefault(x["chunk"], {}).setdefault(tuple(x["a"]), {})[tuple(x["b"])] = x["w"]
    return sorted(held), [held[k] for k in sorted(held)]


def _fold(t: pa.Table) -> pa.Table:
    """The product of a group's matrices, as one of the next level."""
    _, matrices = _held(t)
    while len(matrices) > 1:
        matrices = [combine(*matrices[k : k + 2]) if k + 1 < len(matrices) else matrices[k] for k in range(0, len(matrices), 2)]
    row, chunk = t["row"][0].as_py(), t["up"][0].as_py()
    return pa.Table.from_pylist([{"row": row, "chunk": chunk, "a": list(p), "b": list(q), "w": w} for p, r in matrices[0].items() for q, w in r.items()], schema=ENTRY)


def _unfold(t: pa.Table) -> pa.Table:
    """The states around each of a group's matrices, between the two that the level above has found for the group."""
    chunks, matrices = _held(t)
    got = boundary_states(matrices, (tuple(t["enter"][0].as_py()), tuple(t["leave"][0].as_py())))
    n = len(chunks)
    return pa.table({"row": pa.array([t["row"][0].as_py()] * n, pa.int64()), "chunk": pa.array(chunks, pa.int32()), "enter": pa.array([list(x) for x in got[:-1]], pa.list_(pa.int64())), "leave": pa.array([list(x) for x in got[1:]], pa.list_(pa.int64()))})


def _scan(matrices: DataFrame, chunks: int, fan: int) -> DataFrame:
    """(row, chunk, enter, leave) from matrices (row, chunk, a, b, w) of documents of at most ``chunks`` chunks.

    Level by level, ``fan`` neighbours are combined to one until each document has one matrix; its best path gives the outer
    states, and the levels are read back in turn.  No task holds more than ``fan`` matrices of a document.
    """
    levels, now = [], matrices
    while chunks > 1:
        now = now.withColumn("up", F.floor(F.col("chunk") / fan).cast("int"))
        levels.append(now)
        now = stash(now.groupBy("row", "up").applyInArrow(_fold, "row long, chunk int, a array<long>, b array<long>, w double"), "fold")
        chunks = -(-chunks // fan)
    # equal weights: the path that sorts first
    best = now.groupBy("row", "chunk").agg(F.min(F.struct((-F.col("w")).alias("w"), "a", "b")).alias("m"))
    states = best.select("row", "chunk", F.col("m.a").alias("enter"), F.col("m.b").alias("leave"))
    for level in reversed(levels):
        known = states.select("row", F.col("chunk").alias("up"), "enter", "leave")
        states = level.join(known.hint("merge"), ["row", "up"]).groupBy("row", "up").applyInArrow(_unfold, "row long, chunk int, enter array<long>, leave array<long>")
    return states


def chunk_ids(c: Codec, s: str, base: int, enter: tuple[int, int], leave: tuple[int, int]) -> list[int]:
    """Backtrace: the ids from the entering piece up to, not including, the leaving one."""
    return c.ids(s[enter[0] - base : leave[0] - base])


# ------------------------------------------------------------ the operator


def encode(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """The ids of every row by chunk: both parts of ``encode_parts`` together."""
    small, giant = encode_parts(docs, model, chunk)
    return small.unionByName(giant)


def encode_parts(docs: DataFrame, model: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Documents of one chunk, and giant documents, as row, doc_id, chunk, chunks, ids of every row, in chunk order 0, 1, ...; ids equal the library's of the whole text.

    Null and empty texts give one chunk without ids.  Repeated rows stay repeated (``row`` tells them apart); other columns are
    ignored; texts of any length are encoded whole.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    small = F.coalesce(F.length("text"), F.lit(0)) < chunk

    def one(batches):
        c = codec(model)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [np.array(c.ids(c.normal(t.as_py() or "")), np.int32) for t in part.column(2)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(ids, pa.list_(pa.int32()))], ["row", "doc_id", "chunk", "chunks", "ids"])

    def cut(batches):
        c = codec(model)
        margin = c.longest + 1  # states on either side of a cut reach so far
        for b in batches:
            for row, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = c.normal(text.as_py())
                at = [*range(0, max(len(s) - chunk // 2, 1), chunk), len(s)]
                k = len(at) - 1
                for i in range(k):
                    begin = max(0, at[i] - margin)
                    yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc, "chunk": i, "chunks": k, "base": begin, "lo": at[i], "hi": at[i + 1], "s": s[begin : at[i + 1] + margin]}], schema=SLICE)

    def matrices(batches):
        c = codec(model)
        for b in batches:
            out = []
            for x in b.to_pylist():
                m = transfer(c, x["s"], x["base"], x["lo"], x["hi"], x["chunk"] == 0, x["chunk"] == x["chunks"] - 1)
                out += [{"row": x["row"], "chunk": x["chunk"], "a": list(p), "b": list(q), "w": w} for p, r in m.items() for q, w in r.items()]
            yield pa.RecordBatch.from_pylist(out, schema=ENTRY)

    def trace(batches):
        c = codec(model)
        for b in batches:
            ids = [chunk_ids(c, x["s"], x["base"], x["enter"], x["leave"]) for x in b.to_pylist()]
            keep = [b.column(b.schema.get_field_index(n)) for n in ("row", "doc_id", "chunk", "chunks")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ids, pa.list_(pa.int32()))], ["row", "doc_id", "chunk", "chunks", "ids"])

    out = "row long, doc_id long, chunk int, chunks int, ids array<int>"
    slices = stash(rows.where(~small).mapInArrow(cut, "row long, doc_id long, chunk int, chunks int, base long, lo long, hi long, s string").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row", "chunk"), "slices")
    most = slices.agg(F.max("chunks")).first()[0] or 0
    known = _scan(stash(slices.mapInArrow(matrices, "row long, chunk int, a array<long>, b array<long>, w double"), "matrices"), most, FAN)
    giant = slices.join(known.hint("merge"), ["row", "chunk"]).mapInArrow(trace, out)
    return rows.where(small).mapInArrow(one, out), giant


SLICE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("base", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("s", pa.string())])
ENTRY = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("w", pa.float64())])


def decode_chunk(c: Codec, ids, chunk: int) -> bytes:
    """The UTF-8 text of a chunk's ids; the first chunk drops the leading mark."""
    raw = b"".join(map(c.bytes.__getitem__, ids))
    return raw[1:] if chunk == 0 and c.prefix and raw[:1] == b" " else raw


def decode(ids: list[int], model: str) -> str:
    """The text of a document's ids; bytes that are no UTF-8 become replacement characters."""
    return decode_chunk(codec(model), ids, 0).decode("utf-8", "replace")


def summary(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), n_chunks, decoded_sha256 of every row.

    Chunks are decoded each on its own; checksum and digest run over a document's chunks in order.
    """

    names = ["doc_id", "n_tokens", "ids_crc32", "n_chunks", "decoded_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def single(batches):  # a document of one chunk: its matrices have one path, so ids and digests come at once
        c = codec(model)
        for b in batches:
            got = []
            for x in b.column(1):
                ids = c.ids(c.normal(x.as_py() or ""))
                got.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), 1, hashlib.sha256(decode_chunk(c, ids, 0)).hexdigest()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([g[k] for g in got], t) for k, t in enumerate(kinds[1:]))], names)
        give_back()

    def several(batches):
        """Rows sorted by (row, chunk): checksum and digest run on from batch to batch, so no document is held whole."""
        c, last, doc, n, crc, k, sha = codec(model), None, None, 0, 0, 0, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((doc, n, crc, k, sha.hexdigest()), kinds)], names)

        for b in batches:
            for row, doc_id, chunk, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                if row != last:
                    if last is not None:
                        yield done()
                    last, doc, n, crc, k, sha = row, doc_id, 0, 0, 0, hashlib.sha256()
                ids = ids.as_py()
                n, crc, k = n + len(ids), zlib.crc32(np.array(ids, "<u4").tobytes(), crc), k + 1
                sha.update(decode_chunk(c, ids, chunk))
        if last is not None:
            yield done()
        give_back()

    _, giant = encode_parts(docs, model, chunk)
    dealt = giant.select("row", "doc_id", "chunk", "ids").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row").sortWithinPartitions("row", "chunk")
    small = docs.where(F.coalesce(F.length("text"), F.lit(0)) < chunk)
    schema = "doc_id long, n_tokens long, ids_crc32 long, n_chunks int, decoded_sha256 string"
    return small.select("doc_id", "text").mapInArrow(single, schema).unionByName(dealt.mapInArrow(several, schema))
